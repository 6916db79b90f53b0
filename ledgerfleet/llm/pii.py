"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the whole text:
at-signs, URL schemes, adjacent digits (also across a dot, space or hyphen), a
plus sign before a digit, and cue words of identifiers.  From each anchor a
deterministic local parser expands to the boundaries of a candidate and
validates it:

=======  ======================  ==============================================
kind     anchor                  expansion and validation
=======  ======================  ==============================================
email    ``@``                   local part to the left, dotted domain to the
                                 right
ip       digit ``.`` digit       four dotted numbers of at most 255
card     two digits, also        16 to 19 digits that pass Luhn
         across space, hyphen
phone    ``+`` digit             8 to 15 digits
login    ``://``                 a URL with a user name before its host
iban     ``iban``                country, check digits, account, of the country's
                                 length; modulo 97 is 1
account  ``account``, ``ssn``    a number of 6 to 18 digits after the cue
=======  ======================  ==============================================

The first four are the base kinds; within a kind, spans are leftmost and do
not overlap, and a failing candidate is dropped without a retry.  Anchors
inside an expanded candidate are skipped, so the work is linear in the text.

Spans are code points, end exclusive.  Null texts count as empty and have no
spans; repeated rows are scanned one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "iban", "account")
SPANS = "array<struct<kind: string, start: int, end: int>>"
CUES = {"iban": "iban", "account": "account", "acct": "account", "konto": "account", "compte": "account",
        "cuenta": "account", "ssn": "account", "passport": "account"}

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_IP_RUN = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CARD_RUN = re.compile(r"[0-9 -]+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://[^\s/@:]+(?::[^\s/@]*)?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-.")
_IBAN = re.compile(r"[ :=#]*([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){10,30})")
_IBAN_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
_IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN_SIZE = {country: size for size, own in _IBAN_SIZES.items() for country in own.split()}
_ACCOUNT = re.compile(r"(?:[ ]?(?:no|nr|number|id)\b)?[ .:=#]*([0-9](?:[ -]?[0-9]){5,17})(?![0-9])", re.IGNORECASE)


def anchors():
    """The automaton: pattern to (parser, place of the anchor in the pattern)."""
    import ahocorasick
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("login", 3))
    for a in _DIGITS:
        found.add_word("+" + a, ("phone", 2))
        for b in _DIGITS:
            found.add_word(f"{a}.{b}", ("ip", 3))
            for joint in ("", " ", "-"):
                found.add_word(a + joint + b, ("card", 2 + len(joint)))
    for cue, kind in CUES.items():
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, (kind, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if k % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _iban_valid(text: str) -> bool:
    own = text.replace(" ", "").upper()
    return 15 <= len(own) <= 34 and int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1


def _iban_end(text: str, start: int, end: int) -> int | None:
    """Where the IBAN that starts at ``start`` ends, at ``end`` at the latest:
    after the length of its country, or for a country without a known length
    the last end of a word that makes it valid."""
    size = IBAN_SIZE.get(text[start:start + 2].upper())
    ends = [m.start() for m in _IBAN_END.finditer(text, start, min(end + 1, len(text))) if m.start() <= end]
    for at in reversed(ends):
        own = text[start:at]
        if (size is None or len(own) - own.count(" ") == size) and _iban_valid(own):
            return at
    return None


def _run_start(text: str, at: int, floor: int, members) -> int:
    while at > floor and text[at - 1] in members:
        at -= 1
    return at


def find_spans(text: str, automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a whole text, ordered by kind as listed, then by
    start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)          # where each kind's last candidate ended
    for last, (kind, size) in automaton.iter(text):
        start = last + 1 - size
        if start < done[kind]:
            continue
        if kind == "email":
            left = _run_start(text, start, done["email"], _LOCAL)
            own = _DOMAIN.match(text, start + 1) if left < start else None
            if own:
                found["email"].append((left, own.end()))
                done["email"] = own.end()
        elif kind == "card":
            run = _CARD_RUN.match(text, start)
            for m in _CARD.finditer(text, start, run.end()):
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(m.span())
            done["card"] = run.end()
        elif kind == "ip":
            left = _run_start(text, start, done["ip"], _DIGITS)
            run = _IP_RUN.match(text, start)
            for m in _IP.finditer(text, left, run.end()):
                if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split(".")):
                    found["ip"].append(m.span())
            done["ip"] = run.end()
        elif kind == "phone":
            own = _PHONE.match(text, start)
            if own:
                if 8 <= sum(c in _DIGITS for c in own.group()) <= 15:
                    found["phone"].append(own.span())
                done["phone"] = own.end()
        elif kind == "login":
            own = _LOGIN.match(text, start)
            left = _run_start(text, start, done["login"], _SCHEME)
            if own and left < start:
                found["login"].append((left, own.end()))
                done["login"] = own.end()
        else:
            own = (_IBAN if kind == "iban" else _ACCOUNT).match(text, last + 1)
            end = own and (own.end(1) if kind == "account" else _iban_end(text, *own.span(1)))
            if end:
                found[kind].append((own.start(1), end))
                done[kind] = end
    return [(kind, a, b) for kind in KINDS for a, b in found[kind]]


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, spans of every row of ``docs`` (columns doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t.as_py() or "", automaton)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                       f"doc_id long, spans {SPANS}")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping
    spans are replaced as one, under the kind of the first."""
    parts, at, held = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= held:
            parts += [text[at:a], f"[{kind.upper()}]"]
        held = max(held, b)
        at = held
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with the spans of ``column`` masked, all other columns kept;
    null texts stay null."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            at = batch.schema.get_field_index(column)
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                spans = find_spans(text, automaton) if text else []
                texts.append(mask(text, spans) if spans else text)
            yield batch.set_column(at, batch.schema.field(at).with_type(pa.string()), pa.array(texts, pa.string()))

    return map_batches(docs, run, schema)
