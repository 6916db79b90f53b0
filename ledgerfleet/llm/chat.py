"""Chat formatting over typed content parts (native: DataFrame functions only).

A message is a row (conversation, turn, role, parts); ``parts`` is an array of
typed parts (``PART_TYPE``): text, image, audio, document.  A ``Visitor`` says
what a part of each kind becomes: text is escaped, an attachment leaves an ordered
placeholder in the text and a record of its reference and of the number of
tokens its placeholder expands into.  ``format_conversations`` joins the
visited messages of a conversation to one string with a turn mark before and
after each message and with the loss mask of the trained roles;
``read_turns`` and ``read_loss`` read both back from that output.

Control strings.  ``<|`` opens every control string of the template, and no
text holds it once escaped: ``<``, any number of backslashes and ``|`` get one
backslash more, and lose it when they are read back.  Roles stand in the header
line of their turn, so line feeds, ``|`` and ``%`` are percent-encoded there.

A conversation is one value of the output, as a document is one value of its
table; a task holds a conversation, never a partition.  Texts cross one shuffle, by
conversation; everything read back stays in that stage.

Hard cases: null texts, parts and part lists are empty, a null role is the
empty role, null turns come first, and messages of one turn stand in the order
of role, then text.  Rows repeated in the table are messages of their own.
Messages without a conversation id form one conversation, whose id is null.  Parts of
an unknown kind leave the placeholder ``<|other|>`` and count no tokens.  An empty
table gives no conversations; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_FIELDS = {"kind": "string", "text": "string", "ref": "string", "width": "int", "height": "int",
               "seconds": "double", "pages": "int"}
PART_TYPE = f"array<struct<{','.join(f'{n}:{t}' for n, t in PART_FIELDS.items())}>>"
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
PLACEHOLDER = "<|{}|>"
TRAINED_ROLES = ("assistant",)


# --- parts -----------------------------------------------------------------------

def text_parts(text: Column) -> Column:
    """A message of one text part."""
    fields = [F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
              *[F.lit(None).cast(t).alias(n) for n, t in PART_FIELDS.items() if n not in ("kind", "text")]]
    return F.array(F.struct(*fields))


def json_parts(content: Column) -> Column:
    """Parts written as a JSON array of objects with the fields of ``PART_TYPE``;
    anything else is null, a message without parts."""
    return F.from_json(content, PART_TYPE)


class Visitor:
    """What a part becomes: (text in the output, tokens it expands into).  The
    figures are those of the model the corpus is made for."""

    kinds = ("text", "image", "audio", "document")

    def __init__(self, patch: int = 28, audio_tokens_a_second: float = 25.0, tokens_a_page: int = 1024,
                 unknown_size_tokens: int = 256):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_tokens_a_second, tokens_a_page
        self.unknown = unknown_size_tokens

    def text(self, part: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0)

    def image(self, part: Column) -> tuple[Column, Column]:
        side = [F.ceil(part[c] / self.patch) for c in ("width", "height")]
        return F.lit(PLACEHOLDER.format("image")), side[0] * side[1]

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit(PLACEHOLDER.format("audio")), F.ceil(part["seconds"] * self.audio_rate)

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit(PLACEHOLDER.format("document")), part["pages"] * self.page_tokens

    def visit(self, part: Column) -> Column:
        """struct(piece, kind, ref, tokens) of one part."""
        piece, tokens = F.lit(PLACEHOLDER.format("other")), F.lit(0).cast("long")
        for kind in reversed(self.kinds):
            p, t = getattr(self, kind)(part)
            is_it = part["kind"] == kind
            piece = F.when(is_it, p).otherwise(piece)
            tokens = F.when(is_it, F.greatest(F.coalesce(t.cast("long"), F.lit(self.unknown).cast("long")),
                                              F.lit(0).cast("long"))).otherwise(tokens)
        missing = part.isNull()
        return F.struct(F.when(missing, F.lit("")).otherwise(piece).alias("piece"),
                        F.when(missing, F.lit("text")).otherwise(F.coalesce(part["kind"], F.lit("other"))).alias("kind"),
                        part["ref"].alias("ref"), F.when(missing, F.lit(0)).otherwise(tokens).cast("long").alias("tokens"))


# --- the template ------------------------------------------------------------------

def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


_ROLE_CODES = (("%", "%25"), ("\n", "%0A"), ("|", "%7C"))


def encode_role(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def decode_role(role: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def format_turns(messages: DataFrame, visitor: Visitor | None = None,
                 trained: tuple[str, ...] = TRAINED_ROLES) -> DataFrame:
    """One row per message: its conversation, turn and role, the formatted
    ``piece``, the part of it under the loss mask (``loss_at``, ``loss_length``:
    code points, the message without its marks) and its ``attachments`` in order."""
    visitor = visitor or Visitor()
    role = F.coalesce(F.col("role"), F.lit(""))
    seen = messages.select(
        "conv_id", "turn", role.alias("role"),
        F.transform(F.coalesce("parts", F.array().cast(PART_TYPE)), visitor.visit).alias("seen"))
    parts = seen.select(
        "conv_id", "turn", "role", F.concat(F.lit(TURN_START), encode_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join(F.col("seen.piece"), "").alias("body"),
        F.transform(F.filter("seen", lambda s: s["kind"] != "text"), lambda s: s.dropFields("piece")).alias("attachments"))
    is_trained = F.col("role").isin(*trained)
    return parts.select(
        "conv_id", "turn", "role", F.concat("head", "body", F.lit(TURN_END + "\n")).alias("piece"),
        F.length("head").cast("long").alias("loss_at"),
        F.when(is_trained, F.length("body")).otherwise(0).cast("long").alias("loss_length"), "attachments")


def format_conversations(messages: DataFrame, visitor: Visitor | None = None,
                         trained: tuple[str, ...] = TRAINED_ROLES) -> DataFrame:
    """One row per conversation:

    * ``formatted``: all messages in order;
    * ``marks``: per message where it starts and the span of ``formatted`` under
      the loss mask (code points, end exclusive, empty for untrained roles);
    * ``attachments``: kind, reference and expanded tokens of every placeholder,
      in order, with the number of its message;
    * ``expanded_tokens``: their sum.
    """
    turns = format_turns(messages, visitor, trained)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece").rowsBetween(Window.unboundedPreceding, 0)
    placed = (turns.withColumn("start", F.sum(F.length("piece").cast("long")).over(order) - F.length("piece"))
              .withColumn("loss_start", F.col("start") + F.col("loss_at")))
    whole = (placed.groupBy("conv_id")
             .agg(F.collect_list(F.struct("start", "loss_start", (F.col("loss_start") + F.col("loss_length")).alias("loss_end"),
                                          "piece", "attachments")).alias("m"))
             .select("conv_id", F.sort_array("m").alias("m")))
    sent = F.flatten(F.transform("m", lambda t, k: F.transform(
        t["attachments"], lambda a: F.struct(k.alias("message"), a["kind"].alias("kind"), a["ref"].alias("ref"),
                                             a["tokens"].alias("tokens")))))
    return whole.select(
        "conv_id", F.array_join(F.col("m.piece"), "").alias("formatted"),
        F.transform("m", lambda t: F.struct(t["start"].alias("start"), t["loss_start"].alias("loss_start"),
                                            t["loss_end"].alias("loss_end"))).alias("marks"),
        sent.alias("attachments")).withColumn(
        "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


# --- reading back ------------------------------------------------------------------

def _pieces(formatted: Column) -> Column:
    """The messages without the mark that starts them."""
    cut = F.split(formatted, r"<\|im_start\|>")
    return F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation; placeholders
    stand in the text as they are."""
    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        at = F.length(head) + 2
        body = piece.substr(at, F.length(piece) - F.length(head) - (len(TURN_END) + 2))
        return F.struct(decode_role(head).alias("role"), unescape(body).alias("text"))
    return F.transform(_pieces(formatted), turn)


def read_loss(formatted: Column, marks: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    def under(piece: Column, mark: Column) -> Column:
        at = mark["loss_start"] - mark["start"] - len(TURN_START) + 1
        return unescape(piece.substr(at.cast("int"), (mark["loss_end"] - mark["loss_start"]).cast("int")))
    return F.array_join(F.zip_with(_pieces(formatted), marks, under), "")
