"""IBANs in prose."""

from ledgerfleet.llm import pii

DE, NO, MT = "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"


def ibans(text):
    return [text[a:b] for k, a, b in pii.find_spans(text, pii.anchors()) if k == "iban"]


def test_iban_followed_by_words():
    for own in (DE, NO, MT, DE.replace(" ", ""), DE.lower()):
        for rest in ("", ".", " and thanks", " a b c d e f", " 12 34 56", "\nand", f" or IBAN {NO}"):
            text = f"IBAN: {own}{rest}"
            assert ibans(text) == [own] + [NO] * ("IBAN" in rest), text
    text = f"my iban {DE} and thanks"
    assert pii.mask(text, pii.find_spans(text, pii.anchors())) == "my iban [IBAN] and thanks"


def test_iban_of_a_country_without_a_known_length():
    body = "1234 5678 9012"
    check = next(f"{n:02d}" for n in range(100) if pii._iban_valid(f"QQ{n:02d}{body}"))
    assert ibans(f"IBAN QQ{check} {body} and thanks") == [f"QQ{check} {body}"]


def test_iban_needs_its_length_and_an_end():
    assert ibans("IBAN DE89 3704 0044 0532 0130 00and thanks") == []
    assert ibans("IBAN DE00 3704 0044 0532 0130 00 and thanks") == []
