import random
import re

from fixtures import frame, sha
from reportloom.llm import personal_data as p

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The base rules as written, without any shortcut."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
            fits = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


ALPHABET = "a b @ . - + ( ) 1 2 0 25 4111111111111111 4 % é a@b.c 1.2.3.4 +1 DE89370400440532013000 555-123-4567 phone 123-45-6789".split() + [" "]


def base(text):
    return [f"{x.kind}:{x.start}:{x.end}" for x in p.find(text) if x.kind in p.BASE_KINDS]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 16)))
        assert base(text) == plain(text), text


def test_long_runs_take_linear_time():
    for unit in ("a", "1", "1.", "a@", "+1", "1 ", "a.", "@", "-", "+"):
        p.find(unit * 200_000)


def test_checksums_and_context():
    kinds = lambda text: [x.kind for x in p.find(text)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 please") == []
    assert kinds("my ssn is 123-45-6789") == ["national_id"]
    assert kinds("part 123-45-6789") == []
    assert kinds("call 555-123-4567") == ["local_phone"]
    assert kinds("order 555-123-4567") == []
    assert p.score("ip 1.2.3.4", "ip", 3, 10) > p.score("version 1.2.3.4", "ip", 8, 15)


def test_ibans_end_where_they_should():
    found = lambda text: [text[s:e] for s, e in p.ibans(text)]
    grouped, plain_one = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    assert found(f"IBAN {grouped} BIC COBADEFFXXX") == [grouped]
    assert found(f"{plain_one} 2024") == found(f"{plain_one} I paid") == found(f"A {plain_one}, B") == [plain_one]
    assert found(f"{plain_one} {grouped} NO93 8601 1117 947 BIC") == [plain_one, grouped, "NO93 8601 1117 947"]
    assert found(f"AB12 {grouped}") == [grouped]  # a start that fails hides nothing behind it
    assert found("DE88 3704 0044 0532 0130 00 BIC") == found(f"{plain_one}X") == found(f"X{plain_one}") == []
    # A country that the table lacks: the end is found by the checksum.
    rest = "0044053201300012"
    check = next(f"{n:02}" for n in range(2, 99) if p.mod97(f"ZZ{n:02}{rest}"))
    assert found(f"ZZ{check}{rest} BIC COBA") == [f"ZZ{check}{rest}"]
    p.find("DE89 " * 100_000 + "DE89370400440532013000" * 50_000)


def test_query_columns_and_odd_rows(spark):
    rows = [(1, "mail é a@b.de and 10.0.0.1"), (2, None), (3, ""), (None, "+1 (555) 123-4567"), (1, "mail é a@b.de and 10.0.0.1")]
    got = sorted(map(tuple, p.personal_data_digest(frame(spark, rows, clashing=True)).collect()), key=str)
    want = []
    for doc_id, text in rows:
        spans = plain(text or "")
        counts = [sum(s.startswith(k) for s in spans) for k in PATTERNS]
        want.append((doc_id, *counts, sha(",".join(spans)), ",".join(spans)))
    assert got == sorted(want, key=str)
    assert p.personal_data_digest(frame(spark, rows).limit(0)).count() == 0
    assert p.masked(frame(spark, [(1, "to a@b.de now")])).first().text == "to <email> now"
    spans = p.personal_data(frame(spark, [(1, "to a@b.de now")])).first().spans
    assert [(s.kind, s.start, s.end) for s in spans] == [("email", 3, 9)]
