import random
import re

import duckdb
import pytest
from compare import differences
from corpora import DOCUMENTS, frame, odd_texts, prose
from punctua.llm import personal_data as P
from punctua.llm.oracles import PERSONAL_DATA

SEEDED = [
    "Account DE89 3704 0044 0532 0130 00 AND GB82WEST12345698765432, not DE89 3704 0044 0532 0130 01",
    "SSN: 123-45-6789; order 123-45-6789 part; 000-12-3456 ssn",
    "Call (415) 555-1234 or +1 (415) 555-1234. Serial 415-555-1234 9",
    "write to jo.doe[at]mail (dot) example [dot] org or jo@example.org, a@b, x@y.z_w@v.uk",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 1.2.3.4.5.6.7.8 256.1.1.1 0255.001.02.3",
    "+1+2 555 0000 111 é\U0001F600 +49 (30) 1234567-8. Visa 5500005555555559 \U0001F600 10.0.0.1",
    "x" * 30_000 + "@a.bc " + "1" * 30_000 + ".1.1.1" + "0" * 5_000 + " +1" + "2 " * 9_000 + "DE89" * 5_000,
]


def brute_force(text: str) -> list[tuple[int, int, int]]:
    """The base spans by the stated patterns alone."""
    def count(span):
        return sum(c.isdigit() for c in span)

    def checked(span):
        total = 0
        for place, digit in enumerate(reversed([int(c) for c in span if c.isdigit()])):
            total += sum(map(int, str(digit * 2))) if place % 2 else digit
        return total % 10 == 0

    out = [(0, *m.span()) for m in re.finditer(P.EMAIL, text)]
    out += [(1, *m.span()) for m in re.finditer(P.IP, text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, *m.span()) for m in re.finditer(P.CARD, text) if 13 <= count(m.group()) <= 19 and checked(m.group())]
    return out + [(3, *m.span()) for m in re.finditer(P.PHONE, text) if 9 <= count(m.group()) <= 15]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("0123456789.@-+ ()aZ_%é" if rng.random() < 0.5 else "019.@a- ") for _ in range(rng.randint(0, 60)))
        assert [span for span in P.proposals(text) if span[0] < 4] == brute_force(text)


def test_hidden_addresses_are_leftmost_and_do_not_overlap():
    rng = random.Random(4)
    for _ in range(5_000):
        text = "".join(rng.choice(["[at]", "(AT)", "a", "b.", " ", "(dot)", ".", "[dot]"]) for _ in range(rng.randint(0, 14)))
        assert [span[1:] for span in P.proposals(text) if span[0] == 7] == [m.span() for m in re.finditer(P.HIDDEN, text)]


@pytest.mark.parametrize(("text", "kinds"), [
    ("nothing here", []),
    ("my number is 415-555-1234", []),
    ("my phone is 415-555-1234", ["national"]),
    ("123-45-6789", []),
    ("social security 123-45-6789", ["ssn"]),
    ("social security 666-45-6789", []),
    ("order, ssn 123-45-6789", []),
    ("DE89370400440532013000", ["iban"]),
    ("DE89370400440532013001", []),
    ("call +1 415 555 1234", ["phone"]),
    ("jo [at] example [dot] org", ["hidden"]),
])
def test_checks_and_words_decide(text, kinds):
    assert [P.KINDS[kind] for kind, *_ in P.find(text)] == kinds


def test_words_move_the_score():
    near, far, against = (P.find(f"{word} 10.1.2.3")[0][3] for word in ("server", "whatever", "version"))
    assert (near, far, against) == (90, 60, 30)
    assert P.find("server" + " " * P.BEFORE + "10.1.2.3")[0][3] == 60


def test_long_runs_take_linear_time():
    for run in ("a", "1", "1.", "a@", "+1", "A1", "1-", "DE89", "a[at]"):
        P.find(run * (200_000 // len(run)))


def test_matches_sql_and_brute_force_on_odd_rows(spark):
    rng = random.Random(5)
    texts = odd_texts(rng) + SEEDED + SEEDED[:2] + [prose(rng, 5) + " " + text + " " + prose(rng, 40) for text in SEEDED[:6]]
    docs = frame(spark, texts, ids=[None, 3, 3, *range(10, 7 + len(texts))])
    found = P.scan(docs)
    for row in found.collect():
        if len(row.text or "") < 30_000:  # the plain patterns take quadratic time
            base = [(P.KINDS.index(span.kind), span.start, span.end) for span in row.spans if span.kind in P.BASE]
            assert base == brute_force(row.text or "")
    duck = duckdb.connect()
    duck.register("documents", docs.select("doc_id", "text").toArrow())
    assert differences(P.summary(found), duck, PERSONAL_DATA) == []


def test_masked_texts_hold_no_span(spark):
    docs = frame(spark, [None, "", "call +1 415 555 1234 or jo@example.org!", "a 4111 1111 1111 1111 b"])
    masked = {row.doc_id: row.text for row in P.masked(P.scan(docs)).collect()}
    assert masked == {0: None, 1: "", 2: "call <phone> or <email>!", 3: "a <card> b"}


def test_empty_table(spark):
    assert P.summary(P.scan(spark.createDataFrame([], DOCUMENTS))).count() == 0
