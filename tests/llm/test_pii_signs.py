"""The sign test lets every mention through, and phone numbers are found in all their groupings."""

import random
import re._constants as C
import re._parser as parser

import pytest

from pharmaflow.llm import pii as P

LETTERS = {r"\p{Lu}": "[A-ZÀ-ÝА-ЯΑ-Ω]", r"\p{L}": "A-Za-zà-ýа-яα-ω", r"\p{N}": "0-9"}
ALTERNATIVES = {"email": P.EMAIL, "secret": P.SECRETS, "ip": P.IP, "card": P.CARD, "phone": P.PHONE, "ssn": P.SSN, "name": P.NAME}


def _drawn(tree, rng):
    """A random string of a parsed pattern; what looks around is left out."""
    out = ""
    for op, arg in tree:
        if op is C.LITERAL:
            out += chr(arg)
        elif op is C.IN:
            out += _drawn([rng.choice(arg)], rng)
        elif op is C.RANGE:
            out += chr(rng.randint(*arg))
        elif op is C.CATEGORY:
            out += rng.choice("0123456789")
        elif op in (C.MAX_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, part = arg
            out += "".join(_drawn(part, rng) for _ in range(rng.randint(low, min(high, low + 6))))
        elif op is C.SUBPATTERN:
            out += _drawn(arg[3], rng)
        elif op is C.BRANCH:
            out += _drawn(rng.choice(arg[1]), rng)
        else:
            assert op in (C.ASSERT, C.ASSERT_NOT), op
    return out


def _mentions(pattern, n=3000):
    for java, python in LETTERS.items():
        pattern = pattern.replace(java, python)
    tree, rng = parser.parse(pattern), random.Random(7)
    return sorted({_drawn(tree, rng) for _ in range(n)})


def test_signs_hold_for_every_alternative(spark):
    rows = [(kind, f"see {m} now") for kind, pattern in ALTERNATIVES.items() for m in _mentions(pattern)]
    d = spark.createDataFrame(rows, "kind string, t string")
    found = d.where(d.t.rlike(P.ANY))
    seen = {r.kind: r["count"] for r in found.groupBy("kind").count().collect()}
    assert set(seen) == set(ALTERNATIVES) and min(seen.values()) > 500
    assert found.where(~found.t.rlike(P.SIGNS)).limit(5).collect() == []


NUMBERS = ["+49 30 12 34 56", "555 123 4567", "+33 1 23 45 67 89", "+33 12 34 56 78 90", "+1 (555) 123-4567", "+49 (0)30 12 34 56",
           "+12345", "(555) 123 4567", "555-123-4567", "+1 555 123 4567", "+4 5 6 7 8 9 1 2", "+49.30.12.34"]


@pytest.mark.parametrize("alone", [True, False])
def test_phone_numbers_are_replaced_whole(spark, alone):
    tail = "" if alone else " of 123"
    d = spark.createDataFrame([(i, f"call {m} now{tail}") for i, m in enumerate(NUMBERS)], "doc_id long, text string")
    got = {r.row.doc_id: r for r in P.replace_pii(d).collect()}
    digits = lambda s: "".join(c if not c.isdigit() else "0" for c in s)
    for i, m in enumerate(NUMBERS):
        before, after = f"call {m} now{tail}", got[i].text
        assert got[i].n_replaced == 1 and digits(after) == digits(before), after
        assert sum(a != b for a, b in zip(m, after[5:])) > 1 and not after.startswith(f"call {m}"), after


def test_numbers_that_are_no_phone_numbers_stay(spark):
    texts = ["1 + 2 3 4 and +5 %", "2024-01-05 to 2025-02-06", "10 20 30 40", "1 000 000"]
    got = P.replace_pii(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    assert {r.row.doc_id: r.text for r in got} == dict(enumerate(texts)) and all(r.n_replaced == 0 for r in got)
