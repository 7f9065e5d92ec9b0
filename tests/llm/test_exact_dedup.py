"""Exact dedup by digest runs against plain Python, and its odd cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pharmaflow.llm import exact_dedup as X

SCHEMA = "doc_id long, text string, id string, row int, digest int, node string, n int"
EXTRA = ("i", 1, 2, "n", 3)
ROWS = [(5, "a  b", *EXTRA), (3, "a\tb", *EXTRA), (3, "a b", *EXTRA), (None, "a\n\x0b b", *EXTRA), (4, " a b", *EXTRA),
        (None, "only", *[None] * 5), (None, "only", *EXTRA), (7, None, *EXTRA), (6, "", *EXTRA), (8, " ", *EXTRA),
        (9, " ", *EXTRA), (10, "long " * 200_000, *EXTRA), (2, "long\r" * 200_000, *EXTRA)]


def groups(rows):
    """id and text -> (smallest id, rows) of the text."""
    by = {}
    for i, t in rows:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by.items()}


@pytest.mark.parametrize("parts, bits", [(1, 1), (2, 1), (7, 1), (13, 2), (40, 3)])
def test_any_tree_gives_the_same_groups(spark, parts, bits):
    rows = [r[:2] for r in ROWS] + [(100 + i, "hot text" if i % 3 else f"t{i % 40}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = X.exact_duplicates(df, fan_bits=bits).collect()
    want, digest = groups(rows), lambda t: hashlib.sha256(t.encode()).digest()
    heads = {digest(t): v for t, v in want.items()}
    assert len(got) == len(rows) and all((r.keep_id, r.group_size) == heads[bytes(r.digest)] for r in got)
    kept = [bytes(r.digest) for r in got if r.kept]
    assert sorted(kept) == sorted(heads) and all(r.id == r.keep_id for r in got if r.kept)


def test_one_whole_row_of_each_text(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    once = X.without_exact_duplicates(df)
    assert once.columns == df.columns
    assert sorted(r.doc_id or 0 for r in once.collect()) == [0, 2, 3, 4, 6, 8, 9]
    assert X.without_exact_duplicates(df.limit(0)).count() == 0 and X.exact_duplicates(df.limit(0)).count() == 0


def test_digests_that_meet_are_verified(spark):
    """Entries of one digest but different hashes stay apart."""
    runs = spark.createDataFrame([(b"d", 1, 0, 5), (b"d", 2, 0, 3), (b"d", 1, 1, 4)], "digest binary, check long, node long, id long")
    got = X._merged(runs, F.struct("id"), F.lit(1), F.lit(0)).collect()
    assert sorted((r.check, r["head"].id, r.n) for r in got) == [(1, 4, 2), (2, 3, 1)]


def test_no_python_in_the_plan(spark):
    df = X.exact_duplicates(spark.createDataFrame(ROWS, SCHEMA))
    plan = df._jdf.queryExecution().toString()
    assert not re.search(r"Python|MapInArrow|MapInPandas|CartesianProduct|NestedLoop", plan)
