"""Periodic runs against a plain search over every period."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from pharmaflow.llm import REGISTRY, periodic_runs as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=24):
    """Stretches of words q apart that are equal, for every q, under their smallest period."""
    w, found = np.array(w), {}
    for q in range(1, len(w) // 3 + 1):
        step = np.diff(np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            if b - a + q >= max(least, 3 * q):
                found.setdefault((int(a), int(b - a + q)), q)
    return sorted((a, n, q) for (a, n), q in found.items())


def numbers(words):
    seen = {}
    return [seen.setdefault(x, len(seen)) for x in words]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [x if i < a else words[a + (i - a) % p] for i, x in enumerate(words)]
    runs = brute(numbers(words))
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{k},{q}\n" for s, k, q in runs), " ".join(x for i, x in enumerate(words) if i not in gone))]
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in REGISTRY["op13_periodic_runs"][0](spark, sf).collect()}
    want = {r.doc_id: expected(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert got == want and sum(v[0] > 0 for v in want.values()) >= 10


def test_runs_of_random_sequences():
    rnd, total = np.random.default_rng(0), 0
    for _ in range(600):
        n, v = int(rnd.integers(0, 400)), int(rnd.choice([1, 2, 3, 5, 50]))
        w = rnd.integers(0, v, n)
        for _ in range(rnd.integers(0, 4)):
            if n > 30:
                a = int(rnd.integers(0, n - 10))
                p = int(rnd.integers(1, max(2, (n - a) // 3)))
                k = min(n - a, int(rnd.integers(2 * p, 6 * p + 30)))
                w[a:a + k] = w[a + np.arange(k) % p]
        want = brute(w)
        total += len(want)
        assert R.runs_of(w.astype(np.int64)) == want
    assert total > 300


@pytest.mark.parametrize("w, runs", [
    ([0] * 23, []), ([0] * 24, [(0, 24, 1)]), (list(range(8)) * 3, [(0, 24, 8)]), (list(range(9)) * 2 + list(range(8)), []),
    (([0] * 30 + [1]) * 3, None), (([0] * 12 + [1] + [0] * 11) * 4, None), ([0, 1, 2] * 30_000, [(0, 90_000, 3)]),
    (list(range(20_000)) * 3, [(0, 60_000, 20_000)]),
])
def test_borders_and_nested_runs(w, runs):
    assert R.runs_of(np.array(w, np.int64)) == (brute(w) if runs is None else runs)


def test_transform_is_a_cyclic_convolution():
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(0, R.PRIME, (2, 3, 16)).astype(np.uint64)
    got = R.inverse_ntt(R.ntt(a) * R.ntt(b) % np.uint64(R.PRIME))
    for i in range(3):
        want = [sum(int(a[i, j]) * int(b[i, (k - j) % 16]) for j in range(16)) % R.PRIME for k in range(16)]
        assert got[i].tolist() == want


def test_odd_rows_and_clashing_columns(spark):
    long = "the of and " * 60_000
    rows = [(1, "a " * 24, "x", 1), (1, "a " * 24, "x", 1), (None, "b c " * 20, None, None), (2, None, "x", 2), (3, "", "x", 2),
            (4, " \t\n\x0b ", "x", 2), (5, long, "x", 2), (6, "x" * 300_000, "x", 2), (7, "é ü " * 30 + "tail", "x", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string, t int")
    got = R.periodic_runs(df).collect()
    by = {r.id: ([tuple(x) for x in r.runs], r.text) for r in got}
    assert len(got) == 9 and by[1] == ([(0, 24, 1)], "a") and by[None] == ([(0, 40, 2)], "b c")
    assert by[2] == by[3] == by[4] == ([], "") and by[5] == ([(0, 180_000, 3)], "the of and")
    assert by[6] == ([], "x" * 300_000) and by[7] == ([(0, 30, 1)], "é ü tail")
    assert R.periodic_runs(df.limit(0)).count() == 0 and R.run_digests(df.limit(0)).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    assert {tuple(r)[1:] for r in R.run_digests(df, rewrite=R.planted).where("id in (2, 3, 4)").collect()} == {(0, None, None, None, None, none, none)}
