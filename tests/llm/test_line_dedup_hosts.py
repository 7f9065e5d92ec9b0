"""Boilerplate planted on a few percent of a host's pages goes, at several host sizes; lines
that stand once, and texts with a few copies, stay."""

from collections import Counter

from pharmaflow.llm import line_dedup as L

# pages of a host: pages with its planted line, copies of one text
HOSTS = {20: (4, 2), 50: (15, 4), 400: (16, 4), 2000: (60, 9)}


def test_planted_lines_at_several_host_sizes(spark):
    rows = []
    for n, (planted, copies) in HOSTS.items():
        for i in range(n):
            body = [f"copied line {n}"] if i >= n - copies else [f"line {n} {i} first", f"line {n} {i} second"]
            rows.append((f"h{n}", "\n".join(body + [f"Subscribe to {n}"] * (i < planted))))
    got = L.line_dedup(spark.createDataFrame(rows, "source string, text string")).collect()
    dropped = Counter()
    for r in got:
        assert r.text == "\n".join(x for x in r.row.text.split("\n") if not x.startswith("Subscribe"))
        dropped[r.row.source] += r.n_dropped
    assert dropped == {f"h{n}": planted for n, (planted, _) in HOSTS.items()}


def test_rules_by_their_bounds(spark):
    """On 1,000 pages, more than 1 % are 11; on 300, at least 10 pages; on 60, more than 10 % are 7."""
    want = {(1000, 11): True, (1000, 10): False, (300, 10): True, (300, 9): False, (60, 7): True, (60, 6): False}
    rows = [(f"{n}/{k}", "the same line" if i < k else f"line {i}") for n, k in want for i in range(n)]
    got = L.boilerplate_lines(spark.createDataFrame(rows, "source string, text string")).collect()
    assert {r.host: r.pages for r in got} == {f"{n}/{k}": k for (n, k), bad in want.items() if bad}


def test_a_text_of_very_many_lines(spark):
    """Time grows with the number of lines: one text of 40,000 distinct lines, a tenth of them boilerplate."""
    import time
    many = "\n".join([f"own line {i}" for i in range(36_000)] + [f"shared {i}" for i in range(4_000)])
    rows = [("a", many)] + [("a", "\n".join(f"shared {i}" for i in range(k, 4_000, 4))) for k in (0, 1, 2, 3)] * 12
    df = spark.createDataFrame(rows, "source string, text string")
    L.line_dedup(df.limit(1)).collect()
    began = time.time()
    got = max(L.line_dedup(df).collect(), key=lambda r: r.n_lines)
    assert time.time() - began < 20
    assert (got.n_lines, got.n_dropped) == (40_000, 4_000) and got.text == "\n".join(f"own line {i}" for i in range(36_000))


def test_both_rules_in_the_oracle(spark):
    """Hosts of 400 pages reach the second rule only; SQL and operator agree on it."""
    import duckdb
    rows = [(i, "h", f"line {i}\n" + ("Subscribe" if i < 12 else f"other {i}")) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    con = duckdb.connect()
    documents = df.toPandas()  # noqa: F841  read by the SQL
    want = {r[0]: r[2:] for r in con.execute(L.SQL).fetchall()}
    got = {r.row.doc_id: (r.text, r.n_lines, r.n_dropped) for r in L.line_dedup(df).collect()}
    assert got == want and sum(v[2] for v in got.values()) == 12
