"""The filter audit against DuckDB on odd rows, in any order of files."""

import duckdb
import pytest

from pharmaflow.llm import filter_audit as A

SCHEMA = "doc_id long, text string, lang string, part string, key string, flags int, t int, n long"
EXTRA = ("p", "k", 3, 4, 5)
LONG = " ".join(f"w{i}" for i in range(120))
LABELS = "doc_id long, quality int, toxic int, label int"


def rows():
    out = [(9, LONG, "en", *EXTRA), (5, LONG, "de", *EXTRA), (7, LONG, None, *EXTRA), (1, LONG, "", *EXTRA), (1, LONG, "en", *EXTRA),
           (None, LONG, "en", *EXTRA), (None, None, None, *[None] * 5), (3, None, "en", *EXTRA), (2, "", "en", *EXTRA), (4, " \t\x0b", "fr", *EXTRA),
           (6, "A B", "en", *EXTRA), (8, "a # " * 60_000, "en", *EXTRA), (10, "x" * 300_000, "en", *EXTRA), (11, LONG + " 50%", "fr", *EXTRA),
           (12, LONG + " 50%", "fr", *EXTRA), (13, LONG.upper(), "fr", *EXTRA)]
    return out + [(100 - i, "hot " * (1 + i % 2), "en", *EXTRA) for i in range(60)]


def written(spark, path, data, files):
    """Parts written one after another, so that the stream reads them in this order."""
    n = -(-len(data) // files)
    for k in range(files):
        spark.createDataFrame(data[k * n:(k + 1) * n], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def table_of(df):
    return sorted(tuple(r) for r in df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                              "good_lost", "toxic_lost", "shapley").collect())


@pytest.mark.parametrize("turn, files, batches, texts", [(1, 7, 7, 4), (-1, 7, 3, 256), (1, 1, 4, 1)])
def test_any_order_of_files(spark, tmp_path, monkeypatch, turn, files, batches, texts):
    data = rows()[::turn]
    monkeypatch.setattr(A, "TEXTS", texts)
    written(spark, f"{tmp_path}/documents.parquet", data, files)
    labels = [(9, 1, 0, 1), (9, 0, 0, 1), (5, 1, 1, 1), (1, 0, 1, 1), (None, 1, 1, 1), (6, None, None, None), (8, 1, 1, 0)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = table_of(A.orders(A.failure_counters(spark, f"{tmp_path}/documents.parquet", spark.read.parquet(f"{tmp_path}/labels.parquet"), batches)))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(f"SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley FROM ({A.SQL})").fetchall()
    assert got == sorted(want) and len(got) == 4 * 600 and sum(r[4] for r in got if r[1] == "EABCD" and r[2] == 1) == 63


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/d")
    labels = spark.createDataFrame([], LABELS)
    assert A.orders(A.failure_counters(spark, f"{tmp_path}/d", labels)).count() == 0


def test_state_retracts_what_it_counted():
    changes = A.Counter()
    least = A.Least(changes)
    for i, code in ((5, ("en", 1)), (5, ("de", 0)), (9, ("en", 2)), (3, ("fr", 0))):
        least.add(i, code, 1)
    assert (least.low, least.held) == (3, {("fr", 0): 1})
    assert {k: n for k, n in changes.items() if n} == {("en", 17): 1, ("de", 16): 1, ("en", 18): 1, ("fr", 0): 1}
