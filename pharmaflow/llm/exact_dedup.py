"""Op 12, exact dedup by a tree-merge of sorted digest runs.

Texts are equal when they are identical after every run of white space is replaced by one
space. Each input partition makes one run: its distinct digests in order, each with the
smallest identifier and the number of its rows. Runs are merged in binomial rounds: in
each, the runs of ``2 ** FAN_BITS`` neighbouring nodes of a tree meet, are merged by digest,
and every digest keeps the smallest of its identifiers. A digest is the SHA-256 of the
text, verified at every level by an independent 64-bit hash: entries merge only when both
agree. The root holds each text's smallest identifier and the size of its group, which go
back down the tree to the rows.

Scale. Texts never move: a row is its id, digest, hash and position. A round is one
shuffle; a run is spread over the tasks by digest, so no task holds a whole run or the
root. A text that a third of all rows hold leaves one entry per partition, and a merge
meets at most ``2 ** FAN_BITS`` of them. On the way down the answer goes to the entries of
the first round and from there to rows of at most that many partitions, so no join meets
all rows of a text at one key. ``p`` partitions take ``log2(p) / FAN_BITS`` rounds.

Defined cases: a NULL text counts as the empty one; the smallest identifier leaves NULL ids
last (it is NULL only if all are); of rows that repeat text and id the first in the table's
order stays, so each text keeps exactly one row; an empty table gives an empty result; the
input's further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import broadcast_if, carry, register, saved, table

FAN_BITS = 3  # a round merges the runs of 2^3 nodes
_PARTITION = 33  # monotonically_increasing_id has the partition from this bit on
_KEY = ["digest", "check"]


def _normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(_normalised(text), 256))


def _merged(runs: DataFrame, head: Column, n: Column, node: Column) -> DataFrame:
    """One round: entries of equal digest and hash meet at their parent node."""
    return runs.groupBy(*_KEY, node.alias("node")).agg(F.min(head).alias("head"), F.sum(n).alias("n"))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_bits: int = FAN_BITS) -> DataFrame:
    """One row per input row: ``id``, ``digest``, ``keep_id``, ``group_size`` and ``kept``."""
    if fan_bits < 1:
        raise ValueError("fan_bits must be at least 1")
    text = df.select(F.col(id_col).alias("id"), _normalised(F.col(text_col)).alias("t"))
    rows = saved(text.select("id", F.unhex(F.sha2("t", 256)).alias("digest"), F.xxhash64("t").alias("check"),
                             F.monotonically_increasing_id().alias("row")), "exact-rows")
    last = rows.agg(F.max("row")).first()[0]
    nodes = 1 + ((last or 0) >> _PARTITION)
    parent = F.shiftrightunsigned("row", _PARTITION + fan_bits)
    # the smallest id, NULLs last, then the first row
    head = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    first = saved(_merged(rows, head, F.lit(1), parent), "exact-runs")
    runs, nodes = first, -(-nodes >> fan_bits)
    while nodes > 1:
        runs = _merged(runs, F.col("head"), F.col("n"), F.shiftrightunsigned("node", fan_bits))
        nodes = -(-nodes >> fan_bits)
    groups = saved(runs.where("n > 1").select(*_KEY, F.col("head.id").alias("keep_id"), F.col("head.row").alias("keep_row"), "n"), "exact-groups")
    # down again: to the entries of the first round, then to their rows
    down = saved(first.select(*_KEY, "node").join(groups, _KEY), "exact-down")
    d = rows.withColumn("node", parent).join(broadcast_if(down), [*_KEY, "node"], "left")
    alone = F.col("n").isNull()
    return d.select("id", "digest", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    (alone | (F.col("row") == F.col("keep_row"))).alias("kept"))


def without_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One input row of each text, with all its columns."""
    gone = saved(exact_duplicates(df, id_col, text_col, **options).groupBy("id", "digest").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("NOT kept OR n > 1"), "exact-gone")
    rows = carry(df, F.col(id_col).alias("id"), F.col(text_col).alias("t")).alias("d")
    # texts are only digested where the id is in question
    d = rows.join(broadcast_if(gone).alias("g"), F.col("d.id").eqNullSafe(F.col("g.id"))
                  & (_digest(F.col("t")) == F.col("g.digest")), "left").select("row", "g.id", "g.digest", "kept")
    once = d.where("kept").groupBy("id", "digest").agg(F.first("row").alias("row")).select("row")
    return d.where("kept IS NULL").select("row").unionByName(once).select("row.*")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


@register("op12_exact_dedup", SQL)
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    out = exact_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
