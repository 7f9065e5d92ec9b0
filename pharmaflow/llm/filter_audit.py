"""Op 11, filter interaction audit by incremental retraction streaming.

Five filters are judged in all 120 orders. What a filter removes at a step depends only on
which filters a document fails, so the audit keeps counters of (part, set of failed
filters, labels). Four failures follow from the text alone. The fifth (E: the text is that
of a smaller id) depends on documents that may not have been read yet.

All files are processed as available-now micro-batches of a file stream. The state holds for every
text (by SHA-256) the smallest id seen and the counted documents that have it. Texts are kept
about ``TEXTS`` to a state row, by a hash of their digest: a call per text costs ten times the
work it does. A
document with a larger id is counted as a copy. When a smaller id arrives, what was
counted for the former smallest one is retracted from its part's counter and counted
anew as copies. Counter changes are written by an append-only file sink; their sum after
the last batch holds for the whole table, whatever the order of files.

Scale. Texts never move: after one scan a document is a digest, an id and a few flags. Before
the shuffle every Arrow batch settles its own copies of a text, so one that a third of
all rows hold sends one row per batch, whatever is settled goes as counts, and the
state of a text is one id with a count per (part, flags). The number of state rows follows
from the row count in the files' footers. State and progress live in a
checkpoint in the shared folder, from which lost executors' partitions are restored. The
default state store keeps the digests on the executors' heaps; for more than they hold set
``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB store. The orders are
an explode of 600 literals over the counters: rows of parts x 32 x 4.

Defined cases: a NULL text counts as the empty one; a NULL id is never a copy and makes
none; rows that repeat text and id are not copies of each other; a NULL part is the empty
string; a document with several label rows has a label if any row does; an empty
table gives an empty result; the input's further columns are not read.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .common import register, saved, table, words

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
GOOD, TOXIC = 32, 64
BATCHES = 4  # micro-batches for the files there are
TEXTS = 256  # texts whose state is one row, on average


def text_failures(text: Column) -> Column:
    """Bits of the failed filters A to D; ``text`` must not be NULL."""
    w = words(text)
    tests = [F.size(w) < 100, 100 * F.size(F.array_distinct(w)) < 80 * F.size(w),
             100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text), text.rlike(r"[#$%&*|]")]
    return sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0))


class Least:
    """The smallest id of a text and the (part, flags) counts of its rows; ``changes``
    collects what the counters gain and lose."""

    def __init__(self, changes: Counter, low: int | None = None, held: dict | None = None):
        self.changes, self.low, self.held = changes, low, held or {}

    def add(self, i: int, code: tuple[str, int], n: int) -> None:
        if self.low is not None and i > self.low:
            self.changes[code[0], code[1] | COPY] += n
            return
        if self.low is None or i < self.low:
            for (part, flags), m in self.held.items():  # retracted, and counted as copies
                self.changes[part, flags] -= m
                self.changes[part, flags | COPY] += m
            self.low, self.held = i, {}
        self.held[code] = self.held.get(code, 0) + n
        self.changes[code] += n


_ROWS = pa.schema([("bucket", pa.int64()), ("key", pa.binary()), ("id", pa.int64()), ("part", pa.string()), ("flags", pa.int32()),
                   ("n", pa.int64())])


def _settled(buckets: int):
    """Of a batch, for each text its smallest id with the counts of its rows, and counts of all
    other rows (without a key)."""
    def run(batches):
        for b in batches:
            texts, settled = {}, Counter()
            for key, i, part, flags in zip(*(b.column(c).to_pylist() for c in ("key", "id", "part", "flags"))):
                if i is None:
                    settled[part, flags] += 1
                else:
                    texts.setdefault(key, Least(settled)).add(i, (part, flags), 1)
            rows = []
            for key, least in texts.items():
                for code, n in least.held.items():
                    settled[code] -= n  # the state counts these
                    rows.append((int.from_bytes(key[:7], "big") % buckets, key, least.low, *code, n))
            rows += [(hash(code[1]) % buckets, b"", 0, *code, n) for code, n in settled.items() if n]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ROWS)] if rows
                                             else [pa.array([], f.type) for f in _ROWS], schema=_ROWS)
    return run


def _counted(bucket, frames, state):
    """Counter changes of the new rows of a bucket's texts; the state keeps each text's smallest id."""
    import pandas as pd
    changes: Counter = Counter()
    texts: dict[bytes, tuple] = pickle.loads(state.get[0]) if state.exists else {}
    new: dict[bytes, Least] = {}
    for f in frames:
        for key, i, part, flags, n in zip(f["key"], f["id"].tolist(), f["part"], f["flags"].tolist(), f["n"].tolist()):
            if not key:
                changes[part, flags] += n
                continue
            if (least := new.get(key)) is None:
                low, held = texts.get(key, (None, ()))
                least = new[key] = Least(changes, low, dict(held))
            least.add(i, (part, flags), n)
    if new:
        texts.update((key, (least.low, tuple(least.held.items()))) for key, least in new.items())
        state.update((pickle.dumps(texts),))
    rows = [(*code, n) for code, n in changes.items() if n]
    yield pd.DataFrame(rows, columns=["part", "flags", "delta"])


def _summed(batches):
    for b in batches:
        total: Counter = Counter()
        for part, flags, n in zip(*(b.column(c).to_pylist() for c in ("part", "flags", "delta"))):
            total[part, flags] += n
        rows = [(*code, n) for code, n in total.items() if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))], ["part", "flags", "delta"])


def _label_flags(labels: DataFrame) -> DataFrame:
    flag = F.when(F.col("quality") == 1, GOOD).otherwise(0).bitwiseOR(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))
    return labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("label_id")).agg(F.bit_or(flag).alias("label"))


def _stream_path(spark: SparkSession, path: str) -> str:
    """``path`` for a file stream, which takes folders and patterns: one file is a pattern that only it matches."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return f"{path[:-1]}[{path[-1]}]" if fs.getFileStatus(at).isFile() else path


def failure_counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES, id_col: str = "doc_id",
                     text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, flags, n): documents by part and by failed filters and labels, of the Parquet files under ``path``."""
    given = spark.read.parquet(path)
    files = len(given.inputFiles())
    buckets = max(1, given.count() // TEXTS)  # from the files' footers
    stream = (spark.readStream.schema(given.schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(_stream_path(spark, path))
              .select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("t")))
    rows = stream.select("id", "part", F.unhex(F.sha2("t", 256)).alias("key"), text_failures(F.col("t")).alias("mask"))
    known = saved(_label_flags(labels), "audit-labels")
    rows = rows.join(known, F.col("id") == F.col("label_id"), "left").select(
        "key", "id", "part", F.col("mask").bitwiseOR(F.coalesce("label", F.lit(0))).cast("int").alias("flags"))
    out = "part string, flags int, delta long"
    changes = (rows.mapInArrow(_settled(buckets), "bucket long, key binary, id long, part string, flags int, n long").groupBy("bucket")
               .applyInPandasWithState(_counted, out, "texts binary", "append", "NoTimeout")
               .mapInArrow(_summed, out))
    base = scratch_path(spark, f"audit-{uuid.uuid4().hex[:12]}")
    query = (changes.writeStream.format("parquet").option("path", f"{base}/changes").option("checkpointLocation", f"{base}/progress")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    written = spark.read.schema(out).parquet(f"{base}/changes")
    return written.groupBy("part", "flags").agg(F.sum("delta").alias("n")).where("n > 0")


def orders(counters: DataFrame) -> DataFrame:
    """Counts of every part, order of the filters and step from (part, flags, n)."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order):
            steps.append(F.struct(F.lit("".join(FILTERS[k] for k in order)).alias("filter_order"), F.lit(step + 1).alias("step"),
                                  F.lit(1 << f).alias("bit"), F.lit(before).alias("before")))
            before |= 1 << f
    own = F.col("flags").bitwiseAND((1 << len(FILTERS)) - 1)
    d = counters.select("part", "n", own.alias("mask"), (F.col("flags").bitwiseAND(GOOD) > 0).alias("good"),
                        (F.col("flags").bitwiseAND(TOXIC) > 0).alias("toxic"))
    # of the 120 orders every failed filter comes first among the failed ones in equally many
    d = d.withColumn("share", F.when(F.col("mask") > 0, F.lit(120) / F.bit_count("mask")).otherwise(0).cast("long"))
    d = d.select("*", F.explode(F.array(*steps)).alias("s")).select("*", "s.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0

    def total(cond: Column, n: Column = F.col("n")) -> Column:
        return F.sum(F.when(cond, n).otherwise(0)).cast("long")

    removed = fails & ~earlier
    return d.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(removed).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"), total(fails, F.col("n") * F.col("share")).alias("shapley"))


SQL = r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
              100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
              coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS f FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, good, toxic, f, count(*) AS n FROM m GROUP BY ALL),
x AS (SELECT unnest(range(1, 6)) AS k),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT list_aggregate(list_transform(o, lambda i: substr('ABCDE', i, 1)), 'string_agg', '') AS filter_order,
             k::INT AS step, o[k] AS own, o[:k - 1] AS before FROM o, x),
j AS (SELECT part, good, toxic, n, filter_order, step, own, f[own] AS fails,
             len(list_filter(before, lambda i: f[i])) > 0 AS earlier,
             len(list_filter(f, lambda v: v)) AS failed FROM c, s),
a AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0) AS kept,
             coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS removed,
             coalesce(sum(n) FILTER (fails AND earlier), 0) AS redundant,
             coalesce(sum(n) FILTER (fails AND failed = 1), 0) AS unique_fails,
             coalesce(sum(n) FILTER (fails AND NOT earlier AND good), 0) AS good_lost,
             coalesce(sum(n) FILTER (fails AND NOT earlier AND toxic), 0) AS toxic_lost FROM j GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM a
"""


@register("op11_filter_audit", SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language, order and step of the five filters over all documents."""
    return orders(failure_counters(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels")))
