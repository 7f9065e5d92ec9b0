"""Op 1, mixing sources to target weights with hash-threshold histograms.

Sources in code point order (NULL last) weigh 5, 2, 1, 5, ... and share
``budget`` times all words; a source's target stops at ``max_repeats`` times its size
and the excess is shared again by weight. A document's hash decides how often it is
taken: every copy a source's target covers in full, and one more when its hash is
under the source's threshold. The threshold is where the words of the documents
hashed below it come nearest to what is left of the target.

It is found without sorting: words are summed by (source, top hash bits), the bucket in
which the running sum passes the rest of the target is refined by the next bits, and so
on over that bucket's rows alone. The buckets nest, so a larger target takes a superset.

Scale: one aggregation over all rows, combined map-side (a hot source costs one row
per task and bucket); the refinements read 1 row in 4096. The source table has a row for
each source. Its joins are broadcast by Spark only while the table's written size is
under the broadcast threshold.

Defined cases: a NULL text has size 0; NULL sources are one source, the last; rows that
repeat id and text share a hash and are taken or left together; a source without
words has target 0; an empty table gives an empty result; the input's further columns
travel inside ``row`` or are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from .common import n_words, register, saved, table

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET, MAX_REPEATS = 1.5, 2
BITS, LEVELS = 12, 5  # 60 hash bits


def _hash(doc_id: Column, text: Column) -> Column:
    """60 bits of a digest of id and text: the same on every run and machine."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, full, rest) of ``sizes(source, source_size)``.

    Targets are min(cap, level * weight); in the order of cap / weight the level is
    what remains of the budget over the weights not yet capped."""
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((nth - 1) % len(weights)) + 1)
    s = sizes.select("source", "source_size", weight.alias("w"),
                     (F.lit(float(max_repeats)) * F.col("source_size")).alias("cap"))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.select("*", (F.lit(float(budget)) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
                 (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("open"))
    level = F.col("left") / F.col("open")
    s = s.select("*", F.min(F.when(level * F.col("w") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("w")).alias("at"), level.alias("level")))).over(every)["level"].alias("level"))
    target = F.least(F.col("cap"), F.col("level") * F.col("w"))
    full = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))).cast("long")
    return (s.select("source", "source_size", F.coalesce(target, F.col("cap")).alias("target"))
            .withColumn("full", full)
            .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")))


def _part(level: int) -> Column:
    """Bucket of a hash among its siblings at a level."""
    return F.shiftright("h", 60 - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def mix_plan(rows: DataFrame, **options) -> DataFrame:
    """Per source: (source, source_size, target, full, cut). A row of
    ``rows(source, size, h)`` is taken ``full`` times, once more if ``h <= cut``."""
    histogram = saved(rows.groupBy("source", _part(0).alias("bucket")).agg(F.sum("size").alias("size")), "mix-histogram")
    plan = saved(targets(histogram.groupBy("source").agg(F.sum("size").alias("source_size")), **options), "mix-targets")
    state = plan.select("source", "rest", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        same = F.col("b.source").eqNullSafe(F.col("s.source"))
        run = Window.partitionBy("source").orderBy("bucket")
        upto = (histogram.alias("b").join(state.select("source", "rest", "below", "prefix").alias("s"), same)
                .select("s.source", "rest", "below", "prefix", "bucket", "size")
                .withColumn("upto", F.col("below") + F.sum("size").over(run)))
        # the first bucket in which the running sum passes the rest
        found = (upto.where(F.col("upto") > F.col("rest")).groupBy("source")
                 .agg(F.min(F.struct("bucket", "upto", "size", "rest", "prefix")).alias("x"))
                 .select("source", "x.rest", (F.col("x.upto") - F.col("x.size")).alias("below"),
                         F.shiftleft("x.prefix", BITS).bitwiseOR(F.col("x.bucket")).alias("prefix"),
                         F.col("x.size").alias("inside"), F.col("x.bucket").alias("bucket")))
        state = saved(found, "mix-state")
        if level + 1 < LEVELS:
            s = state.select("source", "bucket").alias("s")
            rows = rows.withColumn("bucket", _part(level)).alias("r").join(
                s, F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.bucket") == F.col("s.bucket")), "left_semi")
            rows = saved(rows.select("source", "size", "h"), "mix-boundary")
            histogram = rows.groupBy("source", _part(level + 1).alias("bucket")).agg(F.sum("size").alias("size"))
    # the last bucket is one hash value: taken if that comes nearer to the rest
    nearer = F.col("below") + F.col("inside") - F.col("rest") < F.col("rest") - F.col("below")
    cut = state.select("source", (F.col("prefix") - F.when(nearer, 0).otherwise(1)).alias("cut"))
    return saved(plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").select(
        "p.source", "source_size", "target", "full", F.coalesce("cut", F.lit(-1).cast("long")).alias("cut")), "mix-plan")


def _copies() -> Column:
    return F.col("full") + F.when(F.col("h") <= F.col("cut"), 1).otherwise(0)


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every input row."""
    rows = saved(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                           _hash(F.col(id_col), F.col(text_col)).alias("h")), "mix-rows")
    plan = mix_plan(rows.select("source", "size", "h"), **options)
    d = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    return d.select("id", "size", "source_size", "target", _copies().cast("long").alias("copies"),
                    (_copies() * F.col("size")).cast("long").alias("taken"))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The input rows that the mix takes, with all their columns, repeated as often
    as it takes them."""
    h = _hash(F.col(id_col), F.col(text_col))
    rows = saved(df.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), h.alias("h")), "mix-rows")
    plan = mix_plan(rows, **options)
    packed = df.select(F.struct("*").alias("row"), F.col(source_col).alias("source"), h.alias("h"))
    d = packed.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    return d.select("row", F.explode(F.sequence(F.lit(1), F.when(_copies() > 0, _copies()).cast("int"))).alias("copy")).select("row.*")


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
       ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), ' ', coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS w,
             2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS lev
      FROM w WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(lev, cap / w) FROM l WHERE lev * w <= cap)) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS full_copies FROM t),
r AS (SELECT *, target - full_copies * source_size AS rest FROM p),
u AS (SELECT d.doc_id, d.size, r.source_size, r.target, full_copies, rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY h)::BIGINT AS upto,
             sum(size) OVER (PARTITION BY d.source, h)::BIGINT AS inside
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (size * (full_copies + CASE WHEN upto <= rest THEN 1
                WHEN upto - inside <= rest AND upto - rest < rest - (upto - inside) THEN 1 ELSE 0 END))::BIGINT AS taken FROM u
"""


@register("op1_mixing", SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the mix takes of it."""
    return mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
