"""Exact, linear-interpolated quantiles by nested histograms.

Every double has an integer key that sorts like it (the bits of its IEEE form:
exponent, then mantissa; negative values mirrored). One scan counts the rows of each
group by the leading ``bits`` of the key. Prefix counts over that histogram tell
which bucket holds each wanted rank; only rows in such a bucket are counted again by the
next ``bits``, and so on. A bucket whose smallest and largest value are equal needs no
refining, so at the latest the whole key has settled every rank.

The method is the same at every size. Rows are only counted, combined before they move,
and never sorted; a value that a third of all rows hold is one bucket. A level's histogram
has at most ``2 ** bits`` rows for each bucket that is refined, and at most two are refined per
(group, probability). Nothing is gathered on the driver.

The result for rank position ``pos = p * (n - 1)`` is
``v[floor] + (v[ceil] - v[floor]) * (pos - floor)``, the same as ``percentile``
and SQL ``quantile_cont``. NaN sorts after infinity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir
from .small import small

BITS = 16  # of the key per level: at most 65,536 buckets in a histogram
_KEY = 63  # bits of a key without its sign

_TINY = 2.0 ** -1022  # fixed values of the IEEE form: smallest normal double, mantissa bits, exponent bias
_MANTISSA, _BIAS = 52, 1023


def with_order_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with a long that sorts like the double column ``value``: the bits of its absolute value,
    negated below 0. Each step is a column of its own, so that none is computed twice."""
    a, v, e, p = F.col("_abs"), F.col(value), F.col("_exp"), F.col("_pow")
    d = df.withColumn("_abs", F.abs(v)).withColumn("_exp", F.least(F.floor(F.log2(a)), F.lit(_BIAS))).withColumn("_pow", F.pow(F.lit(2.0), e))
    # log2 may be off by one next to a power of two
    d = d.withColumn("_off", F.when(a < p, -1).when(a >= 2 * p, 1).otherwise(0))
    power = F.when(F.col("_off") < 0, p / 2).when(F.col("_off") > 0, p * 2).otherwise(p)
    normal = (e + F.col("_off") + _BIAS).cast("long") * (1 << _MANTISSA) + ((a / power - 1) * 2.0 ** _MANTISSA).cast("long")
    below = (a * 2.0 ** 537 * 2.0 ** 537).cast("long")  # counts of the smallest subnormal
    top = F.lit(0x7FF).cast("long") * (1 << _MANTISSA)
    d = d.withColumn("_bits", F.when(F.isnan(a), top + 1).when(a == float("inf"), top).when(a < _TINY, below).otherwise(normal))
    # never NULL for a value: a join on a part of the key then needs no filter, which Spark would move below all these steps
    key = F.coalesce(F.when(v < 0, -F.col("_bits")).otherwise(F.col("_bits")), F.lit(0).cast("long"))
    return d.withColumn(name, key).drop("_abs", "_exp", "_pow", "_off", "_bits")


def quantiles(long: DataFrame, probs: Sequence[float], group: str = "feature",
              value: str = "value", bits: int = BITS) -> DataFrame:
    """(group, q0, q1, ...) exact quantiles of ``value`` per ``group`` for
    ``probs`` (NULL values and groups are ignored; groups without values are absent).
    ``bits`` is the number of key bits per level."""
    ensure_checkpoint_dir(long.sparkSession)
    probs = [float(p) for p in probs]
    if not probs or any(not 0.0 <= p <= 1.0 for p in probs):
        raise ValueError(f"probabilities lie between 0 and 1: {probs}")
    if not 1 <= bits <= 24:
        raise ValueError(f"bits is 1 to 24, not {bits}")
    data = long.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")).where("_g IS NOT NULL AND _v IS NOT NULL")
    data = with_order_key(data, "_v", "_k")
    shift = _KEY - bits
    hist = _histogram(data.withColumn("_p", F.lit(0).cast("long")), shift)
    # ranks asked for: the rank below each position and the one above it
    n = hist.groupBy("_g").agg(F.sum("_c").alias("_n"))
    asked = n.select("_g", F.posexplode(F.array(*[F.lit(p) for p in probs])).alias("_i", "_q"), "_n").select(
        "_g", "_i", (F.col("_q") * (F.col("_n") - 1)).alias("_pos")).select(
        "_g", "_i", (F.col("_pos") - F.floor("_pos")).alias("_w"),
        F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_r"))
    asked = asked.distinct().withColumn("_p", F.lit(0).cast("long"))
    settled = []
    while True:
        hit = _placed(asked, hist).checkpoint(eager=True)
        settled.append(hit.where(F.col("_lo") == F.col("_hi")).select("_g", "_i", "_w", F.col("_lo").alias("_x")))
        open_ = hit.where(F.col("_lo") != F.col("_hi"))
        if open_.isEmpty():
            break
        # the rows of the buckets that hold a rank, by the next bits of their key
        wanted = small(open_.select("_g", F.col("_b").alias("_p")).distinct())
        inner = data.withColumn("_p", F.shiftright("_k", shift)).join(wanted, ["_g", "_p"])
        asked = open_.select("_g", "_i", "_w", (F.col("_r") - F.col("_before")).alias("_r"), F.col("_b").alias("_p"))
        shift = max(0, shift - bits)
        hist = _histogram(inner, shift)
    found = settled[0]
    for s in settled[1:]:
        found = found.unionByName(s)
    x = F.min("_x") + (F.max("_x") - F.min("_x")) * F.max("_w")
    # equal ends need no weight, and infinite ones allow none
    per = found.groupBy("_g", "_i").agg(F.when(F.min("_x") == F.max("_x"), F.min("_x")).otherwise(x).alias("_x"))
    return per.groupBy(F.col("_g").alias(group)).agg(
        *[F.max(F.when(F.col("_i") == i, F.col("_x"))).alias(f"q{i}") for i in range(len(probs))])


def _histogram(rows: DataFrame, shift: int) -> DataFrame:
    """Rows by group, bucket of the level above (``_p``) and bucket, with the values' range."""
    return rows.groupBy("_g", "_p", F.shiftright("_k", shift).alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).checkpoint(eager=True)


def _placed(asked: DataFrame, hist: DataFrame) -> DataFrame:
    """The bucket that holds each asked rank of its parent bucket, and the rows before it there."""
    over = Window.partitionBy("_g", "_p").orderBy("_b")
    cum = hist.withColumn("_upto", F.sum("_c").over(over.rowsBetween(Window.unboundedPreceding, 0)))
    cum = cum.withColumn("_before", F.col("_upto") - F.col("_c"))
    return asked.join(cum, ["_g", "_p"]).where((F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_upto")))
