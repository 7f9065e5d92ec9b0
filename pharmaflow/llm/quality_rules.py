"""Op 5, quality rules: a threshold table compiled into one Spark projection.

Every figure is a column expression over the row's own text, so the operator is
a map without shuffle: no UDF, no state, and a text is never cut.

Defined cases: a NULL text counts as a text without words (all counts 0, rejected
by the base rule); an empty table gives an empty result; repeated rows and rows
with a NULL id are judged one by one; further input columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import WS, evaluated, has_word, register, table, words

# The ten most frequent function words of each language served.
STOP_WORDS = (
    "the of and to a in is it that for "
    "de la le et les des en un une que "
    "der die und das mit den von zu ist ein "
    "el los las y por con del se para no"
).split()
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``lo <= numerator / denominator <= hi`` for texts with a positive
    denominator; an open side is None. Compared by products, so that counts stay
    whole numbers."""
    name: str
    numerator: str
    denominator: str
    lo: float | None = None
    hi: float | None = None

    def passes(self) -> Column:
        n, d = F.col(self.numerator).cast("double"), F.col(self.denominator).cast("double")
        ok = F.lit(True)
        if self.lo is not None:
            ok = ok & (n >= d * F.lit(self.lo))
        if self.hi is not None:
            ok = ok & (n <= d * F.lit(self.hi))
        return ok

    def sql(self) -> str:
        parts = [f"{self.numerator}::DOUBLE {op} {self.denominator}::DOUBLE * {v!r}::DOUBLE"
                 for op, v in ((">=", self.lo), ("<=", self.hi)) if v is not None]
        return "(" + " AND ".join(parts or ["TRUE"]) + ")"


#: The verdict beyond the base rule. Each threshold is a parameter of ``quality_rules``.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.5, 12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.6),
    Rule("words_per_line", "n_words", "n_lines", 2.0, None),
)
MIN_WORDS, REPEAT_PERCENT = 50, 50


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and the counts the rules use.

    Repeated windows: each window becomes a 64-bit hash whose low bits are
    replaced by its position (as few bits as the text needs), so one primitive
    sort puts equal windows side by side. Words covered by the windows found twice
    or more are then counted from the gaps between their positions.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(t, "\n"), has_word)
    d = df.select(F.col(id_col).alias("id"), t.alias("t"), words(t).alias("w"), lines.alias("l"))
    n = F.size("w")
    d = d.select(
        "id", "w", n.alias("n"),
        F.length(F.translate("t", WS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        # the smallest power of two above the number of positions
        F.expr("shiftleft(1L, length(bin(size(w))))").alias("slots"))
    window = F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))
                         .bitwiseAND(-F.col("slots")).bitwiseOR(i.cast("long")))
    counts = ["word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words"]
    d = d.select("id", "n", "slots", *counts,
                 F.sort_array(F.slice(window, 1, F.greatest(F.col("n") - 2, F.lit(0)))).alias("s"))

    def same(a, b):  # equal but for the position bits
        return F.coalesce(a.bitwiseXOR(b).bitwiseAND(-F.col("slots")) == 0, F.lit(False))

    twice = F.filter("s", lambda x, i: same(x, F.get("s", i - 1)) | same(x, F.get("s", i + 1)))
    d = d.select("id", "n", *counts, F.sort_array(
        F.transform(twice, lambda x: x.bitwiseAND(F.col("slots") - 1))).alias("p"))
    covered = F.aggregate(
        F.transform("p", lambda x, i: F.least(F.coalesce(F.get("p", i + 1) - x, F.lit(3)), F.lit(3))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return evaluated(d.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"), *counts,
                              covered.alias("n_repeat_words")))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules=RULES, min_words: int = MIN_WORDS,
                  repeat_percent: int = REPEAT_PERCENT) -> DataFrame:
    """``measures`` plus ``base_failed`` (too short or too repetitive), ``kept``
    and ``failed`` (names of the table's rules that the text breaks)."""
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~r.passes(), r.name) for r in rules]))
    return (measures(df, id_col, text_col).withColumn("base_failed", base).withColumn("failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))


def passing(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The input rows that the rules keep, with all their columns."""
    packed = df.select(F.struct("*").alias("row"), F.col(text_col).alias("t"))
    return quality_rules(packed, "row", "t", **options).where("kept").select("row.*")


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
b AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
c AS (SELECT doc_id, r, w, len(w) AS n_words,
             list_sum(list_transform(w, lambda x: length(x))) AS wc,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
             len(list_filter(w, lambda x: lower(x) IN ({_STOP_SQL}))) AS n_stop_words FROM b),
g AS (SELECT r, i, w[i] AS a, w[i+1] AS b, w[i+2] AS c
      FROM (SELECT r, w, unnest(range(1, n_words - 1)) AS i FROM c)),
h AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM g) WHERE k > 1),
p AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, i + j AS p FROM h, (VALUES (0), (1), (2)) v(j)) GROUP BY r),
m AS (SELECT doc_id, n_words, coalesce(wc, 0)::BIGINT AS word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words,
             coalesce(n_repeat_words, 0) AS n_repeat_words FROM c LEFT JOIN p USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(r.sql() for r in RULES)} AS kept FROM f
"""


@register("op5_quality_rules", SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their counts and the verdict."""
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
