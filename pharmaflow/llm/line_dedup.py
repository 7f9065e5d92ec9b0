"""Op 8, line dedup by site-relative frequency.

A line is boilerplate on a host when it stands on more than ``max_ratio`` of the
host's pages and on at least ``min_pages`` of them, or on more than ``site_ratio`` and at
least ``site_pages``. A page counts once for a line however often it repeats it. Lines
without a word are kept.

The first rule is for small hosts, where three pages can be a large share. The second is
for hosts of 100 pages and more, where most repeated lines stand on a few percent of the
pages: on sf0.1 (20 hosts of 500 pages) only one line is on more than 10 % of a host, the
others are on up to 4.8 %. One percent is clearly below that. Ten pages are above what
copies of whole documents (at most 4 of a text on a host of sf0.1) or a chance repetition
reach: 99.8 % of the (host, line) pairs there have fewer. On hosts of more than 1,000 pages
the ratio is the stricter of the two.

Scale: a page sends the 128-bit fingerprints of its distinct lines, never the
text, and they are counted map-side before they move, so that a line or a host
with a third of all rows costs one row per task. A host has at most (mean lines
per page) / ``site_ratio`` boilerplate lines; they are gathered per host, written,
and joined to the pages by host. Spark broadcasts that table while its written size
is under ``spark.sql.autoBroadcastJoinThreshold``, and then no text moves at all;
beyond it the join shuffles and AQE splits a hot host.

Defined cases: a NULL text has no lines and stays NULL; NULL hosts are one host; an
empty table gives an empty result; repeated rows are pages of their own; a text
that loses all its lines becomes the empty text and its row stays; the input's
further columns travel inside ``row``, whatever their names. A text of many lines takes
time in proportion: its lines are made distinct, and looked up, by hashing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import has_word, register, saved, table

MAX_RATIO, MIN_PAGES = 0.1, 3
SITE_RATIO, SITE_PAGES = 0.01, 10


def _print_of(line: Column) -> Column:
    """128-bit fingerprint of a line, as text: sets of text are hashed."""
    return F.concat(F.hex(F.xxhash64(line)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), line)))


def _prints(text: Column) -> Column:
    """Fingerprints of the distinct lines that have a word."""
    return F.transform(F.filter(F.array_distinct(F.split(text, "\n")), has_word), _print_of)


def boilerplate_lines(df: DataFrame, host_col: str = "source", text_col: str = "text",
                      max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
                      site_ratio: float = SITE_RATIO, site_pages: int = SITE_PAGES) -> DataFrame:
    """Lines over either ratio, by fingerprint: (host, print, pages, total)."""
    totals = df.groupBy(F.col(host_col).alias("host")).agg(F.count(F.lit(1)).alias("total"))
    counts = (df.select(F.col(host_col).alias("host"), F.explode(_prints(F.col(text_col))).alias("print"))
              .groupBy("host", "print")
              .agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min(min_pages, site_pages)))
    return (counts.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
            .where(((F.col("pages") >= min_pages) & (F.col("pages") > F.lit(max_ratio) * F.col("total")))
                   | ((F.col("pages") >= site_pages) & (F.col("pages") > F.lit(site_ratio) * F.col("total"))))
            .select("c.host", "print", "pages", "total"))


def _without(text: Column, bad: Column) -> Column:
    """(text, n_lines, n_dropped) of a text without the lines in ``bad``. A lambda over an array of one item
    names a value within the expression, so that no list of lines becomes a column of its own."""
    def named(value: Column, make) -> Column:
        return F.transform(F.array(value), make)[0]

    def result(lines: Column, here: Column) -> Column:
        kept = F.filter(lines, lambda x: ~F.array_contains(here, _print_of(x)) | ~has_word(x))
        return F.when(F.size(here) == 0, F.struct(text.alias("text"), F.size(lines).alias("n"), F.lit(0).alias("gone"))).otherwise(
            named(kept, lambda k: F.struct(F.array_join(k, "\n").alias("text"), F.size(lines).alias("n"),
                                           (F.size(lines) - F.size(k)).alias("gone"))))

    # the text's own bad lines, found by hashing; usually none
    found = F.coalesce(F.array_intersect(_prints(text), bad), F.array().cast("array<string>"))
    return named(F.split(text, "\n"), lambda lines: named(found, lambda here: result(lines, here)))


def line_dedup(df: DataFrame, host_col: str = "source", text_col: str = "text",
               max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES,
               site_ratio: float = SITE_RATIO, site_pages: int = SITE_PAGES) -> DataFrame:
    """``row`` (the input row as a struct), ``text`` without boilerplate lines,
    ``n_lines`` and ``n_dropped``. Lines keep their order and are joined by \\n."""
    bad = boilerplate_lines(df, host_col, text_col, max_ratio, min_pages, site_ratio, site_pages)
    bad = saved(bad.groupBy("host").agg(F.collect_list("print").alias("bad")), "boilerplate")
    rows = df.select(F.struct("*").alias("row"), F.col(host_col).alias("host"))
    d = rows.alias("r").join(bad.alias("h"), F.col("r.host").eqNullSafe(F.col("h.host")), "left")
    t = F.col("row").getField(text_col)
    d = d.select("row", F.when(t.isNotNull(), _without(t, F.col("bad"))).alias("r"))
    return d.select("row", "r.text", F.coalesce("r.n", F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce("r.gone", F.lit(0)).cast("long").alias("n_dropped"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
t AS (SELECT source, count(*) AS total FROM d GROUP BY source),
c AS (SELECT source, line, count(DISTINCT r) AS pages FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line),
b AS (SELECT c.source, line FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
      WHERE (pages >= {MIN_PAGES} AND pages > {MAX_RATIO}::DOUBLE * total) OR (pages >= {SITE_PAGES} AND pages > {SITE_RATIO}::DOUBLE * total)),
m AS (SELECT r, l.line, i, b.line IS NOT NULL AS bad FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line),
k AS (SELECT r, count(*) AS n_lines, count(*) FILTER (bad) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad), '') AS text FROM m GROUP BY r)
SELECT d.doc_id, d.source, k.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM d LEFT JOIN k USING (r)
"""


@register("op8_line_dedup", SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the boilerplate lines of their source."""
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "row.source", "text", "n_lines", "n_dropped")
