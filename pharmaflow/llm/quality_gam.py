"""Op 3, quality classifier: a generalised additive model with pairwise interactions.

Features are counts and ratios of the whole text, computed as column expressions.
Training is cyclic gradient boosting: turn by turn each feature gets a shallow tree over
its quantile bins, whose leaves are added to the feature's lookup table with a small
step; then the pairs whose joint tree explains most of what is left get tables of their
own in the same way. A score is the sigmoid of an intercept and one table entry per
feature and pair, looked up for whole batches at a time.

Scale: the fit sees at most ``SAMPLE`` labelled rows, drawn by a hash of the id, and
runs on their features alone (``SAMPLE`` x 12 numbers on the driver). Scoring is a map over the
documents without shuffle; the tables are some thousand numbers.

Defined cases: a NULL text counts as empty and is scored; rows without a label, or with a
NULL one, are not learnt from; without labelled rows of both classes every score is the
smoothed share of label 1; a NULL id is held out; repeated rows are scored one by one; an empty
table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import register, saved, table, words
from .quality_rules import measures

SAMPLE = 20_000  # labelled rows learnt from at most
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS, STEP = 150, 60, 6, 0.1
MIN_WEIGHT = 2.0  # least sum of second derivatives in a leaf
SMOOTH = 1.0
CUT = 0.3

FEATURES = ["log_words", "word_length", "symbols", "stop_words", "dup_lines", "repeats", "line_words",
            "upper", "digits", "punctuation", "shouts", "distinct"]


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the FEATURES of every row."""
    t = F.coalesce(F.col(text_col), F.lit(""))

    def without(chars):
        return (F.length(t) - F.length(F.translate(t, chars, ""))).alias

    row = F.struct(F.col(id_col).alias("id"), F.length(t).alias("chars"),
                   F.length(F.regexp_replace(t, r"\P{Lu}+", "")).alias("n_upper"), without("0123456789")("n_digits"),
                   without(".,;:?")("n_punct"), without("!")("n_shouts"), F.size(F.array_distinct(words(t))).alias("n_distinct"))
    m = measures(df.select(row.alias("row"), t.alias("t")), "row", "t")
    n, lines, chars = (F.greatest(c, F.lit(1)).cast("double") for c in (F.col("n_words"), F.col("n_lines"), F.col("row.chars")))
    return m.select("row.id", F.log1p("n_words").alias("log_words"), (F.col("word_chars") / n).alias("word_length"),
                    (F.col("n_symbols") / n).alias("symbols"), (F.col("n_stop_words") / n).alias("stop_words"),
                    (F.col("n_dup_lines") / lines).alias("dup_lines"), (F.col("n_repeat_words") / n).alias("repeats"),
                    (F.col("n_words") / lines).alias("line_words"), (F.col("row.n_upper") / chars).alias("upper"),
                    (F.col("row.n_digits") / chars).alias("digits"), (F.col("row.n_punct") / n).alias("punctuation"),
                    (F.col("row.n_shouts") / n).alias("shouts"), (F.col("row.n_distinct") / n).alias("distinct"))


@dataclass
class Gam:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(e, x[:, j], side="right")]
        coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.pair_edges)]
        for i, j, t in self.pairs:
            total += t[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges at quantiles, between distinct values."""
    u = np.unique(v)
    if len(u) <= bins:
        return (u[1:] + u[:-1]) / 2
    q = np.quantile(v, np.arange(1, bins) / bins)
    # heavy values take several quantiles; the freed ones go to the distinct values
    return np.unique(np.concatenate([q, np.quantile(u, np.arange(1, bins // 4) / (bins // 4))]))


def _gain(g, h):
    return g * g / (h + SMOOTH)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of per-bin sums."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= MIN_WEIGHT) & (hr >= MIN_WEIGHT), _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum()), -1.0)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (-1.0, 0)


def tree_1d(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values by bin of a tree over one feature's bins."""
    gain, at = _best_cut(g, h) if depth else (-1.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + SMOOTH))
    return np.concatenate([tree_1d(g[:at], h[:at], depth - 1), tree_1d(g[at:], h[at:], depth - 1)])


def tree_2d(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values by cell of a tree over two features' bins."""
    rows, cols = (_best_cut(g.sum(axis=a), h.sum(axis=a)) for a in (1, 0)) if depth else ((-1.0, 0), (-1.0, 0))
    if max(rows[0], cols[0]) <= 1e-9:
        return np.full(g.shape, g.sum() / (h.sum() + SMOOTH))
    if rows[0] >= cols[0]:
        return np.vstack([tree_2d(g[:rows[1]], h[:rows[1]], depth - 1), tree_2d(g[rows[1]:], h[rows[1]:], depth - 1)])
    return np.hstack([tree_2d(g[:, :cols[1]], h[:, :cols[1]], depth - 1), tree_2d(g[:, cols[1]:], h[:, cols[1]:], depth - 1)])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS) -> Gam:
    """The model of rows ``x`` with labels ``y`` (0/1)."""
    p = (y.sum() + 1) / (len(y) + 2)
    gam = Gam(float(np.log(p / (1 - p))))
    if len(np.unique(y)) < 2:
        return gam
    n_features = x.shape[1]
    gam.edges = [_edges(x[:, j], BINS) for j in range(n_features)]
    gam.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(n_features)]
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(gam.edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(gam.pair_edges)]
    gam.tables = [np.zeros(len(e) + 1) for e in gam.edges]
    total = np.full(len(y), gam.intercept)

    def slopes():
        q = 1 / (1 + np.exp(-total))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for j in range(n_features):
            g, h = slopes()
            n = len(gam.tables[j])
            step = STEP * tree_1d(np.bincount(fine[j], g, n), np.bincount(fine[j], h, n))
            gam.tables[j] += step
            total += step[fine[j]]

    def cells(i, j, g, h):
        shape = (len(gam.pair_edges[i]) + 1, len(gam.pair_edges[j]) + 1)
        at = coarse[i] * shape[1] + coarse[j]
        return np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = []
    for i, j in combinations(range(n_features), 2):
        cg, ch = cells(i, j, g, h)
        leaf = tree_2d(cg, ch)
        gains.append((float((leaf * cg).sum()), i, j))
    best = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:pairs] if gain > 1e-9]
    tables = {ij: np.zeros((len(gam.pair_edges[ij[0]]) + 1, len(gam.pair_edges[ij[1]]) + 1)) for ij in best}
    for _ in range(pair_rounds):
        for i, j in best:
            g, h = slopes()
            step = STEP * tree_2d(*cells(i, j, g, h))
            tables[i, j] += step
            total += step[coarse[i], coarse[j]]
    gam.pairs = [(i, j, tables[i, j]) for i, j in best]
    return gam


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE) -> Gam:
    """A model of the rows that are not held out."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    n = rows.count()
    share = min(1.0, sample / max(1, n))
    picked = rows.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label")).limit(sample)
    # at most ``sample`` rows of an id and a label
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(saved(picked, "gam-sample")), "id")
    got = features(texts.select(F.struct("id", "label").alias("key"), "t"), "key", "t").select("id.label", *FEATURES).collect()
    x = np.array([r[1:] for r in got], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([1.0 if r[0] else 0.0 for r in got])
    order = np.lexsort(np.column_stack([x, y]).T) if len(y) else []  # the same sums whatever order the rows came in
    return fit(x[order], y[order])


def score(docs: DataFrame, gam: Gam, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    f = features(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in FEATURES])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(gam.score(x))], ["id", "score"])

    return f.mapInArrow(run, f"id {f.schema['id'].dataType.simpleString()}, score double")


@register("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document, learnt from the rows not held out."""
    docs = table(spark, sf_dir, "documents")
    gam = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, gam).select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                                   (F.col("score") >= CUT).cast("int").alias("predicted"))
