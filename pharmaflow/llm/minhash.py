"""Op 2, near-duplicate documents by ProbMinHash.

Shingles are runs of five words. A shingle that a text holds ``tf`` times weighs
``1 + ln(tf)``. Every shingle is a Poisson process of that rate whose arrivals, drawn
from the shingle's hash alone, fall on random registers; a register keeps its first
arrival. Two texts agree on a register with the probability Jaccard of their
weighted shingles. Arrivals of a shingle only get later, so it stops as soon as one
comes after the text's slowest register (early termination).

``bands`` x ``rows`` registers are banded. So are as many registers of the same process with
all weights 1, which agree with the plain Jaccard: links are defined by that, and a
shingle that only one text repeats can make the weighted measure as small as it likes.
Without repeated shingles both are the same registers and bands. Texts that share a band
are verified by the exact Jaccard of their shingle sets (``threshold``), and links make
classes.

Scale. Equal texts are one node from the start. Sizes of the shingle sets travel with the
buckets, and pairs that they rule out are never made. A bucket does not emit its pairs. In
a round each node that may still gain a link meets one other node only (its *hub*: of the nodes at
the head of its buckets the one that shares most buckets with others), so a round has at most as
many pairs as nodes; one (``HUB_ROUNDS``) joins most of a group of near copies. What is left
are buckets that still hold several components. Their members are compared in blocks inside the tasks, first
by one byte of each register with weights 1 (a pair is passed over when its share of equal
bytes is ``EPS`` deviations below the threshold), then those with a possible partner exactly, by their
shingle sets. A block gives links, at most one a node, and a pair is
compared in the first bucket that it shares. Large buckets are
split into blocks that meet two by two in separate tasks, so no bucket has a cap.

Defined cases: a text of one to four words is one shingle; a text without words (or
NULL) is alone in its class; the class id is the smallest id of the class, NULL only if
all its ids are NULL; rows that repeat id and text are one document; an empty table
gives an empty result; the input's further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import broadcast_if, carry, register, saved, table, words
from .components import connected_components
from .embedding_dedup import BLOCK, _blocks as block_pairs, _pair_chunks, _sorted as sorted_blocks, _whole_groups

SHINGLE, THRESHOLD = 5, 0.8
# by the bands with weights 1, a pair at 0.8 shares no band with probability 5e-4, one at 0.4 shares one with 0.05
BANDS, ROWS = 32, 7
HUB_ROUNDS = 1  # rounds in which a node meets one other; each is followed by components, which blocks do without
EPS = 4.0  # deviations of the estimate below the threshold at which a pair is passed over
CHUNK = 1_000_000  # shingles handled at once in a task

_U = np.uint64
_K1, _K2, _K3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)  # fixed: splitmix64


def _step(i: int) -> np.uint64:
    """The i-th offset of a shingle's random stream."""
    return _U(int(_K1) * i % 2 ** 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _K2
    x = (x ^ (x >> _U(27))) * _K3
    return x ^ (x >> _U(31))


def shingles_of(hashes: np.ndarray, ends: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts laid end to end as word hashes, and each one's text.
    ``ends[i]`` is where text i ends. Shorter texts are padded to one shingle."""
    n = np.diff(ends, prepend=0)
    pad = np.where((n > 0) & (n < size), size - n, 0)
    starts = np.concatenate([[0], np.cumsum(n + pad)[:-1]]) if len(n) else np.zeros(0, np.int64)
    laid = np.full(int((n + pad).sum()), 0xA5A5A5A5, dtype=_U)
    doc_of_word = np.repeat(np.arange(len(n)), n)
    laid[np.arange(len(hashes)) - np.repeat(ends - n, n) + starts[doc_of_word]] = hashes
    k = np.maximum(n + pad - size + 1, 0)
    doc = np.repeat(np.arange(len(n)), k)
    at = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + starts[doc]
    out = np.zeros(len(at), dtype=_U)
    for j in range(size):
        out = mix(out * _K1 + laid[at + j] + _U(j + 1))
    return out, doc


def _distinct(shingles: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text, their texts, and how often the text holds each."""
    key = shingles ^ mix(doc.astype(_U) + _K1)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    tf = np.diff(np.append(first, len(key)))
    return shingles[order[first]], doc[order[first]], tf


def _registers(el: np.ndarray, doc: np.ndarray, rate: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    best = np.full(n_docs * registers, np.inf)
    sig = np.zeros(n_docs * registers, dtype=_U)
    t, turn = np.zeros(len(el)), 0
    while len(el):
        u = mix(el + _step(2 * turn + 1))
        t = t - np.log(((u >> _U(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / rate
        slot = doc * registers + (mix(el + _step(2 * turn + 2)) % _U(registers)).astype(np.int64)
        early = np.flatnonzero(t < best[slot])
        early = early[np.argsort(-t[early])]  # the earliest arrival is written last
        best[slot[early]], sig[slot[early]] = t[early], el[early]
        going = t < best.reshape(n_docs, registers).max(axis=1)[doc]
        el, doc, rate, t = el[going], doc[going], rate[going], t[going]
        turn += 1
    return sig.reshape(n_docs, registers)


def signatures(shingles: np.ndarray, doc: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """ProbMinHash registers (n_docs x registers) of weighted shingles; rows of texts
    without shingles are 0."""
    el, doc, tf = _distinct(shingles, doc)
    return _registers(el, doc, 1.0 + np.log(tf), n_docs, registers)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sig), bands), dtype=_U) + _K1 * np.arange(1, bands + 1, dtype=_U)
    for j in range(rows):
        out = mix(out * _K2 + sig.reshape(len(sig), bands, rows)[:, :, j])
    return out.view(np.int64)


def all_band_keys(shingles: np.ndarray, doc: np.ndarray, n_docs: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(n_docs x 2 bands) keys of the weighted registers and, where they differ, of those with all
    weights 1 (0 where they do not), and the size of each text's shingle set."""
    el, doc, tf = _distinct(shingles, doc)
    weighted = band_keys(_registers(el, doc, 1.0 + np.log(tf), n_docs, bands * rows), bands, rows)
    plain, repeats = weighted.copy(), np.bincount(doc[tf > 1], minlength=n_docs) > 0
    if repeats.any():  # without repeated shingles both are equal
        some, at = repeats[doc], np.cumsum(repeats) - 1
        plain[repeats] = band_keys(_registers(el[some], at[doc[some]], np.ones(int(some.sum())), int(repeats.sum()), bands * rows), bands, rows)
    return np.concatenate([weighted, np.where(plain != weighted, plain, 0)], axis=1), np.bincount(doc, minlength=n_docs)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    ends = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]].view(_U), ends[1:] - ends[0]


def _blocks(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about CHUNK words together."""
    at = 0
    while at < len(ends):
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right"))
        yield at, (at := max(upto, at + 1))


def _each_block(batch: pa.RecordBatch):
    flat, ends = _flat(batch.column("h"))
    for a, b in _blocks(ends):
        start = ends[a - 1] if a else 0
        yield batch.slice(a, b - a), *shingles_of(flat[start:ends[b - 1]], ends[a:b] - start), b - a


def _band_batches(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for part, sh, doc, n in _each_block(batch):
                keys, size = all_band_keys(sh, doc, n, bands, rows)
                arr = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, 2 * bands, dtype=np.int32), keys.ravel())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("node"), arr, pa.array(size.astype(np.int32))],
                                                 ["id", "node", "bands", "size"])
    return run


def _shingle_batches(registers: int):
    """(node, s, sketch): the shingle set, and a byte of each register with weights 1."""
    def run(batches):
        for batch in batches:
            for part, sh, doc, n in _each_block(batch):
                order = np.lexsort((sh, doc))
                sh, doc = sh[order], doc[order]
                new = np.concatenate([[True], (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])]) if len(sh) else np.zeros(0, bool)
                sh, doc = sh[new], doc[new]
                k = np.bincount(doc, minlength=n)
                arr = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(k)]).astype(np.int32), sh.view(np.int64))
                sketch = (mix(_registers(sh, doc, np.ones(len(sh)), n, registers)) >> _U(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([part.column("node"), arr, pa.array([x.tobytes() for x in sketch], pa.binary())],
                                                 ["node", "s", "sketch"])
    return run


def _node(ws: Column) -> Column:
    """Digest of a text's words; NULL without words."""
    return F.when(F.size(ws) > 0, F.unhex(F.md5(F.array_join(ws, " "))))


def _hashes(ws: Column) -> Column:
    return F.transform(ws, lambda x: F.xxhash64(x))


def _fits(a: Column, b: Column, threshold: float) -> Column:
    """Sets of these sizes can have that Jaccard similarity."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(threshold)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have that Jaccard similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    d = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("sum"))
    return d.where(F.col("both") >= F.lit(threshold) * (F.col("sum") - F.col("both"))).select("a", "b")


def _open(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """Buckets that hold several components: their rows with each node's component, and the
    largest one of the bucket."""
    comps = connected_components(links)
    named = buckets.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    sizes = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    many = (sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("k"))
            .where("k > 1").select("key", F.col("top.comp").alias("top")))
    return saved(named.join(many, "key"), "near-open")


def _hub_pairs(rows: DataFrame, tried: DataFrame | None, threshold: float) -> DataFrame:
    """One new pair for every node outside the largest component of a bucket: with the hub of
    another component there."""
    def head(cond: Column | None = None) -> Column:
        h = F.struct("hub", "node", "comp", "size")
        return F.max(h if cond is None else F.when(cond, h))

    # of each bucket the hub of the largest component, and the hub of the others
    heads = rows.groupBy("key").agg(head(F.col("comp") == F.col("top")).alias("one"), head(F.col("comp") != F.col("top")).alias("two"))
    met = rows.where(F.col("comp") != F.col("top")).join(heads, "key").select("node", "comp", "size", F.explode(F.array("one", "two")).alias("h"))
    met = met.where((F.col("h.comp") != F.col("comp")) & _fits(F.col("size"), F.col("h.size"), threshold)).select(
        "node", F.struct("h.hub", F.col("h.node").alias("node")).alias("h"))
    if tried is not None:
        old = tried.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
        old = old.select(F.col("p.a").alias("node"), F.col("p.b").alias("other"))
        met = met.withColumn("other", F.col("h.node")).join(old, ["node", "other"], "left_anti")
    best = met.groupBy("node").agg(F.max("h").alias("h"))
    return best.select(F.least("node", "h.node").alias("a"), F.greatest("node", "h.node").alias("b")).distinct()


def _near_pairs(f, threshold: float, registers: int):
    """Row numbers (a, b) of a block's pairs from different components that sizes and sketches allow."""
    least = threshold - EPS * math.sqrt(threshold * (1 - threshold) / registers)
    sketch = np.frombuffer(b"".join(f["sketch"]), np.uint8).reshape(len(f), registers)
    comp, size = np.unique(f["comp"].to_numpy(), return_inverse=True)[1], f["size"].to_numpy()
    for a, b in _pair_chunks(f):
        near = (comp[a] != comp[b]) & (np.minimum(size[a], size[b]) >= np.maximum(size[a], size[b]) * threshold)
        a, b = a[near], b[near]
        near = (sketch[a] == sketch[b]).mean(axis=1) >= least
        yield a[near], b[near]


def _possible(bands: int, registers: int, threshold: float):
    """Rows of a block that take part in such a pair, if no earlier bucket has the pair too."""
    def run(batches):
        for f in _whole_groups(batches):
            keys, t = np.stack(f["keys"].to_numpy()).reshape(len(f), 2, bands), f["t"].to_numpy()
            alive = np.zeros(len(f), bool)
            for a, b in _near_pairs(f, threshold, registers):
                earlier = np.arange(bands) < t[a, None]
                both = [(keys[a, x] == keys[b, y]) & (keys[a, x] != 0) & earlier for x in (0, 1) for y in (0, 1)]
                new = ~np.logical_or.reduce(both).any(axis=1)
                alive[a[new]] = alive[b[new]] = True
            yield pa.RecordBatch.from_pandas(f.loc[alive], schema=_ALIVE, preserve_index=False)
    return run


_ALIVE = pa.schema([("dim", pa.int32()), ("t", pa.int32()), ("key", pa.int64()), ("i", pa.int64()), ("j", pa.int64()),
                    ("role", pa.int32()), ("node", pa.binary()), ("comp", pa.binary()), ("size", pa.int32())])


def _linked(threshold: float, registers: int):
    """Links (a, b) between the components of a block, by the shingle sets; no more than join them."""
    def run(batches):
        for f in _whole_groups(batches):
            comp, nodes = f["comp"].to_numpy(), f["node"].to_numpy()
            sets = [x.view(_U) for x in f["s"]]
            root: dict[bytes, bytes] = {}

            def find(x: bytes) -> bytes:
                while root.setdefault(x, x) != x:
                    root[x] = x = root[root[x]]
                return x

            one, two = [], []
            for a, b in _near_pairs(f, threshold, registers):
                for x, y in zip(a, b):
                    if (rx := find(comp[x])) == (ry := find(comp[y])):
                        continue
                    at = np.minimum(np.searchsorted(sets[x], sets[y]), len(sets[x]) - 1)
                    both = int((sets[x][at] == sets[y]).sum())
                    if both >= threshold * (len(sets[x]) + len(sets[y]) - both):
                        root[rx] = ry
                        one.append(nodes[x])
                        two.append(nodes[y])
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.binary()), pa.array(two, pa.binary())], ["a", "b"])
    return run


def _block_links(rows: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float, bands: int, registers: int) -> DataFrame:
    """Links between components that still share a bucket (``rows``), found in blocks."""
    # both halves of a node's keys have one place for each band
    rows = rows.select(F.lit(0).alias("dim"), (F.col("t") % bands).alias("t"), "key", "node", "comp", "size")
    large = (rows.groupBy("dim", "t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
             .select("dim", "t", "key", F.ceil(F.col("n") / BLOCK).cast("long").alias("s")))
    first = rows.join(nodes.select("node", F.col("bands").alias("keys")), "node").join(sets.select("node", "sketch"), "node")
    blocks = sorted_blocks(block_pairs(first, saved(large, "near-large")))
    alive = saved(blocks.mapInArrow(_possible(bands, registers, threshold), "dim int, t int, key long, i long, j long, role int, "
                                    "node binary, comp binary, size int"), "near-alive")
    exact = sorted_blocks(alive.join(sets, "node"))
    return exact.mapInArrow(_linked(threshold, registers), "a binary, b binary")


def _components(buckets: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float, bands: int, registers: int,
                rounds: int) -> DataFrame:
    """(node, component) over ``buckets(t, key, node, size, hub)``, for nodes with a link."""
    spark = buckets.sparkSession
    links = spark.createDataFrame([], "a binary, b binary")
    tried = None
    rows = buckets.withColumns({"comp": F.col("node"), "top": F.lit(b"").cast("binary")})
    for _ in range(rounds):
        pairs = saved(_hub_pairs(rows, tried, threshold), "near-pairs")
        if pairs.isEmpty():
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = links.unionByName(saved(_verified(pairs, sets, threshold), "near-links"))
        rows = _open(buckets, links)
    found = saved(_block_links(rows, nodes, sets, threshold, bands, registers), "near-links")
    return connected_components(links.unionByName(found))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS, rounds: int = HUB_ROUNDS) -> DataFrame:
    """One row per input row: ``id``, ``node`` (digest of the words), ``class_id``,
    ``class_node`` (the words of the document that stays) and ``kept``."""
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    hashed = base.select("id", words(F.col("t")).alias("w")).select(
        "id", _node(F.col("w")).alias("node"), _hashes(F.col("w")).alias("h"))
    rows_ = saved(hashed.mapInArrow(_band_batches(bands, rows), f"id {kind}, node binary, bands array<bigint>, size int"), "near-rows")
    nodes = saved(rows_.where("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("size").alias("size")), "near-nodes")
    members = nodes.select("node", "size", F.posexplode("bands").alias("t", "key")).where("key <> 0")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = saved(members.join(shared, "key").select("t", "key", "node", "size", "n"), "near-buckets")
    hubs = buckets.groupBy("node").agg(F.sum("n").alias("hub"))
    buckets = saved(buckets.drop("n").join(hubs, "node"), "near-hubs")

    # shingle sets of one row per node that has company; found by id, so that copies of
    # one text do not meet in one task
    wanted = saved(nodes.join(buckets.select("node").distinct(), "node").select(F.col("rep").alias("id"), "node"), "near-wanted")
    texts = base.alias("d").join(broadcast_if(wanted).alias("w"), F.col("d.id").eqNullSafe(F.col("w.id"))).select(
        "w.node", words(F.col("t")).alias("w"))
    texts = texts.where(_node(F.col("w")) == F.col("node")).dropDuplicates(["node"])
    sets = saved(texts.select("node", _hashes(F.col("w")).alias("h")).mapInArrow(
        _shingle_batches(bands * rows), "node binary, s array<bigint>, sketch binary"), "near-sets")
    comps = _components(buckets, nodes, sets, threshold, bands, bands * rows, rounds)

    # classes of several nodes; the document that stays has the smallest id
    named = comps.join(nodes.select("node", "rep"), "node")
    heads = named.groupBy("component").agg(F.min(F.struct(
        F.col("rep").isNull().alias("last"), F.col("rep").alias("class_id"), F.col("node").alias("class_node"))).alias("head"))
    many = named.join(heads, "component").select("node", "head.class_id", "head.class_node")
    heads = nodes.select("node", "rep").join(many, "node", "left").select(
        "node", F.when(F.col("class_node").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_node", "node").alias("class_node"))
    out = rows_.select("id", "node").join(saved(heads, "near-classes"), "node", "left")
    return out.select(
        "id", "node", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), "class_node",
        (F.col("node").isNull() | (F.col("node").eqNullSafe(F.col("class_node"))
                                   & F.col("id").eqNullSafe(F.col("class_id")))).alias("kept"))


def without_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One input row of each class, with all its columns. Texts without words stay."""
    gone = saved(near_duplicates(df, id_col, text_col, **options).groupBy("id", "node").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("NOT kept OR (n > 1 AND node IS NOT NULL)"), "near-gone")
    rows = carry(df, F.col(id_col).alias("id"), F.col(text_col).alias("t")).alias("d")
    # the words are only digested where the id is in question
    d = rows.join(broadcast_if(gone).alias("g"), F.col("d.id").eqNullSafe(F.col("g.id"))
                  & (_node(words(F.col("t"))) == F.col("g.node")), "left").select("row", "g.id", "g.node", "kept")
    once = (d.where("kept").groupBy("id", "node").agg(F.first("row").alias("row")).select("row"))
    return d.where("kept IS NULL").select("row").unionByName(once).select("row.*")


@register("op2_minhash_dedup")
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of its class of near copies."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "kept")
