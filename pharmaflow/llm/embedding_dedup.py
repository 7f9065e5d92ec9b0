"""Op 9, near-duplicate embeddings by randomised-rotation binary codes.

A vector is turned by a random rotation and stored as the signs of its coordinates
(one bit each) with a correction factor, the inner product of the code and the vector.
``<code_b, a> / factor_b`` estimates the cosine of a and b without bias, and its error
has a confidence bound in terms of the factor. ``a`` enters as 8-bit numbers rounded at random.
Pairs whose upper bound (the two directions averaged, ``EPS`` deviations) stays under the
threshold are dropped; all others are recomputed from the vectors in double precision, and
only that decides a link.

Candidates are pairs that share one of ``tables`` hash keys of ``bits`` random hyperplane
signs. ``bits`` grows with log2 of the number of vectors, so that buckets keep their mean
size, and ``tables`` follows from it so that a pair at the threshold shares a key with
probability ``recall`` (closer pairs more surely).

Scale. First pass: bucket rows hold codes, not vectors (about 1/3 of a vector at 64
dimensions), and leave only the rows with a surviving pair. Second pass: those rows
fetch their vectors and are compared exactly. Neither pass emits pairs: a block gives a
count per vector and at most one link per vector for the components. Buckets beyond
``BLOCK`` members are split into blocks that are compared two by two in separate tasks.
A pair is counted in the first table whose key it shares. Equal vectors are one node with
a multiplicity from the start.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components
link with nothing; vectors of different length do not link; NULL ids count as
vectors, and a component without any id has none; repeated rows are vectors of their own;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import register, saved, table
from .components import connected_components

THRESHOLD, RECALL = 0.9, 0.995
EPS = 4.0  # deviations of the estimate's confidence bound
BLOCK = 2048  # members of a block
PAIRS = 200_000  # pairs handled at once in a task
MEAN_BITS = 4  # a bucket holds 2^4 to 2^5 unrelated vectors on average


def plan_of(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = max(4, math.ceil(math.log2(max(2, n))) - MEAN_BITS)
    share = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - share)))


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20250 + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


@lru_cache(maxsize=4)
def planes(dim: int, n: int) -> np.ndarray:
    return np.random.default_rng(77 + dim).standard_normal((dim, n))


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign codes, correction factors, and the rotated vectors as 8-bit numbers
    with their scales, of unit rows."""
    dim = units.shape[1]
    turned = units @ rotation(dim)
    signs = turned >= 0
    factor = np.abs(turned).sum(axis=1) / math.sqrt(dim)
    scale = np.abs(turned).max(axis=1) / 127
    dither = np.random.default_rng(3).random(turned.shape)
    small = np.clip(np.floor(turned / scale[:, None] + dither), -127, 127).astype(np.int8)
    return np.packbits(signs, axis=1), factor, small, scale


def upper_bounds(signs, factor, query, i, j) -> np.ndarray:
    """Upper confidence bounds of the cosines of pairs (i, j); ``signs`` +-1 codes,
    ``query`` rotated vectors."""
    dim = signs.shape[1]
    err = EPS * np.sqrt(np.maximum(0.0, 1 / factor ** 2 - 1) / max(1, dim - 1))
    ij = np.einsum("pd,pd->p", query[i], signs[j]) / (math.sqrt(dim) * factor[j])
    ji = np.einsum("pd,pd->p", query[j], signs[i]) / (math.sqrt(dim) * factor[i])
    return (ij + ji + err[i] + err[j]) / 2


def _prepare(width: int, bits: int, tables: int):
    """(id, v) -> id, node, vec, code, factor, query, scale, keys; NULL node if invalid."""
    power = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for b in batches:
            ids, vs = b.column("id"), b.column("v").to_pylist()
            ok = [i for i, v in enumerate(vs) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
            out: dict[str, list] = {k: [None] * len(vs) for k in ("node", "vec", "code", "factor", "query", "scale", "keys")}
            if ok:
                x = np.zeros((len(ok), width))
                for r, i in enumerate(ok):
                    x[r, :len(vs[i])] = vs[i]
                x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares within range
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                packed, factor, small, scale = codes(unit)
                key = ((unit @ planes(width, bits * tables)) >= 0).reshape(len(ok), tables, bits) @ power
                for r, i in enumerate(ok):
                    raw = np.asarray(vs[i], dtype=np.float64) + 0.0
                    out["node"][i] = hashlib.md5(raw.tobytes()).digest()
                    out["vec"][i], out["code"][i], out["query"][i] = x[r].tobytes(), packed[r].tobytes(), small[r].tobytes()
                    out["factor"][i], out["scale"][i], out["keys"][i] = factor[r], scale[r], key[r]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(out["node"], pa.binary()), pa.array([None if v is None else len(v) for v in vs], pa.int32()),
                *[pa.array(out[k], t) for k, t in (("vec", pa.binary()), ("code", pa.binary()), ("factor", pa.float64()),
                                                  ("query", pa.binary()), ("scale", pa.float64()), ("keys", pa.list_(pa.int64())))]],
                ["id", "node", "dim", "vec", "code", "factor", "query", "scale", "keys"])
    return run


_GROUP = ["dim", "t", "key", "i", "j"]
_ALIVE = pa.schema([("dim", pa.int32()), ("t", pa.int32()), ("key", pa.int64()), ("i", pa.int64()), ("j", pa.int64()),
                    ("role", pa.int32()), ("node", pa.binary())])


def _whole_groups(batches):
    """Frames of whole groups from batches sorted by _GROUP; a group has at most two
    blocks, which bounds what is carried over."""
    rest = None
    for b in batches:
        f = b.to_pandas()
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if not len(f):
            continue
        g = f[_GROUP].to_numpy()
        same = np.flatnonzero((g[:-1] != g[1:]).any(axis=1))
        cut = int(same[-1]) + 1 if len(same) else 0
        rest = f.iloc[cut:].reset_index(drop=True)
        if cut:
            yield f.iloc[:cut]
    if rest is not None and len(rest):
        yield rest


def _pair_chunks(f: pd.DataFrame):
    """Row numbers (a, b) of the pairs to compare: within a block, or between its two."""
    g, role = f[_GROUP].to_numpy(), f["role"].to_numpy()
    edge = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]).any(axis=1), [True]]))
    n = np.diff(edge)
    end = np.repeat(edge[1:], n)
    ones = np.repeat(edge[:-1] + np.add.reduceat(1 - role, edge[:-1]), n)  # first row of the second block
    two = (f["i"] != f["j"]).to_numpy()
    lo = np.where(two, np.where(role == 0, ones, end), np.arange(len(f)) + 1)
    k = end - lo
    total = np.cumsum(k)
    at = 0
    while at < len(f):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        a = np.repeat(np.arange(at, upto), k[at:upto])
        if len(a):
            first = np.repeat(total[at:upto] - k[at:upto] - (total[at - 1] if at else 0), k[at:upto])
            yield a, np.arange(len(a)) - first + lo[a]
        at = upto


def _survivors(width: int, threshold: float):
    """Rows of a block that have a pair whose bound reaches the threshold."""
    def run(batches):
        for f in _whole_groups(batches):
            packed = np.frombuffer(b"".join(f["code"]), np.uint8).reshape(len(f), -1)
            signs = np.unpackbits(packed, axis=1)[:, :width].astype(np.float32) * 2 - 1
            query = np.frombuffer(b"".join(f["query"]), np.int8).reshape(len(f), -1).astype(np.float32)
            query *= f["scale"].to_numpy(np.float32)[:, None]
            factor, alive = f["factor"].to_numpy(), np.zeros(len(f), bool)
            for a, b in _pair_chunks(f):
                near = upper_bounds(signs, factor, query, a, b) >= threshold
                alive[a[near]] = alive[b[near]] = True
            yield pa.RecordBatch.from_pandas(f.loc[alive], schema=_ALIVE, preserve_index=False)
    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable by pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (before == root).all():
            return root
    return root


def _exact(threshold: float):
    """(node, links, head): linked vectors found in a block, and one linked node to join."""
    def run(batches):
        for f in _whole_groups(batches):
            x = np.frombuffer(b"".join(f["vec"]), np.float64).reshape(len(f), -1)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            keys, t, many = np.stack(f["keys"].to_numpy()), f["t"].to_numpy(), f["many"].to_numpy(np.int64)
            links, ends = np.zeros(len(f), np.int64), []
            for a, b in _pair_chunks(f):
                near = np.einsum("pd,pd->p", x[a], x[b]) >= threshold
                a, b = a[near], b[near]
                ends.append((a, b))
                for u in range(keys.shape[1] - 1):  # counted already in an earlier table?
                    if not len(a) or u >= t[a].max():
                        break
                    new = (keys[a, u] != keys[b, u]) | (u >= t[a])
                    a, b = a[new], b[new]
                np.add.at(links, a, many[b])
                np.add.at(links, b, many[a])
            a, b = (np.concatenate(c) if ends else np.zeros(0, int) for c in (list(zip(*ends)) or ((), ())))
            head = _roots(len(f), a, b)
            some = (links > 0) | (head != np.arange(len(f)))
            node = f["node"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(node[some], pa.binary()), pa.array(links[some]),
                                              pa.array(node[head[some]], pa.binary())], ["node", "links", "head"])
    return run


def _blocks(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Members of a bucket over BLOCK, once for each pair of blocks they take part in."""
    own = F.pmod(F.xxhash64("node"), F.col("s"))
    d = rows.join(large, ["dim", "t", "key"], "left").withColumn("s", F.coalesce("s", F.lit(1).cast("long")))
    d = d.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)))
    return d.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"),
                          "role": F.when(F.col("own") > F.col("other"), 1).otherwise(0)}).drop("s", "own", "other")


def _sorted(d: DataFrame) -> DataFrame:
    return d.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "role")


def embedding_links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, n_links, component_id, kept) of every input row."""
    kind = df.schema[id_col].dataType.simpleString()
    n, longest = df.select(F.count(F.lit(1)), F.max(F.size(vec_col))).first()
    width = max(64, -(-max(1, longest or 1) // 8) * 8)
    bits, tables = plan_of(n, threshold, recall)
    rows = saved(df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(
        _prepare(width, bits, tables), f"id {kind}, node binary, dim int, vec binary, code binary, factor double, "
        "query binary, scale double, keys array<long>"), "vec-rows")
    nodes = saved(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("many"),
        *[F.first(c).alias(c) for c in ("dim", "vec", "code", "factor", "query", "scale", "keys")]), "vec-nodes")
    buckets = nodes.select("dim", F.posexplode("keys").alias("t", "key"), "node", "code", "factor", "query", "scale")
    large = (buckets.groupBy("dim", "t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
             .select("dim", "t", "key", F.ceil(F.col("n") / BLOCK).cast("long").alias("s")))
    blocks = _sorted(_blocks(buckets, saved(large, "vec-large")))
    group = "dim int, t int, key long, i long, j long"
    alive = saved(blocks.mapInArrow(_survivors(width, threshold), f"{group}, role int, node binary"), "vec-alive")
    exact = _sorted(alive.join(nodes.select("node", "vec", "keys", "many"), "node"))
    found = saved(exact.mapInArrow(_exact(threshold), "node binary, links long, head binary"), "vec-found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select(F.col("node").alias("a"), F.col("head").alias("b")))
    named = nodes.select("node", "first_id", "many").join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = saved(named.join(ids, "component").join(links, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id"), "vec-known")
    d = rows.select("id", "node").join(known, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return d.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                    F.col("id").eqNullSafe(own).alias("kept"))


@register("op9_embedding_dedup")
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return embedding_links(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component_id").cast("long").alias("component_id"), "kept")
