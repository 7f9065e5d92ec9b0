"""Op 7, SentencePiece encoding and decoding with a max-plus scan over chunks.

A text is cut into chunks of ``chunk`` characters wherever that falls. A boundary's
states are the pieces that end at it or cross it, which both neighbours read off the
characters around it. A chunk's transfer matrix holds, for an entry and an exit
state, 0 if the pieces between them are what the model makes of that stretch and -inf
otherwise. Byte-pair merging makes a sequence of pieces exactly if it makes every two
neighbours of it, so the only path of weight 0 through the product of the matrices is
the text's encoding. The product is associative: matrices are combined in a scan,
which gives every chunk its entry and exit state, and each chunk then reads its own
pieces back independently.

Most of a chunk needs no matrix: no piece holds a character other than a space before a
space, or a line end, so between its first and its last such cut a chunk is encoded on
its own, word by word through a bounded cache, and its matrix is the sum of a head and
a tail vector. A chunk without a cut gets the full matrix.

Scale: a text of one chunk is encoded where it is read and never moves. The chunks of
longer texts are spread over all tasks; the scan groups the small matrices of a
text, not its characters. Tasks hold one Arrow batch and one text at a time.

Defined cases: NULL text gives NULL pieces, the empty text none; U+2581 is the model's own
sign for a space and decodes to one; rows that repeat are encoded one by one;
an empty table gives an empty result; the input's further columns travel inside
``row``, whatever their names.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import register, saved, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 65_536  # characters; at least 64
SPACE = "▁"
_UNIT = re.compile(r" *[^ \n]+| +|\n")
_IDS = StructField("ids", ArrayType(IntegerType()))
_CUT = re.compile(r"(?<=[^ ])(?= )|(?=\n)|(?<=\n)")
_CACHED = 300_000  # distinct units kept by a Python worker
_FLUSH = 2_000_000  # pieces or characters gathered before a batch goes out


class Model:
    """A SentencePiece byte-pair model; texts have spaces where it writes U+2581."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.sp.get_piece_size())
        names = [self.sp.id_to_piece(i) for i in ids]
        plain = [not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i)) for i in ids]
        self.pieces = {n.replace(SPACE, " "): i for i, n in enumerate(names) if plain[i]}
        self.longest = max(map(len, self.pieces))
        if any("\n" in p or " " in p.lstrip(" ") for p in self.pieces):
            raise ValueError(f"{path}: pieces cross the cuts used here")
        self.bytes = [n.replace(SPACE, " ").encode() if plain[i] else
                      bytes([int(n[3:5], 16)]) if self.sp.is_byte(i) else b"" for i, n in enumerate(names)]
        self.lead = len(self.sp.encode("\n"))
        self.cache: dict[str, bytes] = {}

    def ids(self, text: str) -> list[int]:
        """Pieces of a stretch inside a text (no space is put before it)."""
        return self.sp.encode("\n" + text)[self.lead:] if text else []

    def inner(self, text: str) -> np.ndarray:
        """``ids`` of a stretch between cuts, unit by unit."""
        units, cache = _UNIT.findall(text), self.cache
        new = [u for u in set(units) if u not in cache]
        if len(cache) + len(new) > _CACHED:
            cache.clear()
            new = list(set(units))
        # the model itself puts a space before a text that follows none
        spaced = [u for u in new if u[0] == " " and len(u) > 1]
        for u, got in zip(spaced, self.sp.encode([u[1:] for u in spaced], num_threads=1)):
            cache[u] = array("i", got).tobytes()
        for u in new:
            if u not in cache:
                cache[u] = array("i", self.ids(u)).tobytes()
        return np.frombuffer(b"".join(map(cache.__getitem__, units)), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def states(self, left: str, right: str) -> list[tuple[int, int]]:
        """Pieces at a boundary: (characters before it, characters after it)."""
        return [(j, k) for j in range(1, min(len(left), self.longest) + 1)
                for k in range(min(len(right), self.longest - j) + 1)
                if left[len(left) - j:] + right[:k] in self.pieces or (j, k) == (1, 0)]

    def transfer(self, left: str, body: str, right: str, first: bool, last: bool):
        """(matrix, heads, inner, tails, dense) of a chunk: its max-plus matrix and the
        pieces to read back, ``heads`` by entry state and ``tails`` by exit state. A
        piece belongs to the chunk before the boundary that it ends at or crosses.
        Without a cut (``dense``) ``heads`` is by entry and exit state."""
        ins = [(0, 0)] if first else self.states(left, body)
        outs = [(0, 0)] if last else self.states(body, right)
        text, end = body + right, len(body)
        pieces_in = [left[len(left) - j:] + text[:k] for j, k in ins]
        c1, c2 = self._cuts(body, 0 if first else self.longest, end if last else end - self.longest, first, last)
        if c1 is None:
            m, heads = np.full((len(ins), len(outs)), -np.inf), []
            for a, (j, k) in enumerate(ins):
                for b, (j2, k2) in enumerate(outs):
                    path = self._between(pieces_in[a], text[k:end - j2], text[end - j2:end + k2]) if k <= end - j2 else None
                    m[a, b] = -np.inf if path is None else 0.0
                    heads.append(path)
            return m, heads, np.zeros(0, np.int32), [[]] * len(outs), True
        heads = [self._between(p, text[k:c1], "") for p, (_, k) in zip(pieces_in, ins)]
        tails = [self._between("", text[c2:end - j], text[end - j:end + k]) for j, k in outs]
        vector = lambda paths: [-np.inf if x is None else 0.0 for x in paths]
        return np.add.outer(vector(heads), vector(tails)), heads, self.inner(body[c1:c2]), tails, False

    def _between(self, piece: str, middle: str, exit_piece: str) -> list[int] | None:
        """The pieces after ``piece`` up to and with ``exit_piece``, or None if the
        model does not leave the three side by side."""
        path = self.ids(middle) + self.ids(exit_piece)
        return path if self.ids(piece + middle + exit_piece) == self.ids(piece) + path else None

    @staticmethod
    def _cuts(body: str, lo: int, hi: int, first: bool, last: bool) -> tuple[int | None, int | None]:
        """The first and the last cut of a chunk between ``lo`` and ``hi``; a text's
        ends are cuts."""
        c1 = 0 if first else next((m.start() for m in _CUT.finditer(body, lo, max(lo, hi))), None)
        if c1 is None or last:
            return c1, hi
        at = hi
        while at > c1 and not ("\n" in body[at - 1:at + 1] or (body[at] == " " and body[at - 1] != " ")):
            at -= 1
        return c1, at


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus matrix product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def prefixes(ms: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices, by pairwise combination."""
    if len(ms) < 2:
        return list(ms)
    half = prefixes([product(ms[i], ms[i + 1]) for i in range(0, len(ms) - 1, 2)])
    return [ms[0] if i == 0 else half[i // 2] if i % 2 else product(half[i // 2 - 1], ms[i]) for i in range(len(ms))]


def path_states(ms: list[np.ndarray]) -> list[tuple[int, int]]:
    """(entry, exit) state of every chunk on the best path."""
    before = prefixes(ms)
    if np.isneginf(before[-1][0].max()):
        raise ValueError("no path: the model's merges don't decompose")
    out, at = [], int(before[-1][0].argmax())
    for i in range(len(ms) - 1, -1, -1):
        entry = int((before[i - 1][0] + ms[i][:, at]).argmax()) if i else 0
        out.append((entry, at))
        at = entry
    return out[::-1]


def _ints(lists: list) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in lists])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *[np.asarray(x, np.int32) for x in lists if x is not None and len(x)]])
    return pa.ListArray.from_arrays(ends, pa.array(flat.astype(np.int32)), mask=pa.array([x is None for x in lists]))


def _slices(batch: pa.RecordBatch, texts: pa.Array):
    """Runs of rows with about _FLUSH characters together, with their texts."""
    texts, at, room = texts.to_pylist(), 0, 0
    for i, t in enumerate(texts):
        room += len(t or "")
        if room > _FLUSH or i + 1 == len(texts):
            yield batch.slice(at, i + 1 - at), texts[at:i + 1]
            at, room = i + 1, 0


def _encoder(path: str):
    """Texts of one chunk: (row, t) -> (row, ids)."""
    def run(batches):
        mod = model(path)
        for batch in batches:
            for part, texts in _slices(batch, batch.column("t")):
                ids = [None if t is None else mod.inner(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("row"), _ints(ids)], ["row", "ids"])
    return run


def _decoder(path: str):
    """(row, ids) -> (row, ids, decoded)."""
    def run(batches):
        mod = model(path)
        for batch in batches:
            ids = batch.column("ids")
            at, step = 0, max(1, int(batch.num_rows * _FLUSH // max(1, len(ids.values))))
            while at < batch.num_rows:
                part = batch.slice(at, step)
                texts = [None if x is None else mod.decode(x) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("ids"), pa.array(texts, pa.string())],
                                                 ["row", "ids", "decoded"])
                at += step
    return run


def _cutter(path: str, chunk: int):
    """(key, t) -> a row for each chunk with the characters around it."""
    def run(batches):
        wide = model(path).longest
        names = ["key", "chunk", "before", "body", "after", "last"]
        for batch in batches:
            for key, t in zip(batch.column("key").to_pylist(), batch.column("t")):
                t = " " + t.as_py().replace(SPACE, " ")
                starts = range(0, len(t), chunk)
                for some in (starts[i:i + 256] for i in range(0, len(starts), 256)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key] * len(some), pa.int64()), pa.array([at // chunk for at in some], pa.int32()),
                        pa.array([t[max(0, at - wide):at] for at in some]), pa.array([t[at:at + chunk] for at in some]),
                        pa.array([t[at + chunk:at + chunk + wide] for at in some]),
                        pa.array([at + chunk >= len(t) for at in some])], names)
    return run


def _transfers(path: str):
    def run(frames):
        mod = model(path)
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                m, heads, inner, tails, dense = mod.transfer(r.before, r.body, r.after, r.chunk == 0, r.last)
                rows.append((r.key, r.chunk, m.shape[1], dense, m.ravel().tolist(), heads, inner, tails))
            yield pd.DataFrame(rows, columns=["key", "chunk", "n_out", "dense", "m", "heads", "inner", "tails"])
    return run


def _scan(f: pd.DataFrame) -> pd.DataFrame:
    f = f.sort_values("chunk")
    states = path_states([np.asarray(m, float).reshape(-1, n) for m, n in zip(f["m"], f["n_out"])])
    return pd.DataFrame({"key": f["key"].to_numpy(), "chunk": f["chunk"].to_numpy(),
                         "a": [s[0] for s in states], "b": [s[1] for s in states]})


def _long(df: DataFrame, path: str, chunk: int) -> DataFrame:
    rows = saved(df.withColumn("key", F.monotonically_increasing_id()), "sp-long")
    chunks = rows.select("key", "t").mapInArrow(
        _cutter(path, chunk), "key long, chunk int, before string, body string, after string, last boolean")
    parts = saved(chunks.repartition("key", "chunk").mapInPandas(
        _transfers(path), "key long, chunk int, n_out int, dense boolean, m array<double>, "
        "heads array<array<int>>, inner array<int>, tails array<array<int>>"), "sp-transfers")
    states = parts.select("key", "chunk", "n_out", "m").groupBy("key").applyInPandas(
        _scan, "key long, chunk int, a int, b int")
    head = F.get("heads", F.when(F.col("dense"), F.col("a") * F.col("n_out") + F.col("b")).otherwise(F.col("a")))
    back = parts.join(states, ["key", "chunk"]).select(
        "key", "chunk", F.concat(head, "inner", F.get("tails", F.col("b"))).alias("ids"))
    whole = back.groupBy("key").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    return rows.join(whole, "key").select("row", "ids")


def encode(df: DataFrame, text_col: str = "text", path: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """``row`` (the input row as a struct) and ``ids`` (its pieces)."""
    if chunk < 64:
        raise ValueError("chunk must be at least 64 characters")
    rows = df.select(F.struct("*").alias("row"), F.col(text_col).alias("t"))
    # the model sees a space before the text: one chunk holds chunk - 1 characters
    over = F.coalesce(F.length("t") >= chunk, F.lit(False))
    schema = StructType([rows.schema["row"], _IDS])
    return rows.where(~over).mapInArrow(_encoder(path), schema).unionByName(_long(rows.where(over), path, chunk))


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``row`` and ``ids`` of ``encode`` with the ``decoded`` text."""
    d = encoded.select("row", "ids")
    return d.mapInArrow(_decoder(path), StructType([d.schema["row"], _IDS, StructField("decoded", StringType())]))


@register("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and whether they decode to its text."""
    d = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return d.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                    (F.col("decoded") == F.translate("row.text", SPACE, " ")).alias("round_trip"))
