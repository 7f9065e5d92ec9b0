"""Op 13, periodic runs in texts by block convolution.

A run of period q is a stretch of consecutive words in which words q apart are identical, q
being its smallest period, at least ``max(MIN_LENGTH, 3 * q)`` words long, that no
neighbouring word extends.

Scales are dyadic. At scale L the word sequence is cut into aligned blocks of L words, and
each block is laid against the words that follow it: the sum of squared differences of
word numbers is a convolution, computed exactly modulo a prime by a number-theoretic
transform (NTT). Where it is 0 at distance d the block occurs again, and (block, d) is a seed. A run
of period q in [L, 2L) and at least 3q words holds an aligned block of L words
together with its copy q words on; with ``MIN_LENGTH`` = 24 the same is true of
blocks of 8 for every q below 16. So every run leaves a seed at its scale. A remainder of 0 is necessary
for equal words; that it is sufficient is checked by comparing the words of every seed.
Seeds are extended to both sides as far as words d apart stay equal.

Two sound tests save transforms and drop no run: a block whose words do not all recur
within 2L words has no copy there; a block that lies with its copy, or with its whole
window, inside a run found at an earlier scale can only find that run again.
A stretch is reported under the smallest distance that found it, which is its smallest
period (a stretch of three periods d with a shorter period p has been found under p).

Scale. A map over documents, without a shuffle: Spark deals the rows, a task packs texts of about
``PACK`` words together and works on them as one sequence with word numbers of
their own for each text, so that no block matches across texts. Memory is a few arrays
over the packed words; transforms go through ``CELLS`` cells at a time. The work of a scale is
linear in the words, times log L for blocks that survive the tests, also for one very long text.

Defined cases: a NULL or empty text has no words and no runs; a NULL id has no rewriting in
the query; repeated rows are documents of their own; an empty table gives an empty
result; the input's further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import register, table

MIN_LENGTH, PERIODS = 24, 3
FIRST = 8  # block length of the first scale; it finds periods 1 to 15
PACK = 500_000  # words handled together
CELLS = 1 << 20  # cells of a transform at once
PRIME, ROOT = 998_244_353, 3  # fixed: 119 * 2^23 + 1 and a primitive root of it

_U = np.uint64
_P = _U(PRIME)


@lru_cache(maxsize=None)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. half-1 of a root of order 2 * half."""
    w = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    w = pow(w, PRIME - 2, PRIME) if inverse else w
    out = np.ones(half, _U)
    n = 1
    while n < half:  # doubles what is there
        out[n:2 * n] = out[:n] * _U(pow(w, n, PRIME)) % _P
        n *= 2
    return out


def ntt(x: np.ndarray) -> np.ndarray:
    """Transform of each row, in bit-reversed order (decimation in frequency)."""
    rows, n = x.shape
    half = n // 2
    while half:
        y = x.reshape(rows, -1, 2, half)
        u, v = y[:, :, 0], y[:, :, 1]
        x = np.stack([(u + v) % _P, (u + _P - v) * _twiddles(half, False) % _P], axis=2).reshape(rows, n)
        half //= 2
    return x


def inverse_ntt(x: np.ndarray) -> np.ndarray:
    """Rows back from bit-reversed order."""
    rows, n = x.shape
    half = 1
    while half < n:
        y = x.reshape(rows, -1, 2, half)
        u, v = y[:, :, 0], y[:, :, 1] * _twiddles(half, True) % _P
        x = np.stack([(u + v) % _P, (u + _P - v) % _P], axis=2).reshape(rows, n)
        half *= 2
    return x * _U(pow(n, PRIME - 2, PRIME)) % _P


def block_matches(w: np.ndarray, starts: np.ndarray, known: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of each block ``w[start : start + size]`` that occurs again
    ``distance`` words on, low <= distance < high, and not before ``known``, the end of a
    run that the block is part of. ``w`` holds word numbers."""
    span = high - low + size - 1  # words of a window
    n = 1 << (span - 1).bit_length()
    found_s, found_d = [], []
    for at in range(0, len(starts), max(1, CELLS // n)):
        s = starts[at:at + max(1, CELLS // n)]
        block = w[s[:, None] + np.arange(size)].astype(_U) % _P
        places = s[:, None] + low + np.arange(span)
        past = places >= len(w)
        window = np.where(past, 0, w[np.minimum(places, len(w) - 1)]).astype(_U) % _P
        a, b = np.zeros((len(s), n), _U), np.zeros((len(s), n), _U)
        a[:, :size], b[:, :span] = block[:, ::-1], window
        cross = inverse_ntt(ntt(a) * ntt(b) % _P)[:, size - 1:span]  # no sum here wraps around
        squares = np.concatenate([np.zeros((len(s), 1), _U), np.cumsum(window * window % _P, axis=1) % _P], axis=1)
        own = (block * block % _P).sum(axis=1, dtype=_U) % _P
        total = own[:, None] + squares[:, size:] + _P - squares[:, :-size] + 2 * (_P - cross)
        r, d = np.nonzero(total % _P == 0)
        end = s[r] + d + low + size
        new = (end <= len(w)) & (end > known[at + r])
        r, d = r[new], d[new] + low
        if len(r):  # the words themselves
            for part in np.array_split(np.arange(len(r)), -(-len(r) * size // CELLS)):
                one = s[r[part], None] + np.arange(size)
                same = (w[one] == w[one + d[part, None]]).all(axis=1)
                found_s.append(s[r[part][same]])
                found_d.append(d[part[same]])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_s), np.concatenate(found_d)) if found_s else (none, none)


def _reach(w: np.ndarray, at: int, d: int, step: int) -> int:
    """Number of words from ``at`` on (step 1) or down from ``at - 1`` (step -1) that equal the words d on."""
    done, size = 0, 64
    while True:
        size = min(size, len(w) - d - at - done if step > 0 else at - done)
        if size <= 0:
            return done
        a = at + done if step > 0 else at - done - size
        same = w[a:a + size] == w[a + d:a + d + size]
        if not same.all():
            return done + int(np.argmin(same if step > 0 else same[::-1]))
        done, size = done + size, 2 * size


def _next_distance(w: np.ndarray) -> np.ndarray:
    """Words up to the next place of the same word; the length of ``w`` where there is none."""
    order = np.argsort(w, kind="stable")
    out = np.full(len(w), len(w), np.int64)
    same = w[order[1:]] == w[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def runs_of(w: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers below 2^62, by start, then
    period. ``longest`` bounds the length of a run (texts packed into one sequence)."""
    longest = len(w) if longest is None else longest
    if longest < MIN_LENGTH:
        return []
    recur = _next_distance(w)
    most = recur[:len(w) // FIRST * FIRST].reshape(-1, FIRST).max(axis=1)
    covered = np.zeros(len(w), np.int64)  # the furthest end of the runs found so far that hold a word
    periods: dict[tuple[int, int], int] = {}
    size = FIRST
    while PERIODS * (size if size > FIRST else 1) <= longest and len(most):
        starts = np.flatnonzero(most < 2 * size) * size
        starts = starts[covered[starts] < starts + 3 * size]
        s, d = block_matches(w, starts, covered[starts], size, size if size > FIRST else 1, 2 * size)
        order = np.lexsort((s, d))
        s, d = s[order], d[order]
        # neighbouring blocks that recur at one distance are one stretch
        head = np.flatnonzero((np.diff(s, prepend=-1) != size) | (np.diff(d, prepend=-1) != 0)) if len(s) else s
        found, last = [], (0, 0)
        for a, b in zip(head, np.append(head[1:], len(s))):
            dist = int(d[a])
            if dist == last[0] and s[a] < last[1]:
                continue  # the last stretch went on over blocks that were passed over
            start = int(s[a]) - _reach(w, int(s[a]), dist, -1)
            tail = int(s[b - 1]) + size
            end = tail + _reach(w, tail, dist, 1) + dist
            last = (dist, end - dist)
            if end - start >= max(MIN_LENGTH, PERIODS * dist):
                periods[start, end] = min(dist, periods.get((start, end), dist))
                found.append((start, end))
        for start, end in set(found):
            np.maximum(covered[start:end], end, out=covered[start:end])
        size *= 2
        even = len(most) // 2 * 2
        most = np.maximum(most[:even:2], most[1:even:2])
    return sorted((start, end - start, p) for (start, end), p in periods.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for the words that a run repeats: all of it after its first period."""
    keep = np.ones(n, bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return keep


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)."""
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    if not runs:
        return 0, None, None, None, None, _digest(b""), _digest(b" ".join(words))
    start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    keep = kept_words(len(words), runs)
    return (len(runs), start, length, period, 1000 * length // period, _digest(listed.encode()),
            _digest(b" ".join([words[i] for i in np.flatnonzero(keep)])))


def _packs(batches: Iterator[pa.RecordBatch], rewrite: Callable) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and word lists of consecutive texts, about PACK words together."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("id").to_pylist(), batch.column("t").cast(pa.binary())):
            # bytes.split parts at the six separators of a word and at nothing else
            words = rewrite(i, (text.as_py() or b"").split())
            ids.append(i)
            texts.append(words)
            size += len(words)
            if size >= PACK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _numbers(texts: list[list[bytes]]) -> np.ndarray:
    """The texts' words end to end as numbers; two texts share none."""
    out, base = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        number = seen.setdefault
        out.extend([number(x, base + len(seen)) for x in words])
        base += len(seen)
    return np.array(out, np.int64)


def _unchanged(_, words: list[bytes]) -> list[bytes]:
    return words


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query's documents: every tenth id, by its CRC, repeats itself from some word on."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // len(unit))))[:n - a]


def _run_batches(rewrite: Callable, make: Callable, fields: list[tuple[str, pa.DataType]], kind: pa.DataType):
    schema = pa.schema([("id", kind), *fields])

    def run(batches):
        for ids, texts in _packs(batches, rewrite):
            n = np.array([len(x) for x in texts])
            ends = np.cumsum(n)
            w = _numbers(texts)
            runs: list[list] = [[] for _ in ids]
            for start, length, period in runs_of(w, int(n.max())):
                doc = int(np.searchsorted(ends, start, side="right"))
                runs[doc].append((start - int(ends[doc] - n[doc]), length, period))
            rows = [make(words, found) for words, found in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind)] + [pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), fields)], schema=schema)
    return run


_SUMMARY = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
            ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _mapped(df: DataFrame, id_col: str, text_col: str, rewrite, make, fields, ddl: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type
    kind = df.schema[id_col].dataType
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(_run_batches(rewrite, make, fields, to_arrow_type(kind)), f"id {kind.simpleString()}, {ddl}")


def _full(words: list[bytes], runs: list) -> tuple:
    keep = kept_words(len(words), runs)
    return ([dict(zip(("start", "length", "period"), r)) for r in runs],
            b" ".join([words[i] for i in np.flatnonzero(keep)]).decode())


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, text): all runs of each text by word number, and its words, joined by one space, without
    the repetitions: of each run the first period stays."""
    return _mapped(df, id_col, text_col, _unchanged, _full, [("runs", pa.list_(_RUN)), ("text", pa.string())],
                   "runs array<struct<start: bigint, length: bigint, period: bigint>>, text string")


def run_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable = _unchanged) -> DataFrame:
    """Per text the number of runs, the one of greatest exponent, and digests of all runs and of the
    collapsed text. ``rewrite(id, words)`` may change the words first."""
    return _mapped(df, id_col, text_col, rewrite, summary, _SUMMARY,
                   "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                   "runs_sha256 string, collapsed_sha256 string")


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which are made to repeat."""
    return run_digests(table(spark, sf_dir, "documents"), rewrite=planted).withColumnRenamed("id", "doc_id")
