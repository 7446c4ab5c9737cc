"""Periodic runs of words by multi-scale minimizers (operator 12).

A run is a maximal stretch of words with smallest period q and a length of at
least max(min_length, 2 * q). Documents are judged alone, whole and unshuffled; the
documents of a chunk are searched together, parted by words that occur once.

* Periods up to `lags` come from direct lag scans: stretches of x[i] == x[i + q].
* Longer ones by scales. Scale s covers periods in (2^s, 2^(s+1)]. Its grams have
  k = 2^(s-1) words, its windows k + 1 grams, so a window is no longer than any
  period of the scale and recurs one period later inside a run. The gram of least hash
  in each window (with all ties) is kept; equal kept grams at a distance of the
  scale are seeds. A seed is extended both ways as long as x[i] == x[i + q]
  holds (binary search over prefix hashes), and stays if that makes a run.
* Equal grams are not paired one by one. Occurrences at most k / 2 apart are a
  progression (the gram itself is periodic), whose step divides all its gaps. Two
  progressions of one gram give each distance between them once, and at most 7
  of them lie within reach, so the number of seeds stays in proportion to the
  kept grams. A distance within one progression is never a smallest period.

Words are compared exactly (dictionary numbers); the lengths of extensions rest on
two prefix hashes modulo 2^31 - 1. Memory is some 200 bytes a word of a chunk of
`CHUNK_BYTES` of text or of one longer document.

Defined cases: null and empty texts have no words and no runs; rows that repeat
a doc_id, or have none, are judged row by row; empty tables give empty results;
other columns pass through `periodic_runs` and may have any name but the two that it adds
(those are replaced).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelstats.llm import arrowtext as at

MIN_LENGTH = 12
LAGS = 16  # a power of two
CHUNK_BYTES = 1 << 20

_MOD = (1 << 31) - 1
_BASES = (1_103_515_245 % _MOD, 1_664_525_013 % _MOD)
_REACH = 7
_EMPTY = hashlib.sha256(b"").hexdigest()
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _lag_stretches(x: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the stretches of at least `least` places where x[i] == x[i + q]."""
    if len(x) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(x) - q + 2, np.int8)
    np.equal(x[:-q], x[q:], out=same[1:-1].view(bool))
    turn = np.flatnonzero(same[1:] != same[:-1])
    a, b = turn[::2], turn[1::2]
    long = b - a >= least
    return a[long], b[long]


def _sliding(f, x: np.ndarray, w: int) -> np.ndarray:
    """f (np.minimum or np.maximum) over every window of w values."""
    have = 1
    while have * 2 <= w:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: len(x) - (w - have)], x[w - have :]) if w > have else x


def _kept_grams(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the grams of k words that are least in some window of k + 1 grams."""
    grams = at.ngram_hash(at.mix(x.astype(at.U64) + at.U64(0x51ED270B)), k)
    w = k + 1
    if len(grams) < w:
        return np.zeros(0, np.int64), np.zeros(0, at.U64)
    least = _sliding(np.minimum, grams, w)
    pad = np.zeros(w - 1, at.U64)
    where = np.flatnonzero(_sliding(np.maximum, np.concatenate([pad, least, pad]), w) == grams)
    return where, grams[where]


def _seeds(pos: np.ndarray, gram: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of equal kept grams at distances in (low, high]."""
    order = np.argsort(gram, kind="stable")  # positions rise within a gram
    pos, gram = pos[order], gram[order]
    same = gram[1:] == gram[:-1]
    shared = np.zeros(len(pos), bool)
    shared[1:] |= same
    shared[:-1] |= same
    pos, gram = pos[shared], gram[shared]
    if not len(pos):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = np.diff(pos)
    close = (gram[1:] == gram[:-1]) & (gap <= k // 2)
    head = np.flatnonzero(np.concatenate([[True], ~close]))
    first, last, gram = pos[head], pos[np.append(head[1:], len(pos)) - 1], gram[head]
    step = np.gcd.reduceat(np.concatenate([[0], np.where(close, gap, 0)]), head)
    out_a, out_d = [], []
    for t in range(1, min(_REACH, len(first) - 1) + 1):
        pair = np.flatnonzero((gram[t:] == gram[:-t]) & (first[t:] - last[:-t] <= high) & (last[t:] - first[:-t] > low))
        if not len(pair):
            continue
        a0, a1, b0, b1 = first[pair], last[pair], first[pair + t], last[pair + t]
        g = np.maximum(np.gcd(step[pair], step[pair + t]), 1)
        near = b0 - a1
        i0 = np.maximum(-(-(low + 1 - near) // g), 0)
        i1 = np.minimum((high - near) // g, (b1 - a0 - near) // g)
        n = np.maximum(i1 - i0 + 1, 0)
        which = np.repeat(np.arange(len(pair)), n)
        i = at.flat(i0, n)
        back = np.minimum(i, (a1 - a0)[which] // g[which])
        out_a.append(a1[which] - back * g[which])
        out_d.append(near[which] + i * g[which])
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_d)


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of base modulo _MOD, kept by the Python worker for usual lengths."""
    kept = at.process_cache("run powers")
    if len(kept.get(base, ())) < n:
        p = np.ones(1, np.int64)
        while len(p) < n:
            p = np.concatenate([p, p * (int(p[-1]) * base % _MOD) % _MOD])
        if len(p) > 1 << 22:
            return p
        kept[base] = p
    return kept[base]


class _Equal:
    """Whether x[a : a + n] == x[b : b + n] for arrays of places, a < b, by prefix hashes."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.lanes = []
        for lane, base in enumerate(_BASES):
            value = (at.mix(x.astype(at.U64) * at.U64(2) + at.U64(lane + 1)) >> at.U64(34)).astype(np.int64)
            power = _power(base, n + 1)
            total = np.zeros(n + 1, np.int64)
            np.cumsum(value * power[:n] % _MOD, out=total[1:])
            self.lanes.append((total % _MOD, power))

    def __call__(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        ok = np.ones(len(a), bool)
        for total, power in self.lanes:
            ok &= (total[a + n] - total[a]) % _MOD * power[b - a] % _MOD == (total[b + n] - total[b]) % _MOD
        return ok


def _extended(equal: _Equal, n: int, a: np.ndarray, d: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the stretch around a where x[i] == x[i + d]; most: no stretch is longer."""
    fore, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for j in range(most.bit_length(), -1, -1):
        m = 1 << j
        at_a = a + fore
        can = np.flatnonzero(at_a + d + m <= n)
        fore[can[equal(at_a[can], (at_a + d)[can], m)]] += m
        at_a = a - back - m
        can = np.flatnonzero(at_a >= 0)
        back[can[equal(at_a[can], (at_a + d)[can], m)]] += m
    return a - back, a + fore


def find_runs(words: np.ndarray, counts: np.ndarray, min_length: int = MIN_LENGTH, lags: int = LAGS) -> tuple[np.ndarray, ...]:
    """(row, start, length, period) of all runs, by row, start and period.

    words: word numbers of the rows one after the other, counts: words per row.
    """
    rows = len(counts)
    off = np.concatenate([[0], np.cumsum(counts + 1)])  # each row ends in a word of its own
    x = np.empty(off[-1], np.int64)
    own = np.ones(len(x), bool)
    own[off[1:] - 1] = False
    x[own] = words
    x[~own] = int(words.max(initial=-1)) + 1 + np.arange(rows)
    most = int(counts.max(initial=0))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q in range(1, min(lags, most // 2) + 1):
        a, b = _lag_stretches(x, q, max(q, min_length - q))
        found.append((a, b + q, np.full(len(a), q)))
    low, equal = lags, None
    while 2 * (low + 1) <= most:
        # rows long enough for a run of this scale
        long = np.repeat(counts >= 2 * (low + 1), counts + 1)
        where = np.flatnonzero(long)
        a, d = _seeds(*_kept_grams(x[where], low // 2), low // 2, low, 2 * low)
        if len(a):
            equal = equal or _Equal(x)
            a, b = _extended(equal, len(x), where[a], d, most)
            run, once = b - a >= np.maximum(d, min_length - d), None
            once = np.unique(np.stack([a[run], d[run], b[run]]), axis=1)
            found.append((once[0], once[2] + once[1], once[1]))
        low *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, end, period = (np.concatenate(c) for c in zip(*found))
    # a multiple of the smallest period has the same stretch
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    row = np.searchsorted(off, start, side="right") - 1
    return row, start - off[row], end - start, period


def _searched(part: pa.RecordBatch, rewrite: Callable | None, min_length: int) -> tuple:
    """Runs of a chunk's rows, and the words kept, as an array of one binary list per row."""
    buf, off = at.utf8(part.column("text"))
    start, end, counts = at.words(buf, off)
    text = at.word_array(buf, start, end)
    number = text.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    source = np.arange(len(number))
    if rewrite is not None:
        source = rewrite(part, counts)
    row, begin, length, period = find_runs(number[source], counts, min_length)
    base = np.cumsum(counts) - counts
    drop = np.zeros(len(number) + 1, np.int64)
    np.add.at(drop, base[row] + begin + period, 1)
    np.add.at(drop, base[row] + begin + length, -1)
    keep = np.cumsum(drop[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(np.bincount(at.rows_of(counts)[keep], minlength=len(counts)))])
    lists = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), text.take(pa.array(source[keep])))
    return row, begin, length, period, pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """docs plus runs (start, length, period in words, by start and period) and collapsed.

    collapsed is the text's words joined by one space, without the words that lie
    in some run after that run's first period.
    """
    keep = [f for f in docs.schema.fields if f.name not in ("runs", "collapsed")]
    schema = StructType(keep + StructType.fromDDL("runs array<struct<start:long,length:long,period:long>>, collapsed string").fields)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text", CHUNK_BYTES):
                row, begin, length, period, joined = _searched(part, None, min_length)
                cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (begin, length, period)], fields=list(_RUN))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs)
                yield pa.record_batch([*(part.column(n) for n in names[:-2]), lists, joined.cast(pa.large_string()).cast(pa.string())], names=names)

    return docs.select([f.name for f in keep]).mapInArrow(run, schema)


def planted_words(part: pa.RecordBatch, counts: np.ndarray) -> np.ndarray:
    """For every word the word that stands in its place: one document in ten is made periodic from some word on.

    With h the crc32 of the decimal doc_id and g = h // 10: where h % 10 is 0, word
    a + i becomes word a + i % p, a = g % n and p = 1 + (n - a) // (3 + g % 8). A
    null doc_id leaves the words alone.
    """
    source = np.arange(int(counts.sum()))
    base = np.cumsum(counts) - counts
    for r, i in enumerate(part.column("doc_id").to_pylist()):
        n = int(counts[r])
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        b = int(base[r])
        source[b + a : b + n] = b + a + np.arange(n - a) % p
    return source


def run_report(docs: DataFrame, rewrite: Callable | None = planted_words, min_length: int = MIN_LENGTH) -> DataFrame:
    """Per document its number of runs, its longest run, and digests of all runs and of the kept words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text", CHUNK_BYTES):
                row, begin, length, period, joined = _searched(part, rewrite, min_length)
                n = part.num_rows
                cut = np.searchsorted(row, np.arange(n + 1))
                order = np.lexsort((period, begin, -length, row))
                has = np.diff(cut) > 0
                top = np.zeros(n, np.int64)
                top[has] = order[cut[:-1][has]]
                digest = [_EMPTY] * n
                for r in np.flatnonzero(has).tolist():
                    s = slice(cut[r], cut[r + 1])
                    lines = zip(begin[s].tolist(), length[s].tolist(), period[s].tolist())
                    digest[r] = hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in lines).encode()).hexdigest()

                def longest(values: np.ndarray) -> pa.Array:
                    return pa.array(values[top] if len(values) else np.zeros(n, np.int64), pa.int64(), mask=~has)

                yield pa.record_batch(
                    [
                        part.column("doc_id"), pa.array(np.diff(cut), pa.int64()),
                        longest(begin), longest(length), longest(period), longest(1000 * length // np.maximum(period, 1)),
                        pa.array(digest), pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in joined]),
                    ],
                    names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )
