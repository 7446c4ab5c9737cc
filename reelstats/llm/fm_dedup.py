"""Substring dedup with FM-indexes (operator 4).

Words `[^\\x20\\x09-\\x0D]+`, unchanged. A window is 20 consecutive words of one
document; a word is removed when a window covers it whose word sequence also
starts earlier (smaller doc_id, or the same document further left), judged on
the input.

1. Anchors. All 5-word grams of all documents are counted in a fixed-size table
   that orders them from rare to frequent. A window's anchor is its rarest gram
   (the leftmost of equal ones), so equal windows have equal anchors at equal
   places, and windows that reach beyond a frequent passage have rare ones. Neighbouring
   windows with one anchor occurrence form a context: at most 16 windows, 35
   words. Inside a task, equal contexts meet at once, by their anchor and a 64-bit
   hash of their words: all but the first are repeats, and only the first goes on
   (so a group of copies costs a context once per task).
2. Anchors travel as packed arrays, one row per task and shard. Those that
   occur once in all shards are done.
3. The contexts of the others, with their words, go to their anchor's shard. A
   shard numbers their words by their bytes and builds an FM-index over 5-word
   symbols (a step of the backward search reads five words): the suffix order by
   rank doubling, and the Burrows-Wheeler sequence, compressed to its runs, with
   a wavelet matrix over the runs' heads. The contexts are streamed against it:
   backward search gives the matching statistics of their word ends, that is, how
   far back a match goes that starts earlier in (doc_id, position) order. Matches of
   20 words and more are reported as intervals.
4. Intervals are gathered per document and the covered words go.

Defined cases: null text has no words; a null doc_id comes before all others;
rows that share a doc_id aren't told apart (what is removed in one is removed
in each, and equal windows at one position of them aren't earlier than each
other); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm import arrowtext as at
from reelstats.llm import rarity
from reelstats.llm.tables import id_key, shards_for, written

WINDOW = 20
GRAM = 5
_VIEW = WINDOW - GRAM + 1


def _word_hashes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buf, off = at.utf8(arr)
    start, end, counts = at.words(buf, off)
    return at.span_hash(buf, start, end), counts


def gram_classes(docs: DataFrame) -> np.ndarray:
    """Frequency classes of all 5-word grams (see rarity)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(rarity.COUNTERS, np.uint32)
        for batch in batches:
            for part in at.chunks(batch, "text"):
                h, counts = _word_hashes(part.column("text"))
                rarity.count(table, at.ngram_hash(h, GRAM)[at.window_starts(counts, GRAM)])
        if table.any():
            yield pa.record_batch([pa.array(range(rarity.SEGMENTS), pa.int64()), pa.array(rarity.packed(table), pa.binary())], names=["segment", "counts"])

    return rarity.merged(docs.select("text").mapInArrow(run, "segment long, counts binary"))


def contexts(h: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor code, first window's word position, windows) of every context of the rows, in order."""
    first = at.window_starts(counts, WINDOW)
    if not len(first):
        return np.zeros(0, at.U64), first, first
    code = rarity.codes(at.ngram_hash(h, GRAM), classes)
    view = np.lib.stride_tricks.sliding_window_view(code, _VIEW)
    place = first + view.argmin(axis=1)[first]
    # a context ends where the row or the anchor changes
    cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)]))
    return code[place[cut]], first[cut], np.diff(np.concatenate([cut, [len(first)]]))


def _run_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = at._powers(len(h) + 1)
    total = np.zeros(len(h) + 1, at.U64)
    np.multiply(h, up[: len(h)], out=total[1:])
    np.cumsum(total, out=total)
    return at.mix((total[end] - total[start]) * down[start] + (end - start).astype(at.U64))


def suspect_contexts(docs: DataFrame, classes, shards: int) -> DataFrame:
    """doc, start, windows, is_repeat: contexts whose anchor occurs in several of them; is_repeat: an equal context is earlier in its task. Written once."""
    names = ["shard", "anchor", "doc", "start", "windows"]

    def packed(shard: int, *cols: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([shard], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cols)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for part in at.chunks(batch, "text"):
                h, counts = _word_hashes(part.column("text"))
                anchor, start, windows = contexts(h, counts, classes.value)
                row = at.rows_of(counts)[start] if len(start) else start
                begin = np.cumsum(counts) - counts
                ids = part.column("_id").to_numpy()
                cols.append((anchor, _run_hash(h, start, start + windows + WINDOW - 1), ids[row], (start - begin[row]).astype(np.int32), windows.astype(np.uint8)))
        if not cols:
            return
        anchor, whole, doc, start, windows = (np.concatenate(c) for c in zip(*cols))
        cols.clear()
        if not len(anchor):
            return
        key = at.mix(anchor ^ at.mix(whole))
        order = np.lexsort((start, doc, key))
        again = np.zeros(len(key), bool)
        same = [x[order][1:] == x[order][:-1] for x in (key, anchor, whole)]
        again[1:] = same[0] & same[1] & same[2]
        # the same position of rows that share a doc_id is not earlier
        head = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(key))))]
        repeat = order[again & ((doc[order] != doc[head]) | (start[order] != start[head]))]
        first = np.sort(order[~again])
        # repeats take any shard; there they pass through
        for i in range(0, len(repeat), 100_000):
            own = repeat[i : i + 100_000]
            yield packed(int(doc[own[0]] + i) % shards, np.zeros(0, at.U64), doc[own], start[own], windows[own])
        shard = (at.mix(anchor[first]) % at.U64(shards)).astype(np.int64)
        order = first[np.argsort(shard, kind="stable")]
        cut = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
        for i in range(shards):
            own = order[cut[i] : cut[i + 1]]
            if len(own):
                yield packed(i, anchor[own], doc[own], start[own], windows[own])

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(doc: np.ndarray, start: np.ndarray, windows: np.ndarray, is_repeat: bool) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(doc), 200_000):
                i = slice(a, a + 200_000)
                yield pa.record_batch([
                    pa.array(doc[i]), pa.array(start[i]), pa.array(windows[i].astype(np.int32)), pa.array(np.full(len(doc[i]), is_repeat)),
                ], names=["doc", "start", "windows", "is_repeat"])

        parts = []
        for batch in batches:
            for a, d, s, w in zip(*(batch.column(c) for c in names[1:])):
                own = (np.frombuffer(a.as_py(), at.U64), np.frombuffer(d.as_py(), np.int64), np.frombuffer(s.as_py(), np.int32), np.frombuffer(w.as_py(), np.uint8))
                if len(own[0]):
                    parts.append(own)
                else:
                    yield from rows(*own[1:], True)
        if not parts:
            return
        anchor, doc, start, windows = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        order = np.argsort(anchor, kind="stable")
        same = np.concatenate([[False], anchor[order][1:] == anchor[order][:-1], [False]])
        hit = order[same[1:] | same[:-1]]
        yield from rows(doc[hit], start[hit], windows[hit], False)

    arrays = docs.select(id_key().cast("long").alias("_id"), "text").mapInArrow(run, "shard int, anchor binary, doc binary, start binary, windows binary")
    return written(arrays.groupBy("shard").applyInArrow(meet, "doc long, start int, windows int, is_repeat boolean"), "suspects")


class WaveletMatrix:
    """Succinct rank over a symbol sequence: one packed bit level per symbol bit."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.n = len(symbols)
        self.bits = max(1, int(top).bit_length())
        self.levels = []
        for b in range(self.bits - 1, -1, -1):
            bit = ((symbols >> b) & 1).astype(bool)
            raw = np.packbits(bit, bitorder="little")
            word = np.zeros(self.n // 64 + 1, np.uint64)
            word.view(np.uint8)[: len(raw)] = raw
            before = np.zeros(len(word) + 1, np.int32)
            np.cumsum(np.bitwise_count(word), out=before[1:])
            zeros = self.n - int(before[-1])
            self.levels.append((b, word, before, zeros))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[i] before place[i]."""
        begin, at_ = np.zeros_like(place), place.copy()
        for b, word, before, zeros in self.levels:
            one = ((symbol >> b) & 1).astype(bool)
            for x in (begin, at_):
                w = x >> 6
                ones = before[w] + np.bitwise_count(word[w] & ((np.uint64(1) << (x & 63).astype(np.uint64)) - np.uint64(1)))
                x[:] = np.where(one, zeros + ones, x - ones)
        return at_ - begin


class RunLengthBwt:
    """A Burrows-Wheeler sequence by its runs: a wavelet matrix over the runs' heads, where runs start, and how long they are.

    Copies give long runs, so its size grows with the different texts, not with how often they occur.
    """

    def __init__(self, bwt: np.ndarray, top: int):
        new = np.ones(len(bwt), bool)
        new[1:] = bwt[1:] != bwt[:-1]
        self.start = np.flatnonzero(new).astype(np.int32)
        self.head = bwt[self.start].astype(np.int32)
        self.runs = WaveletMatrix(self.head.astype(np.int64), top)
        by_symbol = np.argsort(self.head, kind="stable")
        length = np.diff(np.append(self.start, len(bwt)))[by_symbol]
        self.before = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])  # over the runs, symbol by symbol
        self.own = np.searchsorted(self.head[by_symbol], np.arange(top + 2))  # a symbol's first run there

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[i] before place[i]."""
        run = np.searchsorted(self.start, place, side="right") - 1
        own = self.own[symbol]
        whole = self.before[own + self.runs.rank(symbol, run)] - self.before[own]
        return whole + np.where(self.head[run] == symbol, place - self.start[run], 0)


def gram_symbols(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Numbers of the grams that begin at starts: equal exactly where all their words are."""
    _, first, symbol = np.unique(at.ngram_hash(at.mix(words.astype(at.U64)), GRAM)[starts], return_index=True, return_inverse=True)
    like = starts[first][symbol]
    if all((words[starts + i] == words[like + i]).all() for i in range(GRAM)):
        return symbol
    # different grams share a hash
    _, symbol = np.unique(np.lib.stride_tricks.sliding_window_view(words, GRAM)[starts], axis=0, return_inverse=True)
    return symbol.reshape(-1)


class FmIndex:
    """FM-index over the 5-word symbols of contexts.

    words: numbers of the contexts' words, joined (equal words, equal numbers);
    length: words of each context, at least five.
    """

    def __init__(self, words: np.ndarray, length: np.ndarray):
        self.begin = begin = np.cumsum(length) - length
        ctx = at.rows_of(length).astype(np.int32)
        n = len(words)
        has = np.zeros(n + 4 * GRAM * 2, bool)  # a gram of five words starts here
        at_ = np.arange(n)
        has[:n] = at_ + GRAM <= (begin + length)[ctx]
        own = np.flatnonzero(has[:n])
        symbol = np.zeros(len(has), np.int32)  # 0: none
        symbol[own] = gram_symbols(words, own) + 1
        rank = symbol
        reach = GRAM
        while reach < 2 * WINDOW:
            # the suffix five, ten, twenty words on, if it is in the same context
            key = rank[:n].astype(np.int64) * (int(rank.max()) + 1)
            m = n - reach
            if m > 0:
                key[:m] += np.where(ctx[reach:] == ctx[:m], rank[reach:n], 0)
            key = key[own]
            _, inverse = np.unique(key, return_inverse=True)
            rank = np.zeros(len(has), np.int32)
            rank[own] = inverse + 1
            reach *= 2
        del key, inverse
        self.order = order = own[np.argsort(rank[own], kind="stable")]  # the suffix array
        del rank
        self.symbol = symbol
        top = int(symbol.max()) + 1  # stands for 'no gram before'
        prev = order - GRAM
        bwt = np.where(prev >= begin[ctx[order]], symbol[np.maximum(prev, 0)], top)
        self.count = np.bincount(symbol[own], minlength=top + 2)
        self.first = np.cumsum(self.count) - self.count  # where a symbol's suffixes begin
        ends = own[~(has[own + GRAM] & (np.concatenate([ctx, np.full(GRAM, -1, np.int32)])[own + GRAM] == ctx[own]))]
        # its suffixes with nothing after the gram sort first
        self.base = self.first + np.bincount(symbol[ends], minlength=top + 2)
        self.bwt = RunLengthBwt(bwt, top)

    def back(self, place: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with the gram at each place put before what they stand for."""
        s = self.symbol[place]
        return self.base[s] + self.bwt.rank(s, lo), self.base[s] + self.bwt.rank(s, hi)

    def find(self, start: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the n words (a multiple of five) at each start."""
        last = self.symbol[start + n - GRAM]
        lo, hi = self.first[last], self.first[last] + self.count[last]
        for step in range(n - 2 * GRAM, -1, -GRAM):
            lo, hi = self.back(start + step, lo, hi)
        return lo, hi


def matched_windows(words: np.ndarray, length: np.ndarray, windows: np.ndarray, age: np.ndarray) -> np.ndarray:
    """For each window of each context: whether an equal window of lower age exists.

    words, length: see FmIndex; windows: of each context; age: of each window, in
    its order, by document and then position. Matching statistics, from the right: a match that ends at a word is
    taken back by grams of five for as long as it also starts earlier elsewhere.
    From 20 words on its interval is reported; ends of windows inside it aren't
    searched again.
    """
    index = FmIndex(words, length)
    query = at.flat(index.begin, windows)
    least = np.iinfo(np.int64).max
    oldest = np.full(len(words), least)
    oldest[query] = age
    by_order = np.append(oldest[index.order], least)
    first = np.repeat(index.begin, windows)
    from_right = np.repeat(windows, windows) - 1 - (query - first)
    late = np.zeros(len(words) + 1, bool)
    for turn in range(-(-int(windows.max(initial=0)) // GRAM)):
        own = (from_right // GRAM == turn) & ~late[query]
        top, place, left = query[own], query[own], first[own]
        lo, hi = index.find(place, WINDOW)
        while len(place):
            # one interval for all equal matches
            low, at_low = np.unique(lo, return_inverse=True)
            high = np.zeros(len(low), np.int64)
            high[at_low] = hi
            earliest = np.minimum.reduceat(by_order, np.column_stack([low, high]).ravel())[::2]
            hit = earliest[at_low] < oldest[place]
            late[at.flat(place[hit], top[hit] - place[hit] + 1)] = True
            more = hit & (place - GRAM >= left)
            top, place, left = top[more], place[more] - GRAM, left[more]
            lo, hi = index.back(place, lo[more], hi[more])
    return late[query]


def search_shards(docs: DataFrame, suspects: DataFrame, classes, shards: int) -> DataFrame:
    """doc, start, windows: intervals of windows with an earlier equal window, by FM-index."""
    per_doc = suspects.groupBy("doc").agg(F.collect_list(F.struct("start", "windows")).alias("_spans"))
    texts = docs.select(id_key().cast("long").alias("doc"), "text").join(per_doc, "doc")

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text"):
                buf, off = at.utf8(part.column("text"))
                first, end, counts = at.words(buf, off)
                code = rarity.codes(at.ngram_hash(at.span_hash(buf, first, end), GRAM), classes.value)
                begin = np.cumsum(counts) - counts
                spans = part.column("_spans")
                off = spans.offsets.to_numpy()
                flat = spans.values.slice(off[0], off[-1] - off[0])
                row = at.rows_of(np.diff(off))
                start = flat.field("start").to_numpy().astype(np.int64)
                windows = flat.field("windows").to_numpy().astype(np.int64)
                length = windows + WINDOW - 1
                # rows that share a doc_id: a span of the other row may not fit
                fits = start + length <= counts[row]
                row, start, windows, length = row[fits], start[fits], windows[fits], length[fits]
                if not len(row):
                    continue
                base = begin[row] + start
                # the windows' common anchor is the least gram of the first window
                anchor = np.lib.stride_tricks.sliding_window_view(code, _VIEW)[base].min(axis=1)
                shard = (at.mix(anchor) % at.U64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                ids = part.column("doc").to_numpy()[row]
                byte, size = first[base], end[base + length - 1] - first[base]
                for i in np.unique(shard).tolist():
                    own = order[cut[i] : cut[i + 1]]
                    yield pa.record_batch([
                        pa.array([i], pa.int32()), pa.array([buf[at.flat(byte[own], size[own])].tobytes()], pa.binary()),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (size[own].astype(np.int32), ids[own], start[own].astype(np.int32), windows[own].astype(np.uint8))),
                    ], names=["shard", "texts", "size", "doc", "start", "windows"])

    def index(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("texts", "size", "doc", "start", "windows"))):
                parts.append([np.frombuffer(x.as_py(), t) for x, t in zip(row, (np.uint8, np.int32, np.int64, np.int32, np.uint8))])
        buf, size, doc, start, windows = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        begin, end, _ = at.words(buf, np.concatenate([[0], np.cumsum(size, dtype=np.int64)]))
        words = at.word_array(buf, begin, end).dictionary_encode().indices.to_numpy()  # words are told apart by their bytes
        del buf, begin, end
        windows = windows.astype(np.int64)
        d, s = np.repeat(doc, windows), at.flat(start.astype(np.int64), windows)
        order = np.lexsort((s, d))
        fresh = np.ones(len(d), bool)
        fresh[1:] = (d[order][1:] != d[order][:-1]) | (s[order][1:] != s[order][:-1])
        age = np.empty(len(d), np.int64)
        age[order] = np.cumsum(fresh)  # equal places of one doc_id are equally old
        late = matched_windows(words, windows + WINDOW - 1, windows, age)
        d, s = d[late], s[late]
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        cut = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] != s[:-1] + 1)])) if len(d) else np.zeros(0, np.int64)
        run = np.diff(np.concatenate([cut, [len(d)]]))
        for a in range(0, len(cut), 200_000):
            c = cut[a : a + 200_000]
            yield pa.record_batch([pa.array(d[c]), pa.array(s[c].astype(np.int32)), pa.array(run[a : a + 200_000].astype(np.int32))], names=["doc", "start", "windows"])

    shipped = texts.mapInArrow(ship, "shard int, texts binary, size binary, doc binary, start binary, windows binary")
    return shipped.groupBy("shard").applyInArrow(index, "doc long, start int, windows int")


def repeated_windows(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """doc (id, null as NULL_ID), start, windows: all runs of windows that start earlier elsewhere."""
    shards = shards or shards_for(docs, bytes_each=8 << 20)
    classes = docs.sparkSession.sparkContext.broadcast(gram_classes(docs))
    suspects = suspect_contexts(docs, classes, shards)
    found = search_shards(docs, suspects.where("not is_repeat"), classes, shards)
    return suspects.where("is_repeat").select("doc", "start", "windows").unionByName(found)


def drop_repeats(docs: DataFrame, shards: int | None = None, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, and kept_sha256 (digest) or kept (the words left, joined by a space)."""
    spans = repeated_windows(docs, shards).groupBy("doc").agg(F.collect_list(F.struct("start", "windows")).alias("_spans"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("doc", id_key()).join(spans, "doc", "left").select("doc_id", "text", "_spans")
    last = "kept_sha256" if digest else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text"):
                buf, off = at.utf8(part.column("text"))
                start, end, counts = at.words(buf, off)
                begin = np.cumsum(counts) - counts
                gone = np.zeros(len(start), bool)
                for i, spans_ in enumerate(part.column("_spans").to_pylist()):
                    for s in spans_ or ():
                        to = s["start"] + s["windows"] + WINDOW - 1
                        if to <= counts[i]:
                            gone[begin[i] + s["start"] : begin[i] + to] = True
                removed = np.bincount(at.rows_of(counts)[gone], minlength=len(counts))
                out = []
                keep = np.flatnonzero(~gone)
                cut = np.searchsorted(keep, np.concatenate([begin, [len(start)]]))
                # kept words and one space after each, laid out at once
                size = end[keep] - start[keep]
                text = np.full(int(size.sum()) + len(keep), 32, np.uint8)
                place = np.cumsum(size + 1) - size - 1
                text[at.flat(place, size)] = buf[at.flat(start[keep], size)]
                place = np.append(place, len(text))
                data = text.tobytes()
                for i in range(len(counts)):
                    own = data[place[cut[i]] : max(place[cut[i + 1]] - 1, place[cut[i]])]
                    out.append(hashlib.sha256(own).hexdigest() if digest else own.decode())
                yield pa.record_batch([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())], names=["doc_id", "n_words", "n_removed", last])

    return texts.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {last} string")
