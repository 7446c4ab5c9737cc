"""Benchmark decontamination with an Aho-Corasick automaton (operator 13).

Texts are normalised the same way on both sides: A-Z lower-cased, words are runs
of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` (digits, letters, everything beyond ASCII).
A window is `size` consecutive words of an item; an item with fewer words, but not
none, is one window. All windows go into one automaton whose symbols are word
numbers, so it finds windows of every length in one pass over a document's words.
Words that no item has end the match, so only stretches of known words are
scanned. A hit is mapped back to word numbers and to code point offsets of the
original text.

Bounds: the automaton holds at most some `shard_bytes` of normalised item text
(about 120 bytes of memory a byte of text). A larger benchmark is cut into as
many automata, each scanned in a pass of its own whose result is written; long
items are cut into overlapping segments, so no window is lost. Documents are never
shuffled.

Defined cases: null text has no words; an item with a null id counts as an item
whose id is the empty string; rows that share an item_id are one item whose
windows are those of each row; items without words have no windows; documents
that repeat a doc_id, or have none, are judged row by row; empty tables give
empty results or no hits; other columns pass through `find_passages` and may
have any name but the four that it adds (those are replaced).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelstats.llm import arrowtext as at
from reelstats.llm.tables import written

WINDOW = 10
SHARD_BYTES = 1 << 21
SEGMENT_WORDS = 2000
CHUNK_BYTES = 2 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
_INSIDE = np.array([b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" for b in range(256)])
_FOUND = "n_words long, hits array<struct<first:long,last:long,start:long,end:long>>, items array<string>"
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def item_segments(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, segment, words): the items' words, in segments that overlap by size - 1 words."""
    step = SEGMENT_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text")):
                words = _WORD.findall((text.as_py() or "").translate(_LOWER))
                for i in range(0, max(1, len(words) - size + 1), step):
                    if words:
                        out.append((item, i // step, words[i : i + step + size - 1]))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.list_(pa.string())))], names=["item", "segment", "words"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "item string, segment int, words array<string>")


def _patterns(rows: list, size: int) -> dict:
    """Word numbers, windows as tuples of them and the items of each window, of one shard."""
    number: dict[str, int] = {}
    items = sorted({r["item"] for r in rows})
    item_no = {x: i for i, x in enumerate(items)}
    windows: dict[tuple[int, ...], set[int]] = {}
    for r in rows:
        ids = [number.setdefault(w, len(number) + 1) for w in r["words"]]
        for i in range(max(1, len(ids) - size + 1)):
            windows.setdefault(tuple(ids[i : i + size]), set()).add(item_no[r["item"]])
    return {"name": uuid.uuid4().hex, "vocabulary": [w.encode() for w in number], "items": items, "windows": [(w, tuple(sorted(s))) for w, s in windows.items()]}


def _automaton(shard: dict) -> tuple:
    """(automaton, vocabulary, shortest window) of a shard, built once per Python worker."""
    kept = at.process_cache("automata")
    if shard["name"] not in kept:
        import ahocorasick

        kept.clear()
        auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for word_numbers, items in shard["windows"]:
            auto.add_word(word_numbers, (len(word_numbers), items))
        auto.make_automaton()
        kept[shard["name"]] = auto, pa.array(shard["vocabulary"], pa.large_binary()), min(len(w) for w, _ in shard["windows"])
    return kept[shard["name"]]


def _matches(shard: dict, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, set[int]]]:
    """Words covered by windows, as (first, last + 1) word positions, and the item numbers of each row.

    ids: word numbers of the rows one after the other, 0 for words that no item has.
    """
    auto, _, least = _automaton(shard)
    # stretches of known words within a row, as long as the shortest window
    known = ids > 0
    first = np.zeros(len(ids), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    before = np.concatenate([[False], known[:-1]])
    begin = np.flatnonzero(known & (~before | first))
    after = np.concatenate([known[1:] & ~first[1:], [False]])
    end = np.flatnonzero(known & ~after) + 1
    long = end - begin >= least
    begin, size = begin[long], (end - begin)[long]
    where = at.flat(begin, size)
    # stretches are parted by the number 0, which no window holds
    place = np.arange(len(where)) + np.repeat(np.arange(len(size)), size)
    line = np.zeros(len(where) + len(size), np.int64)
    line[place] = ids[where]
    back = np.zeros(len(line), np.int64)
    back[place] = where
    row = at.rows_of(counts)
    lo, hi, items = [], [], {}
    for e, (n, found) in auto.iter(tuple(line.tolist())):
        w = int(back[e])
        lo.append(w - n + 1)
        hi.append(w + 1)
        items.setdefault(int(row[w]), set()).update(found)
    return np.array(lo, np.int64), np.array(hi, np.int64), items


def _scan(docs: DataFrame, shard: dict) -> DataFrame:
    """The documents with the hits of one shard added to those that they have."""
    share = docs.sparkSession.sparkContext.broadcast(shard)
    schema = StructType([f for f in docs.schema if f.name not in ("n_words", "hits", "items")] + StructType.fromDDL(_FOUND).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = share.value
        _, vocabulary, _ = _automaton(shard)
        for batch in batches:
            for part in at.chunks(batch, "text", CHUNK_BYTES):
                buf, off = at.utf8(part.column("text"))
                low = at.lower_ascii(buf)
                start, end, counts = at.words(low, off, _INSIDE)
                number = pc.index_in(at.word_array(low, start, end), value_set=vocabulary)
                ids = pc.add(pc.fill_null(number, -1), 1).to_numpy(zero_copy_only=False).astype(np.int64)
                lo, hi, items = _matches(shard, ids, counts)
                cover = np.zeros(len(ids) + 1, np.int64)
                np.add.at(cover, lo, 1)
                np.add.at(cover, hi, -1)
                base = np.cumsum(counts) - counts
                if "hits" in part.schema.names:
                    for r, spans in enumerate(part.column("hits").to_pylist()):
                        for s in spans:
                            cover[base[r] + s["first"]] += 1
                            cover[base[r] + s["last"]] -= 1
                hit = np.concatenate([[False], np.cumsum(cover[:-1]) > 0])
                # runs of hit words; a row's last word ends its run
                cut = np.zeros(len(ids) + 1, bool)
                cut[base] = True
                on, was = hit[1:], hit[:-1]
                a = np.flatnonzero(on & (~was | cut[:-1]))
                nxt = np.concatenate([on[1:], [False]]) if len(on) else on
                b = np.flatnonzero(on & (~nxt | cut[1:])) + 1
                row = at.rows_of(counts)
                spans: dict[int, list] = {}
                if len(a):
                    # code points before every byte, to name places in the original text
                    points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
                    for x, y in zip(a.tolist(), b.tolist()):
                        r = int(row[x])
                        p = int(points[off[r]])
                        spans.setdefault(r, []).append({"first": x - int(base[r]), "last": y - int(base[r]), "start": int(points[start[x]]) - p, "end": int(points[end[y - 1]]) - p})
                names = shard["items"]
                earlier = part.column("items").to_pylist() if "hits" in part.schema.names else [[]] * part.num_rows
                found = [sorted({*earlier[r], *(names[i] for i in items.get(r, ()))}) for r in range(part.num_rows)]
                keep = [n for n in part.schema.names if n not in ("n_words", "hits", "items")]
                yield pa.record_batch(
                    [*(part.column(n) for n in keep), pa.array(counts, pa.int64()), pa.array([spans.get(r, []) for r in range(part.num_rows)], pa.list_(_SPAN)), pa.array(found, pa.list_(pa.string()))],
                    names=[*keep, "n_words", "hits", "items"],
                )

    return docs.mapInArrow(run, schema)


def find_passages(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs plus n_words, hits, items and contaminated.

    hits are the maximal stretches of hit words: word numbers [first, last) and code
    point offsets [start, end) in the original text; items are the ids of the items
    with a window in the document, as strings in code point order.
    """
    parts = written(item_segments(benchmark, size), "benchmark")
    total = parts.agg(F.sum(F.octet_length(F.array_join("words", " ")))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    out = docs.select([c for c in docs.columns if c not in ("n_words", "hits", "items", "contaminated")])
    out = out.withColumn("text", F.col("text").cast("string"))
    if not total:
        # nothing to find, but words are still counted
        return _scan(out, {"name": "none", "vocabulary": [], "items": [], "windows": [((0,) * size, ())]}).withColumn("contaminated", F.lit(False))
    for i in range(shards):
        # at most some shard_bytes of text
        rows = parts.where(F.pmod(F.xxhash64("item", "segment"), F.lit(shards)) == i).select("item", "words").collect()
        if rows:
            out = _scan(out, _patterns(rows, size))
            out = written(out, "passages") if i + 1 < shards else out
    return out.withColumn("contaminated", F.size("hits") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents, all columns, in which no window of a benchmark item occurs."""
    whole = docs.select("text", F.struct("*").alias("document"))
    return find_passages(whole, benchmark, size).where("not contaminated").select("document.*")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return find_passages(docs.select(F.col("doc_id").cast("long"), "text"), benchmark).select(
        "doc_id", "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
