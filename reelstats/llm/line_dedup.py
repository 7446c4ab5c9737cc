"""Line dedup with two Bloom filters (operator 9).

A text is split at \\n (null or empty: one empty line). A line's key is the
line with all of [\\x20\\x09-\\x0D] stripped at both ends and A-Z lower-cased.
Keys of at least 10 code points that occur in two or more documents lose all
their lines but those in the document with the smallest id.

Two passes over the texts:
1. every task marks its keys in a once-seen and a twice-seen Bloom filter and
   ships the set positions, cut into segments; per segment the partial filters
   are merged (a bit set once in two tasks becomes a twice-seen bit), and only
   the twice-seen filter, of fixed size `filter_bits`, is broadcast;
2. lines whose key hits the twice-seen filter are suspects. Only they are
   written once under the shared folder, then grouped by the exact key (partial
   minima first, so a hot line costs one row per task), which gives the first
   document of every confirmed key. That table is written too: the join that
   finds the suspects of other documents then has two plain shuffles as inputs,
   so AQE splits a hot line's suspects over several tasks.
A false hit only adds a suspect, never a dropped line. The filter has at least 8
bits for every distinct line, by an approximate count of them beforehand, and at
most MAX_FILTER_BITS (128 MiB), which bounds the broadcast. Beyond some 1.3 * 10^8
distinct lines more and more unrepeated lines are suspected and shuffled.

Defined cases: a null doc_id is one document, before all others; rows that
share a doc_id are one document; empty tables give empty results; other
columns pass through `drop_repeated_lines` (internal names start with _line_).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm import arrowtext as at
from reelstats.llm.tables import NULL_ID, id_key, written

MIN_KEY = 10
LEAST_FILTER_BITS = 1 << 23
MAX_FILTER_BITS = 1 << 30
SEGMENT_BITS = 1 << 21
_WS = " \t\n\x0b\x0c\r"
_CUT = re.compile(r"[^\n]*")


def _key(line: str) -> str | None:
    """The line's key as text, or None below MIN_KEY code points."""
    k = line.strip(_WS)
    if len(k) < MIN_KEY:
        return None
    # str.lower would also change letters beyond A-Z
    return k.lower() if k.isascii() else k.encode().lower().decode()


def _bits(keys: list[str], filter_bits: int) -> np.ndarray:
    """Two positions of each key, shape (2, n)."""
    raw = b"".join(hashlib.blake2b(k.encode(), digest_size=16).digest() for k in keys)
    return (np.frombuffer(raw, np.uint64).reshape(-1, 2).T % np.uint64(filter_bits)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    ids = batch.column("_line_doc").to_pylist()
    for i, text in zip(ids, batch.column("text")):
        yield i, text.as_py() or ""


def fitting_filter_bits(docs: DataFrame) -> int:
    """Filter size for the table's distinct lines (approximate count; keys are lines without their blanks)."""
    line = F.explode(F.split(F.col("text"), "\n", -1)).alias("line")
    keys = docs.select(line).select(F.trim("line").alias("line")).where(F.length("line") >= MIN_KEY)
    distinct = keys.agg(F.approx_count_distinct(F.xxhash64("line"), 0.05)).first()[0]
    return min(MAX_FILTER_BITS, max(LEAST_FILTER_BITS, 1 << (8 * int(distinct)).bit_length()))


def twice_seen_filter(docs: DataFrame, filter_bits: int) -> np.ndarray:
    """The merged twice-seen filter as a packed bit array of filter_bits / 8 bytes."""
    segment = min(SEGMENT_BITS, filter_bits)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(0, np.int64)
        twice = np.zeros(0, np.int64)
        # rows that share a doc_id are one document: (doc, key) pairs count once in a task;
        # across tasks such a pair only makes one more suspect
        for batch in batches:
            for part in at.chunks(batch, "text"):
                pairs = {(d, k) for d, t in _texts(part) for x in t.split("\n") if (k := _key(x))}
                if not pairs:
                    continue
                found, n = np.unique(_bits([k for _, k in pairs], filter_bits), return_counts=True)
                again = np.concatenate([twice, found[n > 1], found[np.isin(found, once, assume_unique=True)]])
                twice = np.unique(again)
                once = np.union1d(once, found)
        names, out = ["segment", "once", "twice"], []
        o_cut = np.searchsorted(once, np.arange(0, filter_bits + 1, segment))
        t_cut = np.searchsorted(twice, np.arange(0, filter_bits + 1, segment))
        for s in range(filter_bits // segment):
            o, t = once[o_cut[s] : o_cut[s + 1]], twice[t_cut[s] : t_cut[s + 1]]
            if len(o):
                out.append((s, (o - s * segment).astype(np.uint32).tobytes(), (t - s * segment).astype(np.uint32).tobytes()))
        if out:
            yield pa.record_batch([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.binary())], names=names)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(segment, bool), np.zeros(segment, bool)
        for batch in batches:
            for o, t in zip(batch.column("once"), batch.column("twice")):
                o, t = np.frombuffer(o.as_py(), np.uint32), np.frombuffer(t.as_py(), np.uint32)
                twice[o[once[o]]] = True
                twice[t] = True
                once[o] = True
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())], names=["segment", "twice"])

    parts = (
        docs.select(id_key().alias("_line_doc"), "text")
        .mapInArrow(mark, "segment int, once binary, twice binary")
        .groupBy("segment").applyInArrow(merge, "segment int, twice binary")
    )
    whole = np.zeros(filter_bits // 8, np.uint8)
    for row in parts.toLocalIterator():  # filter_bits / segment rows, whatever the input
        a = row["segment"] * segment // 8
        whole[a : a + segment // 8] = np.frombuffer(row["twice"], np.uint8)
    return whole


def confirmed_lines(docs: DataFrame, filter_bits: int | None = None) -> DataFrame:
    """(_line_doc, _line_keys): the repeated keys each document has to drop."""
    filter_bits = filter_bits or fitting_filter_bits(docs)
    shared = docs.sparkSession.sparkContext.broadcast(twice_seen_filter(docs, filter_bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in batches:
            for part in at.chunks(batch, "text"):
                pairs = list({(d, k) for d, t in _texts(part) for x in t.split("\n") if (k := _key(x))})
                if not pairs:
                    continue
                at_bit = _bits([k for _, k in pairs], filter_bits)
                hit = np.flatnonzero(((seen[at_bit >> 3] >> (at_bit & 7).astype(np.uint8)) & 1).all(0))
                yield pa.record_batch([pa.array([pairs[i][0] for i in hit], pa.int64()), pa.array([pairs[i][1] for i in hit], pa.string())], names=["_line_doc", "_line_key"])

    found = written(docs.select(id_key().alias("_line_doc"), "text").mapInArrow(suspects, "_line_doc long, _line_key string"), "suspects")
    first = written(
        found.groupBy("_line_key").agg(F.min("_line_doc").alias("_line_first"), F.max("_line_doc").alias("_line_last"))
        .where("_line_first < _line_last").select("_line_key", "_line_first"),
        "repeated-lines",
    )
    return (
        found.join(first, "_line_key").where("_line_doc > _line_first")
        .groupBy("_line_doc").agg(F.collect_set("_line_key").alias("_line_keys"))
    )


def drop_repeated_lines(docs: DataFrame, filter_bits: int | None = None, digest: bool = False) -> DataFrame:
    """The documents with their repeated lines dropped and n_chars brought up to date.

    digest=True gives doc_id, n_lines, n_dropped, kept_sha256 instead.
    """
    drops = confirmed_lines(docs, filter_bits)
    keep = docs.select("doc_id", "text") if digest else docs
    joined = keep.withColumn("_line_doc", id_key()).join(drops, "_line_doc", "left").drop("_line_doc")
    if digest:
        out = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    else:
        out = docs.select([F.col(c) for c in docs.columns]).schema

    def split(text: str | None, keys: list[str] | None) -> tuple[list[str], list[str]]:
        lines = (text or "").split("\n")
        if not keys:
            return lines, lines
        gone = set(keys)
        return lines, [x for x in lines if _key(x) not in gone]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text"):
                rows = [split(t.as_py(), k.as_py()) for t, k in zip(part.column("text"), part.column("_line_keys"))]
                if digest:
                    yield pa.record_batch([
                        part.column("doc_id").cast(pa.int64()),
                        pa.array([len(a) for a, _ in rows], pa.int64()),
                        pa.array([len(a) - len(b) for a, b in rows], pa.int64()),
                        pa.array([hashlib.sha256("\n".join(b).encode()).hexdigest() for _, b in rows], pa.string()),
                    ], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])
                    continue
                texts = ["\n".join(b) for _, b in rows]
                cols = []
                for name in part.schema.names:
                    if name == "_line_keys":
                        continue
                    col = part.column(name)
                    if name == "text":
                        col = pa.array([None if old is None and not new else new for old, new in zip(col.to_pylist(), texts)], pa.string())
                    elif name == "n_chars":
                        col = pa.array([len(t) for t in texts], pa.int64()).cast(col.type)
                    cols.append(col)
                yield pa.record_batch(cols, names=[n for n in part.schema.names if n != "_line_keys"])

    return joined.mapInArrow(run, out)
