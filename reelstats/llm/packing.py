"""Best-fit packing into fixed-length sequences (operator 7).

A document is its ids plus end_id. Only documents longer than a sequence are
cut, into full sequences and one shorter last piece. Pieces go through a
bounded-space online best-fit packer: at most `open_bins` open sequences per
task, held in a bitset keyed by free space; a piece goes to the open sequence
with the least free space that takes it, and when a new sequence is needed and
none may be opened, the fullest closes first. Pieces arrive in blocks of 4 * open_bins, the
longest of a block first: that bounded look-ahead leaves about 0.1 % of the room empty
where pieces as they come leave 1 % (sf0.1).

Encoder and packer run in one Python worker. A row waits there only until its
sequence closes; waiting rows are at most HELD_BYTES and those of the open
sequences, and are emitted as soon as they are over.

What is still open at a task's end is packed once more: the pieces of those
sequences (at most open_bins per task) are dealt to a few tasks and packed there
by the same bounded-space packer, blocks being given by a hash. So half-filled sequences are lost to only one task in `fan_in`. The pieces are
written once in between, with small row groups; a retried task gives the same rows.

Defined cases: null text is empty and is one piece of one id; rows that repeat
a doc_id, and null ids, are documents of their own; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from reelstats.llm import arrowtext as at
from reelstats.llm.tables import written
from reelstats.llm.tokens import CHUNK_BYTES, Encoder

LENGTH = 2048
HELD_BYTES = 6 << 20
ROW_GROUP_BYTES = 32 << 20
OPEN_BINS = 512
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bounded-space best-fit. Bit f of the set says that some open bin has f ids free."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.open_bins = length, open_bins
        self.bins: dict[int, list[int]] = {}  # free space -> bin numbers
        self.set, self.n_open, self.made = 0, 0, 0
        self.free: dict[int, int] = {}

    def _take(self, free: int) -> int:
        here = self.bins[free]
        b = here.pop()
        if not here:
            self.set &= ~(1 << free)
        return b

    def _put(self, b: int, free: int) -> None:
        self.bins.setdefault(free, []).append(b)
        self.set |= 1 << free

    def add(self, n: int) -> tuple[int, int]:
        """(bin, offset in it) for a piece of n ids."""
        fits = self.set >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                fullest = (self.set & -self.set).bit_length() - 1
                self.free.pop(self._take(fullest))
                self.n_open -= 1
            b, free = self.made, self.length
            self.made += 1
            self.n_open += 1
        left = free - n
        if left:
            self._put(b, left)
            self.free[b] = left
        else:
            self.free.pop(b, None)
            self.n_open -= 1
        return b, self.length - free


def _packed(length: int, open_bins: int, first_bin: int, leave_open: bool):
    """mapInArrow body: adds sequence_id (null where the sequence is left open) and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = first_bin + (TaskContext.get().partitionId() << 32)
        fit = BestFit(length, open_bins)
        # rows wait until their bin closes; only the open bins' rows stay
        kept: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        held = held_bytes = 0

        def out(batch, bins, offsets, open_):
            seq = pa.array(base + bins, pa.int64(), mask=open_ if leave_open else None)
            return pa.record_batch([*batch.columns, seq, pa.array(offsets, pa.int64())], names=[*batch.schema.names, "sequence_id", "offset"])

        for batch in batches:
            sizes = batch.column("length").to_numpy(zero_copy_only=False)
            bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for i in range(0, len(sizes), 4 * open_bins):
                ahead = i + np.argsort(-sizes[i : i + 4 * open_bins], kind="stable")
                placed = [fit.add(n) for n in sizes[ahead].tolist()]
                bins[ahead], offsets[ahead] = zip(*placed)
            if not leave_open:
                yield out(batch, bins, offsets, None)
                continue
            kept.append((batch, bins, offsets))
            held += len(bins)
            held_bytes += batch.nbytes
            if held > 64 * open_bins or held_bytes > HELD_BYTES:
                still = np.fromiter(fit.free, np.int64, len(fit.free))
                rest = []
                for part, b, o in kept:
                    open_ = np.isin(b, still)
                    if not open_.all():
                        yield out(part.filter(pa.array(~open_)), b[~open_], o[~open_], np.zeros(int((~open_).sum()), bool))
                    if open_.any():
                        rest.append((part.filter(pa.array(open_)), b[open_], o[open_]))
                kept.clear()
                if rest:
                    table = pa.Table.from_batches([r[0] for r in rest]).combine_chunks().to_batches()[0]
                    kept.append((table, np.concatenate([r[1] for r in rest]), np.concatenate([r[2] for r in rest])))
                held, held_bytes = sum(len(r[1]) for r in rest), 0
                del rest, part, batch
                at._release()
        still = np.fromiter(fit.free, np.int64, len(fit.free))
        for batch, bins, offsets in kept:
            yield out(batch, bins, offsets, np.isin(bins, still))

    return run


def _encoded(tokenizer: str, end_id: int, length: int, with_ids: bool, added_tokens: bool):
    """mapInArrow body: the pieces of (doc_id, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(tokenizer, added_tokens)
        for batch in batches:
            for part in at.chunks(batch, "text", CHUNK_BYTES):
                yield piece_rows(part, coder, end_id, length, with_ids)

    return run


def piece_rows(part: pa.RecordBatch, coder: Encoder, end_id: int, length: int, with_ids: bool) -> pa.RecordBatch:
    ids, off = coder.with_end(part.column("text"), end_id)
    n = np.diff(off)
    cut = -(-n // length)
    row = at.rows_of(cut)
    piece = at.flat(np.zeros(len(cut), np.int64), cut)
    start = piece * length
    size = np.minimum(n[row] - start, length)
    begin = off[row] + start
    crc = [zlib.crc32(ids[a : a + m]) for a, m in zip(begin.tolist(), size.tolist())]
    cols = [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(crc, pa.int64())]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([begin, off[-1:]]), pa.int32()), pa.array(ids.view(np.int32))))
        names.append("ids")
    return pa.record_batch(cols, names=names)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document; added_tokens as in Encoder."""
    return _texts(docs).mapInArrow(_encoded(tokenizer, end_id, length, with_ids, added_tokens), _piece_schema(with_ids))


def _piece_schema(with_ids: bool) -> StructType:
    return StructType.fromDDL(_PIECES + (", ids array<int>" if with_ids else ""))


def _placed(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("sequence_id", LongType()).add("offset", LongType())


def pack(rows: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, fan_in: int = 64) -> DataFrame:
    """rows (any columns, with length long) plus sequence_id and offset."""
    return _again(rows.mapInArrow(_packed(length, open_bins, 0, True), _placed(rows.schema)), length, open_bins, fan_in)


def _again(packed: DataFrame, length: int, open_bins: int, fan_in: int) -> DataFrame:
    """The rows packed by the first level, with those of sequences left open packed once more."""
    first = written(packed, "packed", ROW_GROUP_BYTES)
    left = first.where("sequence_id is null").drop("sequence_id", "offset")
    # about one task for every fan_in first-level tasks
    blocks = max(1, -(-left.count() // (open_bins * 4)))
    tasks = -(-blocks // fan_in)
    key = [c for c in ("doc_id", "piece", "ids_crc32") if c in left.columns]
    dealt = left.withColumn("_block", F.pmod(F.xxhash64(*key), F.lit(blocks))).withColumn("_deal", F.col("_block") % tasks)
    again = (
        dealt.repartition(tasks, "_deal").sortWithinPartitions("_block", F.col("length").desc(), *key).drop("_deal", "_block")
        .mapInArrow(_packed(length, open_bins, 1 << 62, False), first.schema)
    )
    return first.where("sequence_id is not null").unionByName(again)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, open_bins: int = OPEN_BINS, with_ids: bool = False, added_tokens: bool = False, fan_in: int = 64
) -> DataFrame:
    """pack(pieces(...)), encoded and packed in one pass."""
    encode, place = _encoded(tokenizer, end_id, length, with_ids, added_tokens), _packed(length, open_bins, 0, True)
    packed = _texts(docs).mapInArrow(lambda batches: place(encode(batches)), _placed(_piece_schema(with_ids)))
    return _again(packed, length, open_bins, fan_in)
