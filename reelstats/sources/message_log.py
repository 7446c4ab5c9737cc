"""A stored message table read as a stream by offsets, with an exact row cap per trigger.

`append_messages` numbers messages (offset) in a given order and appends them as a
segment of Parquet files sorted by offset; a small manifest names the files of each
segment with their offsets and is put in place last, so readers never see half a
segment. `MessageLog` is a streaming source over it (Python Data Source API):

    spark.dataSource.register(MessageLog)
    spark.readStream.format("message_log").option("path", p)
        .option("startingOffsets", "earliest" | "latest" | "<offset>")
        .option("maxOffsetsPerTrigger", 1000).option("positionFile", f).load()

The driver handles offsets and file names only. Tasks read the files, each a part
of a file's offsets, as Arrow batches; row group statistics skip the rest of the file.
A restarted query goes on at the offset of its checkpoint. With a cap, the reader has to
know where the last planned batch ended before the engine tells it, also after a restart:
it keeps that offset in `positionFile`, one file a query beside its checkpoint. (The
engine logs a batch's offsets before it is planned and plans an unfinished batch again
first, so the file never runs ahead of the checkpoint.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from reelstats.operators.ordering import numbered
from reelstats.sources import paths

SCHEMA = "offset long, key string, value string, timestamp timestamp"
ROWS_PER_TASK = 1_000_000
#: Of the files written: a task that reads a part of a file skips the rest by its row groups.
ROW_GROUP_BYTES = 8 << 20
_MANIFESTS = "_manifests"


def manifests(path: str) -> list[dict]:
    """The segments of a message table by offset: {"first", "end", "files": [[file, first, end], ...]}."""
    from pyarrow import fs

    system, root = paths.file_system(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/{_MANIFESTS}", allow_not_found=True))
    out = []
    for info in found:
        if info.base_name.startswith("segment-") and info.base_name.endswith(".json"):
            with system.open_input_file(info.path) as f:
                out.append(json.loads(f.read()))
    return sorted(out, key=lambda m: m["first"])


def end_offset(path: str) -> int:
    """The offset that the next message will get."""
    segments = manifests(path)
    return segments[-1]["end"] if segments else 0


def append_messages(messages: DataFrame, path: str, order: list[Column], partitions: int | None = None) -> tuple[int, int]:
    """Appends messages (key, value and timestamp, where they have them) in the given order.

    Returns their offsets [first, end). One writer at a time.
    """
    spark = messages.sparkSession
    first = end_offset(path)
    segment = f"segment-{first:020d}-{uuid.uuid4().hex}"
    missing = [F.lit(None).cast(t).alias(c) for c, t in (("key", "string"), ("timestamp", "timestamp")) if c not in messages.columns]
    placed = numbered(messages.select("*", *missing), order, "offset", partitions, first)
    cast = [F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(SCHEMA).fields]
    placed.select(*cast).repartitionByRange("offset").sortWithinPartitions("offset").write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path}/{segment}")
    stored = spark.read.parquet(f"{path}/{segment}").select(F.input_file_name().alias("file"), "offset")
    spans = stored.groupBy("file").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).orderBy("first").collect()  # a row a file
    end = spans[-1]["last"] + 1 if spans else first
    if spans:
        names = [[f"{segment}/{s['file'].rsplit('/', 1)[-1]}", s["first"], s["last"] + 1] for s in spans]
        paths.put(f"{path}/{_MANIFESTS}/{segment}.json", json.dumps({"first": first, "end": end, "files": names}).encode())
    return first, end


@dataclass
class FileSlice(InputPartition):
    """Offsets [first, end) of one file."""

    file: str
    first: int
    end: int


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.start = options.get("startingOffsets", "latest")
        cap = options.get("maxOffsetsPerTrigger")
        self.cap = None if cap is None else int(cap)
        self.position_file = options.get("positionFile")
        if self.cap is not None and self.position_file is None:
            raise ValueError("maxOffsetsPerTrigger needs a positionFile")
        self.rows_per_task = int(options.get("rowsPerTask", ROWS_PER_TASK))
        self.planned: int | None = None  # the end of the last batch planned

    def _first(self) -> int:
        if self.start == "earliest":
            return 0
        return end_offset(self.path) if self.start == "latest" else int(self.start)

    def _position(self) -> int:
        """Where the last planned batch ended: by this reader, the one before a restart, or where the stream starts."""
        if self.planned is None:
            kept = paths.get(self.position_file)
            if kept is None:
                self._keep(self._first())
            else:
                self.planned = int(kept)
        return self.planned

    def _keep(self, offset: int) -> None:
        self.planned = offset
        if self.position_file is not None:
            paths.put(self.position_file, str(offset).encode())

    def initialOffset(self) -> dict:  # noqa: N802 (the interface's names)
        return {"offset": self._first() if self.cap is None else self._position()}

    def latestOffset(self) -> dict:  # noqa: N802
        end = end_offset(self.path)
        return {"offset": end if self.cap is None else min(end, self._position() + self.cap)}

    def partitions(self, start: dict, end: dict) -> list[FileSlice]:
        lo, hi = start["offset"], end["offset"]
        self._keep(hi)
        out = []
        for segment in manifests(self.path):
            if segment["end"] <= lo or segment["first"] >= hi:
                continue
            for name, a, b in segment["files"]:
                a, b = max(a, lo), min(b, hi)
                out += [FileSlice(name, i, min(i + self.rows_per_task, b)) for i in range(a, b, self.rows_per_task)]
        return out

    def read(self, partition: FileSlice) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        system, root = paths.file_system(self.path)
        data = ds.dataset(f"{root}/{partition.file}", format="parquet", filesystem=system)
        here = (pc.field("offset") >= partition.first) & (pc.field("offset") < partition.end)
        for batch in data.to_batches(columns=["offset", "key", "value", "timestamp"], filter=here, use_threads=False):
            yield batch.set_column(3, "timestamp", batch.column("timestamp").cast(pa.timestamp("us", tz="UTC")))


class MessageLog(DataSource):
    """The streaming source `message_log`."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> MessageLogReader:  # noqa: N802
        return MessageLogReader(self.options)


def batch_number(cap: int) -> Column:
    """The batch that a row is in, when a table is read from offset 0 in batches of `cap` rows."""
    return F.expr(f"offset div {int(cap)}L")


def message_options(path: str, checkpoint: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = 1000,
                    batches_per_trigger: int = 1, rows_per_task: int = ROWS_PER_TASK) -> dict[str, str]:
    """Options of a message table stream, named as those of `decode.kafka_options`; checkpoint is the query's.

    batches_per_trigger: so many batches of the cap are taken by one trigger where they wait, for a
    handler that tells them apart by `batch_number`; a trigger costs about as much as a few
    100,000 rows.
    """
    out = {"path": path, "startingOffsets": starting_offsets, "rowsPerTask": str(rows_per_task)}
    if max_offsets_per_trigger is not None:
        out |= {"maxOffsetsPerTrigger": str(max_offsets_per_trigger * batches_per_trigger), "positionFile": f"{checkpoint.rstrip('/')}-position"}
    return out


def read_messages(spark: SparkSession, path: str, checkpoint: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = 1000,
                  batches_per_trigger: int = 1, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    spark.dataSource.register(MessageLog)
    options = message_options(path, checkpoint, starting_offsets, max_offsets_per_trigger, batches_per_trigger, rows_per_task)
    return spark.readStream.format(MessageLog.name()).options(**options).load()
