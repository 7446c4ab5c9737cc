"""Full refresh of a collection that readers never see half of.

A refresh writes new Parquet files beside the old ones; each task hands the driver
the names of its files, and only when all tasks are done does the driver swap the
collection's manifest, in one step. A refresh that fails leaves the manifest, so readers go on
with the old collection, and removes its files; what tasks still running then write
afterwards is in no manifest, and `vacuum` removes it. The writer is a Python Data
Source (`format("collection")`, mode overwrite or append), fed with Arrow
batches; attempts of a task write files of their own, and only those of
the attempt that the driver accepts are listed. Reading is a plain Parquet scan
of the listed files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from reelstats.sources import paths

MANIFEST = "current.json"
ROW_GROUP_BYTES = 32 << 20
FILE_BYTES = 512 << 20


@dataclass
class Written(WriterCommitMessage):
    """The files that a task wrote, relative to the collection, and its rows."""

    files: list[str] = field(default_factory=list)
    rows: int = 0


class CollectionWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool, file_bytes: int):
        self.path, self.schema, self.overwrite, self.file_bytes = path, schema, overwrite, file_bytes
        self.run = f"run-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        system, root = paths.file_system(self.path)
        done, out, bytes_ = Written(), None, 0
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            nonlocal out, bytes_
            if not held:
                return
            table = pa.Table.from_batches(held)
            if out is None:
                system.create_dir(f"{root}/{self.run}")
                done.files.append(f"{self.run}/part-{uuid.uuid4().hex}.parquet")
                out = pq.ParquetWriter(f"{root}/{done.files[-1]}", table.schema, filesystem=system)
            out.write_table(table)
            bytes_ += table.nbytes
            held.clear()
            if bytes_ >= self.file_bytes:
                out.close()
                out, bytes_ = None, 0

        for batch in iterator:
            held.append(batch)
            done.rows += batch.num_rows
            if sum(b.nbytes for b in held) >= ROW_GROUP_BYTES:
                flush()
        flush()
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        new = [f for m in messages if m is not None for f in m.files]
        rows = sum(m.rows for m in messages if m is not None)
        old = None if self.overwrite else manifest(self.path)
        if old is not None:
            new, rows = old["files"] + new, old["rows"] + rows
        paths.put(f"{self.path}/{MANIFEST}", json.dumps({"files": new, "rows": rows, "schema": self.schema.json()}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        _remove(self.path, [self.run])


class Collection(DataSource):
    """The sink `collection`; option fileBytes bounds the size of a file."""

    @classmethod
    def name(cls) -> str:
        return "collection"

    def writer(self, schema: StructType, overwrite: bool) -> CollectionWriter:
        return CollectionWriter(self.options["path"], schema, overwrite, int(self.options.get("fileBytes", FILE_BYTES)))


def _remove(path: str, runs: list[str]) -> None:
    system, root = paths.file_system(path)
    for run in runs:
        if system.get_file_info(f"{root}/{run}").type.name == "Directory":
            system.delete_dir(f"{root}/{run}")


def manifest(path: str) -> dict | None:
    """{"files", "rows", "schema"} as of the last refresh, None before the first."""
    data = paths.get(f"{path}/{MANIFEST}")
    return None if data is None else json.loads(data)


def refresh_collection(df: DataFrame, path: str, mode: str = "overwrite") -> dict:
    """Replaces the collection (or adds to it: mode append) as one step; returns its manifest."""
    df.sparkSession.dataSource.register(Collection)
    df.write.format(Collection.name()).mode(mode).save(path)
    return manifest(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """The collection as of its last finished refresh."""
    now = manifest(path)
    if now is None:
        raise FileNotFoundError(f"no finished refresh of {path}")
    schema = StructType.fromJson(json.loads(now["schema"]))
    if not now["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in now["files"]])


def vacuum(path: str) -> list[str]:
    """Removes the files of refreshes that the manifest doesn't name; call it when no reader of an older one is left."""
    from pyarrow import fs

    now = manifest(path)
    system, root = paths.file_system(path)
    kept = {f.split("/")[0] for f in now["files"]} if now else set()
    found = [i.base_name for i in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.base_name.startswith("run-")]
    gone = sorted(r for r in found if r not in kept)
    _remove(path, gone)
    return gone
