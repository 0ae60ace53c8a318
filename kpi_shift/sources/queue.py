"""A folder as a queue of messages, for batch and stream: each message is read once, whatever tasks or runs fail.

Tasks write Parquet files that nobody reads yet. A finished write becomes visible by one manifest, whose number is its place in
the queue; readers follow manifests, and a stream's offset is the number of the last one it took. A failed write leaves no
manifest, so its files do not count. A stream's batch that is repeated after a failure finds its manifest and adds none.

``register(spark)`` makes the format ``folder_queue`` known. The folder is a path or URI that driver and executors share; one
writer at a time may append to it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

FORMAT = "folder_queue"
SCHEMA = "value binary"
ARROW = pa.schema([("value", pa.binary())])
NO_WRITER = "batch"


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class MessageFile(InputPartition):
    def __init__(self, file: str):
        super().__init__(file)


class _Folder:
    """Files and manifests of a queue; holds only its address, so that it travels to tasks."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def at(self, *names: str) -> tuple[fs.FileSystem, str]:
        files, base = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("/") else f"/{self.path}")
        return files, "/".join((base, *names))

    def manifests(self) -> list[tuple[int, str, str]]:
        """Number, writer and batch of each manifest, which its name tells, in order."""
        files, folder = self.at("manifests")
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = [f.base_name.removesuffix(".json") for f in found if f.base_name.endswith(".json")]
        return sorted((int(n), writer, batch) for n, writer, batch in (name.split("_") for name in names))

    def files_between(self, after: int, upto: int | None) -> list[MessageFile]:
        """Data files of the manifests ``after`` < number <= ``upto``."""
        found = []
        for number, writer, batch in self.manifests():
            if number > after and (upto is None or number <= upto):
                files, path = self.at("manifests", f"{number:012d}_{writer}_{batch}.json")
                with files.open_input_stream(path) as stream:
                    found += [MessageFile(f) for f in json.loads(stream.read())]
        return found

    def read(self, partition: MessageFile) -> Iterator[pa.RecordBatch]:
        files, path = self.at("data", partition.value)
        with files.open_input_file(path) as source:
            yield from pq.ParquetFile(source).iter_batches(batch_size=10_000)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """One task's rows as one file; rows go through a batch at a time. An empty task writes none."""
        name, writer, sink = f"{uuid.uuid4().hex}.parquet", None, None
        try:
            for batch in batches:
                if batch.num_rows:
                    if writer is None:
                        files, path = self.at("data", name)
                        files.create_dir(self.at("data")[1], recursive=True)
                        sink = files.open_output_stream(path)
                        writer = pq.ParquetWriter(sink, ARROW)
                    writer.write_batch(pa.RecordBatch.from_arrays([batch.column(0).cast(pa.binary())], schema=ARROW))
        finally:
            for opened in (writer, sink):
                if opened is not None:
                    opened.close()
        return Written(None if writer is None else name)

    def publish(self, written: list[Written | None], writer: str, batch: str) -> None:
        """Make files visible: the manifest is written beside its place and then moved there."""
        known = self.manifests()
        if any(w == writer and b == batch for _, w, b in known) and writer != NO_WRITER:
            self.discard(written)
            return
        number = known[-1][0] + 1 if known else 1
        files, folder = self.at("manifests")
        files.create_dir(folder, recursive=True)
        pending = f"{folder}/{uuid.uuid4().hex}.pending"
        with files.open_output_stream(pending) as stream:
            stream.write(json.dumps([w.file for w in written if w is not None and w.file]).encode())
        files.move(pending, f"{folder}/{number:012d}_{writer}_{batch}.json")

    def discard(self, written: list[Written | None]) -> None:
        """Remove files that will never be visible. Those of tasks that did not report stay, unread."""
        for message in written:
            if message is not None and message.file:
                files, path = self.at("data", message.file)
                files.delete_file(path)


class _Reader(DataSourceReader):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        # one file per partition; an empty queue still needs one
        return self.folder.files_between(0, None) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.folder.read(partition) if partition.value is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"manifest": 0}

    def latestOffset(self) -> dict:
        known = self.folder.manifests()
        return {"manifest": known[-1][0] if known else 0}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.folder.files_between(start["manifest"], end["manifest"])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.folder.read(partition)


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write(iterator)

    def commit(self, messages: list) -> None:
        self.folder.publish(messages, NO_WRITER, "0")

    def abort(self, messages: list) -> None:
        self.folder.discard(messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: _Folder, name: str):
        self.folder, self.name = folder, name

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.folder.write(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.folder.publish(messages, self.name, str(batchId))

    def abort(self, messages: list, batchId: int) -> None:
        self.folder.discard(messages)


class FolderQueue(DataSource):
    """Options: ``path``; a stream that writes also needs ``writer``, a name of its own that it keeps over restarts."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _folder(self) -> _Folder:
        return _Folder(self.options["path"])

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._folder())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self._folder())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        self._accept(schema)
        if overwrite:
            raise ValueError("A queue is only appended to.")
        return _Writer(self._folder())

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        self._accept(schema)
        name = self.options.get("writer", "")
        if not name or "_" in name or "/" in name or name == NO_WRITER:
            raise ValueError(f"The option writer must name this stream, without _ and /, and not as {NO_WRITER!r}.")
        return _StreamWriter(self._folder(), name)

    def _accept(self, schema) -> None:
        if [f.name for f in schema.fields] != ["value"] or schema[0].dataType.typeName() not in ("binary", "string"):
            raise ValueError("A queue takes one column, value, of text or bytes.")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FolderQueue)
