"""A sink that sends request bodies and counts what became of them, as a Spark data source for writing.

A sender is a function from a list of rows, at most ``chunk``, to a list of status codes, null for no answer.
It runs in the tasks. Each task writes a receipt per row and reports its counts in its commit message; the
commit writes their sum under the name of the job. So a task that runs twice sends again, with the same
``batch_key``, by which the receiver knows the body (and answers 409, which counts as sent), but is counted
once; and a job that runs again under its name replaces its counts and receipts.

    spark.dataSource.register(body_sink("collector", send))
    bodies.write.format("collector").option("job", "2026-01-01").mode("append").save(folder)
    sink_stats(spark, folder)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

Sender = Callable[[list[dict]], list[int | None]]

#: The answers that count as delivered.
DELIVERED = (202, 409)
_STATS = "job string, sent long, failed long, files array<string>"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Delivered(WriterCommitMessage):
    """What a task sent."""

    file: str
    sent: int
    failed: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, send: Sender, path: str, job: str, keys: list[str], chunk: int):
        self.send, self.path, self.job, self.keys, self.chunk = send, path, job, keys, chunk
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Delivered:
        files, root = _open(self.path)
        folder = f"{root}/receipts/{self.job}"
        files.create_dir(folder, recursive=True)
        name = f"{self.run}-{uuid.uuid4().hex}.jsonl"
        counts = {True: 0, False: 0}
        with files.open_output_stream(f"{folder}/{name}") as out:
            for batch in iterator:
                for start in range(0, batch.num_rows, self.chunk):
                    rows = batch.slice(start, self.chunk).to_pylist()
                    statuses = self.send(rows)
                    if len(statuses) != len(rows):
                        raise ValueError(f"{len(rows)} bodies, but {len(statuses)} answers")
                    for row, status in zip(rows, statuses):
                        sent = status in DELIVERED
                        counts[sent] += 1
                        line = {**{k: row[k] for k in self.keys}, "status": status, "sent": sent}
                        out.write(json.dumps(line, default=str).encode() + b"\n")
        return Delivered(name, counts[True], counts[False])

    def _remove(self, keep: set[str]) -> None:
        files, root = _open(self.path)
        for info in files.get_file_info(fs.FileSelector(f"{root}/receipts/{self.job}", allow_not_found=True)):
            if info.is_file and info.base_name not in keep:
                files.delete_file(info.path)

    def commit(self, messages: list[Delivered | None]) -> None:
        files, root = _open(self.path)
        done = [m for m in messages if m is not None]
        files.create_dir(f"{root}/jobs", recursive=True)
        stats = {"job": self.job, "sent": sum(m.sent for m in done), "failed": sum(m.failed for m in done),
                 "files": [m.file for m in done]}
        with files.open_output_stream(f"{root}/jobs/{self.job}.json") as out:
            out.write(json.dumps(stats).encode())
        # Receipts of attempts that don't count, and of an earlier run of this job.
        self._remove({m.file for m in done})

    def abort(self, messages: list[Delivered | None]) -> None:
        files, root = _open(self.path)
        for message in messages:
            if message is not None:
                files.delete_file(f"{root}/receipts/{self.job}/{message.file}")


def body_sink(format_name: str, send: Sender, keys: tuple[str, ...] = ("batch_key",)) -> type[DataSource]:
    """A data source of that name. Receipts carry the columns ``keys``, which must be there.

    Options: ``path``, a folder that driver and executors share; ``job``, the name counts go by (a new one by
    default); ``chunk``, bodies handed to the sender at once (100).
    """

    class BodySink(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
            missing = [k for k in keys if k not in schema.fieldNames()]
            if missing:
                raise ValueError(f"no column {', '.join(missing)}")
            job = self.options.get("job") or uuid.uuid4().hex
            return _Writer(send, self.options["path"], job, list(keys), int(self.options.get("chunk", 100)))

    return BodySink


def sink_stats(spark: SparkSession, path: str) -> DataFrame:
    """job, sent, failed of every finished job."""
    return spark.read.schema(_STATS).json(f"{path}/jobs").select("job", "sent", "failed")


def receipts(spark: SparkSession, path: str, schema: str = "batch_key string") -> DataFrame:
    """job, the key columns, status and sent of every body of the finished jobs."""
    jobs = spark.read.schema(_STATS).json(f"{path}/jobs")
    counted = jobs.select("job", F.explode("files").alias("__file"))
    lines = spark.read.schema(f"{schema}, status int, sent boolean").json(f"{path}/receipts/*").withColumn(
        "__file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return lines.join(counted, "__file").drop("__file")
