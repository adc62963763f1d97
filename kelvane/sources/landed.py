"""Landed text files as a stream of lines in a total order.

Spark's own text source tells the file of a line and no more. This one gives the
byte at which each line begins, and its offset is (time of file, file, byte):
lines are ordered by columns everywhere, and a micro-batch may end inside a file.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

START = {"time": -1, "file": "", "byte": 0}
SCHEMA = "value binary, time bigint, file string, byte bigint"
CHUNK = 1 << 20
BATCH_ROWS = 10_000
# Tasks for each core, and bytes of a task that takes several spans.
TASKS, TASK_BYTES = 4, 64 << 20


@dataclass
class Span(InputPartition):
    """Lines of a file that begin in ``low``..``high``."""

    time: int
    file: str
    low: int
    high: int


@dataclass
class Spans(InputPartition):
    """Spans that follow one another, read by one task."""

    spans: list[Span]


def packed(spans: list[Span], most: int) -> list[Spans]:
    """``spans`` in order, as many to a task as come to ``most`` bytes."""
    tasks, size = [], 0
    for span in spans:
        if not tasks or size + span.high - span.low > most:
            tasks.append(Spans([]))
            size = 0
        tasks[-1].spans.append(span)
        size += span.high - span.low
    return tasks


def lines_of(stream, low: int, high: int) -> Iterator[tuple[int, bytes]]:
    """(byte, line) of the lines that begin in ``low``..``high``, read in chunks."""
    at = low
    if low > 0:  # a line that began before belongs to the span before
        stream.seek(low - 1)
        at = low - 1
    else:
        stream.seek(0)
    skip, rest = low > 0, b""
    while True:
        chunk = stream.read(CHUNK)
        pieces = (rest + chunk).split(b"\n")
        rest = pieces.pop()
        for piece in pieces:
            if skip:
                skip = False
            elif at >= high:
                return
            else:
                yield at, piece.removesuffix(b"\r")
            at += len(piece) + 1
        if not chunk:
            if rest and not skip and at < high:
                yield at, rest.removesuffix(b"\r")
            return
        if not skip and at >= high:
            return


class LandedReader(DataSourceStreamReader):
    """Files by time, then name. A file has to lie there, whole, within ``settle``
    seconds of its time; until then it is not looked at.

    The first micro-batch of a run takes all that lies behind the checkpoint,
    whose place Spark tells only then; later ones take ``batchBytes``.

    A task costs a start and a file for each partition of the shuffle behind it.
    With ``tasks``, spans that are more than so many share tasks.
    """

    def __init__(self, options: dict) -> None:
        given = {key.lower(): value for key, value in options.items()}
        self.path = given["path"]
        self.settle = float(given.get("settle", 5))
        self.batch_bytes = int(given.get("batchbytes", 1 << 32))
        self.span_bytes = int(given.get("spanbytes", 64 << 20))
        self.tasks = int(given.get("tasks", 0))
        self.planned: dict | None = None

    def _files(self) -> list[tuple[int, str, int]]:
        system, folder = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        newest = (time.time() - self.settle) * 1e6
        found = system.get_file_info(fs.FileSelector(folder, recursive=True))
        files = [(f.mtime_ns // 1000, f.path, f.size) for f in found
                 if f.type == fs.FileType.File and f.base_name[0] not in "._"]
        return sorted(f for f in files if f[0] <= newest)

    @staticmethod
    def _behind(start: dict, files: list[tuple[int, str, int]]) -> list[tuple[int, str, int, int]]:
        """(time, file, size, first byte) of what lies behind an offset."""
        place = (start["time"], start["file"])
        return [(*f, start["byte"] if f[:2] == place else 0) for f in files if f[:2] >= place]

    def initialOffset(self) -> dict:
        return START

    def latestOffset(self) -> dict:
        files = self._files()
        if self.planned is None:
            end = {"time": files[-1][0], "file": files[-1][1], "byte": files[-1][2]} if files else START
        else:
            end, left = self.planned, self.batch_bytes
            for at, file, size, first in self._behind(end, files):
                if left <= 0:
                    break
                end = {"time": at, "file": file, "byte": min(size, first + left)}
                left -= end["byte"] - first
        return end

    def partitions(self, start: dict, end: dict) -> list[Span] | list[Spans]:
        self.planned = end
        spans = []
        for at, file, size, first in self._behind(start, self._files()):
            if (at, file) > (end["time"], end["file"]):
                break
            last = end["byte"] if (at, file) == (end["time"], end["file"]) else size
            spans += [Span(at, file, low, min(low + self.span_bytes, last))
                      for low in range(first, last, self.span_bytes)]
        if not self.tasks:
            return spans
        share = -(-sum(span.high - span.low for span in spans) // self.tasks)
        return packed(spans, max(self.span_bytes, min(share, TASK_BYTES)))

    def read(self, part: Span | Spans) -> Iterator[pa.RecordBatch]:
        for span in part.spans if isinstance(part, Spans) else [part]:
            yield from self._read(span)

    def _read(self, span: Span) -> Iterator[pa.RecordBatch]:
        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        schema = pa.schema([("value", pa.binary()), ("time", pa.int64()), ("file", pa.string()), ("byte", pa.int64())])

        def batch(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
            places, values = zip(*held)
            n = len(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(values, pa.binary()), pa.array([span.time] * n), pa.array([span.file] * n),
                 pa.array(places)], schema=schema)

        with system.open_input_file(span.file) as stream:
            held = []
            for line in lines_of(stream, span.low, span.high):
                held.append(line)
                if len(held) == BATCH_ROWS:
                    yield batch(held)
                    held = []
            if held:
                yield batch(held)

    def commit(self, end: dict) -> None:
        pass


class LandedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LandedReader:
        return LandedReader(dict(self.options))


def landed_topic(spark: SparkSession, path: str, settle: float = 5, batch_bytes: int = 1 << 32,
                 span_bytes: int = 64 << 20) -> DataFrame:
    """Landed payloads, one JSON document per line, as a topic with their place.

    ``offset`` is the time of the file; ``position`` (file, byte) places a line
    among those of that time. ``path`` is a folder, or a URI that pyarrow can
    open; empty lines are payloads too, as in any topic.
    """
    spark.dataSource.register(LandedLines)
    lines = spark.readStream.format("landed_lines").option("path", path).option("settle", str(settle)).option(
        "batchBytes", str(batch_bytes)).option("spanBytes", str(span_bytes)).option(
        "tasks", str(TASKS * spark.sparkContext.defaultParallelism)).load()
    return lines.select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit(0).alias("partition"), F.col("time").alias("offset"),
        F.struct("file", "byte").alias("position"))
