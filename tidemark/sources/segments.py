"""A partitioned topic with offsets as a data source, for batches and streams.

A topic is a folder: data files below ``data`` and one small file per published batch
below ``commits``, numbered without gaps. A commit lists the batch's segments (topic
partition, first offset, rows, file) and where every partition ends after it. Offsets
are given when a batch commits, so its tasks write in parallel; until then its
files belong to nothing, and an aborted batch leaves nothing that can be read. One
writer at a time may publish to a topic.

A stream's offset is ``{topic: {partition: next offset}}``. The driver looks up commits
by bisection and never lists the folder. A tick takes at most ``maxoffsetspertrigger``
rows, an equal share of every partition; each topic partition's range is read by
one task per ``rowspertask`` rows. ``read`` skips row groups outside its range. Tasks
hold a row group, or a part of one, at a time.

Paths may be of any file system that pyarrow opens by URI, or plain local ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas

FORMAT = "segment_topic"
ROWS_PER_TASK = 50_000
ROW_GROUP = 10_000


@dataclass(frozen=True)
class Segment:
    """Rows of one topic partition: the first has offset ``base``."""

    partition: int
    base: int
    rows: int
    file: str


class TopicLog:
    """The commits of one topic folder."""

    def __init__(self, path: str):
        if "://" in path or path.startswith("file:"):
            self.files, self.root = fs.FileSystem.from_uri(path)
        else:
            self.files, self.root = fs.LocalFileSystem(), path
        self.root = self.root.rstrip("/")
        self._read: dict[int, dict] = {}
        self._known = -1

    def _name(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def _exists(self, number: int) -> bool:
        return self.files.get_file_info(self._name(number)).type == fs.FileType.File

    def last(self) -> int:
        """The newest commit's number, or -1: probed from the last known one on."""
        step = 1
        while self._exists(self._known + step):
            step *= 2
        low, high = self._known + step // 2, self._known + step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._exists(middle) else (low, middle)
        self._known = low
        return low

    def commit(self, number: int) -> dict:
        if number < 0:
            return {"ends": {}, "segments": [], "batches": {}}
        if number not in self._read:
            with self.files.open_input_stream(self._name(number)) as found:
                self._read = {**dict(list(self._read.items())[-64:]), number: json.loads(found.read())}
        return self._read[number]

    def ends(self) -> dict[int, int]:
        """Where every partition ends now."""
        return {int(p): end for p, end in self.commit(self.last())["ends"].items()}

    def segments(self, start: Mapping[int, int], end: Mapping[int, int]) -> list[Segment]:
        """The segments that hold offsets from ``start`` up to ``end``."""
        wanted = {p: (start.get(p, 0), e) for p, e in end.items() if e > start.get(p, 0)}
        found: list[Segment] = []
        if not wanted:
            return found

        def passed(number: int) -> bool:
            """Whether a commit holds, or follows, the first wanted offset."""
            ends = self.commit(number)["ends"]
            return any(ends.get(str(p), 0) > first for p, (first, _) in wanted.items())

        low, high = -1, self.last()
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if passed(middle) else (middle, high)
        for number in range(high, self.last() + 1):
            commit = self.commit(number)
            for item in commit["segments"]:
                segment = Segment(**item)
                first, until = wanted.get(segment.partition, (0, 0))
                if segment.base < until and segment.base + segment.rows > first:
                    found.append(segment)
            if all(commit["ends"].get(str(p), 0) >= until for p, (_, until) in wanted.items()):
                break
        return found

    def append(self, written: Sequence[tuple[int, int, int, str]], writer: str, batch: int | None) -> None:
        """Give offsets to (task, partition, rows, file) and make them readable, all at once.

        A batch that this writer has committed before is not added again.
        """
        number = self.last()
        before = self.commit(number)
        if not written and batch is None:
            return
        batches = dict(before["batches"])
        if batch is not None and batches.get(writer, -1) >= batch:
            self.discard([file for *_, file in written])
            return
        ends, segments = dict(before["ends"]), []
        for _, partition, rows, file in sorted(written):
            base = ends.get(str(partition), 0)
            segments.append({"partition": partition, "base": base, "rows": rows, "file": file})
            ends[str(partition)] = base + rows
        if batch is not None:
            batches[writer] = batch
        self.files.create_dir(f"{self.root}/commits")
        draft = f"{self.root}/commits/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as out:
            out.write(json.dumps({"ends": ends, "segments": segments, "batches": batches}).encode())
        self.files.move(draft, self._name(number + 1))

    def discard(self, names: Sequence[str]) -> None:
        for name in names:
            if self.files.get_file_info(f"{self.root}/{name}").type == fs.FileType.File:
                self.files.delete_file(f"{self.root}/{name}")


@dataclass
class Range(InputPartition):
    """Some segments of a topic partition, and the offsets wanted of them."""

    partition: int
    start: int
    end: int
    segments: tuple[Segment, ...]


def _ranges(log: TopicLog, start: Mapping[int, int], end: Mapping[int, int], rows: int) -> list[Range]:
    tasks = []
    by_partition: dict[int, list[Segment]] = {}
    for segment in log.segments(start, end):
        by_partition.setdefault(segment.partition, []).append(segment)
    for partition, segments in sorted(by_partition.items()):
        at, until = start.get(partition, 0), end[partition]
        while at < until:
            to = min(at + rows, until)
            held = tuple(s for s in segments if s.base < to and s.base + s.rows > at)
            tasks.append(Range(partition, at, to, held))
            at = to
    return tasks


def _read(path: str, topic: str, task: Range) -> Iterator[pa.RecordBatch]:
    log = TopicLog(path)
    for segment in task.segments:
        at = segment.base
        with log.files.open_input_file(f"{log.root}/{segment.file}") as source:
            file = pq.ParquetFile(source)
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if at < task.end and at + rows > task.start:
                    first = 0
                    for held in file.iter_batches(ROW_GROUP, [group], use_threads=False):
                        low = max(task.start - at - first, 0)
                        batch = held.slice(low, max(min(task.end - at - first, held.num_rows) - low, 0))
                        n, base = batch.num_rows, at + first + low
                        if n:
                            yield pa.RecordBatch.from_arrays([
                                batch.column("key"), batch.column("value"), pa.repeat(pa.scalar(topic), n),
                                pa.repeat(pa.scalar(task.partition, pa.int32()), n),
                                pa.array(np.arange(base, base + n)), batch.column("timestamp"),
                            ], names=schemas.TOPIC.names)
                        first += held.num_rows
                at += rows


class _Options:
    def __init__(self, options: Mapping[str, str]):
        self.path, self.topic = options["path"], options.get("topic", "events")
        self.limit = int(options["maxoffsetspertrigger"]) if "maxoffsetspertrigger" in options else None
        self.rows = int(options.get("rowspertask", ROWS_PER_TASK))
        self.writer = options.get("writer", "")
        self.batch = int(options["batch"]) if "batch" in options else None


class BatchReader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        log = TopicLog(self.options.path)
        return _ranges(log, {}, log.ends(), self.options.rows) or [Range(0, 0, 0, ())]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.options.path, self.options.topic, partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, options: _Options):
        self.options = options
        self._log: TopicLog | None = None
        self._position: dict[int, int] = {}

    @property
    def log(self) -> TopicLog:
        if self._log is None:
            self._log = TopicLog(self.options.path)
        return self._log

    def _offset(self, ends: Mapping[int, int]) -> dict:
        return {self.options.topic: {str(p): end for p, end in sorted(ends.items())}}

    def _ends(self, offset: dict) -> dict[int, int]:
        return {int(p): end for p, end in offset.get(self.options.topic, {}).items()}

    def initialOffset(self) -> dict:  # noqa: N802
        return self._offset({})

    def latestOffset(self) -> dict:  # noqa: N802
        ends = self.log.ends()
        if self.options.limit is not None:
            share = max(1, self.options.limit // max(1, len(ends)))
            ends = {p: min(end, self._position.get(p, 0) + share) for p, end in ends.items()}
        return self._offset(ends)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # Called for every tick, and after a restart with where the last one ended.
        self._position = self._ends(end)
        return _ranges(self.log, self._ends(start), self._position, self.options.rows)

    def commit(self, end: dict) -> None:
        pass

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(self.options.path, self.options.topic, partition)

    def __getstate__(self) -> dict:
        return {"options": self.options, "_log": None, "_position": {}}


@dataclass
class Written(WriterCommitMessage):
    """(task, partition, rows, file) of what one task wrote."""

    segments: list[tuple[int, int, int, str]]


def _segments(messages: Sequence[Written | None]) -> list[tuple[int, int, int, str]]:
    return [segment for m in messages if m is not None for segment in m.segments]


class BatchWriter(DataSourceArrowWriter):
    """Writes the rows of a task, which come sorted by partition, a file per partition."""

    def __init__(self, options: _Options):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        log = TopicLog(self.options.path)
        log.files.create_dir(f"{log.root}/data")
        done: list[tuple[int, int, int, str]] = []
        held: list[pa.Table] = []
        out, name, rows, waiting, current = None, "", 0, 0, None

        def flush() -> None:
            nonlocal out, held, rows, waiting
            if held:
                table = pa.concat_tables(held)
                if out is None:
                    out = pq.ParquetWriter(f"{log.root}/{name}", table.schema, filesystem=log.files, compression="zstd")
                out.write_table(table)
                rows += table.num_rows
                held, waiting = [], 0

        def close() -> None:
            nonlocal out
            flush()
            if out is not None:
                out.close()
                done.append((task, current, rows, name))
                out = None

        for batch in iterator:
            table = pa.Table.from_batches([batch])
            partitions = table.column("partition").to_numpy()
            cuts = [0, *((partitions[1:] != partitions[:-1]).nonzero()[0] + 1).tolist(), len(partitions)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if int(partitions[a]) != current:
                    close()
                    current, rows = int(partitions[a]), 0
                    name = f"data/{current}-{uuid.uuid4().hex}.parquet"
                held.append(table.slice(a, b - a).select(["key", "value", "timestamp"]))
                waiting += b - a
                if waiting >= ROW_GROUP:
                    flush()
        close()
        return Written(done)

    def commit(self, messages: Sequence[Written | None]) -> None:
        TopicLog(self.options.path).append(_segments(messages), self.options.writer, self.options.batch)

    def abort(self, messages: Sequence[Written | None]) -> None:
        TopicLog(self.options.path).discard([file for *_, file in _segments(messages)])


class SegmentTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return schemas.TOPIC

    def _options(self) -> _Options:
        return _Options({k.lower(): v for k, v in self.options.items()})

    def reader(self, schema) -> DataSourceReader:
        return BatchReader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return StreamReader(self._options())

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(self._options())


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(SegmentTopic)
    return spark


def dealt(messages: DataFrame, partitions: int, order: Sequence[str]) -> DataFrame:
    """Messages with the topic partition they belong to, sorted as the writer needs them.

    A message keeps its ``partition`` if it has one, else its key decides, so a key's messages
    are on one partition in ``order``. A partition is cut into ranges by the order, so
    a busy one is written by several tasks.
    """
    by_key = F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
    chosen = F.coalesce(F.col("partition"), by_key) if "partition" in messages.columns else by_key
    rows = messages.withColumn("partition", chosen)
    keys = ["partition", *order]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("key", "value", "timestamp", "partition")


def publish(
    messages: DataFrame, path: str, partitions: int = 3, order: Sequence[str] = ("timestamp",),
    **options: str,
) -> None:
    """Append key, value, timestamp (and partition) as one batch: all of it or nothing.

    With the options ``writer`` and ``batch`` (a number that grows) a batch that is
    published again is not appended again.
    """
    register(messages.sparkSession)
    rows = dealt(messages, partitions, order)
    rows.write.format(FORMAT).mode("append").options(path=path, **options).save()


def publish_stream(
    messages: DataFrame, path: str, checkpoint: str, partitions: int = 3,
    order: Sequence[str] = ("timestamp",),
) -> DataStreamWriter:
    """Publish every tick of a stream once; a tick that is repeated is not published again.

    Ticks are known by the checkpoint, so give each stream its own.
    """
    def tick(batch: DataFrame, number: int) -> None:
        publish(batch, path, partitions, order, writer=checkpoint, batch=str(number))

    return messages.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)


def read_batch(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return register(spark).read.format(FORMAT).options(path=path, topic=topic).load()


def read_stream(spark: SparkSession, path: str, topic: str, max_per_tick: int | None = None) -> DataFrame:
    reader = register(spark).readStream.format(FORMAT).options(path=path, topic=topic)
    if max_per_tick is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_tick)
    return reader.load()


def ends(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """(topic, partition, end_offset) of a topic now: one row a partition."""
    found = [(topic, partition, end) for partition, end in sorted(TopicLog(path).ends().items())]
    return spark.createDataFrame(found, "topic string, partition int, end_offset bigint")
