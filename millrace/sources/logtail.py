"""A Spark data source for delimited logs that still grow.

``spark.read`` scans the files as they are; ``spark.readStream`` gives the existing lines and then each line that is
appended later. The position of a stream is the byte after the last complete line of every file, together with
fingerprints of the file's beginning and of the bytes just before the position; Spark keeps them in the checkpoint. A
file that changed is compared with both. So a log that was renamed is read on under its new name, and one that was
replaced by other content is noticed, also if both begin with the same lines. Folders are read with all their sub-folders. Files are
read in byte ranges on the executors through Arrow's file systems, so the path may name a local, HDFS or object-store
folder.
"""

from __future__ import annotations

import decimal
import hashlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition

FORMAT = "delimited_log"
RANGE_BYTES = 128 << 20  # one task, unless the option range_bytes says otherwise
BLOCK_BYTES = 1 << 20  # read and decoded at a time
PROBE_BYTES = 64 << 10
HEAD_BYTES = 1024  # at its beginning that a file is known by
TAIL_BYTES = 4096  # before the position that a file is known by
OPENED_AT_ONCE = 16  # files that the driver looks into


@dataclass
class ByteRange(InputPartition):
    """Lines that begin in ``[start, stop)``; the last one may end anywhere before ``limit``."""

    path: str
    start: int
    stop: int
    limit: int


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _files(path: str) -> dict[str, tuple[int, int]]:
    """Size and time of change of the file, or of every file below the folder that is not hidden."""
    system, root = _open(path)
    info = system.get_file_info(root)
    if info.type == pafs.FileType.File:
        return {info.path: (info.size, info.mtime_ns or 0)}
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(pafs.FileSelector(root, recursive=True))

    def hidden(inner: str) -> bool:
        return any(name[:1] in "._" for name in inner[len(info.path) :].strip("/").split("/"))

    return {f.path: (f.size, f.mtime_ns or 0) for f in found if f.type == pafs.FileType.File and not hidden(f.path)}


def _print(system: pafs.FileSystem, path: str, begin: int, length: int) -> str:
    """Fingerprint of ``length`` bytes; a file that ends before them has another one."""
    with system.open_input_file(path) as handle:
        if handle.size() < begin + length:
            return "short"
        return hashlib.sha1(handle.read_at(length, begin) if length else b"").hexdigest()


@dataclass(frozen=True)
class Place:
    """How far a file has been read, its size then, what it begins with, and what stands before the position."""

    position: int
    size: int
    length: int
    head: str
    before: int = 0
    tail: str = ""

    @staticmethod
    def at(system: pafs.FileSystem, path: str, position: int, size: int) -> Place:
        length, before = min(HEAD_BYTES, position), min(TAIL_BYTES, position)
        return Place(position, size, length, _print(system, path, 0, length), before, _print(system, path, position - before, before))

    def of(self, system: pafs.FileSystem, path: str) -> bool:
        """Whether a file is the one that was read."""
        if not self.length or _print(system, path, 0, self.length) != self.head:
            return False
        return not self.before or _print(system, path, self.position - self.before, self.before) == self.tail

    def as_list(self) -> list:
        return [self.position, self.size, self.length, self.head, self.before, self.tail]


NEW = Place(0, 0, 0, hashlib.sha1(b"").hexdigest())


def _at_once(function: Callable, items: list) -> list:
    with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
        return list(pool.map(function, items))


def _after_last_newline(system: pafs.FileSystem, path: str, start: int, size: int) -> int:
    """The byte after the last newline in ``[start, size)``, or ``start``."""
    with system.open_input_file(path) as handle:
        end = size
        while end > start:
            begin = max(start, end - PROBE_BYTES)
            found = handle.read_at(end - begin, begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return start


def _ranges(path: str, start: int, limit: int, size: int) -> list[ByteRange]:
    return [ByteRange(path, at, min(at + size, limit), limit) for at in range(start, limit, size)]


def _lines(root: str, part: ByteRange) -> Iterator[pa.Array]:
    """Lines of a range, one Arrow array per block; a line belongs to the range with its first byte."""
    if part.start >= part.limit:
        return
    system, _ = _open(root)
    with system.open_input_file(part.path) as handle:
        at = part.start
        # a range that begins inside a line leaves that line to the range before it
        skipping = at > 0 and handle.read_at(1, at - 1) != b"\n"
        line_start, rest = at, []  # pieces of a line that goes on in the next block
        while at < part.limit:
            block = handle.read_at(min(BLOCK_BYTES, part.limit - at), at)
            if not block:
                break
            at += len(block)
            if skipping:
                found = block.find(b"\n")
                if found < 0:
                    continue
                block, skipping = block[found + 1 :], False
                line_start = at - len(block)
            if line_start >= part.stop:
                return
            lines = block.split(b"\n")
            if len(lines) > 1 and rest:
                lines[0], rest = b"".join([*rest, lines[0]]), []
            if last := lines.pop():
                rest.append(last)
            kept = []
            for line in lines:
                if line_start >= part.stop:
                    break
                kept.append(line)
                line_start += len(line) + 1
            if kept:
                yield _texts(kept)
        if rest and not skipping and line_start < part.stop:
            # the last line of the file, without a newline
            yield _texts([b"".join(rest)])


def _texts(lines: list[bytes]) -> pa.Array:
    return pc.utf8_rtrim(pa.array(lines, pa.binary()).cast(pa.string()), "\r")


def _typed(text: pa.Array, kind: T.DataType) -> pa.Array:
    """One decoded field for a batch; empty is NULL and bad text raises."""
    value = pc.if_else(pc.equal(text, ""), pa.scalar(None, pa.string()), text)
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.ShortType):
        return value.cast(pa.int16())
    if isinstance(kind, T.IntegerType):
        return value.cast(pa.int32())
    if isinstance(kind, T.LongType):
        return value.cast(pa.int64())
    if isinstance(kind, T.DateType):
        return value.cast(pa.int32()).cast(pa.date32())
    if isinstance(kind, T.TimestampNTZType):
        return value.cast(pa.timestamp("us"))
    if isinstance(kind, T.DecimalType):
        exact = value.cast(pa.decimal256(76, 38))
        rounded = pc.round(exact, ndigits=kind.scale, round_mode="half_towards_infinity")
        digits = kind.precision - kind.scale
        if digits < 38:
            fits = pc.less(pc.abs(rounded), pa.scalar(decimal.Decimal(10) ** digits, rounded.type))
            rounded = pc.if_else(fits, rounded, pa.scalar(None, rounded.type))
        return rounded.cast(pa.decimal128(kind.precision, kind.scale))
    raise ValueError(f"unsupported data type: {kind.simpleString()}")


def _decode(lines: pa.Array, schema: T.StructType, separator: str, filters: dict[int, list], fail: bool) -> pa.RecordBatch:
    """Typed columns of a batch of lines; equality filters are applied before the other columns are decoded."""
    fields = pc.split_pattern(lines, separator)
    good = pc.equal(pc.list_value_length(fields), len(schema.fields))
    if fail and not pc.all(good, min_count=0).as_py():
        raise ValueError(f"wrong number of fields: {lines.filter(pc.invert(good))[0].as_py()}")
    fields = fields.filter(good)
    for index, values in filters.items():
        column = _typed(pc.list_element(fields, index), schema.fields[index].dataType)
        for value in values:
            match = pc.fill_null(pc.equal(column, pa.scalar(value, column.type)), False)
            fields, column = fields.filter(match), column.filter(match)
    columns = [_typed(pc.list_element(fields, i), f.dataType) for i, f in enumerate(schema.fields)]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


class _Decoder:
    """What a reader needs on the executors."""

    def __init__(self, schema: T.StructType, options: dict):
        if "path" not in options:
            raise ValueError("the option path is required")
        self.schema = schema
        self.root = options["path"]
        self.separator = options.get("separator", ",")
        self.fail = options.get("on_malformed", "drop") == "fail"
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.filters: dict[int, list] = {}

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        for lines in _lines(self.root, partition):
            yield _decode(lines, self.schema, self.separator, self.filters, self.fail)


class LogReader(_Decoder, DataSourceReader):
    """Bounded scan up to the current size of the files."""

    def pushFilters(self, filters):
        """Take equality on string and integer columns; Spark evaluates the others."""
        for item in filters:
            if isinstance(item, EqualTo) and len(item.attribute) == 1 and item.attribute[0] in self.schema.names:
                index = self.schema.names.index(item.attribute[0])
                if isinstance(self.schema.fields[index].dataType, (T.StringType, T.IntegerType)):
                    self.filters.setdefault(index, []).append(item.value)
                    continue
            yield item

    def partitions(self) -> list[ByteRange]:
        parts = [part for path, (size, _) in sorted(_files(self.root).items()) for part in _ranges(path, 0, size, self.range_bytes)]
        return parts or [ByteRange("", 0, 0, 0)]  # Spark asks for one part at least


class LogStreamReader(_Decoder, DataSourceStreamReader):
    """Existing lines, then every complete line that is appended."""

    def __init__(self, schema: T.StructType, options: dict):
        super().__init__(schema, options)
        self.rotation = options.get("on_rotation", "fail")
        if self.rotation not in ("fail", "restart"):
            raise ValueError("on_rotation must be fail or restart")
        self.stats: dict[str, tuple[int, int]] = {}
        self.known: dict[str, Place] = {}

    def initialOffset(self) -> dict:
        return {}

    def _lost(self, path: str, place: Place) -> None:
        """A file that was read is not there any more, under no name."""
        if self.rotation == "fail" and place.size > place.position:
            raise ValueError(f"{path} is gone, and lines at its end were not complete when it was read")

    def _replaced(self, path: str) -> Place:
        if self.rotation == "fail":
            raise ValueError(
                f"{path} holds other content or became shorter: a log that is read as a stream may only grow, "
                "unless on_rotation=restart reads it anew"
            )
        return NEW

    def _matched(self, system: pafs.FileSystem, before: dict[str, Place], paths: list[str]) -> dict[str, Place]:
        """Where each file was read up to: by its name if it begins as it did, else by its beginning under a former name."""
        same = _at_once(lambda path: path not in before or before[path].length == 0 or before[path].of(system, path), paths)
        found = {path: before[path] for path, good in zip(paths, same) if good and path in before}
        others = {path: place for path, place in before.items() if path not in found}
        for path in paths:
            if path not in found:
                former = next((name for name, place in others.items() if name != path and place.of(system, path)), None)
                if former is not None:
                    found[path] = others.pop(former)
        for path in paths:
            if path not in found:
                found[path] = self._replaced(path) if path in others else NEW
        for path, place in others.items():
            if path not in paths:
                self._lost(path, place)
        return found

    def latestOffset(self) -> dict:
        system, _ = _open(self.root)
        stats = _files(self.root)
        changed = [path for path in sorted(stats) if self.stats.get(path) != stats[path]]
        gone = [path for path in self.known if path not in stats]
        if changed or gone:
            moving = {path: self.known[path] for path in [*changed, *gone] if path in self.known}
            before = self._matched(system, moving, changed)

            def look(path: str) -> Place:
                place, size = before[path], stats[path][0]
                if size < place.position:
                    place = self._replaced(path)
                position = _after_last_newline(system, path, place.position, size)
                return Place.at(system, path, position, size)

            found = dict(zip(changed, _at_once(look, changed)))
            self.known = {path: found.get(path) or self.known[path] for path in stats}
            self.stats = stats
        return {path: place.as_list() for path, place in sorted(self.known.items())}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        system, _ = _open(self.root)
        stats = _files(self.root)
        before = {path: Place(*place) for path, place in start.items()}
        after = {path: Place(*place) for path, place in end.items()}
        moved = sorted(path for path in after if before.get(path) != after[path])
        moving = {path: place for path, place in before.items() if after.get(path) != place}
        begins = self._matched(system, moving, moved)
        parts = []
        for path in moved:
            begin, limit = begins[path].position, after[path].position
            if stats.get(path, (0, 0))[0] < limit or (after[path].length and not after[path].of(system, path)):
                raise ValueError(f"{path} was replaced or became shorter while it was read")
            parts.extend(_ranges(path, min(begin, limit), limit, self.range_bytes))
        return parts

    def commit(self, end: dict) -> None:
        pass


class DelimitedLog(DataSource):
    """Options: ``path`` (required), ``separator`` (``,``), ``on_malformed`` (``drop`` or ``fail``), ``range_bytes``, and for
    streams ``on_rotation``: ``fail`` if a log that was read holds other content, or ``restart`` it from its beginning.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("declare the schema of the log")

    def reader(self, schema: T.StructType) -> LogReader:
        return LogReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> LogStreamReader:
        return LogStreamReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Make the format known and let equality filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DelimitedLog)


def read_log(spark: SparkSession, path: str, schema: str | T.StructType, mode: str = "batch", **options: str) -> DataFrame:
    """Scan (``mode='batch'``) or tail (``mode='stream'``) a log."""
    if mode not in ("batch", "stream"):
        raise ValueError("mode must be batch or stream")
    register(spark)
    reader = spark.read if mode == "batch" else spark.readStream
    return reader.format(FORMAT).schema(schema).options(**options).load(path)
