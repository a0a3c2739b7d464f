"""Zip archives of observation files (S4) as a Python data source.

The directory of each archive is read when the scan is planned; it says where every member lies. Members are then read by their offset, in
tasks of their own: no task and no row holds an archive, and an archive of many members is read by many tasks.
Small members that follow one another share a task.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gaugeworks.functions import text
from gaugeworks.sources.observations import raw_schema, tidy_fields

_LINES = "archive string, member string, line_no bigint, line string, error string"
_SCHEMA = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("error", pa.string())])
_LINES_PER_BATCH = 10_000
_READ = 1 << 20
TASK_BYTES = 16 << 20  # compressed bytes of small members that share a task
STORED, DEFLATED, ENCRYPTED = 0, 8, 1  # fixed values of the format
_UNREADABLE = (zipfile.BadZipFile, OSError, EOFError, NotImplementedError, RuntimeError, zlib.error, struct.error, pa.ArrowInvalid)


class Member(NamedTuple):
    """Where a member lies in its archive."""

    name: str
    offset: int
    size: int
    method: int
    flags: int
    crc: int


class Share(InputPartition):
    """Members of one archive that a task reads, or why the archive cannot be read."""

    def __init__(self, archive: str, members: list[Member], error: str | None = None) -> None:
        self.archive, self.members, self.error = archive, members, error


def _store(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def find_archives(path: str) -> list[str]:
    """Every zip file below a path, in order; paths without a scheme are local."""
    from pyarrow.fs import FileSelector, FileType

    store, base = _store(path)
    if store.get_file_info(base).type == FileType.File:
        return [path]
    found = store.get_file_info(FileSelector(base, recursive=True))
    below = [f.path[len(base):].strip("/") for f in found if f.type == FileType.File and f.path.endswith(".zip")]
    return [f"{path.rstrip('/')}/{name}" for name in sorted(below)]


def directory(archive: str) -> list[Member]:
    """The members of an archive in the order of their names, from its directory alone."""
    store, place = _store(archive)
    with store.open_input_file(place) as source, zipfile.ZipFile(source) as z:
        found = [Member(i.filename, i.header_offset, i.compress_size, i.compress_type, i.flag_bits, i.CRC) for i in z.infolist() if not i.is_dir()]
    return sorted(found)


def shares(archive: str, members: list[Member], task_bytes: int = TASK_BYTES) -> list[Share]:
    out: list[Share] = []
    for m in members:
        if out and sum(x.size for x in out[-1].members) + m.size <= task_bytes:
            out[-1].members.append(m)
        else:
            out.append(Share(archive, [m]))
    return out


def member_lines(source, member: Member) -> Iterator[bytes]:
    """Lines of a member without their ends, read from its offset; what it says of itself is checked at the end."""
    source.seek(member.offset)
    head = source.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile(f"no member at byte {member.offset}")
    if member.flags & ENCRYPTED or member.method not in (STORED, DEFLATED):
        raise NotImplementedError(f"{member.name}: encrypted, or method {member.method}")
    source.seek(member.offset + 30 + sum(struct.unpack("<HH", head[26:30])))
    expand = zlib.decompressobj(-15) if member.method == DEFLATED else None
    left, crc, rest = member.size, 0, b""
    while left:
        raw = source.read(min(left, _READ))
        if not raw:
            raise EOFError(f"{member.name} ends early")
        left -= len(raw)
        while raw:  # a little can expand to a lot, so it expands piece by piece
            part = expand.decompress(raw, _READ) if expand else raw
            raw = expand.unconsumed_tail if expand else b""
            crc = zlib.crc32(part, crc)
            *lines, rest = (rest + part).split(b"\n")
            yield from lines
    if expand:
        part = expand.flush()
        crc = zlib.crc32(part, crc)
        *lines, rest = (rest + part).split(b"\n")
        yield from lines
    if rest:
        yield rest
    if crc != member.crc:
        raise zipfile.BadZipFile(f"{member.name}: wrong checksum")


class MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.task_bytes = options["path"], int(options.get("taskBytes", TASK_BYTES))

    def _planned(self, archive: str) -> list[Share]:
        try:
            return shares(archive, directory(archive), self.task_bytes)
        except _UNREADABLE as exc:
            return [Share(archive, [], str(exc))]

    def partitions(self) -> list[Share]:
        with ThreadPoolExecutor(16) as pool:  # directories are a few kilobytes at the end of each archive
            return [share for found in pool.map(self._planned, find_archives(self.path)) for share in found] or [Share("", [])]

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        def batch(member: str, first: int, lines: list[str]) -> pa.RecordBatch:
            n = len(lines)
            same = [pa.repeat(pa.scalar(v, pa.string()), n) for v in (share.archive, member, None)]
            return pa.RecordBatch.from_arrays([*same[:2], pa.array(range(first, first + n), pa.int64()), pa.array(lines, pa.string()), same[2]], schema=_SCHEMA)

        def failed(member: str | None, why: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"archive": share.archive, "member": member, "line_no": None, "line": None, "error": why}], schema=_SCHEMA)

        if share.error is not None:
            yield failed(None, share.error)
        if share.members:
            store, place = _store(share.archive)
            with store.open_input_file(place) as source:
                for member in share.members:
                    lines, first = [], 0
                    try:
                        for line in member_lines(source, member):
                            lines.append(line.rstrip(b"\r\n").decode("latin-1"))
                            if len(lines) >= _LINES_PER_BATCH:
                                yield batch(member.name, first, lines)
                                first, lines = first + len(lines), []
                        if lines:
                            yield batch(member.name, first, lines)
                    except _UNREADABLE as exc:
                        if lines:
                            yield batch(member.name, first, lines)
                        yield failed(member.name, str(exc))


class ZipMembers(DataSource):
    """``spark.read.format("zip_members").load(path)``: the lines of all members of all zip files below a path.

    Bytes are ISO-8859-1 for the decoder; an unreadable archive or member gives one row with ``error``.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return _LINES

    def reader(self, schema) -> MemberReader:
        return MemberReader(self.options)


def scan_members(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Lines of every member of every archive below ``path``: ``archive``, ``member``, ``line_no``, ``line``, ``error``."""
    spark.dataSource.register(ZipMembers)
    return spark.read.format("zip_members").option("taskBytes", task_bytes).load(path)


def archive_audit(lines: DataFrame) -> DataFrame:
    """Archives read and failed."""
    per = lines.groupBy("archive").agg(
        F.count("line").alias("lines"), F.max("error").alias("error")
    )
    return per.select("archive", "lines", F.col("error").isNull().alias("ok"), "error")


def parse_lines(lines: DataFrame, fields: list[str], numbers: list[str]) -> DataFrame:
    """Split lines with the CSV rules of the file scan; blank lines are skipped. Only a line that begins with white space is looked at whole."""
    line = F.col("line")
    full = F.when(F.left(line, F.lit(1)).isin(list(text.WHITE)), F.length(text.strip_white(line)) > 0).otherwise(line != "")
    good = lines.filter(F.col("error").isNull() & full)
    options = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed = good.select(
        F.from_csv("line", raw_schema(fields), options).alias("r"),
        F.struct(F.col("archive"), F.col("member"), F.col("line_no").alias("pos")).alias("load_order"),
        F.concat_ws("!", "archive", "member").alias("file"),
    )
    return tidy_fields(parsed.select("r.*", "load_order", "file"), fields, numbers)


def member_rows(lines: DataFrame, glob: str, fields: list[str], numbers: list[str]) -> DataFrame:
    """Parsed rows of the members whose base name starts as the glob does; order by archive and member, then line."""
    prefix = glob.split("*")[0]
    base = F.element_at(F.split("member", "/"), -1)
    return parse_lines(lines.filter(F.col("error").isNull() & base.startswith(prefix)), fields, numbers)
