"""Stored zip archives read by ranges of entries; no archive is ever one value, so it may have any size.

The first step reads each archive's own directory and cuts its entries into ranges of bounded packed bytes. The
ranges of one archive then go to different tasks, which open the file at the entries' places.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.session import cut_lineage
from tenderloom.sources.archives import MAX_DEPTH, MAX_VALUE_BYTES, PART_BYTES
from tenderloom.sources.batches import SLICE_BYTES, SLICE_ROWS, give_back, slices

RANGE_BYTES = 1 << 26    # packed bytes of the entries that one task step reads
HELD_BYTES = 1 << 26     # an inner archive up to this size is held; a larger one is read on its stream
TAIL_BYTES = 1 << 20     # kept of the end of such a stream
DIRECTORY_BYTES = 128    # what an entry adds to a range by being listed
MAX_TASKS = 50_000

_RANGES = pa.schema([("archive", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("error", pa.string())])
_LISTED = pa.schema([("archive", pa.string()), ("entry_path", pa.string()), ("depth", pa.int32()), ("size", pa.int64()),
                     ("content_md5", pa.string()), ("error", pa.string()), ("trail", pa.list_(pa.int64())), ("step", pa.int64())])
_READ = pa.schema([("archive", pa.string()), ("entry_path", pa.string()), ("part", pa.int32()), ("content", pa.binary())])
_INNER = 1 << 40         # steps of inner archives come after those of all plain entries


class _Places(io.RawIOBase):
    """A file of known size whose places are only moved to when they are read.

    Places before its start are refused as files do, which readers of directories rely on. The last ``tail`` bytes are kept
    once read: going to and fro in a directory then doesn't start a stream anew.
    """

    def __init__(self, file, size: int, tail: int = 0):
        self._file, self._size, self._at, self._tail_from, self._tail = file, size, 0, size - min(tail, size), None

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + (0 if whence == io.SEEK_SET else self._at if whence == io.SEEK_CUR else self._size)
        if place < 0:
            raise OSError("place before the start of the file")
        self._at = place
        return place

    def _fetch(self, place: int, length: int) -> bytes:
        if self._file.tell() != place:
            self._file.seek(place)
        return self._file.read(length)

    def readinto(self, buffer) -> int:
        length = min(len(buffer), self._size - self._at)
        if length <= 0:
            return 0
        if self._at >= self._tail_from:
            if self._tail is None:
                self._tail = self._fetch(self._tail_from, self._size - self._tail_from)
            data = self._tail[self._at - self._tail_from:][:length]
        else:
            data = self._fetch(self._at, min(length, self._tail_from - self._at))
        buffer[:len(data)] = data
        self._at += len(data)
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self._file.close()
        super().close()


def open_stored(path: str) -> BinaryIO:
    """A seekable file at a path or URI that Arrow knows (file, hdfs, s3, gs, abfs)."""
    from pyarrow import fs
    if path.startswith("s3a://"):
        path = "s3://" + path[6:]
    if path.startswith("file:"):
        system, name = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    elif path.startswith("/"):
        system, name = fs.LocalFileSystem(), path
    else:
        system, name = fs.FileSystem.from_uri(path)
    file = system.open_input_file(name)
    return io.BufferedReader(_Places(file, file.size()), 1 << 20)


def archive_files(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(archive, length) of stored files; their bytes are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("archive"), "length")


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == SLICE_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
            give_back()
    yield pa.RecordBatch.from_pylist(held, schema)


def entry_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES, open_file: Callable[[str], BinaryIO] = open_stored) -> DataFrame:
    """(archive, first, last, error): entry numbers from ``first`` up to before ``last``, by the archive's directory alone.

    An archive without entries gives one empty range, a file that can't be opened as an archive one with its error.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    try:
                        with open_file(name) as file, zipfile.ZipFile(file) as archive:
                            sizes = [info.compress_size + DIRECTORY_BYTES for info in archive.infolist()]
                    except Exception as e:
                        yield {"archive": name, "first": 0, "last": 0, "error": str(e) or type(e).__name__}
                        continue
                    first, weight = 0, 0
                    for no, size in enumerate(sizes):
                        if weight and weight + size > range_bytes:
                            yield {"archive": name, "first": first, "last": no, "error": None}
                            first, weight = no, 0
                        weight += size
                    yield {"archive": name, "first": first, "last": len(sizes), "error": None}
        yield from _batches(rows(), _RANGES)
    return files.select("archive").mapInArrow(cut, "archive string, first long, last long, error string")


def _tasks(spark: SparkSession, total_bytes: int, range_bytes: int) -> int:
    return min(MAX_TASKS, max(spark.sparkContext.defaultParallelism, -(-total_bytes // range_bytes)))


def _checked(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> tuple[int, str]:
    """Size and md5 of an entry in one pass; raises where its checksum is wrong."""
    digest, size = hashlib.md5(usedforsecurity=False), 0
    with archive.open(info) as stream:
        while part := stream.read(1 << 20):
            digest.update(part)
            size += len(part)
    return size, digest.hexdigest()


def _inner(archive: zipfile.ZipFile, info: zipfile.ZipInfo, held_bytes: int) -> zipfile.ZipFile:
    stream = archive.open(info)
    if info.file_size <= held_bytes:
        with stream:
            return zipfile.ZipFile(io.BytesIO(stream.read()))
    # going back starts the stream anew: once after its directory, as its entries are read in their order
    return zipfile.ZipFile(io.BufferedReader(_Places(stream, info.file_size, min(TAIL_BYTES, held_bytes)), 1 << 16))


def _listed(archive: zipfile.ZipFile, numbers: range, prefix: str, trail: list[int], held_bytes: int) -> Iterator[dict]:
    """Rows of the numbered entries, then of the archives among them; a damaged entry ends the list."""
    infos, depth, inner = archive.infolist(), len(trail), []

    def row(no: int, **values) -> dict:
        return {"entry_path": None, "depth": depth, "size": None, "content_md5": None, "error": None, "trail": [*trail, no], **values}

    for no in numbers:
        info = infos[no]
        path = prefix + info.filename
        if info.is_dir():
            continue
        if path.endswith(".zip"):
            inner.append((no, info, path))
            continue
        try:
            size, md5 = _checked(archive, info)
        except Exception as e:
            yield row(no, size=info.file_size, error=f"{path}: {e}", step=no)
            return
        yield row(no, entry_path=path, size=size, content_md5=md5, step=no)
    for no, info, path in inner if depth < MAX_DEPTH else []:
        try:
            _checked(archive, info)
        except Exception as e:
            yield row(no, size=info.file_size, error=f"{path}: {e}", step=_INNER + no)
            return
        try:
            opened = _inner(archive, info, held_bytes)
        except Exception as e:
            yield row(no, depth=depth + 1, error=str(e), step=_INNER + no)
            continue
        with opened:
            for r in _listed(opened, range(len(opened.infolist())), path[:-4] + "/", [*trail, no], held_bytes):
                yield {**r, "step": _INNER + no}


def scan(files: DataFrame, range_bytes: int = RANGE_BYTES, held_bytes: int = HELD_BYTES,
         open_file: Callable[[str], BinaryIO] = open_stored) -> DataFrame:
    """One row per entry of the stored archives ``files(archive, length)``: (archive, entry_path, depth, size, content_md5, is_valid,
    error, trail), every entry unpacked once for its checksum and md5 together.

    Inner archives are opened to the depth limit and not listed themselves (their bytes are read once more for that, on their
    stream where they are above ``held_bytes``). ``trail`` holds the entry numbers that lead to the entry. A damaged entry ends
    its archive: entries before it count, then comes a row with the error, inner archives stay closed. An archive without
    entries, or one that can't be opened, gives one row without a path. ``is_valid`` says whether every checksum of the outer
    archive is right. The listed rows, which hold no bytes of entries, are written to the shared folder once. A task holds the
    directory of one archive.
    """
    spark = files.sparkSession
    total = files.agg(F.sum("length")).first()[0] or 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                give_back()
                for r in batch.to_pylist():
                    bare = {"archive": r["archive"], "entry_path": None, "depth": 0, "size": None, "content_md5": None,
                            "error": r["error"], "trail": None, "step": -1 if r["first"] == 0 else None}
                    if r["error"] is not None or r["first"] == r["last"]:
                        yield bare
                        continue
                    with open_file(r["archive"]) as file, zipfile.ZipFile(file) as archive:
                        empty = True
                        for entry in _listed(archive, range(r["first"], r["last"]), "", [], held_bytes):
                            yield {"archive": r["archive"], **entry}
                            empty = False
                    if empty and r["first"] == 0:
                        yield bare
        yield from _batches(rows(), _LISTED)

    ranges = entry_ranges(files.repartition(_tasks(spark, total, range_bytes), "archive"), range_bytes, open_file)
    spread = ranges.repartition(_tasks(spark, total, range_bytes), "archive", "first")
    listed = cut_lineage(spread.mapInArrow(read, "archive string, entry_path string, depth int, size long, content_md5 string, "
                                                 "error string, trail array<long>, step long"), "entries")
    ends = F.col("error").isNotNull() & (F.col("depth") == 0)
    ends_at = listed.groupBy("archive").agg(F.min(F.when(ends, F.col("step"))).alias("stop"),
                                            F.count_if(F.col("step") >= 0).alias("n_entries"))
    settled = listed.join(ends_at, "archive")
    counts = F.when((F.col("step") < 0) & F.col("error").isNull(), F.col("n_entries") == 0).otherwise(
        F.col("stop").isNull() | (F.col("step") <= F.col("stop")))
    return settled.filter(counts).select("archive", "entry_path", "depth", "size", "content_md5", F.col("stop").isNull().alias("is_valid"),
                                         "error", "trail")


def read_contents(entries: DataFrame, value_bytes: int = MAX_VALUE_BYTES, part_bytes: int = PART_BYTES, range_bytes: int = RANGE_BYTES,
                  held_bytes: int = HELD_BYTES, open_file: Callable[[str], BinaryIO] = open_stored) -> DataFrame:
    """Bytes of chosen rows of ``scan``: (archive, entry_path, part, content); nothing else of the archives is unpacked.

    An entry above ``value_bytes`` gives a row for each ``part_bytes`` of it, numbered from 0; all others have part 0 and are whole.
    """
    spark = entries.sparkSession
    chosen = entries.filter("entry_path IS NOT NULL").select("archive", "entry_path", "size", "trail")
    total = chosen.agg(F.sum("size")).first()[0] or 0
    spread = chosen.repartition(_tasks(spark, total, range_bytes), "archive", F.col("trail")[0]).sortWithinPartitions("archive", "trail")

    def reached(archive: zipfile.ZipFile, trail: list[int]) -> zipfile.ZipFile:
        for no in trail:
            archive = _inner(archive, archive.infolist()[no], held_bytes)
        return archive

    def bytes_of(archive: zipfile.ZipFile, no: int) -> Iterator[bytes]:
        info = archive.infolist()[no]
        with archive.open(info) as stream:
            if info.file_size <= value_bytes:
                yield stream.read()
            else:
                while part := stream.read(part_bytes):
                    yield part

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = file = archive = holder = at = None   # entries of one inner archive follow each other: it is opened once
        try:
            for piece in slices(batches, 1):
                held, weight = [], 0
                for r in piece.to_pylist():
                    if r["archive"] != name:
                        if file is not None:
                            file.close()
                        name, file = r["archive"], open_file(r["archive"])
                        archive = zipfile.ZipFile(file)
                        at = None
                    if r["trail"][:-1] != at:
                        at = r["trail"][:-1]
                        holder = reached(archive, at)
                    for k, body in enumerate(bytes_of(holder, r["trail"][-1])):
                        held.append({"archive": name, "entry_path": r["entry_path"], "part": k, "content": body})
                        weight += len(body)
                        if weight > SLICE_BYTES:
                            yield pa.RecordBatch.from_pylist(held, _READ)
                            held, weight = [], 0
                            give_back()
                yield pa.RecordBatch.from_pylist(held, _READ)
        finally:
            if file is not None:
                file.close()
    return spread.mapInArrow(read, "archive string, entry_path string, part int, content binary")


def store(entries: DataFrame, folder: str) -> DataFrame:
    """Write ``entries(entry_path, content)`` into archives below a shared folder, one a batch, from the tasks; (archive, length) of
    what was written. What a lost task left behind is in no row.
    """
    from pyarrow import fs

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid
        local = folder.startswith(("file:", "/"))
        system, root = (fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(folder)
        system.create_dir(root)
        for batch in batches:
            if not batch.num_rows:
                continue
            name = f"{uuid.uuid4().hex}.zip"
            with system.open_output_stream(f"{root}/{name}") as out:
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                    for path, content in zip(*batch.columns):
                        archive.writestr(path.as_py(), content.as_py() or b"")
            length = system.get_file_info(f"{root}/{name}").size
            yield pa.RecordBatch.from_pydict({"archive": [f"{folder.rstrip('/')}/{name}"], "length": [length]})
            give_back()
    return cut_lineage(entries.select("entry_path", "content").mapInArrow(write, "archive string, length long"), "stored")
