"""Entries of stored zip archives."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.operators.common import spread_nulls
from tenderloom.sources.batches import SLICE_BYTES, SLICE_ROWS, slices

MAX_DEPTH = 5
MAX_VALUE_BYTES = 1 << 30   # a larger entry comes in numbered parts
PART_BYTES = 1 << 26
_SCHEMA = pa.schema([("archive", pa.string()), ("entry_path", pa.string()), ("depth", pa.int32()), ("size", pa.int64()),
                     ("content", pa.binary()), ("is_valid", pa.bool_()), ("error", pa.string()), ("part", pa.int32()), ("content_md5", pa.string())])
_DDL = ("archive string, entry_path string, depth int, size long, content binary, is_valid boolean, error string, part int, "
        "content_md5 string")


def _parts(archive: zipfile.ZipFile, info: zipfile.ZipInfo, part_bytes: int) -> Iterator[bytes]:
    with archive.open(info) as stream:
        while part := stream.read(part_bytes):
            yield part


def _entries(data: bytes, prefix: str, depth: int, with_content: bool, value_bytes: int, part_bytes: int) -> Iterator[tuple]:
    """(path, depth, size, bytes, error, part, md5); inner archives are opened to the depth limit and not listed.

    A damaged entry ends its archive: entries before it count, inner archives stay closed. An entry in parts is read
    through once for its checksum before the first part is given out.
    """
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        yield None, depth, None, None, str(e), 0, None
        return
    with archive:
        inner = []
        for info in archive.infolist():
            path = prefix + info.filename
            if info.is_dir():
                continue
            if path.endswith(".zip"):
                inner.append((path, info))
            elif info.file_size > value_bytes:
                digest = hashlib.md5(usedforsecurity=False)
                try:
                    for part in _parts(archive, info, 1 << 20):
                        digest.update(part)
                except Exception as e:
                    yield None, depth, info.file_size, None, f"{path}: {e}", 0, None
                    return
                md5 = digest.hexdigest()
                for k, part in enumerate(_parts(archive, info, part_bytes) if with_content else [None]):
                    yield path, depth, info.file_size, part, None, k, md5
            else:
                try:
                    body = archive.read(info) if with_content else None
                    size = len(body) if with_content else sum(map(len, _parts(archive, info, 1 << 20)))
                except Exception as e:
                    yield None, depth, info.file_size, None, f"{path}: {e}", 0, None
                    return
                yield path, depth, size, body, None, 0, None
        if depth < MAX_DEPTH:
            for path, info in inner:
                try:
                    body = archive.read(info)
                except Exception as e:
                    yield None, depth, info.file_size, None, f"{path}: {e}", 0, None
                    return
                yield from _entries(body, path[:-4] + "/", depth + 1, with_content, value_bytes, part_bytes)


def _is_valid(data: bytes | None) -> bool:
    try:
        with zipfile.ZipFile(io.BytesIO(data or b"")) as archive:
            return archive.testzip() is None
    except Exception:
        return False


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(archive, content) of stored files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("archive"), "content")


def _rows(name: str | None, data: bytes, with_content: bool, value_bytes: int, part_bytes: int) -> Iterator[dict]:
    """Rows of one archive; one row without a path where it has no entries."""
    entries = _entries(data, "", 0, with_content, value_bytes, part_bytes)
    if with_content:
        valid = _is_valid(data)
    else:   # few bytes a row: held until the last checksum is known
        entries = list(entries)
        valid = not any(error is not None and depth == 0 for _, depth, _, _, error, _, _ in entries)
    bare = True
    for path, depth, size, body, error, part, md5 in entries:
        yield {"archive": name, "entry_path": path, "depth": depth, "size": size, "content": body, "is_valid": valid, "error": error,
               "part": part, "content_md5": md5}
        bare = False
    if bare:
        yield {"archive": name, "depth": 0, "is_valid": valid, "part": 0}


def _read(batches: Iterator[pa.RecordBatch], with_content: bool, value_bytes: int, part_bytes: int) -> Iterator[pa.RecordBatch]:
    """Entries of (archive, content), in batches of bounded rows and bytes."""
    held, weight = [], 0
    for piece in slices(batches, 1):
        for name, data in zip(*piece.columns):
            for row in _rows(name.as_py(), data.as_py() or b"", with_content, value_bytes, part_bytes):
                held.append(row)
                weight += len(row.get("content") or b"")
                if weight > SLICE_BYTES or len(held) == SLICE_ROWS:
                    yield pa.RecordBatch.from_pylist(held, _SCHEMA)
                    held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _SCHEMA)


def expand(archives: DataFrame, with_content: bool = True, value_bytes: int = MAX_VALUE_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per entry of ``archives(archive, content)``; a corrupt archive gives one row with an error.

    ``is_valid`` says whether every checksum of the outer archive is right. With content, an entry above ``value_bytes`` gives
    a row for each ``part_bytes`` of it, numbered from 0 in ``part``; ``size`` and ``content_md5`` of such rows are those of the
    whole entry. All other rows have part 0 and no ``content_md5``.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _read(batches, with_content, value_bytes, part_bytes)
    return archives.select("archive", "content").mapInArrow(read, _DDL)


def listed(archives: DataFrame) -> DataFrame:
    """Entries without their bytes, of archives by value (archive, content) or of files (archive, length)."""
    if "content" in archives.columns:
        return expand(archives, with_content=False)
    from tenderloom.sources.archive_files import scan
    return scan(archives.select("archive", "length").distinct())


def stored_files(downloads: DataFrame) -> DataFrame:
    """(url, path, is_valid) of stored archives, by value (url, archive, content) or as files (url, archive, length): what the
    download stage chooses from."""
    checked = listed(downloads).groupBy("archive").agg(F.bool_and("is_valid").alias("is_valid"))
    return downloads.select("url", "archive").join(checked, "archive").select("url", F.col("archive").alias("path"), "is_valid")


_DOCUMENT = r"\.(pdf|PDF)\z"


def select_documents(entries: DataFrame) -> DataFrame:
    """PDF entries; lower-case endings come before upper-case ones, then by path."""
    docs = entries.filter(F.col("entry_path").rlike(_DOCUMENT))
    return docs.withColumn("is_upper", F.col("entry_path").endswith(".PDF"))


def archive_outcomes(queue: DataFrame, entries: DataFrame) -> DataFrame:
    """Failed results for queued tenders whose archive is missing or holds no document.

    ``entries`` carries ``archive`` as stored in ``zip_path``; they are read once, since reading may mean unpacking.
    """
    is_document = F.coalesce(F.col("entry_path").rlike(_DOCUMENT), F.lit(False))
    seen = entries.groupBy(F.col("archive").alias("zip_path")).agg(F.bool_or(is_document).alias("has_document"))
    path = spread_nulls(F.col("zip_path"), F.col("id"))
    joined = queue.withColumn("zip_path", path).join(seen, "zip_path", "left")
    failed = joined.filter("has_document IS NULL OR NOT has_document")
    return failed.select(
        F.lit("analyze").alias("stage"), F.col("id").alias("tender_id"), F.lit(0).cast("long").alias("seq"),
        F.lit(False).alias("ok"),
        F.when(F.col("has_document").isNotNull(), S.ERROR_NO_PDF).otherwise(S.ERROR_NO_ARCHIVE).alias("error"),
        F.lit(None).cast("string").alias("next_status"))
