"""Reading the given Parquet tables and stored keyed tables (Parquet, ORC, CSV, JSON)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_FORMATS = ("parquet", "orc", "csv", "json")
_CSV_NULL = r"\N"   # an empty text stays an empty text


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the input has fewer files than cores.

    Only file names are looked at. A table of many files is left as it is, so no large table is shuffled;
    a small one is not worked off by a single task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def keyed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Scan of a stored table with its declared schema; nothing is inferred."""
    if fmt not in _FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {_FORMATS}")
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(header="true", multiLine="true", escape='"', nullValue=_CSV_NULL)
    return reader.load(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything lies at ``path``, in whichever store."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append; a CSV target gets its header from the column names, as a new table would."""
    _write(df, path, fmt, "append")


def put(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write in place of whatever lies at ``path``."""
    _write(df, path, fmt, "overwrite")


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(header="true", escape='"', nullValue=_CSV_NULL)
    writer.save(path)
