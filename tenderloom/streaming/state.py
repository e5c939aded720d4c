"""State of a foreachBatch stream: a table as a base and the rows each batch changed.

Batch ``n`` reads the state after ``n-1`` and overwrites what it wrote itself under ``v=n``, so running a batch
again after a lost executor or driver gives the same state again. A batch writes changed rows only; every
``COMPACT_EVERY`` batches the state is written whole, so few change sets are ever laid over a base.

A state may be held by key: its files are then dealt into so many buckets by the column ``key``, which a row of an id never
changes, and joins on the key move none of it. A state keeps the number of buckets it began with.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPACT_EVERY = 16
MOST_LAYERS = 4      # so many change sets are laid over a base bucket by bucket; more are moved by id


class Buckets(NamedTuple):
    """How a state is held by key."""
    n: int
    repeats: bool = True     # whether the first table may have an id twice


def _path(root: str, table: str, kind: str, version: int) -> str:
    return f"{root}/{table}/{kind}/v={version}"


def overlay(base: DataFrame, changes: DataFrame) -> DataFrame:
    """The base with changed rows (one per id) in place of its own, and new rows added."""
    return base.join(changes.select("id"), "id", "left_anti").unionByName(changes)


def write_buckets(df: DataFrame, path: str, buckets: Buckets) -> DataFrame:
    """Write the rows in buckets by ``key`` in place of what lies there, and read them back. The catalog holds the files' name no longer than that."""
    spark, name = df.sparkSession, f"tenderloom_{uuid.uuid4().hex}"
    (df.write.mode("overwrite").format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets.n, "key")
     .saveAsTable(name))
    return _once(spark, name)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets) -> DataFrame:
    name, place = f"tenderloom_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`key`) INTO {buckets.n} BUCKETS LOCATION '{place}'")
    return _once(spark, name)


def _once(spark: SparkSession, name: str) -> DataFrame:
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def layers(spark: SparkSession, root: str, table: str, version: int, initial: DataFrame, buckets: Buckets,
           columns: list[str] | None = None) -> list[DataFrame]:
    """Base and change sets after batch ``version`` of a state that is held by key, the oldest first. A change set has a row of an id once."""
    base_version = (version + 1) // COMPACT_EVERY * COMPACT_EVERY - 1
    there = lambda kind, v: read_buckets(spark, _path(root, table, kind, v), initial.schema, buckets)
    wanted = list(dict.fromkeys([*(columns or initial.columns), "id", "key"]))
    base = (initial if base_version < 0 else there("base", base_version)).select(*wanted)
    changes = [there("changes", v).select(*wanted) for v in range(base_version + 1, version + 1)]
    return [base, *[c.dropDuplicates(["key", "id"]) if buckets.repeats else c for c in changes]]


def _laid_over(found: list[DataFrame], columns: list[str]) -> DataFrame:
    """The layers as one table: of each the rows that no later one has."""
    rows = []
    for i, layer in enumerate(found):
        for later in found[i + 1:]:
            there = later.select(F.col("key").alias("_key"), F.col("id").alias("_id"))
            layer = layer.join(there, (F.col("key") == F.col("_key")) & F.col("id").between(F.col("_id"), F.col("_id")), "left_anti")
        rows.append(layer.select(*columns))
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def read(spark: SparkSession, root: str, table: str, version: int, initial: DataFrame, columns: list[str] | None = None,
         buckets: Buckets | None = None) -> DataFrame:
    """State after batch ``version``; before the first batch it is ``initial``.

    With ``columns`` (``id`` among them) only these are read: the newest change of an id is found among whole rows, which no
    later choice of columns makes narrower. With ``buckets`` the state is held by key and read bucket by bucket.
    """
    if buckets and (version + 1) % COMPACT_EVERY <= MOST_LAYERS:
        return _laid_over(layers(spark, root, table, version, initial, buckets, columns), columns or initial.columns)
    if columns is not None:
        initial = initial.select(*columns)
    base_version = (version + 1) // COMPACT_EVERY * COMPACT_EVERY - 1
    base = initial if base_version < 0 else spark.read.schema(initial.schema).parquet(_path(root, table, "base", base_version))
    paths = [_path(root, table, "changes", v) for v in range(base_version + 1, version + 1)]
    if not paths:
        return base
    changes = (spark.read.schema(T.StructType([*initial.schema.fields, T.StructField("v", T.IntegerType())]))
               .option("basePath", f"{root}/{table}/changes").parquet(*paths))
    last = changes.groupBy("id").agg(F.max_by(F.struct(*initial.columns), "v").alias("r")).select("r.*")
    return overlay(base, last)


def write(changes: DataFrame, root: str, table: str, version: int, initial: DataFrame, buckets: Buckets | None = None) -> DataFrame:
    """Write a batch's changed rows (and the whole state when it is time); returns the rows as written."""
    rows = put(changes.select(*initial.columns), root, f"{table}/changes", version, buckets)
    if (version + 1) % COMPACT_EVERY == 0:
        spark = changes.sparkSession
        before = read(spark, root, table, version - 1, initial)
        if buckets:
            write_buckets(overlay(before, rows).repartition(buckets.n, "key"), _path(root, table, "base", version), buckets)
            return rows
        overlay(before, rows).write.mode("overwrite").option("compression", "zstd").parquet(
            _path(root, table, "base", version))
    return rows


def put(df: DataFrame, root: str, table: str, version: int, buckets: Buckets | None = None) -> DataFrame:
    """Write one batch's rows under its version (in buckets by key, where they have one) and read them back."""
    path = f"{root}/{table}/v={version}"
    if buckets:
        return write_buckets(df, path, buckets)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest(spark: SparkSession, root: str, table: str, initial: DataFrame, versions: int, buckets: Buckets | None = None) -> DataFrame:
    """State after ``versions`` batches."""
    return read(spark, root, table, versions - 1, initial, buckets=buckets)
