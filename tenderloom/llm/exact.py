"""Exact deduplication as a stateful stream: one entry of keyed state per different text, kept for good.

``absorb`` reads the files of a table that have landed since its last call and folds them into state keyed by the digest of the normalised text
(A-Z lower-cased). An entry holds the stable identifier of the row that stays (the largest id; of rows that repeat it the last by content locator),
its content locator (file and row in the file), the number of rows and the text's length. There is no watermark, so no entry expires; the state lies in
RocksDB on the executors' disks, with its versions in the shared folder, so it is bounded by disk and outlives executors. Copies are folded before the
shuffle. ``decide`` then gives every row its entry. A digest that was met more than once is a hit: the text at the entry's locator is fetched and compared
byte by byte with the row's own. Rows that differ in spite of equal digests are regrouped by their whole texts.

A digest with more than 1/``SHARES`` of all rows or bytes is hot. There can't be more than 2 * ``SHARES`` of those, so they are broadcast, and the rows of
each are dealt over lanes that hold no more than such a share each, whichever share of the table the digest has.

All of it is column functions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.llm.common import stored

SHARES = 256
#: Files of about so many bytes are folded in one batch; between batches the state is committed.
BATCH_BYTES = 256 << 30
_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
          "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
          # no space is set aside for stores that stay small; a batch commits what it changed, not whole stores
          "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
          "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def normalised(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null counts as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), upper, upper.lower())


def sha256(text: Column) -> Column:
    return F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b""))      # never null, which the planner can't see by itself


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _located(rows: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text (normalised), digest and content locator of each row of a file-based table."""
    text = normalised(F.col(text_col))
    return rows.select(F.col(id_col).alias("doc_id"), text.alias("text"), digest(text).alias("digest"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def absorb(spark: SparkSession, path: str, root: str, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES) -> None:
    """Folds the Parquet files at ``path`` that weren't read before into the state below ``root``; a repeated or broken off call goes on where the
    last batch was committed. Entries that a batch touched are written to its own folder, by overwrite, so a repeated batch leaves one copy."""
    schema = spark.read.parquet(path).schema
    # as a pattern the path may be one file or a folder; a plain one must be a folder
    place = path.rstrip("/")
    files = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(f"{place[:-1]}[{place[-1]}]")
    rows = _located(files, id_col, text_col, digest)
    entries = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("top"), F.count("*").alias("n"),
                                         F.max(F.octet_length("text")).cast("long").alias("bytes"))

    def write(touched: DataFrame, batch: int) -> None:
        touched.write.mode("overwrite").parquet(f"{root}/entries/batch={batch}")

    with _settings(spark, _STATE):
        query = (entries.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()


def entries(spark: SparkSession, root: str) -> DataFrame:
    """The state as a table: digest, top (doc_id, file, row of the row that stays), n (rows), bytes. The last batch that touched an entry counts."""
    written = spark.read.parquet(f"{root}/entries")
    newest = F.max(F.struct("batch", "top", "n", "bytes")).alias("e")
    if written.agg(F.max("batch")).first()[0] in (None, 0):
        return written.drop("batch")
    return written.groupBy("digest").agg(newest).select("digest", "e.top", "e.n", "e.bytes")


def decide(spark: SparkSession, path: str, state: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Per row of the absorbed table: doc_id, digest, keep_id, group_size, kept."""
    rows = _located(spark.read.parquet(path), id_col, text_col, digest)
    state = stored(state.where("n > 1"), "hits")
    # rows and bytes of single texts don't matter: shares are of all hits, which makes lanes smaller still
    total = state.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("n") * F.col("bytes")), F.lit(0)).alias("bytes")).first()
    share = F.greatest(F.col("n") / max(total.n, 1), F.col("n") * F.col("bytes") / max(total.bytes, 1))
    state = state.withColumn("lanes", F.greatest(F.ceil(share * SHARES), F.lit(1)).cast("int"))
    hot = state.where("lanes > 1").select("digest", "lanes")      # at most SHARES by rows and SHARES by bytes
    lane = F.pmod(F.xxhash64("file", "row"), F.col("lanes").cast("long")).cast("int")
    dealt = rows.join(F.broadcast(hot), "digest", "left").withColumn("lane", F.coalesce(lane, F.lit(0))).drop("lanes")
    lanes = state.select("digest", "top", "n", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), "lanes")
    placed = dealt.join(lanes.hint("merge"), ["digest", "lane"], "left")
    at_locator = F.struct("doc_id", "file", "row").eqNullSafe(F.col("top"))
    fetched = placed.where(F.col("n").isNotNull() & at_locator).select(
        "digest", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), F.col("text").alias("kept_text"))
    checked = placed.join(fetched.hint("merge"), ["digest", "lane"], "left")
    same = F.col("n").isNull() | F.col("text").eqNullSafe(F.col("kept_text"))
    out = stored(checked.select("doc_id", "digest", "file", "row", F.coalesce("top.doc_id", "doc_id").alias("keep_id"), F.col("n").isNull().alias("single"),
                                F.coalesce("n", F.lit(1)).alias("group_size"), at_locator.alias("is_top"), same.alias("same")), "decided")
    told = out.select("doc_id", "digest", F.when(F.col("single"), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), "group_size",
                      (F.col("single") | F.col("is_top")).alias("kept"))
    mixed = stored(out.where("not same").select("digest").distinct(), "mixed")
    if mixed.isEmpty():
        return told
    apart = _regrouped(rows.join(mixed, "digest", "left_semi"))
    return told.join(mixed, "digest", "left_anti").unionByName(apart)


def _regrouped(rows: DataFrame) -> DataFrame:
    """Rows whose digests meet though their texts differ, grouped by the texts themselves."""
    me = F.struct("doc_id", "file", "row")
    groups = rows.groupBy("digest", "text").agg(F.max(me).alias("top"), F.count("*").alias("group_size"))
    return rows.join(groups, ["digest", "text"]).select("doc_id", "digest", F.col("top.doc_id").alias("keep_id"), "group_size",
                                                        me.eqNullSafe(F.col("top")).alias("kept"))


def deduplicate(spark: SparkSession, path: str, root: str, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per row of the Parquet table at ``path``: doc_id, digest (of the normalised text), keep_id (id of the row that stays), group_size, kept.

    Null and empty texts are equal to each other. Of rows that repeat both id and text one stays. Null ids sort before all others: such a row
    stays only in a group without any id. An empty table gives an empty one; other columns are not looked at.
    """
    absorb(spark, path, root, id_col, text_col, digest, batch_bytes)
    return decide(spark, path, entries(spark, root), id_col, text_col, digest)
