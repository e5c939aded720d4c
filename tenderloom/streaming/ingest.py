"""Incremental runs: each cycle is an ``availableNow`` query over what has landed since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.functions.keys import tender_key
from tenderloom.operators import history, minutes, outcomes, upsert
from tenderloom.operators.common import spread_nulls
from tenderloom.session import broadcast_if_small, cut_lineage
from tenderloom.streaming import state

LOGGED = ["status", "estimation"]
HASHES = ["tender_hash", "hash_content", "hash_dce", "detail_hash"]
SEEDS = ["id", "url_id", "reference", "hash_content"]     # of the stored rows, what a batch is held against


def landing(spark, path: str, schema) -> DataFrame:
    """Stream over a landing folder of Parquet files."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def run_available(source: DataFrame, step: Callable[[DataFrame, int], None], root: str, name: str) -> int:
    """Work off everything that has landed, then stop. Returns the number of batches done so far."""
    query = (source.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/{name}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    # what is committed counts: a run that finds nothing new names the batch it would have done
    commits = source.sparkSession.read.format("binaryFile").load(f"{root}/{name}/checkpoint/commits")
    last = commits.agg(F.max(F.regexp_extract("path", r"/(\d+)\z", 1).try_cast("long"))).first()[0]
    return 0 if last is None else last + 1


def held_by_key(stored: DataFrame, path: str, n: int) -> tuple[DataFrame, state.Buckets | None]:
    """The stored tenders written in ``n`` buckets by their key; without a key and buckets where an id stands for several keys."""
    key = tender_key(F.col("url_id"), F.col("reference"))
    tags = stored.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64(key)).alias("a"), F.max(F.xxhash64(key)).alias("b"))
    found = tags.agg(F.max("n").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("several")).first()
    if found.several:
        return cut_lineage(stored, "stored"), None
    buckets = state.Buckets(n, repeats=(found.n or 0) > 1)
    hashes = [c for c in stored.columns if c in HASHES]
    return state.write_buckets(upsert.dealt_by(stored, spread_nulls(key, F.col("id")), n, hashes), path, buckets), buckets


def listing_step(root: str, initial: DataFrame, as_of: Column, buckets: state.Buckets | None = None) -> Callable[[DataFrame, int], None]:
    """Upsert a listing batch; write the changed tenders, the effects (hence the counters) and the change log.

    The effects are written once and read back, so the batch is worked off a single time. When they
    are few, the stored table is scanned but neither shuffled nor rewritten. With ``buckets`` (see :func:`held_by_key`) a batch's rows are
    moved to the state's buckets once and the state is never moved.
    """
    def step(batch: DataFrame, n: int) -> None:
        stored = lambda columns=None: state.read(batch.sparkSession, root, "tenders", n - 1, initial, columns, buckets)
        layers = lambda columns=None: state.layers(batch.sparkSession, root, "tenders", n - 1, initial, buckets, columns) if buckets else None
        effects = state.put(upsert.upsert_effects(stored(SEEDS), batch, layers(SEEDS), buckets.n if buckets else 0), root, "effects", n, buckets)
        rows = state.write(upsert.changed_rows(stored(), effects, as_of, layers()), root, "tenders", n, initial, buckets)
        # a new row is none of the stored ones and in no event
        hit = effects.filter(~F.col("is_new"))
        if buckets:
            old = upsert.looked_up(hit.select("key", "id", "is_new"), layers(["id", *LOGGED])).filter("s.id IS NOT NULL")
            old = old.select("key", *[f"s.{c}" for c in ("id", *LOGGED)])
        else:
            old = stored(["id", *LOGGED]).join(broadcast_if_small(hit.select("id")), "id", "left_semi")
        state.put(history.change_log(old, rows, LOGGED, as_of, within="key" if buckets else None), root, "log", n)
    return step


def minutes_step(root: str, initial: DataFrame, as_of: Column) -> Callable[[DataFrame, int], None]:
    """Store new minutes; the stored hashes are the state that keeps repeats out across runs."""
    def step(batch: DataFrame, n: int) -> None:
        stored = state.read(batch.sparkSession, root, "pvs", n - 1, initial)
        state.write(minutes.saved_rows(stored, batch, as_of), root, "pvs", n, initial)
    return step


def stage_step(root: str, initial: DataFrame, as_of: Column | None = None,
               keep_previous_error: bool = True) -> Callable[[DataFrame, int], None]:
    """Apply stage results to the tenders and write the run's metrics."""
    def step(batch: DataFrame, n: int) -> None:
        stored = state.read(batch.sparkSession, root, "tenders", n - 1, initial)
        rows = outcomes.apply_outcomes(stored, batch, as_of, keep_previous_error, touched_only=True)
        state.write(rows, root, "tenders", n, initial)
        state.put(outcomes.run_metrics(batch), root, "metrics", n)
    return step


def change_log(spark, root: str) -> DataFrame:
    """All change events so far, one partition per batch; a repeated batch replaces its own."""
    return spark.read.parquet(f"{root}/log")


def unseen_files(stream: DataFrame, time_column: str, delay: str) -> DataFrame:
    """Minutes with a file hash, each hash once within the watermark. Optional first filter; the stored
    hashes stay the judge across longer spans."""
    rows = minutes.with_address(stream.withColumn("pv_pdf_url", F.col("pdf_url"))).drop("pv_pdf_url")
    timed = rows.withColumn(time_column, F.col(time_column).cast("timestamp"))
    return timed.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["hash_pdf"])
