"""Incremental runs over the given tables: they land in three waves, each worked off by one run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.plans import catalog_tables as C
from tenderloom.plans.registry import ORACLE, query
from tenderloom.session import cut_lineage, scratch_path
from tenderloom.sources import bindings as B
from tenderloom.streaming import ingest, state


def in_waves(spark, rows: DataFrame, order: Column, cuts: tuple, name: str, step: Callable[[str], Callable]) -> tuple[str, int]:
    """Land the rows in waves of rising order and run the stream after each wave."""
    root = scratch_path(spark, name)
    lows, highs = (None, *cuts), (*cuts, None)
    done = 0
    for low, high in zip(lows, highs):
        wave = rows
        if low is not None:
            wave = wave.filter(order >= low)
        if high is not None:
            wave = wave.filter(order < high)
        wave.write.mode("append").option("compression", "zstd").parquet(f"{root}/landing")
        done = ingest.run_available(ingest.landing(spark, f"{root}/landing", rows.schema), step(root), root, name)
    return root, done


ROWS_PER_BUCKET = 1_000_000     # of the stored rows and all that will land, together


def _listing(spark, d):
    stored, rows = B.stored_tenders(spark, d), B.listing_batch(spark, d)
    buckets = max(spark.sparkContext.defaultParallelism, -(-(stored.count() + rows.count()) // ROWS_PER_BUCKET))
    initial, buckets = ingest.held_by_key(stored, scratch_path(spark, "stored"), buckets)   # the stored table, as a table
    return initial, buckets, in_waves(spark, rows, F.col("page"), (800, 1600), "listing",
                                      lambda root: ingest.listing_step(root, initial, C._now(), buckets))


@query("r01_listing_stream", None)
def r01(spark, d):
    initial, buckets, (root, n) = _listing(spark, d)
    out = state.latest(spark, root, "tenders", initial, n, buckets)
    is_new = F.col("created_at") == C._now()
    return out.select(F.when(~is_new, F.col("id")).alias("id"), "url_id", "reference", "date_publication", "date_limite",
                      "lien_detail", "objet", "acheteur", "hash_content", "status", "retry_count",
                      F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"))


ORACLE["r01_listing_stream"] = ORACLE["u01_upsert"]


@query("r02_minutes_stream", f"WITH {C._SAVED} SELECT hash_pdf, tender_id, reference, procedure_type, d AS date_publication FROM new")
def r02(spark, d):
    rows = B.pvs(spark, d).withColumn("seq", F.col("id"))
    initial = spark.createDataFrame([], rows.drop("procedure_code", "seq").schema)
    root, n = in_waves(spark, rows, F.col("created_at"), (F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1999-01-01").cast("timestamp_ntz")),
                       "minutes", lambda root: ingest.minutes_step(root, initial, C._now()))
    return state.latest(spark, root, "pvs", initial, n).select("hash_pdf", "tender_id", "reference", "procedure_type", "date_publication")


@query("r03_stage_stream", None)
def r03(spark, d):
    initial = cut_lineage(B.tenders(spark, d), "stored")
    rows = B.outcomes(spark, d)
    root, n = in_waves(spark, rows, F.col("seq"), (300, 700), "stage", lambda root: ingest.stage_step(root, initial))
    return state.latest(spark, root, "tenders", initial, n).select("id", "retry_count", "last_error", "status", "zip_path")


ORACLE["r03_stage_stream"] = ORACLE["u04_failures"]


@query("r04_change_log_stream", C.LISTING_SQL + """SELECT s.id AS tender_id, s.reference, 'status' AS field, s.status AS old_value, 'TO_ENRICH' AS new_value
    FROM stored_tenders s JOIN eff e ON e.sid = s.id WHERE e.n_updated > 0 AND s.status <> 'TO_ENRICH'""")
def r04(spark, d):
    _, _, (root, _) = _listing(spark, d)
    return ingest.change_log(spark, root).select("tender_id", "reference", "field", "old_value", "new_value")
