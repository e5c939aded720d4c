"""Stage results: failures, transitions, resets, run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S


def outcome_effects(outcomes: DataFrame, keep_previous_error: bool = True) -> DataFrame:
    """One row per tender: what its results, taken in ``seq`` order, amount to.

    Plain aggregates with map-side combine, so a tender with very many results is no hot spot.
    """
    failed = ~F.col("ok")
    said = failed & F.col("error").isNotNull() if keep_previous_error else failed
    error = F.col("error") if keep_previous_error else F.coalesce("error", F.lit("None"))
    last = lambda value, when: F.max_by(F.when(when, value), F.when(when, F.col("seq")))
    aggregates = [
        F.count_if(failed).cast("int").alias("n_failed"),
        last(error, said).alias("new_error"),
        last(F.col("next_status"), F.col("next_status").isNotNull()).alias("new_status"),
    ]
    if "path" in outcomes.columns:
        aggregates.append(last(F.col("path"), F.col("path").isNotNull()).alias("new_path"))
    return outcomes.groupBy(F.col("tender_id").alias("id")).agg(*aggregates)


def apply_outcomes(tenders: DataFrame, outcomes: DataFrame, as_of: Column | None = None,
                   keep_previous_error: bool = True, touched_only: bool = False) -> DataFrame:
    """Failures raise the retry count and set the error; a named next status and path are taken over.

    ``touched_only`` returns just the tenders that have results.
    """
    effects = outcome_effects(outcomes, keep_previous_error).withColumn("touched", F.lit(True))
    joined = tenders.join(effects, "id", "inner" if touched_only else "left")
    changes = {
        "retry_count": F.when(F.col("n_failed") > 0, F.coalesce("retry_count", F.lit(0)) + F.col("n_failed"))
        .otherwise(F.col("retry_count")).cast("int"),
        "last_error": F.coalesce("new_error", "last_error"),
        "status": F.coalesce("new_status", "status"),
    }
    if "path" in outcomes.columns:
        changes["zip_path"] = F.coalesce("new_path", "zip_path")
    if as_of is not None:
        changes["updated_at"] = F.when(F.col("touched"), as_of).otherwise(F.col("updated_at"))
    return joined.withColumns(changes).select(*tenders.columns)


def download_outcomes(queue: DataFrame, files: DataFrame) -> DataFrame:
    """Results of queued downloads (id, lien_dce) from the files that were stored for their links (url, path, is_valid).

    A row whose link has a valid archive goes on with the path of the least one by name; one whose link has none fails. Links are folded to one row each
    before the join, so a link that many tenders share, or many files answer, is no hot spot.
    """
    path = files.filter("is_valid").groupBy(F.col("url").alias("lien_dce")).agg(F.min("path").alias("path"))
    found = queue.join(path, "lien_dce", "left")
    ok = F.col("path").isNotNull()
    return found.select(F.lit("download").alias("stage"), F.col("id").alias("tender_id"), F.lit(0).cast("long").alias("seq"), ok.alias("ok"),
                        F.when(~ok, S.ERROR_UNRESOLVED).alias("error"), F.when(ok, "TO_ANALYZE").alias("next_status"), "path")


def set_fields(table: DataFrame, values: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Overwrite columns by id with the given rows' values (one row per id); others stay."""
    names = [c for c in values.columns if c != "id"]
    renamed = values.select(F.col("id"), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in names])
    joined = table.join(renamed, "id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    changes = {c: F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)) for c in names}
    if as_of is not None:
        changes["updated_at"] = F.when(hit, as_of).otherwise(F.col("updated_at"))
    return joined.withColumns(changes).select(*table.columns)


def mark(table: DataFrame, ids: DataFrame, as_of: Column | None = None, **values) -> DataFrame:
    """Set constants on the rows whose id is in ``ids``; an id list never becomes a literal list."""
    return set_fields(table, ids.select("id").distinct().withColumns({k: F.lit(v) for k, v in values.items()}), as_of)


def reset_errors(tenders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Failed rows go back to the stage that failed, with a clean retry count and no error."""
    back = F.create_map(*[F.lit(x) for pair in S.RESET_STATUS.items() for x in pair])[F.col("status")]
    hit = back.isNotNull()
    changes = {
        "retry_count": F.when(hit, F.lit(0)).otherwise(F.col("retry_count")),
        "last_error": F.when(~hit, F.col("last_error")),
        "status": F.coalesce(back, "status"),
    }
    if as_of is not None:
        changes["updated_at"] = F.when(hit, as_of).otherwise(F.col("updated_at"))
    return tenders.withColumns(changes)


def reset_count(tenders: DataFrame) -> DataFrame:
    return tenders.agg(F.count_if(F.col("status").isin(list(S.RESET_STATUS))).alias("n_reset"))


def run_metrics(outcomes: DataFrame) -> DataFrame:
    """Processed, ok and failed results of each stage."""
    return outcomes.groupBy("stage").agg(
        F.count_if(F.col("ok")).alias("n_ok"), F.count_if(~F.col("ok")).alias("n_errors"),
        F.count(F.lit(1)).alias("n_processed"))


def listing_metrics(batch: DataFrame, effects: DataFrame) -> DataFrame:
    """Pages and rows seen, with the new and updated rows they led to."""
    seen = batch.agg(F.countDistinct("page").alias("pages"), F.count(F.lit(1)).alias("seen"))
    counters = effects.agg(F.coalesce(F.sum(F.col("is_new").cast("long")), F.lit(0)).alias("n_new"),
                           F.coalesce(F.sum("n_updated"), F.lit(0)).alias("n_updated"))
    return counters.withColumns({"pages": seen.select("pages").scalar(), "seen": seen.select("seen").scalar()})
