"""Merging detail records into the tenders table; guards on unique keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions.keys import tender_hash
from tenderloom.functions.links import url_id
from tenderloom.functions.text import keep_non_empty
from tenderloom.operators.common import spread_nulls

OVERWRITTEN = ["estimation", "domaines", "contact_nom", "contact_email", "contact_tel", "contact_fax", "lien_dce",
               "attributaire", "montant_reel", "date_attribution", "nb_soumissionnaires"]


def hash_winners(details: DataFrame, tenders: DataFrame) -> DataFrame:
    """Details with their tender hash and ``is_duplicate``.

    A hash that is stored already belongs to its holder; a free one goes to the lowest id. Both are
    aggregates per hash, so a hash shared by very many rows costs one small row per task.
    """
    first = details.groupBy("new_hash").agg(F.min("id").alias("first_id"))
    taken = tenders.filter(F.col("tender_hash").isNotNull()).groupBy(F.col("tender_hash").alias("new_hash")).agg(
        F.min("id").alias("holder_low"), F.max("id").alias("holder_high"))
    joined = details.join(first.join(taken, "new_hash", "left"), "new_hash", "left")
    own = (F.col("holder_low") == F.col("id")) & (F.col("holder_high") == F.col("id"))
    wins = F.when(F.col("holder_low").isNotNull(), own).otherwise(F.col("id") == F.col("first_id"))
    return joined.withColumn("is_duplicate", ~wins).drop("first_id", "holder_low", "holder_high")


def with_hash(tenders: DataFrame, details: DataFrame, effective_buyer: bool = False) -> DataFrame:
    """Details (by id) with the hash over the stored reference and date and the detail's buyer.

    ``effective_buyer`` uses the stored buyer where the detail has none.
    """
    base = tenders.select("id", "reference", "date_publication", F.col("acheteur").alias("_stored_buyer"))
    joined = details.join(base, "id")
    buyer = keep_non_empty(F.col("acheteur"), F.col("_stored_buyer")) if effective_buyer else F.col("acheteur")
    return joined.withColumn("new_hash", tender_hash(F.col("reference"), F.col("date_publication"), buyer)).drop(
        "reference", "date_publication", "_stored_buyer")


def merge_details(tenders: DataFrame, details: DataFrame, as_of: Column, effective_buyer: bool = False,
                  shared_hash: bool = False, status: str = "TO_DOWNLOAD") -> DataFrame:
    """Enriched table. Duplicate hashes become failures: nothing stored, one retry more.

    The detail page's hash goes to ``detail_hash``. ``shared_hash`` puts it over the listing's
    ``hash_content`` instead, so that the next listing finds every enriched row changed.
    """
    hash_column = "hash_content" if shared_hash else "detail_hash"
    judged = hash_winners(with_hash(tenders, details, effective_buyer), tenders)
    d = judged.select("id", "is_duplicate", "new_hash", F.struct(
        "objet", "acheteur", *OVERWRITTEN, F.col("hash_content").alias("page_hash")).alias("d"))
    joined = tenders.join(d, "id", "left")
    hit = F.coalesce(~F.col("is_duplicate"), F.lit(False))
    lost = F.coalesce(F.col("is_duplicate"), F.lit(False))
    changes = {c: F.when(hit, F.col(f"d.{c}")).otherwise(F.col(c)) for c in OVERWRITTEN}
    for c in ("objet", "acheteur"):
        changes[c] = F.when(hit, keep_non_empty(F.col(f"d.{c}"), F.col(c))).otherwise(F.col(c))
    changes |= {
        "tender_hash": F.when(hit, F.col("new_hash")).otherwise(F.col("tender_hash")),
        "status": F.when(hit, F.lit(status)).otherwise(F.col("status")),
        "retry_count": F.when(lost, F.coalesce("retry_count", F.lit(0)) + 1).otherwise(F.col("retry_count")),
        "last_error": F.when(lost, F.lit(S.ERROR_HASH_TAKEN)).otherwise(F.col("last_error")),
        "updated_at": F.when(hit | lost, as_of).otherwise(F.col("updated_at")),
    }
    if hash_column in tenders.columns:
        changes[hash_column] = F.when(hit, F.col("d.page_hash")).otherwise(F.col(hash_column))
    return joined.withColumns(changes).select(*tenders.columns)


def missing_links(queue: DataFrame) -> DataFrame:
    """Failed results for queued rows without a detail link."""
    return queue.filter(F.coalesce(F.length("lien_detail"), F.lit(0)) == 0).select(
        F.lit("enrich").alias("stage"), F.col("id").alias("tender_id"), F.lit(0).cast("long").alias("seq"),
        F.lit(False).alias("ok"), F.lit(S.ERROR_NO_LINK).alias("error"), F.lit(None).cast("string").alias("next_status"))


def missing_pages(queue: DataFrame, stored_pages: DataFrame) -> DataFrame:
    """Failed results for queued rows with a link to which no page (url) is stored."""
    linked = queue.filter(F.length("lien_detail") > 0)
    return linked.join(stored_pages.select(F.col("url").alias("lien_detail")).distinct(), "lien_detail", "left_anti").select(
        F.lit("enrich").alias("stage"), F.col("id").alias("tender_id"), F.lit(0).cast("long").alias("seq"),
        F.lit(False).alias("ok"), F.lit(S.ERROR_UNRESOLVED).alias("error"), F.lit(None).cast("string").alias("next_status"))


def backfill_url_id(tenders: DataFrame, parameter: str = "refConsultation") -> DataFrame:
    """Fill missing portal numbers from the link. The lowest id gets a number; numbers in use stay put."""
    found = F.when(F.col("url_id").isNull(), F.nullif(url_id(F.col("lien_detail"), parameter), F.lit("")))
    t = tenders.withColumn("_found", found)
    taken = t.filter(F.col("url_id").isNotNull()).select(F.col("url_id").alias("_n"), F.lit(None).cast("long").alias("_id"))
    wanted = t.filter(F.col("_found").isNotNull()).select(F.col("_found").alias("_n"), F.col("id").alias("_id"))
    # one aggregate decides: any holder blocks a number, else the lowest id wins it
    winners = taken.unionByName(wanted).groupBy("_n").agg(
        F.bool_or(F.col("_id").isNull()).alias("_held"), F.min("_id").alias("_winner")).filter("NOT _held")
    joined = t.withColumn("_k", spread_nulls(F.col("_found"), F.col("id"))).join(
        winners.select(F.col("_n").alias("_k"), "_winner"), "_k", "left")
    return joined.withColumn("url_id", F.coalesce("url_id", F.when(F.col("_winner") == F.col("id"), F.col("_found")))) \
        .select(*tenders.columns)
