"""Opening minutes: skip known ones, link to tenders, create orphans, store without repeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions.keys import surrogate_id, tender_key
from tenderloom.functions.links import url_id
from tenderloom.operators.common import spread_nulls
from tenderloom.session import cut_lineage


def with_uid(candidates: DataFrame, parameter: str = "refConsultation") -> DataFrame:
    return candidates.withColumn("uid", F.nullif(url_id(F.col("lien"), parameter), F.lit("")))


def with_address(candidates: DataFrame) -> DataFrame:
    """Minutes without a file address are left out before linking."""
    return candidates.filter(F.length("pv_pdf_url") > 0)


def tag_procedure(candidates: DataFrame) -> DataFrame:
    """Procedure name by code: three fixed names, looked up in the projection."""
    names = F.create_map(*[F.lit(x) for pair in S.PROCEDURES.items() for x in pair])
    return candidates.withColumn("procedure_type", names[F.col("procedure_code")])


def drop_known(candidates: DataFrame, tenders: DataFrame, pvs: DataFrame, per: str = "tender") -> DataFrame:
    """Candidates that are still to be visited.

    ``per="tender"`` drops one whose tender number or reference has minutes already, by two equi
    anti-joins against distinct keys; ``per="file"`` drops only known files.
    """
    if per == "file":
        known = pvs.filter(F.col("hash_pdf").isNotNull()).select("hash_pdf").distinct()
        hashed = F.when(F.length("pv_pdf_url") > 0, F.md5("pv_pdf_url"))
        keyed = candidates.withColumn("hash_pdf", spread_nulls(hashed, F.xxhash64("lien", "reference")))
        return keyed.join(known, "hash_pdf", "left_anti").select(*candidates.columns)
    c = with_uid(candidates)
    c = c.withColumn("uid", spread_nulls(F.col("uid"), F.xxhash64("lien", "reference")))
    with_minutes = tenders.filter(F.col("url_id").isNotNull()).select("id", F.col("url_id").alias("uid")).join(
        pvs.select(F.col("tender_id").alias("id")).distinct(), "id", "left_semi").select("uid").distinct()
    refs = pvs.filter(F.col("reference").isNotNull()).select("reference").distinct()
    return c.join(with_minutes, "uid", "left_anti").join(refs, "reference", "left_anti").select(*candidates.columns)


def newest_by_reference(tenders: DataFrame) -> DataFrame:
    """Newest tender of each reference (ties: lowest id)."""
    return tenders.groupBy("reference").agg(
        F.max_by("id", F.struct(F.col("created_at"), (-F.col("id")).alias("low"))).alias("id_by_ref"))


def by_number(tenders: DataFrame) -> DataFrame:
    return tenders.filter(F.col("url_id").isNotNull()).groupBy(F.col("url_id").alias("uid")).agg(
        F.min("id").alias("id_by_uid"))


def link(candidates: DataFrame, tenders: DataFrame) -> DataFrame:
    """Candidates with ``id_by_uid`` and ``id_by_ref`` of their stored tender.

    Both look-up sides hold one row per key. Rows that need no look-up get a key that matches nothing
    and is spread by sequence number, so neither blank numbers nor matched rows pile up in one task.
    """
    return _by_reference(_by_number(with_uid(candidates), tenders), tenders)


def _by_number(rows: DataFrame, tenders: DataFrame) -> DataFrame:
    c = rows.withColumn("_u", spread_nulls(F.col("uid"), F.col("seq")))
    return c.join(by_number(tenders).withColumnRenamed("uid", "_u"), "_u", "left").drop("_u")


def _by_reference(rows: DataFrame, tenders: DataFrame) -> DataFrame:
    c = rows.withColumn("_r", spread_nulls(F.when(F.col("id_by_uid").isNull(), F.col("reference")), F.col("seq")))
    return c.join(newest_by_reference(tenders).withColumnRenamed("reference", "_r"), "_r", "left").drop("_r")


def choose_orphans(unmatched: DataFrame, told: Callable[[str, DataFrame], None] | None = None) -> DataFrame:
    """Rows that found a new tender, in first-come order over two keys.

    A row founds one unless an earlier founder shares its number or its reference. Equal (number, reference) pairs are folded first. Two steps take
    turns until no row is left. The first settles the rows that are first for both of their keys, and with them all rows sharing a key:
    rows that share no key, or only with such rows, leave at once. The second settles whole chains: a row with one earlier row among those left founds
    exactly if that one doesn't, so pointers to the earlier row are doubled until they reach the chain's head, and an even distance from a head
    that founds makes a founder. A chain of n rows thus takes log2(n) doublings instead of n rounds; what takes further turns is rows with two earlier ones.
    Every step is written to the shared folder. ``told`` hears of each step with the rows left.
    """
    pairs = unmatched.groupBy("uid", "reference").agg(F.min_by(F.struct("seq", "lien", "objet"), "seq").alias("r"))
    left = cut_lineage(pairs.select("uid", "reference", "r.*"))
    founders, step = None, _heads
    while not left.isEmpty():
        if told:
            told(step.__name__, left)
        taken = cut_lineage(step(left))
        founders = taken if founders is None else founders.unionByName(taken)
        rest = left.join(taken.select("reference"), "reference", "left_anti")
        left = cut_lineage(rest.join(taken.filter(F.col("uid").isNotNull()).select("uid"), "uid", "left_anti"))
        step = _chains if step is _heads else _heads
    return left if founders is None else founders


def _heads(left: DataFrame) -> DataFrame:
    """Rows that are the first of their reference and of their number."""
    head = left.groupBy("reference").agg(F.min_by(F.struct("seq", "uid", "lien", "objet"), "seq").alias("r")).select(
        "r.uid", "reference", "r.seq", "r.lien", "r.objet")
    first_uid = left.filter(F.col("uid").isNotNull()).groupBy("uid").agg(F.min("seq").alias("uid_first"))
    named = head.filter(F.col("uid").isNotNull()).join(first_uid, "uid").filter(F.col("seq") == F.col("uid_first")).drop("uid_first")
    return head.filter(F.col("uid").isNull()).unionByName(named)


def _chains(left: DataFrame) -> DataFrame:
    """Founders among rows with at most one earlier row, by doubled pointers."""
    def placed(rows: DataFrame, key: str) -> DataFrame:
        """0, 1 or 2 for no, one, more earlier rows with the key, and the first of them. Minima only, so a popular key costs map-side partials."""
        spread = rows.withColumn("_k", spread_nulls(F.col(key), F.col("seq")))
        keyed = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), "seq")
        first = keyed.groupBy("_k").agg(F.min("seq").alias("_first"))
        second = keyed.join(first, "_k").filter(F.col("seq") > F.col("_first")).groupBy("_k").agg(F.min("seq").alias("_second"))
        j = spread.join(first.join(second, "_k", "left"), "_k", "left")
        earlier = F.when(F.col("_first").isNull() | (F.col("seq") == F.col("_first")), 0).when(F.col("seq") == F.col("_second"), 1).otherwise(2)
        return j.select("seq", earlier.alias(f"{key}_n"), F.col("_first").alias(f"{key}_first"))

    rows = cut_lineage(placed(left, "uid").join(placed(left, "reference"), "seq"))
    before = F.when(F.col("uid_n") == 1, F.col("uid_first")).otherwise(F.col("reference_first"))
    links = cut_lineage(rows.filter(F.col("uid_n") + F.col("reference_n") == 1).select("seq", before.alias("to"), F.lit(1).alias("odd")))
    while True:
        ahead = links.select(F.col("seq").alias("at"), F.col("to").alias("next"), F.col("odd").alias("more"))
        links = cut_lineage(links.join(ahead, links["to"] == ahead["at"], "left").select(
            "seq", F.coalesce("next", "to").alias("to"), F.col("odd").bitwiseXOR(F.coalesce("more", F.lit(0))).alias("odd"), F.col("at").isNotNull().alias("on")))
        if links.filter("on").isEmpty():
            break
    heads = rows.filter((F.col("uid_n") == 0) & (F.col("reference_n") == 0)).select("seq")
    even = links.filter("odd = 0").join(heads.withColumnRenamed("seq", "to"), "to", "left_semi").select("seq")
    return left.join(heads.unionByName(even), "seq", "left_semi")


def link_with_orphans(candidates: DataFrame, tenders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates with ``tender_id``, orphan tenders). Candidates without an address are ignored.

    What a candidate is linked with depends on its number and reference, and on its place only against the founder of its number.
    So equal (number, reference) pairs are folded before anything is looked up; the pairs with what they found are written
    once, and the candidates themselves are joined a single time, with their pair.
    """
    rows = with_uid(with_address(candidates))
    pairs = rows.groupBy("uid", "reference").agg(F.min_by(F.struct("seq", "lien", "objet"), "seq").alias("r"))
    numbered = _by_number(pairs.select("uid", "reference", "r.*"), tenders)
    texts = {c: F.when(F.col("id_by_uid").isNull(), F.col(c)) for c in ("lien", "objet")}     # only founders need them
    looked = cut_lineage(_by_reference(numbered.withColumns(texts), tenders), "linked")
    is_free = F.col("id_by_uid").isNull() & F.col("id_by_ref").isNull()
    key = tender_key(F.coalesce("uid", F.lit("")), F.col("reference"))
    orphans = choose_orphans(looked.filter(is_free).select("seq", "uid", "reference", "lien", "objet")).withColumn(
        "id", surrogate_id(key))
    by_uid = orphans.filter(F.col("uid").isNotNull()).select(
        F.col("uid").alias("_u"), F.col("seq").alias("_useq"), F.col("id").alias("_uid_orphan"))
    by_ref = orphans.select(F.col("reference").alias("_r"), F.col("id").alias("_ref_orphan"))
    found = looked.select(F.col("uid").alias("_uid"), F.col("reference").alias("_reference"), "id_by_uid", "id_by_ref",
                          spread_nulls(F.when(F.col("id_by_uid").isNull(), F.col("uid")), F.col("seq")).alias("_u"),
                          spread_nulls(F.when(is_free, F.col("reference")), F.col("seq")).alias("_r"))
    found = found.join(by_uid, "_u", "left").join(by_ref, "_r", "left").drop("_u", "_r")
    joined = rows.join(found, rows["uid"].eqNullSafe(found["_uid"]) & rows["reference"].eqNullSafe(found["_reference"]), "left")
    early = F.when(F.col("_useq") <= F.col("seq"), F.col("_uid_orphan"))
    linked = joined.withColumn("tender_id", F.coalesce("id_by_uid", early, "id_by_ref", "_ref_orphan"))
    return linked.select(*candidates.columns, "tender_id"), orphans


def add_orphans(tenders: DataFrame, orphans: DataFrame, as_of: Column) -> DataFrame:
    rows = orphans.select(
        "id", F.col("uid").alias("url_id"), "reference", F.col("lien").alias("lien_detail"), "objet",
        F.lit("TO_ENRICH").alias("status"), F.lit(0).alias("retry_count"), as_of.alias("created_at"),
        as_of.alias("updated_at"))
    return tenders.unionByName(rows, allowMissingColumns=True)


def first_minutes(incoming: DataFrame) -> DataFrame:
    """First row of each file, with the first date any of its rows gives."""
    rows = incoming.filter(F.length("pdf_url") > 0).withColumn("hash_pdf", F.md5("pdf_url"))
    dated = F.length("date_publication") > 0
    return rows.groupBy("hash_pdf").agg(
        F.min_by(F.struct("tender_id", "reference", "pdf_url", "procedure_type"), "seq").alias("r"),
        F.coalesce(F.min_by(F.when(dated, F.col("date_publication")), F.when(dated, F.col("seq"))), F.lit("")).alias("d"))


def _saved(stored: DataFrame, incoming: DataFrame, as_of: Column, how: str) -> DataFrame:
    new = first_minutes(incoming).alias("n")
    old = stored.withColumn("_k", spread_nulls(F.col("hash_pdf"), F.col("id"))).alias("o")
    j = old.join(new, F.col("o._k") == F.col("n.hash_pdf"), how)
    is_new, both = F.col("o._k").isNull(), F.col("o._k").isNotNull() & F.col("n.hash_pdf").isNotNull()
    filled = both & (F.coalesce(F.length("o.date_publication"), F.lit(0)) == 0) & (F.col("n.d") != "")
    out = {
        "id": F.when(is_new, surrogate_id(F.col("n.hash_pdf"))).otherwise(F.col("o.id")),
        "date_publication": F.when(is_new | filled, F.col("n.d")).otherwise(F.col("o.date_publication")),
        "hash_pdf": F.when(is_new, F.col("n.hash_pdf")).otherwise(F.col("o.hash_pdf")),
        "synced_to_sheets": F.when(is_new, F.lit(0)).otherwise(F.col("o.synced_to_sheets")),
        "created_at": F.when(is_new, as_of).otherwise(F.col("o.created_at")),
        "updated_at": F.when(is_new, as_of).otherwise(F.col("o.updated_at")),
    }
    for c in ("tender_id", "reference", "pdf_url", "procedure_type"):
        out[c] = F.when(is_new, F.col(f"n.r.{c}")).otherwise(F.col(f"o.{c}"))
    if how == "right_outer":
        j = j.filter(is_new | filled)
    return j.select(*[out.get(c, F.col(f"o.{c}")).alias(c) for c in stored.columns])


def save_minutes(stored: DataFrame, incoming: DataFrame, as_of: Column) -> DataFrame:
    """The minutes table after a batch: new files are added, known files only get a missing date."""
    return _saved(stored, incoming, as_of, "full_outer")


def saved_rows(stored: DataFrame, incoming: DataFrame, as_of: Column) -> DataFrame:
    """Only the rows a batch adds or dates."""
    return _saved(stored, incoming, as_of, "right_outer")


def cascade_delete(pvs: DataFrame, survivors: DataFrame) -> DataFrame:
    """Minutes whose tender is still there."""
    return pvs.join(survivors.select(F.col("id").alias("tender_id")), "tender_id", "left_semi")
