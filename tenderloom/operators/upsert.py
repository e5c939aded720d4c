"""Keyed upsert of listing rows with change detection.

The rows of a key, in ``(page, row)`` order, form a chain: a row is *applied* when its hash differs from
the hash before it, the first one being compared with the stored hash. Chains of neighbouring rows are
summarised and the summaries are joined up, so a key that fills a third of the batch is first cut into
blocks of pages (a page is one stored document, hence bounded) and only block summaries meet per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.functions.keys import packed, surrogate_id, tender_key, unpacked
from tenderloom.operators.common import spread_nulls
from tenderloom.session import BROADCAST_ROWS, broadcast_if_small

PAGES_PER_BLOCK = 256
BINS = 4096                # of keys, by hash; what a crowded bin holds is cut into blocks
CROWDED_ROWS = 100_000     # a bin of fewer rows is never crowded
_INSERT = ["reference", "date_publication", "date_limite", "lien_detail", "objet", "acheteur", "url_id"]


def changed(before: Column, after: Column) -> Column:
    return ~before.eqNullSafe(after)


def change_flags(batch: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Per row: is its hash another than the one before it in its key's chain?

    ``stored`` (key, hash) seeds the chains. Rows of different page blocks of one key meet only as
    block ends.
    """
    rows = batch.withColumns({"key": tender_key(F.col("url_id"), F.col("reference")),
                              "block": F.floor(F.col("page") / PAGES_PER_BLOCK)})
    inside = Window.partitionBy("key", "block").orderBy("page", "row")
    rows = rows.withColumns({"before": F.lag("page_hash").over(inside), "pos": F.row_number().over(inside)})
    ends = rows.groupBy("key", "block").agg(
        F.max_by(F.struct("page_hash"), F.struct("page", "row")).alias("tail"))
    across = Window.partitionBy("key").orderBy("block")
    ends = ends.select("key", "block", F.lag("tail").over(across).alias("tail_before"))
    if stored is not None:
        seeds = stored.groupBy("key").agg(F.min_by(F.struct("hash_content"), "id").alias("seed"))
        ends = ends.join(seeds, "key", "left")
    else:
        ends = ends.withColumn("seed", F.lit(None).cast("struct<hash_content:string>"))
    rows = rows.join(ends, ["key", "block"], "left")
    start = F.when(F.col("tail_before").isNotNull(), changed(F.col("tail_before.page_hash"), F.col("page_hash"))) \
        .when(F.col("seed").isNotNull(), changed(F.col("seed.hash_content"), F.col("page_hash"))) \
        .otherwise(F.lit(True))
    return rows.withColumn("is_change", F.when(F.col("pos") > 1, changed(F.col("before"), F.col("page_hash")))
                           .otherwise(start)).drop("before", "pos", "block", "tail_before", "seed")


def _crowded(rows: DataFrame) -> list[int]:
    """Bins that hold many more rows than most do, so maybe a key with a large part of them. At most ``BINS`` counts are moved a task."""
    counts = {r.bin: r.n for r in rows.groupBy(_bin(F.col("key")).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(b for b, n in counts.items() if n > max(CROWDED_ROWS, 8 * sum(counts.values()) / BINS))


def _bin(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BINS))


def dealt_by(rows: DataFrame, key: Column, parts: int, hashes: list[str]) -> DataFrame:
    """The rows, moved to the partitions of their ``key``, which becomes a column behind the move; hashes are short on the way."""
    return rows.withColumns({h: packed(F.col(h)) for h in hashes}).repartition(parts, key).withColumns(
        {**{h: unpacked(F.col(h)) for h in hashes}, "key": key})


def _summaries(rows: DataFrame, cut: bool = True) -> DataFrame:
    """One row per key and page block (per key, if not ``cut``): its first row, its last hash, and what was applied after the first."""
    by = ["key", "block"] if cut else ["key"]
    if cut:
        rows = rows.withColumn("block", F.floor(F.col("page") / PAGES_PER_BLOCK))
    chain = Window.partitionBy(*by).orderBy("page", "row")
    rows = rows.withColumns({"pos": F.row_number().over(chain), "before": F.lag("page_hash").over(chain)})
    rows = rows.withColumn("applied", (F.col("pos") > 1) & changed(F.col("before"), F.col("page_hash")))
    at = lambda when: F.when(when, F.col("pos"))
    applied = F.col("applied")
    return rows.groupBy(*by).agg(
        F.min_by(F.struct(*_INSERT, F.col("page_hash")), "pos").alias("first"),
        F.max_by(F.struct("page_hash"), "pos").alias("tail"),
        F.count_if(applied).alias("n_applied"),
        F.max_by(F.struct("date_limite"), at(applied)).alias("limit_set"),
        F.max_by("objet", at(applied & (F.col("objet") != ""))).alias("objet_set"),
        F.max_by("acheteur", at(applied & (F.col("acheteur") != ""))).alias("acheteur_set"),
    )


def _seeds(stored: DataFrame) -> DataFrame:
    """Per key: ``seed``, the stored row that holds it, and ``moved``, the sum of the ids that left it.

    A row without a number is known by its reference until it gets one. Its id was made from the reference,
    so the next row known by that reference needs another id; ``moved`` tells the two apart.
    """
    own = F.struct(tender_key(F.col("url_id"), F.col("reference")).alias("key"), F.lit(True).alias("own"))
    left = F.struct(tender_key(F.lit(""), F.col("reference")).alias("key"), F.lit(False).alias("own"))
    keys = F.explode(F.when(F.col("url_id") != "", F.array(own, left)).otherwise(F.array(own))).alias("k")
    rows = stored.select("id", "hash_content", keys).select("id", "hash_content", "k.key", "k.own")
    return rows.groupBy("key").agg(
        F.min_by(F.struct("id", "hash_content"), F.when(F.col("own"), F.col("id"))).alias("seed"),
        F.sum(F.when(~F.col("own"), F.col("id").cast("decimal(28,0)"))).alias("moved"))


def _held_seeds(blocks: DataFrame, stored: DataFrame, layers: list[DataFrame], parts: int) -> DataFrame:
    """The same look-up where the state's layers are dealt by key, like the blocks: only the references that were left are moved.

    A key's rows in a later layer are its seed as it was changed, or the row that was new then, so the last layer that has the key counts.
    """
    blocks = blocks.withColumn("seed", F.lit(None).cast("struct<id:bigint,hash_content:string>"))
    for layer in reversed(layers):
        own = layer.groupBy("key").agg(F.min_by(F.struct("id", "hash_content"), "id").alias("own"))
        blocks = blocks.join(own, "key", "left").withColumn("seed", F.coalesce("seed", "own")).drop("own")
    left = stored.filter(F.col("url_id") != "").groupBy(tender_key(F.lit(""), F.col("reference")).alias("key")).agg(
        F.sum(F.col("id").cast("decimal(28,0)")).alias("moved"))
    return blocks.join(left.repartition(parts, "key"), "key", "left")


def _new_id(key: Column, moved: Column) -> Column:
    return F.when(moved.isNull(), surrogate_id(key)).otherwise(surrogate_id(F.concat(key, F.lit("|"), moved.cast("string"))))


def upsert_effects(stored: DataFrame, batch: DataFrame, layers: list[DataFrame] | None = None, parts: int = 0) -> DataFrame:
    """What a listing batch does to each of its keys (exactly as if its rows came one by one).

    ``layers`` are those of ``stored``, the oldest first, all dealt by key into ``parts``: the rows are then moved once, by key, and the
    layers stay where they are. Keys that may hold a large part of the rows still go by blocks.
    """
    rows = batch.withColumn("key", tender_key(F.col("url_id"), F.col("reference")))
    if layers is None:
        return _effects(_summaries(rows).join(_seeds(stored), "key", "left"))
    key = tender_key(F.col("url_id"), F.col("reference"))
    crowded = _crowded(rows)
    in_crowd = _bin(key).isin(crowded)
    whole = _summaries(dealt_by(batch.filter(~in_crowd) if crowded else batch, key, parts, ["page_hash"]), cut=False)
    whole = whole.withColumn("block", F.lit(0))
    effects = _effects(_held_seeds(whole, stored, layers, parts))
    if crowded:
        cut = _summaries(rows.filter(in_crowd)).repartition(parts, "key")
        effects = effects.unionByName(_effects(_held_seeds(cut, stored, layers, parts)))
    # what a stored row's first row said is in the other columns; only a new row is made of it
    return effects.withColumn("first", F.when(F.col("is_new"), F.col("first")))


def _effects(blocks: DataFrame) -> DataFrame:
    """Block summaries, with what is stored of their keys, joined up per key."""
    chain = Window.partitionBy("key").orderBy("block")
    blocks = blocks.withColumns({"n": F.row_number().over(chain), "tail_before": F.lag("tail").over(chain)})
    unseen = F.col("seed").isNull()
    insert = (F.col("n") == 1) & unseen
    head_applied = (~insert) & F.when(F.col("n") == 1, changed(F.col("seed.hash_content"), F.col("first.page_hash"))) \
        .otherwise(changed(F.col("tail_before.page_hash"), F.col("first.page_hash")))
    blocks = blocks.withColumn("head", head_applied)
    head, total = F.col("head"), F.col("n_applied") + F.col("head").cast("long")
    text = lambda name: F.coalesce(
        F.col(f"{name}_set"), F.when(head & (F.col(f"first.{name}") != ""), F.col(f"first.{name}")))
    limit = F.when(F.col("n_applied") > 0, F.col("limit_set")).when(
        head, F.struct(F.col("first.date_limite").alias("date_limite")))
    at = lambda value: F.when(value.isNotNull(), F.col("n"))
    return blocks.groupBy("key").agg(
        F.first("seed").alias("seed"), F.first("moved").alias("moved"),
        F.min_by("first", "n").alias("first"),
        F.max_by("tail", "n").alias("tail"),
        F.sum(total).alias("n_updated"),
        F.max_by(limit, at(limit)).alias("limit_set"),
        F.max_by(text("objet"), at(text("objet"))).alias("objet_set"),
        F.max_by(text("acheteur"), at(text("acheteur"))).alias("acheteur_set"),
    ).select(
        F.coalesce("seed.id", _new_id(F.col("key"), F.col("moved"))).alias("id"), "key",
        F.col("seed").isNull().alias("is_new"), "first", F.col("tail.page_hash").alias("new_hash"),
        "n_updated", "limit_set", "objet_set", "acheteur_set")


def _merged(cols: list[str], as_of: Column, hit: Column, new: Column) -> dict[str, Column]:
    touched = hit & (F.col("e.n_updated") > 0)
    latest = lambda name: F.coalesce(F.col(f"e.{name}_set"), F.when(new, F.col(f"e.first.{name}")).otherwise(F.col(f"s.{name}")))
    out = {
        "id": F.coalesce("s.id", "e.id"),
        "url_id": F.when(new, F.nullif(F.col("e.first.url_id"), F.lit(""))).otherwise(F.col("s.url_id")),
        "date_limite": F.when(F.col("e.limit_set").isNotNull(), F.col("e.limit_set.date_limite"))
        .when(new, F.col("e.first.date_limite")).otherwise(F.col("s.date_limite")),
        "objet": latest("objet"), "acheteur": latest("acheteur"),
        "hash_content": F.when(hit | new, F.col("e.new_hash")).otherwise(F.col("s.hash_content")),
        "last_seen": F.when(hit | new, as_of).otherwise(F.col("s.last_seen")),
        "status": F.when(new | touched, F.lit("TO_ENRICH")).otherwise(F.col("s.status")),
        "retry_count": F.when(new, F.lit(0)).otherwise(F.col("s.retry_count")),
        "created_at": F.when(new, as_of).otherwise(F.col("s.created_at")),
        "updated_at": F.when(hit | new, as_of).otherwise(F.col("s.updated_at")),
    }
    if "key" in cols:
        out["key"] = spread_nulls(F.coalesce("s.key", "e.key"), out["id"])
    for name in ("reference", "date_publication", "lien_detail"):
        out[name] = F.when(new, F.col(f"e.first.{name}")).otherwise(F.col(f"s.{name}"))
    return {c: out.get(c, F.col(f"s.{c}")) for c in cols}


def apply_effects(stored: DataFrame, effects: DataFrame, as_of: Column) -> DataFrame:
    """The table after the batch: one full outer join on the row id.

    New rows carry their hashed key as id, so they spread evenly and no null key exists.
    """
    new = F.coalesce(F.col("e.is_new"), F.lit(False))
    hit = F.coalesce(~F.col("e.is_new"), F.lit(False))
    joined = stored.alias("s").join(
        effects.alias("e"), (F.col("s.id") == F.col("e.id")) & ~F.col("e.is_new"), "full_outer")
    return joined.select(*[v.alias(k) for k, v in _merged(stored.columns, as_of, hit, new).items()])


def looked_up(effects: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """``e``, an effect, and ``s``, the stored row it hits as the last layer that has it holds it (null for a new row). All are dealt by key,
    so nothing is moved; the id is compared beside the key, not as a second key."""
    found = effects.select("key", F.struct("*").alias("e"), F.lit(None).cast(layers[0].schema).alias("s"))
    for i, layer in enumerate(reversed(layers)):
        there = layer.select(F.col("key").alias("_key"), F.struct(*layers[0].columns).alias("_s"))
        hit = (F.col("key") == F.col("_key")) & F.col("_s.id").between(F.col("e.id"), F.col("e.id")) & ~F.col("e.is_new") & F.col("s").isNull()
        found = found.join(there, hit, "left").select("key", "e", F.coalesce("s", "_s").alias("s"))
    return found


def changed_rows(stored: DataFrame, effects: DataFrame, as_of: Column, layers: list[DataFrame] | None = None) -> DataFrame:
    """Only the rows a batch touched, as they are afterwards, and the new ones.

    For a batch that is small beside the table: the stored rows are not shuffled when the counted effects
    fit a broadcast. With ``layers`` (see :func:`upsert_effects`) they never are.
    """
    if layers is not None and effects.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        new = F.col("e.is_new")
        rows = looked_up(effects, layers).filter(new | F.col("s").isNotNull())
        return rows.select(*[v.alias(k) for k, v in _merged(stored.columns, as_of, ~new, new).items()])
    known = broadcast_if_small(effects.filter(~F.col("is_new")))
    true, false = F.lit(True), F.lit(False)
    hit = stored.alias("s").join(known.alias("e"), F.col("s.id") == F.col("e.id"))
    hit = hit.select(*[v.alias(k) for k, v in _merged(stored.columns, as_of, true, false).items()])
    blank = F.struct(*[F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
    fresh = effects.filter("is_new").select(F.struct("*").alias("e"), blank.alias("s"))
    return hit.unionByName(fresh.select(*[v.alias(k) for k, v in _merged(stored.columns, as_of, false, true).items()]))


def upsert(stored: DataFrame, batch: DataFrame, as_of: Column) -> DataFrame:
    return apply_effects(stored, upsert_effects(stored, batch), as_of)


def upsert_counters(effects: DataFrame) -> DataFrame:
    return effects.agg(F.count_if(F.col("is_new")).alias("n_new"),
                       F.coalesce(F.sum("n_updated"), F.lit(0)).alias("n_updated"))
