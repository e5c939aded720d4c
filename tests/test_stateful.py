"""Upsert, minutes and orphans against row-by-row models; replay and wave splitting."""

import random

import pytest
from folds import minutes_fold, orphan_fold, upsert_fold
from pyspark.sql import functions as F

from tenderloom.operators import minutes, upsert
from tenderloom.session import cut_lineage
from tenderloom.sources import bindings as B
from tenderloom.streaming import ingest, state

def NOW():
    return F.lit("2024-03-10 00:00:00").cast("timestamp")


STORED = ("id long, url_id string, reference string, date_publication string, date_limite string, lien_detail string, objet string, "
          "acheteur string, hash_content string, last_seen timestamp, retry_count int, status string, created_at timestamp, updated_at timestamp")
BATCH = ("page long, row long, url_id string, reference string, date_publication string, date_limite string, lien_detail string, "
         "objet string, acheteur string, page_hash string")


def random_case(rng):
    stored = []
    for i in range(rng.randint(0, 6)):
        stored.append({"id": i + 1, "url_id": rng.choice([None, str(i), str(i)]), "reference": f"R{rng.randint(0, 3)}",
                       "objet": rng.choice(["o", "", None]), "acheteur": "a", "date_limite": "d", "hash_content": rng.choice("ab") if rng.random() < .8 else None,
                       "status": rng.choice(["DONE", "TO_SYNC", "TO_ENRICH"]), "last_seen": None})
    batch = []
    for i in range(rng.randint(1, 25)):
        batch.append({"page": rng.choice([0, 1, 255, 256, 700]), "row": i, "url_id": rng.choice(["", str(rng.randint(0, 5))]),
                      "reference": f"R{rng.randint(0, 3)}", "date_limite": f"d{i}", "objet": rng.choice(["", f"o{i}"]),
                      "acheteur": rng.choice(["", f"a{i}"]), "page_hash": rng.choice(["a", "b", None])})
    return stored, batch


def frames(spark, stored, batch):
    s = spark.createDataFrame([(r["id"], r["url_id"], r["reference"], "p", r["date_limite"], "l", r["objet"], r["acheteur"], r["hash_content"],
                                None, 1, r["status"], None, None) for r in stored], STORED)
    b = spark.createDataFrame([(r["page"], r["row"], r["url_id"], r["reference"], "p", r["date_limite"], "l", r["objet"], r["acheteur"],
                                r["page_hash"]) for r in batch], BATCH)
    return s, b


def shape(rows):
    return sorted((str(r["url_id"]), r["reference"], str(r["objet"]), r["acheteur"], r["date_limite"], str(r["hash_content"]), r["status"],
                   r["last_seen"] is not None) for r in rows)


@pytest.mark.parametrize("seed", range(6))
def test_upsert_is_the_fold(spark, seed):
    stored, batch = random_case(random.Random(seed))
    s, b = frames(spark, stored, batch)
    table, new, updated, flags = upsert_fold(stored, batch, "now")
    effects = upsert.upsert_effects(s, b)
    out = upsert.apply_effects(s, effects, NOW()).collect()
    assert shape(r.asDict() for r in out) == shape(table)
    assert len({r.id for r in out}) == len(out)
    small = state.overlay(s, upsert.changed_rows(s, effects, NOW())).collect()
    assert sorted(map(str, small)) == sorted(map(str, out))
    c = upsert.upsert_counters(effects).first()
    assert (c.n_new, c.n_updated) == (new, updated)


def test_change_flags_are_the_fold(spark):
    from tenderloom.functions.keys import tender_key
    for seed in range(3):
        stored, batch = random_case(random.Random(100 + seed))
        s, b = frames(spark, stored, batch)
        seeds = s.withColumn("key", tender_key(F.col("url_id"), F.col("reference"))).select("key", "id", "hash_content")
        got = {(r.page, r.row): r.is_change for r in upsert.change_flags(b, seeds).collect()}
        order = sorted(batch, key=lambda r: (r["page"], r["row"]))
        assert [got[(r["page"], r["row"])] for r in order] == upsert_fold(stored, batch, "now")[3]


@pytest.mark.parametrize("seed", range(4))
def test_minutes_are_the_fold(spark, seed):
    rng = random.Random(seed)
    row = lambda i: {"seq": i, "tender_id": i, "reference": f"R{i}", "pdf_url": rng.choice(["", "u1", "u2", "u3", "u4"]), "procedure_type": "p",
                     "date_publication": rng.choice(["", f"d{i}"])}
    first, second = [row(i) for i in range(8)], [row(i) for i in range(8, 30)]
    ddl = "seq long, tender_id long, reference string, pdf_url string, procedure_type string, date_publication string"
    df = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], ddl)
    empty = spark.createDataFrame([], "id long, tender_id long, reference string, pdf_url string, pdf_path string, procedure_type string, "
                                      "date_publication string, hash_pdf string, synced_to_sheets int, created_at timestamp, updated_at timestamp")
    one = minutes.save_minutes(empty, df(first), NOW())
    two = minutes.save_minutes(one, df(second), NOW())
    want = minutes_fold(minutes_fold([], first), second)
    keep = ["hash_pdf", "tender_id", "reference", "pdf_url", "procedure_type", "date_publication"]
    assert sorted(tuple(r[k] for k in keep) for r in two.collect()) == sorted(tuple(r[k] for k in keep) for r in want)
    laid = state.overlay(one, minutes.saved_rows(one, df(second), NOW()))
    assert sorted(map(str, laid.collect())) == sorted(map(str, two.collect()))
    again = minutes.save_minutes(two, df(second), NOW())
    assert sorted(map(str, again.collect())) == sorted(map(str, two.collect()))


def orphan_result(spark, tenders, batch):
    t = spark.createDataFrame([(x["id"], x["url_id"], x["reference"], x["created"]) for x in tenders],
                              "id long, url_id string, reference string, created_at int")
    c = spark.createDataFrame([(r["seq"], f"?refConsultation={r['uid']}" if r["uid"] else "", r["reference"], "o", "pdf") for r in batch],
                              "seq long, lien string, reference string, objet string, pv_pdf_url string")
    linked, orphans = minutes.link_with_orphans(c, t)
    founded = {r.id: r.seq for r in orphans.collect()}
    return {r.seq: ("new", founded[r.tender_id]) if r.tender_id in founded else r.tender_id for r in linked.collect()}, sorted(founded.values())


@pytest.mark.parametrize("seed", range(5))
def test_orphans_are_the_fold(spark, seed):
    rng = random.Random(seed)
    tenders = [{"id": i + 1, "url_id": rng.choice([None, str(i)]), "reference": f"R{rng.randint(0, 12)}", "created": rng.randint(0, 3)} for i in range(5)]
    batch = [{"seq": i, "uid": rng.choice(["", str(rng.randint(0, 12))]), "reference": f"R{rng.randint(0, 12)}"} for i in range(40)]
    assert orphan_result(spark, tenders, batch) == orphan_fold(tenders, batch)


def test_orphan_golden_rows(spark):
    rows = lambda *pairs: [{"seq": i, "uid": u, "reference": r} for i, (u, r) in enumerate(pairs)]
    assert orphan_result(spark, [], rows(("1", "R"), ("2", "R")))[1] == [0]
    links, founders = orphan_result(spark, [], rows(("1", "R"), ("1", "S"), ("2", "S")))
    assert founders == [0, 2] and links[1] == ("new", 0)
    links, founders = orphan_result(spark, [], rows(("", "R"), ("1", "R"), ("1", "S")))
    assert founders == [0, 2] and links[1] == ("new", 0)


def test_a_chain_of_a_thousand_orphans_takes_few_steps(spark):
    """Each row shares its number with one neighbour and its reference with the other; a ladder of rows with two earlier ones comes beside it."""
    chain = [{"seq": i, "uid": f"u{(i + 1) // 2}", "reference": f"r{i // 2}"} for i in range(1000)]
    rng = random.Random(3)
    ladder = [{"seq": 1000 + i, "uid": f"v{rng.randint(i // 4, i // 4 + 3)}", "reference": f"s{rng.randint(i // 4, i // 4 + 3)}"} for i in range(60)]
    df = spark.createDataFrame([(r["seq"], r["uid"], r["reference"], "", "") for r in chain + ladder], "seq long, uid string, reference string, lien string, objet string")
    for rows, most in ((chain, 2), (chain + ladder, 12)):
        steps = []
        founders = minutes.choose_orphans(df.filter(F.col("seq") < len(rows)), lambda step, left: steps.append(step))
        assert sorted(r.seq for r in founders.collect()) == orphan_fold([], rows)[1] and len(steps) <= most


def test_orphans_over_the_given_tables(spark, sf):
    """Brute force over the whole derived tables."""
    tenders = [{"id": r.id, "url_id": r.url_id, "reference": r.reference, "created": r.created_at}
               for r in B.stored_tenders(spark, sf).select("id", "url_id", "reference", "created_at").collect()]
    rows = minutes.with_uid(minutes.with_address(B.pv_candidates(spark, sf))).select("seq", "uid", "reference").collect()
    links, founders = orphan_fold(tenders, [r.asDict() for r in rows])
    linked, orphans = minutes.link_with_orphans(B.pv_candidates(spark, sf), B.stored_tenders(spark, sf))
    founded = {r.id: r.seq for r in orphans.collect()}
    assert sorted(founded.values()) == sorted(founders)
    assert {r.seq: ("new", founded[r.tender_id]) if r.tender_id in founded else r.tender_id for r in linked.collect()} == links


def test_state_is_compacted(spark, tmp_path, monkeypatch):
    """Change sets over a base, before and after the base is written anew, with one batch run twice."""
    monkeypatch.setattr(state, "COMPACT_EVERY", 3)
    ddl = "id long, x string"
    initial = spark.createDataFrame([(i, "old") for i in range(5)], ddl)
    want = {i: "old" for i in range(5)}
    for n in range(8):
        rows = [(n % 5, f"n{n}"), (100 + n, f"new{n}")]
        want.update(rows)
        for _ in range(2 if n in (2, 4) else 1):
            state.write(spark.createDataFrame(rows, ddl), str(tmp_path), "t", n, initial)
        assert {r.id: r.x for r in state.read(spark, str(tmp_path), "t", n, initial).collect()} == want
    assert sorted(p.name for p in (tmp_path / "t" / "base").iterdir()) == ["v=2", "v=5"]


def test_replayed_batch_changes_nothing(spark, sf, tmp_path):
    initial = B.stored_tenders(spark, sf)
    now = F.lit("1998-06-15").cast("timestamp_ntz")
    step = ingest.listing_step(str(tmp_path), initial, now)
    batch = B.listing_batch(spark, sf)
    first, second = batch.filter("page < 1200"), batch.filter("page >= 1200")
    step(first, 0)
    step(second, 1)
    read = lambda v: sorted(map(str, state.read(spark, str(tmp_path), "tenders", v, initial).collect()))
    log = lambda: sorted(map(str, ingest.change_log(spark, str(tmp_path)).collect()))
    table, events = read(1), log()
    step(second, 1)
    assert read(1) == table and log() == events
    whole = upsert.upsert(initial, batch, now)
    assert sorted(map(str, whole.collect())) == table


def test_a_number_given_later_leaves_the_reference_free(spark):
    """Listing, backfill and listing again, three times over: no two rows share an id, in a table and in a stream's state."""
    from tenderloom.operators import enrichment
    row = lambda page: spark.createDataFrame([(page, 0, "", "REF1", "p", "d", f"x?refConsultation={page}", "o", "a", f"h{page}")], BATCH)
    table = laid = spark.createDataFrame([], STORED)
    held = lambda df: spark.createDataFrame(df.collect(), STORED)
    for n in range(3):
        table = held(enrichment.backfill_url_id(held(upsert.upsert(table, row(n), NOW()))))
        effects = upsert.upsert_effects(laid, row(n))
        laid = held(enrichment.backfill_url_id(held(state.overlay(laid, upsert.changed_rows(laid, effects, NOW())))))
    rows = table.collect()
    assert sorted(r.url_id for r in rows) == ["0", "1", "2"] and len({r.id for r in rows}) == 3
    assert sorted(map(str, laid.collect())) == sorted(map(str, rows))


def test_an_idle_run_keeps_the_version(spark, sf, tmp_path):
    initial = B.stored_tenders(spark, sf)
    landed, root = str(tmp_path / "in"), str(tmp_path / "state")
    now = F.lit("1998-06-15").cast("timestamp_ntz")
    batch = B.listing_batch(spark, sf)
    run = lambda: ingest.run_available(ingest.landing(spark, landed, batch.schema), ingest.listing_step(root, initial, now), root, "listing")
    (tmp_path / "in").mkdir()
    assert run() == 0
    batch.filter("page < 1200").write.mode("append").parquet(landed)
    assert run() == 1 == run()
    batch.filter("page >= 1200").write.mode("append").parquet(landed)
    assert run() == 2 == run()
    whole = upsert.upsert(initial, batch, now)
    assert sorted(map(str, state.latest(spark, root, "tenders", initial, 2).collect())) == sorted(map(str, whole.collect()))


def test_orphans_are_looked_up_by_pair(spark, tmp_path, monkeypatch):
    """A number and reference are looked up once, however many candidates share them; the candidates all come back."""
    written = {}
    monkeypatch.setattr(minutes, "cut_lineage", lambda df, label="cut": written.setdefault(label, df) if label == "linked" else cut_lineage(df, label))
    c = spark.range(400).selectExpr("id AS seq", "concat('?refConsultation=', id % 4) AS lien", "concat('R', id % 4) AS reference",
                                    "'o' AS objet", "'pdf' AS pv_pdf_url")
    t = spark.createDataFrame([(7, "1", "X", 0), (8, None, "R2", 0)], "id long, url_id string, reference string, created_at int")
    linked, orphans = minutes.link_with_orphans(c, t)
    assert written["linked"].count() == 4
    founders = {r.seq: r.id for r in orphans.collect()}
    want = [founders[0], 7, 8, founders[3]]
    assert sorted(founders) == [0, 3] and {r.seq: r.tender_id for r in linked.collect()} == {i: want[i % 4] for i in range(400)}


def test_a_few_columns_of_the_state_are_read_alone(spark, tmp_path):
    """The newest change of an id, with the other columns neither read nor moved."""
    initial = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, s string, wide string")
    for n in range(2):
        state.write(spark.createDataFrame([(2, f"b{n}", "z"), (3 + n, "new", "z")], initial.schema), str(tmp_path), "t", n, initial)
    narrow = state.read(spark, str(tmp_path), "t", 1, initial, ["id", "s"])
    assert {tuple(r) for r in narrow.collect()} == {(1, "a"), (2, "b1"), (3, "new"), (4, "new")}
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    read = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line]
    assert read and not any("wide" in schema for schema in read)


def plan_without_broadcasts(spark, make):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_state_held_by_key_is_never_moved(spark, tmp_path, monkeypatch):
    """Change sets over a base in buckets: the rows that a state moved by id has, one batch run twice, and a base written anew."""
    monkeypatch.setattr(state, "COMPACT_EVERY", 3)
    ddl, buckets = "id long, x string, key string", state.Buckets(4)
    rows = lambda some: spark.createDataFrame([(i, x, f"k{i // 2}") for i, x in some], ddl)
    initial = state.write_buckets(rows([(i, "old") for i in range(6)]), str(tmp_path / "first"), buckets)
    want = {i: "old" for i in range(6)}
    for n in range(3):
        some = [(n, f"n{n}"), (100 + n, f"new{n}")]
        want.update(some)
        for _ in range(2 if n == 1 else 1):
            state.write(rows(some * 2 if n == 0 else some), str(tmp_path), "t", n, initial, buckets)     # an id twice in one set
        held = state.latest(spark, str(tmp_path), "t", initial, n + 1, buckets)
        assert sorted((r.id, r.x) for r in held.collect()) == sorted(want.items())
    read = lambda: state.read(spark, str(tmp_path), "t", 1, initial, ["id", "x"], state.Buckets(4, repeats=False))
    plan = plan_without_broadcasts(spark, read)
    assert plan.count("LeftAnti") == 3 and "Exchange" not in plan


def test_rows_of_a_batch_are_moved_once_to_a_state_held_by_key(spark, tmp_path, monkeypatch):
    """The effects and the changed rows of stored tables that are moved, with one move of the batch, one of the references that were left
    (as sums), and none of the stored rows. A key with most of the rows is cut into blocks of pages all the same."""
    stored, batch = random_case(random.Random(3))
    batch += [{"page": p, "row": 0, "url_id": "1", "reference": "R1", "date_limite": f"d{p}", "objet": f"o{p % 3}", "acheteur": "", "page_hash": "abc"[p % 7 % 3]}
              for p in range(0, 900, 9)]
    s, b = map(cut_lineage, frames(spark, stored, batch))
    held, buckets = ingest.held_by_key(s, str(tmp_path / "s"), 4)
    shown = lambda e: sorted(str(r) for r in e.withColumn("first", F.when(F.col("is_new"), F.col("first"))).select(
        "id", "key", "is_new", "first", "new_hash", "n_updated", "limit_set", "objet_set", "acheteur_set").collect())
    plain = cut_lineage(upsert.upsert_effects(s, b))
    plan = plan_without_broadcasts(spark, lambda: upsert.upsert_effects(held, b, [held], 4))
    assert plan.count("Exchange ") <= 3 and "hashpartitioning(key#" not in "".join(x for x in plan.splitlines() if "Exchange" in x and "block" in x)
    effects = state.write_buckets(upsert.upsert_effects(held, b, [held], 4), str(tmp_path / "e"), buckets)
    assert shown(effects) == shown(plain)
    monkeypatch.setattr(upsert, "BROADCAST_ROWS", 0)
    rows = lambda: upsert.changed_rows(held, effects, NOW(), [held])
    assert sorted(map(str, rows().drop("key").collect())) == sorted(map(str, upsert.changed_rows(s, plain, NOW()).collect()))
    assert "Exchange" not in plan_without_broadcasts(spark, rows)
    monkeypatch.setattr(upsert, "CROWDED_ROWS", 50)
    monkeypatch.setattr(upsert, "BINS", 64)
    assert shown(upsert.upsert_effects(held, b, [held], 4)) == shown(plain)
    assert len(upsert._crowded(b.withColumn("key", upsert.tender_key(F.col("url_id"), F.col("reference"))))) == 1


def test_an_id_of_two_keys_is_not_held_by_key(spark, tmp_path):
    rows = [{"id": 1, "url_id": u, "reference": "R", "date_limite": "d", "objet": "o", "acheteur": "a", "hash_content": "h", "status": "DONE"} for u in "12"]
    initial, buckets = ingest.held_by_key(frames(spark, rows, [])[0], str(tmp_path / "s"), 4)
    assert buckets is None and "key" not in initial.columns and initial.count() == 2


def test_hashes_are_packed_without_loss(spark):
    from tenderloom.functions.keys import packed, unpacked
    texts = ["", "é", "0" * 32, "ab" * 16, "AB" * 16, "ab" * 32, "a" * 33, "ab" * 16 + "\n", "\u0001" + "x" * 15, None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    got = rows.select("t", unpacked(F.col("p")).alias("u"), F.length("p").alias("n"), "p").collect()
    assert all(r.t == r.u for r in got) and len({bytes(r.p) for r in got if r.p is not None}) == len(texts) - 1
    assert [r.n for r in got if r.t in ("ab" * 16, "ab" * 32)] == [17, 33]
