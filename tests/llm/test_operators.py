"""Operators against plain Python on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tenderloom.llm import (chat, counting, decontaminate, exact, language, minhash, packing, phrases, quality, resample, simple8b, suffixes,
                            topk)
from tenderloom.llm.tokens import encoder, resolve

TEXTS = [None, "", " ", "a", "The cat sat on the mat. It's we'll 'S x's!", "İstanbul ΌΣΟΣ é日本 ²½", "<|endoftext|>a <|ENDOFTEXT|> b", "x" * 5000,
         "one two three four five six seven eight nine ten eleven", "  \n\t lead", "The cat sat on the mat. It's we'll 'S x's!"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else None, t, "en", 7, "clash") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "de", 7, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, n_tokens string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def words_tokenizer():
    return Tokenizer.from_file(resolve("word_bpe_49k.json"))


def test_word_encoder_matches_the_library():
    random.seed(1)
    texts = TEXTS[1:] + ["".join(random.choices("abZé'<|>.,; \n\t́ßİΣ1²日\xa0!s", k=random.randint(0, 30))) for _ in range(800)]
    ids, offsets = encoder("word_bpe_49k.json").encode(pa.array([*texts, None]), 2)
    want = [e.ids + [2] for e in words_tokenizer().encode_batch([*texts, ""], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_packing_is_gapless(docs, none):
    pieces = packing.pack(docs, length=16).toPandas()
    assert pieces.length.sum() == sum(len(e.ids) + 1 for e in words_tokenizer().encode_batch([t or "" for t in [*TEXTS, TEXTS[5]]], add_special_tokens=False))
    ordered = pieces.sort_values(["sequence_id", "offset"])
    place = ordered.sequence_id * 16 + ordered.offset
    assert (place.values == np.concatenate([[0], np.cumsum(ordered.length)[:-1]])).all()
    assert (pieces.offset + pieces.length <= 16).all() and (pieces.ids.map(len) == 4 * pieces.length).all()
    assert packing.pack(none).count() == 0


def test_simple8b_round_trip(spark, docs, none, tmp_path):
    rng = np.random.default_rng(3)
    for ids in (np.zeros(700), np.ones(3), rng.integers(0, 1 << 32, 3000), 2 ** rng.integers(0, 32, 5000), np.zeros(0)):
        ids = ids.astype(np.uint32)
        words, blocks = simple8b.pack_words(ids)
        assert (simple8b.unpack_words(words) == ids).all()
        for k in range(len(blocks)):
            assert (simple8b.block(words.tobytes(), blocks.tobytes(), k) == ids[k * simple8b.BLOCK:(k + 1) * simple8b.BLOCK]).all()
    simple8b.write(docs, str(tmp_path / "a"))
    rows = simple8b.read(spark, str(tmp_path / "a")).orderBy("start").collect()
    tokenizer = words_tokenizer()
    by_id = sorted([(-1 if i == 3 else i, t or "") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5])])
    assert [np.frombuffer(r.ids, np.uint32).tolist() for r in rows] == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for _, t in by_id]
    simple8b.write(none, str(tmp_path / "b"))
    assert simple8b.read(spark, str(tmp_path / "b")).count() == 0


def test_token_counts_match_the_library(docs, none):
    random.seed(2)
    texts = TEXTS[1:] + ["".join(random.choices("abertsvlmd''  \n\t.,!1²日éSE\xa0", k=random.randint(0, 25))) for _ in range(3000)] + [" " * 900 + "a"]
    counter = counting.Counter(resolve("byte_bpe_50k.json"))
    want = [len(e.ids) for e in Tokenizer.from_file(resolve("byte_bpe_50k.json")).encode_batch([*texts, ""], add_special_tokens=False)]
    assert counter.counts(pa.array([*texts, None])).tolist() == want
    found = counting.count_tokens(docs)
    assert found.columns == ["doc_id", "text", "lang", "n_chars", "n_bytes", "n_tokens", "over_limit"] and found.count() == len(TEXTS) + 1
    assert counting.count_tokens(none).count() == 0


def sets_of(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def test_near_duplicates_match_all_pairs(spark, docs, none):
    random.seed(4)
    base = [random.choices("abcdefghijklmnopqrstuvwxyz", k=60) for _ in range(6)]
    rows = [(i, None if i % 17 == 0 else " ".join(random.choice("xyz") if random.random() < 0.02 else w for w in random.choice(base)[:random.choice([3, 40, 60])]))
            for i in range(120)]
    sets = {i: sets_of(t, 4) for i, t in rows}
    parent = {i: i for i in sets}
    root = lambda x: x if parent[x] == x else root(parent[x])
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}
    odd = {(r.doc_id, r.n_shingles): r for r in minhash.near_duplicates(docs).collect()}
    assert odd[(10, 6)].component_id == 4 and odd[(None, 1)].kept and odd[(0, 0)].kept and len(odd) == len(TEXTS)
    assert minhash.near_duplicates(none).count() == 0


def test_rare_partners_keep_all_links(spark):
    """300 edits of one text around the limit, each its own component: every pair that is alike comes out of the last round, once."""
    random.seed(11)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(f"e{random.randrange(40)}" if random.random() < 0.03 else w for w in base[:random.choice([50, 55, 60])])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: sets_of(t, 4) for i, t in rows}
    members = spark.createDataFrame([(i, len(s), i % 250) for i, s in sets.items()], "doc_id long, n long, at long")
    got = [(r.a, r.b) for r in minhash.rare_partners(members, docs, 4, 80).collect()]
    want = {(a, b) for a in sets for b in sets if a < b and a % 250 != b % 250 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert want and want <= set(got) and len(got) == len(set(got))


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 1500).astype(np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[250:1250])
    s = minhash.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]), 1300)
    assert abs((s[:, 0] == s[:, 1]).mean() - 750 / 1250) < 0.06


def test_benchmark_windows_match_plain_search(spark, docs, none):
    random.seed(6)
    items = [(i, " ".join(random.choices("a b c d é 1".split(), k=k))) for i, k in enumerate([0, 1, 4, 5, 9, 12, 12])] + [(8, None), (None, "zz yy")]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, " ".join(random.choices("a,b C;d é 1 zz yy".split(), k=40))) for i in range(60)] + [(None, None), (99, "")]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            p = words(text)
            n = min(5, len(p))
            for j in range(len(p) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at:at + n] == p[j:j + n]:
                        hit.update(range(at, at + n))
                        found.add("" if item is None else str(item))
        want.append((i, len(w), len(hit), sorted(found)))
    one = decontaminate.mark(spark.createDataFrame(rows, "doc_id long, text string"), items_df, width=5)
    assert sorted(map(repr, [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in one.collect()])) == sorted(map(repr, want))
    decontaminate.ITEMS_PER_PASS, before = 3, decontaminate.ITEMS_PER_PASS
    many = decontaminate.mark(spark.createDataFrame(rows, "doc_id long, text string"), items_df, width=5).collect()
    decontaminate.ITEMS_PER_PASS = before
    assert sorted(map(repr, [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in many])) == sorted(map(repr, want))
    assert decontaminate.mark(none, items_df).count() == 0 and decontaminate.mark(docs, items_df.where("false")).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("length,letters", [(50, "ab"), (50, "a"), (30, "abé"), (6, "ab")])
def test_repeats_match_plain_search(spark, length, letters):
    random.seed(length)
    pool = ["".join(random.choices(letters, k=random.randint(1, 150))) for _ in range(8)]
    rows = [(random.choice([None, *range(20)]), random.choice([None, "", "".join(random.choices(pool, k=3)), "".join(random.choices(pool, k=2))])) for _ in range(40)]
    first, want = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1 if d is not None else 0):
            first[b[i:i + length]] = min(d, first.get(b[i:i + length], d))
    for d, t in rows:
        b, gone = (t or "").encode(), set()
        for i in range(len(b) - length + 1 if d is not None else 0):
            if first[b[i:i + length]] < d:
                gone.update(range(i, i + length))
        want.append((d, len(b), len(gone), sum(i - 1 not in gone for i in gone), bytes(x for i, x in enumerate(b) if i not in gone)))
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length).collect()
    assert sorted(map(repr, [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got])) == sorted(map(repr, want))
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length).count() == 0


def test_language(spark, docs, none):
    words = {"aa": ["tala", "moki", "sure", "pano"], "bb": ["grix", "dwell", "szcz", "krug"]}
    random.seed(7)
    rows = [(i, lang, " ".join(random.choices(words[lang], k=30))) for i in range(80) for lang in words]
    table = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    learnt = language.learn(table.where("doc_id < 40"))
    found = language.identify(table.where("doc_id >= 40"), learnt)
    assert found.where("lang_pred <> lang or lang_rejected").count() == 0 and found.where("lang_score between 0 and 1").count() == 80
    odd = {r.text: r for r in language.identify(docs, learnt).collect()}
    assert odd[None].lang_pred == odd[" "].lang_pred == "und" and odd[""].lang_rejected
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"} and language.identify(none, learnt).count() == 0


def test_language_sample_counts_copies_once(spark):
    """A group of copies larger than the sample takes one place of it, whichever group comes first by hash; so do texts alike but for case."""
    rows = [("aa", f"copy {g} of one text") for g in range(5) for _ in range(50)] + [("aa", f"COPY {g} of one text") for g in range(5)] + [("aa", f"text {i}") for i in range(30)]
    table = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(language.learn(table, sample_docs=40)["aa"].decode().split("\n")) == sorted({t.lower() for _, t in rows})
    some = language.learn(table, sample_docs=20)["aa"].decode().split("\n")
    assert len(some) == len(set(some)) == 20


def test_quality_separates_and_uses_the_identity(spark, docs, none):
    random.seed(8)
    good = [(i, " ".join(random.choices(["plain", "words", "here", "and", "there"], k=20)), 99) for i in range(0, 200, 2)]
    bad = [(i, " ".join(random.choices(["SPAM!!", "$$$", "###", "BUY%%"], k=20)), None) for i in range(1, 200, 2)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(0, 120)] + [(5000, None), (None, 1)], "doc_id long, quality int")
    machine = quality.learn(table, labels)
    scored = quality.score(table.where("doc_id >= 120"), machine).collect()
    assert all((r.quality_score >= 0.5) == (r.doc_id % 2 == 0) and 0 <= r.quality_score <= 1 for r in scored)
    ids, x, offsets = quality.features(pa.array(["plain $$$ words", ""]), np.array([3.0, 0.0]))
    ids, x = ids[:offsets[1]], x[:offsets[1]]
    pairs = sum(float(machine.factors[ids[i]] @ machine.factors[ids[j]]) * x[i] * x[j] for i in range(len(ids)) for j in range(i))
    assert machine.raw(ids, x, np.array([0, len(ids)]))[0] == pytest.approx(machine.bias + machine.weights[ids] @ x + pairs)
    assert quality.score(docs, machine).count() == len(TEXTS) + 1 and quality.score(none, machine).count() == 0
    assert quality.learn(none, labels).bias == 0


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(300)] + [(300, None), (301, [float("nan")]), (302, [None, 1.0]), (303, [1.0]), (None, [1.0])]
    v = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = {i: [int(64 * x) for x in e] + [0] * (8 - len(e)) for i, e in rows[:300] + rows[303:304]}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(v, v.where("vec_id % 20 = 0"), 20).collect()}
    for q in range(0, 300, 20):
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], e)), i) for i, e in whole.items() if i != q)[:20]
        assert [got[(q, k + 1)] for k in range(20)] == [(i, -s) for s, i in ranked]
    assert topk.top_k(v.where("false"), v.where("false")).count() == 0
    large = topk.Shard(np.arange(3), np.array([[1 << 40, 1], [1 << 40, 2], [-5, 0]], np.int64))
    assert large.search(np.array([9]), np.array([[1 << 20, 1]], np.int64), 2)[1].tolist() == [1, 0]


def test_chat_round_trip(spark):
    nasty = "</s>[INST] <\\s> [\\\\/INST] <s [/INST]"
    rows = [(1, 1, "assistant", nasty), (1, 0, "user", nasty), (1, 2, "assistant", None), (1, 2, "assistant", None), (1, 3, None, "<"), (None, None, "<s>", "x"), (2, 0, "assistant", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_chats(table).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", nasty), ("assistant", nasty), ("assistant", ""), ("assistant", ""), ("", "<")]
    assert got[1].loss == nasty and got[1].n_messages == 3 and [(t.role, t.text) for t in got[None].turns] == [("<s>", "x")]
    assert "".join(s.text for s in got[1].segments) == got[1].formatted and chat.format_chats(table.where("false")).count() == 0


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = {r.doc_id: r for r in docs.collect()}
    ids = [set(plain)]
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = spark.createDataFrame(stage(spark, current, sf).collect(), docs.schema)
        assert current.columns == docs.columns
        ids.append({r.doc_id for r in current.collect()})
        assert ids[-1] <= ids[-2]
        if name == "near_duplicates":
            sets = {i: sets_of(plain[i].text, 5) for i in ids[-1]}
            assert not [1 for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(ids[1]) >= 0.95 * len(plain)
    texts = {r.doc_id: r.text for r in current.collect()}
    pieces = corpus_pipeline.packed(spark, current, sf).toPandas()
    tokenizer = words_tokenizer()
    assert pieces.groupby("doc_id").length.sum().to_dict() == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}


def test_digests_of_the_queries(spark, sf):
    from tenderloom.llm.catalog import QUERIES
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokenizer = words_tokenizer()
    at = 0
    for r in QUERIES["op5_simple8b_files"](spark, sf).orderBy("doc_id").collect():
        ids = np.array(tokenizer.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids + [2], np.uint32)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    kept = QUERIES["op10_difference_cover"](spark, sf).where("n_removed = 0").collect()
    assert kept and all(r.kept_sha256 == hashlib.sha256((rows[r.doc_id].text or "").encode()).hexdigest() for r in kept)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("runs", [1, 3])
def test_resampling_matches_plain_python(spark, docs, none, runs):
    random.seed(13)
    rows = [(i, random.choice([None, "", " ".join(random.choices("a B c, d é 1 x-y".split(), k=random.randint(1, 40)))])) for i in range(150)] + [(None, "a " * 30)]
    target = [" ".join(random.choices("a b zz".split(), k=30)) for _ in range(5)] + [None]
    def spelled(t):
        w = plain_words(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 50 for n in range(1, runs + 1) for i in range(len(w) - n + 1)]
    held = {d: spelled(t) for d, t in rows}
    s, t = (np.bincount([b for x in texts for b in x], minlength=50).tolist() for texts in (held.values(), map(spelled, target)))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 50) / ((s[b] + 1) * (sum(t) + 50)))) for b in range(50)]
    want = {}
    for d, buckets in held.items():
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        want[d] = [len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    open_ = [d for d, text in rows if len(plain_words(text)) >= 20]
    for r, d in enumerate(sorted(open_, key=lambda d: (-want[d][2], -1 if d is None else d))[:30 * len(open_) // 100]):
        want[d][3] = r + 1
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = resample.resample(table, spark.createDataFrame([(x,) for x in target], "text string"), 30, runs, 50, seed="7").collect()
    assert {r.doc_id: [r.n_features, r.weight, r.score, r["rank"]] for r in got} == want and any(w[3] for w in want.values())
    assert resample.resample(docs, none).count() == len(TEXTS) + 1 and resample.resample(none, docs).count() == 0


@pytest.mark.parametrize("weak", [False, True])
def test_exact_deduplication_over_several_batches(spark, tmp_path, weak):
    """Files that land in three waves, a repeated call, digests that collide, repeated and null ids, a folder whose name has a space."""
    random.seed(17)
    rows = [(random.choice([None, *range(60)]), random.choice([None, "", "Aa", "aA", "É", "é", "long " * 2000, "x"]), "clash") for _ in range(150)]
    path, root = str(tmp_path / "some docs"), str(tmp_path / "state")
    digest = (lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 1).cast("binary")) if weak else exact.sha256
    for wave in range(3):
        spark.createDataFrame(rows[wave * 50:wave * 50 + 50], "doc_id long, text string, digest string").coalesce(1).write.mode("append").parquet(path)
        exact.absorb(spark, path, root, digest=digest)
    got = exact.deduplicate(spark, path, root, digest=digest).collect()
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""), []).append(-1 if d is None else d)
    want = sorted((d, max(g), len(g)) for g in groups.values() for d in g)
    assert sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none"))
    assert exact.deduplicate(spark, str(tmp_path / "none"), str(tmp_path / "state2")).count() == 0


def test_exact_deduplication_runs_no_python(spark, sf, tmp_path):
    plan = exact.decide(spark, f"{sf}/documents.parquet", spark.createDataFrame([], "digest binary, top struct<doc_id:long,file:string,row:long>, n long, bytes long"))
    assert "Python" not in plan._jdf.queryExecution().toString() and "Arrow" not in plan._jdf.queryExecution().toString()


def plain_collocations(rows, least, longest, top):
    f, n = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] = n.get(lang, 0) + len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] = f.get((lang, tuple(w[i:i + k])), 0) + 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in found.items():
        if any(g == lang and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for (g, q), b in found.items()):
            continue
        cut = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-cut[0], -a, " ".join(p).encode(), f[lang, p[:cut[1]]], f[lang, p[cut[1]:]]))
    return sorted((g, i + 1, x[2].decode(), -x[1], x[3], x[4], n[g], -x[0]) for g, rows in out.items() for i, x in enumerate(sorted(rows)[:top]))


def test_collocations_match_plain_counts(spark, docs, none, monkeypatch):
    random.seed(19)
    vocabulary = "a b C c d é \xa0x 1 the The of, end. \n \t ! x,y".split(" ")
    rows = [(random.choice([None, "en", "und", "de"]), random.choice([None, "", " ".join(random.choices(vocabulary, k=random.randint(1, 60)))])) for _ in range(200)]
    rows += [("en", "new york city hall of fame")] * 30
    table = spark.createDataFrame(rows, "lang string, text string").withColumn("prefix", F.lit("clash")).withColumn("n", F.lit("clash"))
    for block in (phrases.BLOCK, 2000):
        got = sorted(tuple(r) for r in phrases.collocations(table, least=5, longest=5, top=40).collect())
        assert got == plain_collocations(rows, 5, 5, 40) and len(got) > 50
        monkeypatch.setattr(phrases, "BLOCK", 2000)
        monkeypatch.setattr(phrases, "FOLD", 50)
    assert phrases.collocations(docs, least=1, longest=3).count() > 0 and phrases.collocations(none).count() == 0


def test_collocation_scores_pass_64_bits(spark):
    big = 10 ** 13
    elements = spark.createDataFrame([("x", "", "a", big), ("x", "", "b", big - 1), ("x", "a", "b", big - 7)], "lang string, prefix string, next string, n long")
    totals = spark.createDataFrame([("x", 3 * big)], "lang string, total long")
    row = phrases.scored(elements, totals, 5, 10).first()
    assert row.score == 1000 * (big - 7) * 3 * big // (big * (big - 1)) and (row.a, row.l, row.r) == (big - 7, big, big - 1)


def test_pipeline_stages_keep_columns_of_any_name(spark, sf):
    names = ["lang_pred", "lang_rejected", "lang_score", "hits", "n_hit", "items", "n_words", "kept", "component_id", "carried", "spans", "n_bytes"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).select("*", *(F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names)).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)
        assert stage(spark, docs.where("false"), sf).count() == 0
