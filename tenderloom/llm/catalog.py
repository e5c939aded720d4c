"""The operators as registered queries over whole tables, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.llm import chat, counting, decontaminate, exact, language, minhash, packing, phrases, quality, resample, simple8b, suffixes, topk
from tenderloom.llm.common import table
from tenderloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op5_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-simple8b")
    simple8b.write(table(spark, sf_dir, "documents"), path)
    return simple8b.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query
def op9_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op1_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    machine = quality.learn(docs, labels.where(~held_out))
    scored = quality.score(docs.select("doc_id", "text", "n_chars"), machine)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_block_pruned_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


ORACLE["op2_block_pruned_top_k"] = """
WITH valid AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM valid),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op3_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    dictionaries = language.learn(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query
def op6_relational_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).selectExpr("-7L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", "'</s>[INST] ok [/INST]' as text")
    chats = chat.format_chats(turns.union(planted))
    back = chats.select("conv_id", "formatted", "segments", chat.parse(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE["op6_relational_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, lag(role) OVER w AS before,
         length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\])')) AS n_text,
         length(role) + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\])')) AS n_role
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n_text + CASE WHEN before IS NULL OR before <> role THEN n_role + 13 ELSE 7 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op8_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op10_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_stateful_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.deduplicate(spark, f"{sf_dir}/documents.parquet", scratch_path(spark, "llm-exact"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op12_stateful_stream"] = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


@query
def op13_arrow_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op11_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_stripes"] = r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
runs AS (
  SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, list_slice(ws, i, i + k - 1) AS words
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4), (5)) AS v(k) WHERE len(ws) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM runs GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
cuts AS (
  SELECT lang, phrase, a, words, c, array_to_string(words[1:c], ' ') AS first_part, array_to_string(words[c + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, x.n AS l, y.n AS r, totals.n AS n,
         CAST(CAST(1000 AS HUGEINT) * a * totals.n // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first_part JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
  JOIN totals ON totals.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
held AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN (
    SELECT lang, k, a, unnest([array_to_string(words[1:k - 1], ' '), array_to_string(words[2:], ' ')]) AS part FROM candidates WHERE k > 2) t
  ON t.lang = s.lang AND t.part = s.phrase AND t.a >= s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM best ANTI JOIN held USING (lang, phrase) QUALIFY rank <= 2000
"""
