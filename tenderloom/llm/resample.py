"""Target-distribution importance resampling: documents are drawn in proportion to how much likelier their word runs are in a target text collection.

Words are split, coded and counted by Arrow kernels, a slice of texts at a time: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode`` give a code per word; runs of words are codes paired with the codes shifted by one, made small again by the distinct pairs; only
distinct runs are spelled out and hashed (CRC-32). What both collections hold is one count per bucket, so a fixed number of rows whatever their size. The
gains of the buckets are then taken per run and reduced per document.

Scores are integers within the range of their logarithms (some 1e5 values), so the draw is ranked without a sort of all rows: documents are counted by
score, running sums over those counts give each score's first rank, and only rows that share a score are put in order.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import slices, stored

BUCKETS = 10000
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(texts: pa.Array, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each run of 1 to ``runs`` words, document it belongs to, number of words per document). Null texts have none."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), _BREAKS)
    words = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists).to_numpy()
    full = pc.not_equal(pc.binary_length(words), 0)      # breaks at either end of a text leave empty words
    words, owner = words.filter(full), owner[full.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    one, spelled_one = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    code, spelled = one, spelled_one
    found, owners = [], []
    for length in range(1, runs + 1):
        if length > 1:      # runs of one word less, and the word behind them in the same document
            inside = owner[:len(code)][:len(one) - length + 1] == owner[length - 1:]
            pairs = code[:len(inside)] * len(spelled_one) + one[length - 1:]
            distinct, code = np.unique(pairs, return_inverse=True)
            spelled = pc.binary_join_element_wise(spelled.take(pa.array(distinct // max(len(spelled_one), 1))),
                                                  spelled_one.take(pa.array(distinct % max(len(spelled_one), 1))), " ")
        else:
            inside = np.ones(len(code), bool)
        hashed = np.fromiter((zlib.crc32(x) for x in spelled.cast(pa.binary()).to_pylist()), np.int64, len(spelled)) % buckets
        found.append(hashed[code][inside])
        owners.append(owner[:len(code)][inside])
    return np.concatenate(found), np.concatenate(owners), np.bincount(owner, minlength=len(texts))


def bucket_counts(docs: DataFrame, runs: int, buckets: int) -> DataFrame:
    """(bucket, n): one row per bucket that occurs, counted per task before the shuffle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            n += np.bincount(features(batch.column(0), runs, buckets)[0], minlength=buckets)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(n[met])], ["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, runs: int, buckets: int) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of target share to source share) per bucket; ``buckets`` numbers, whatever the tables hold."""
    counts = []
    for table in (docs, target):
        held = [0] * buckets
        for row in bucket_counts(table, runs, buckets).collect():      # at most one row per bucket
            held[row.bucket] = row.n
        counts.append(held)
    s, t = counts
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, runs: int) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean of the gains over a document's features, 0 without any."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(gains)
        for batch in slices(batches):
            buckets, owner, words = features(batch.column("text"), runs, len(gains))
            order = np.argsort(owner, kind="stable") if runs > 1 else slice(None)
            taken = table.take(pa.array(buckets[order])).to_numpy()
            n = np.bincount(owner, minlength=batch.num_rows)
            total = np.concatenate([[0], np.cumsum(taken)])[np.concatenate([[0], np.cumsum(n)])]
            weight = np.where(n > 0, np.diff(total) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def _luck(doc_id: Column, seed: str) -> Column:
    """floor(1000 * a Gumbel variate) fixed by seed and id."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(df: DataFrame, target: DataFrame, percent: int = 10, runs: int = 1, buckets: int = BUCKETS, least_words: int = 20, seed: str = "2024",
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score, rank (from 1; null if not drawn).

    ``percent`` of the rows with ``least_words`` words or more are drawn, highest score first, ties to the smaller id (null first; rows that repeat id
    and score in any order). Null texts have no words. An empty target makes all its shares equal; an empty table gives an empty one. Other columns
    are not looked at.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    gains = bucket_gains(docs, target.select(F.col(text_col).cast("string").alias("text")), runs, buckets)
    score = (F.col("weight") + _luck(F.col("doc_id"), seed)).alias("score")
    scored = stored(weigh(docs, gains, runs).select("*", score, (F.col("n_words") >= least_words).alias("open")), "scored")
    at = stored(scored.where("open").groupBy("score").agg(F.count("*").alias("n")), "scores")
    above = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    at = at.select("score", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"))      # one row per different score
    drawn = scored.where("open").count() * percent // 100
    first = at.where(F.col("above") < drawn)
    places = scored.where("open").join(F.broadcast(first), "score")
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first()))
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = places.select(*columns, F.when(place <= drawn, place).cast("long").alias("rank"))
    rest = scored.join(F.broadcast(first.withColumn("open", F.lit(True))), ["score", "open"], "left_anti")
    return ranked.unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))
