"""Quality of a text by a factorisation machine over hashed words, hashed word shapes, structure statistics and metadata.

The score is the logistic of w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j. The pairs are never listed: for each factor their sum is half of
(sum v_i x_i)^2 - sum (v_i x_i)^2, so a text costs time in proportion to its distinct features. Fitted by AdaGrad on a bounded sample of labelled
rows; only the sample's hashed features reach the driver.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import buffer_of, slices, split_words

WORD_BUCKETS, SHAPE_BUCKETS, STATS, BINS = 1 << 14, 1 << 10, 12, 16
FEATURES = WORD_BUCKETS + SHAPE_BUCKETS + STATS * BINS
FACTORS = 8
# The fitted sample: at most so many rows, half of them of either label.
SAMPLE_ROWS = 4000
EPOCHS, BATCH, RATE, PENALTY = 12, 128, 0.08, 2e-4
NEW = {"quality_score": "double"}


def features(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of all texts, one after the other, and their offsets. ``n_chars``: the stated length, the one metadatum."""
    texts = texts.fill_null("")
    n = len(texts)
    codes, words, bounds = split_words(texts)
    count = np.diff(bounds)
    row = np.repeat(np.arange(n), count)
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % WORD_BUCKETS for w in words.to_pylist()), np.int64, len(words))
    shapes = pc.replace_substring_regex(pc.replace_substring_regex(pc.replace_substring_regex(words, r"\p{Lu}+", "A"), r"\pL*\p{Ll}\pL*", "a"), r"\pN+", "9")
    shapes = shapes.dictionary_encode()
    shape_of = np.array([zlib.crc32(s.encode()) % SHAPE_BUCKETS for s in shapes.dictionary.to_pylist()], np.int64)
    shape = shape_of[shapes.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
    w_row, w_id, w_x = _normalised(row, bucket[codes] if len(codes) else codes, n, WORD_BUCKETS)
    s_row, s_id, s_x = _normalised(row, shape[codes] if len(codes) else codes, n, SHAPE_BUCKETS)
    stats = _binned(texts, codes, words, row, count, n_chars, n)
    rows = np.concatenate([w_row, s_row, np.repeat(np.arange(n), STATS)])
    ids = np.concatenate([w_id, s_id + WORD_BUCKETS, (stats + np.arange(STATS) * BINS + WORD_BUCKETS + SHAPE_BUCKETS).ravel()])
    values = np.concatenate([w_x, s_x, np.full(n * STATS, 0.4)])
    order = np.argsort(rows, kind="stable")
    return ids[order], values[order], np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])


def _normalised(row: np.ndarray, feature: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature) with the root of their counts, each row of length one."""
    both, times = np.unique(row * size + feature, return_counts=True)
    row = both // size
    length = np.bincount(row, times, n)
    return row, both % size, np.sqrt(times / length[row])


def _binned(texts, codes, words, row, count, n_chars, n) -> np.ndarray:
    """n x STATS bin numbers of structure statistics."""
    data, offsets = buffer_of(texts)
    size = np.diff(offsets)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)

    upper, lower = (data >= 0x41) & (data <= 0x5A), (data >= 0x61) & (data <= 0x7A)
    digit, beyond, white = (data >= 0x30) & (data <= 0x39), data >= 0x80, (data == 0x20) | (data == 0x0A)
    distinct = np.bincount(np.unique(row * max(1, len(words)) + codes) // max(1, len(words)), minlength=n) if len(codes) else np.zeros(n)
    lines = pc.split_pattern(texts, "\n")
    per_text = np.diff(lines.offsets.to_numpy())
    values = lines.flatten().dictionary_encode()
    in_row = np.repeat(np.arange(n), per_text)
    k = max(1, len(values.dictionary))
    own = np.bincount(np.unique(in_row * k + values.indices.to_numpy(zero_copy_only=False)) // k, minlength=n)
    length = pc.binary_length(words).to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0)
    mean = np.bincount(row, length, n) / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(0, np.bincount(row, length ** 2.0, n) / np.maximum(count, 1) - mean ** 2))
    logs = lambda x: np.log2(1 + np.maximum(x, 0))
    stats = [logs(count), logs(per_text) * 1.5, share(upper) * 30, share(digit) * 40, share(beyond) * 40, share(white) * 40,
             share(~(upper | lower | digit | beyond | white)) * 40, distinct / np.maximum(count, 1) * 15, own / np.maximum(per_text, 1) * 15,
             mean, spread, logs(np.nan_to_num(n_chars.astype(float), nan=0.0))]
    return np.clip(np.stack(stats, axis=1), 0, BINS - 1).astype(np.int64)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, ids: np.ndarray, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        vx = self.factors[ids] * x[:, None]
        sums, squares = np.add.reduceat(vx, offsets[:-1]), np.add.reduceat((vx * vx).sum(axis=1), offsets[:-1])
        return self.bias + np.add.reduceat(self.weights[ids] * x, offsets[:-1]) + 0.5 * ((sums * sums).sum(axis=1) - squares)

    def score(self, ids: np.ndarray, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(ids, x, offsets), -40, 40)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], share: float) -> Machine:
    """From (label, feature numbers, values); ``share``: how many of all labelled rows have label 1, for the bias."""
    machine = Machine(0.0, np.zeros(FEATURES), np.random.default_rng(7).normal(0, 0.02, (FEATURES, FACTORS)))
    labels = np.array([r[0] for r in rows], float)
    if len(set(labels)) < 2:
        machine.bias = 0.0 if not len(labels) else 3.0 if labels[0] else -3.0
        return machine
    g_w, g_v, order = np.full(FEATURES, 1e-2), np.full((FEATURES, FACTORS), 1e-2), np.random.default_rng(11)
    for _ in range(EPOCHS):
        shuffled = order.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = shuffled[at:at + BATCH]
            ids, x = np.concatenate([rows[i][1] for i in chosen]), np.concatenate([rows[i][2] for i in chosen])
            sizes = [len(rows[i][1]) for i in chosen]
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            error = np.repeat(machine.score(ids, x, offsets) - labels[chosen], sizes) / len(chosen)
            vx = machine.factors[ids] * x[:, None]
            sums = np.repeat(np.add.reduceat(vx, offsets[:-1]), sizes, axis=0)
            seen, where = np.unique(ids, return_inverse=True)
            d_w = np.bincount(where, error * x) + PENALTY * machine.weights[seen]
            step = (error * x)[:, None] * (sums - vx)
            d_v = np.stack([np.bincount(where, step[:, f]) for f in range(FACTORS)], axis=1) + PENALTY * machine.factors[seen]
            g_w[seen] += d_w ** 2
            g_v[seen] += d_v ** 2
            machine.weights[seen] -= RATE * d_w / np.sqrt(g_w[seen])
            machine.factors[seen] -= RATE * d_v / np.sqrt(g_v[seen])
            machine.bias -= RATE * float(error[offsets[:-1]].sum())
    # the sample has its own share of label 1
    own = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    share = min(max(share, 1e-3), 1 - 1e-3)
    machine.bias += np.log(share / (1 - share)) - np.log(own / (1 - own))
    return machine


def _stated(batch: pa.RecordBatch, chars_col: str | None) -> np.ndarray:
    if chars_col is None:
        return np.zeros(batch.num_rows)
    return batch.column(chars_col).cast(pa.float64()).to_numpy(zero_copy_only=False)


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          chars_col: str | None = "n_chars", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fits on at most ``sample_rows`` labelled rows, drawn by hash. Labels other than 0 and 1, null ids and null texts take no part."""
    known = labels.where(f"{label_col} in (0, 1) and {id_col} is not null").select(id_col, F.col(label_col).cast("int").alias("_label"))
    drawn = F.xxhash64(F.col(id_col))
    parts = [known.where(F.col("_label") == q).orderBy(drawn, id_col).limit(sample_rows // 2) for q in (0, 1)]
    share = known.agg(F.avg("_label")).first()[0]
    columns = [F.col(text_col).cast("string").alias("text"), *([F.col(chars_col).alias("n_chars")] if chars_col else [])]
    sample = docs.join(F.broadcast(parts[0].union(parts[1])), id_col).where(F.col(text_col).isNotNull()).select("_label", *columns)

    def run(batches):
        for batch in slices(batches):
            ids, x, offsets = features(batch.column("text"), _stated(batch, "n_chars" if chars_col else None))
            offsets = offsets.astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("_label"), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
                                              pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.float32)))], ["label", "ids", "x"])

    got = sample.mapInArrow(run, "label int, ids array<int>, x array<float>").toArrow().combine_chunks()
    rows = [(int(q), np.asarray(i.values, np.int64), np.asarray(x.values, float)) for q, i, x in zip(got["label"].to_pylist(), got["ids"], got["x"])]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1][:8].tolist()))     # the same model whatever the order of tasks
    return fit(rows, share if share is not None else 0.5)


def score(df: DataFrame, machine: Machine, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns with quality_score, 0 to 1; a column of that name is replaced. Null texts are scored as empty ones, by their
    statistics; repeated rows alike; a null stated length counts as 0."""
    kept = df.drop(*NEW)
    schema = kept.selectExpr("*", *(f"cast(null as {t}) {n}" for n, t in NEW.items())).schema
    model = df.sparkSession.sparkContext.broadcast(machine)     # fixed size: FEATURES x (FACTORS + 1)

    def run(batches):
        for batch in slices(batches, text_col):
            found = model.value.score(*features(batch.column(text_col), _stated(batch, chars_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, *NEW])

    return kept.mapInArrow(run, schema)
