"""Benchmark passages in documents by Wu-Manber search over words.

Test strings are windows of ``width`` consecutive words of a benchmark item (a shorter item is one window). For each window length a shift
table over blocks of two words says how far the search may jump: a block that no window holds is skipped with all windows
that would cover it. Where the shift is nought, the window's last block and its hash select the test strings, and their words are
compared one by one. Texts are searched in lanes side by side. The items of one pass are bounded by ``ITEMS_PER_PASS``; more items make
more passes over the same rows, chained without a shuffle, so tables in memory and broadcasts stay bounded.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import buffer_of, slices, split_words, string_array

ITEMS_PER_PASS = 20_000
# Window ends that one lane looks at; only speed depends on it.
LANE = 256
_WORD_BYTES = np.array([b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
                        for b in range(256)], np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes, distinct words, offsets: runs of digits, letters (A-Z lower-cased) and anything beyond ASCII."""
    data, offsets = buffer_of(texts)
    return split_words(string_array(_WORD_BYTES[data], offsets))


def _block_slot(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    return (((left.astype(np.uint64) * _STEP + right.astype(np.uint64)) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


class Windows:
    """All distinct windows of one length: shift table, test strings by suffix bucket and window hash."""

    def __init__(self, windows: dict[tuple[int, ...], set[str]], length: int) -> None:
        self.length = length
        self.block = min(2, length)
        rows = np.array(list(windows), np.int32).reshape(len(windows), length)
        self.bits = min(24, max(10, int(np.ceil(np.log2(max(2, rows.size)))) + 3))
        self.shift = np.full(1 << self.bits, length - self.block + 1, np.int16)
        for end in range(self.block - 1, length):
            np.minimum.at(self.shift, self._slots(rows, end), length - 1 - end)
        keys = self._keys(rows, self._slots(rows, length - 1))
        order = np.argsort(keys, kind="stable")
        self.rows, self.keys = rows[order], keys[order]
        items = list(windows.values())
        self.items = [sorted(items[i]) for i in order]

    def _slots(self, rows: np.ndarray, end: int) -> np.ndarray:
        return _block_slot(rows[:, end - 1] if self.block == 2 else np.zeros(len(rows), np.int32), rows[:, end], self.bits)

    def _keys(self, rows: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Suffix bucket above, hash of the whole window below."""
        h = np.zeros(len(rows), np.uint64)
        for j in range(self.length):
            h = (h + rows[:, j].astype(np.uint64)) * _MIX
            h ^= h >> np.uint64(29)
        return (slots.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))

    def find(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of all occurrences and the windows that occur there; rows are codes[bounds[i]:bounds[i + 1]]."""
        first, stop = bounds[:-1] + self.length - 1, bounds[1:]
        lanes = np.maximum(0, -(-(stop - first) // LANE))
        at = np.repeat(first, lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        last = np.minimum(at + LANE, np.repeat(stop, lanes))
        ends = []
        while len(at):
            left = codes[at - 1] if self.block == 2 else np.zeros(len(at), np.int32)
            jump = self.shift[_block_slot(left, codes[at], self.bits)]
            ends.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            going = at < last
            at, last = at[going], last[going]
        ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        if not len(ends):
            return ends, ends
        found = codes[ends[:, None] + np.arange(1 - self.length, 1)]
        keys = self._keys(found, self._slots(found, self.length - 1))
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        n = high - low
        which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ends, found = np.repeat(ends, n), np.repeat(found, n, axis=0)
        same = (self.rows[which] == found).all(axis=1)
        return ends[same], which[same]


class Patterns:
    """Vocabulary and windows of one pass; small enough to broadcast by ITEMS_PER_PASS."""

    def __init__(self, items: list[tuple[str, str | None]], width: int) -> None:
        codes, words, bounds = words_of(pa.array([t for _, t in items], pa.string()))
        self.vocabulary = words
        codes = codes.astype(np.int32) + 1
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for i, (item, _) in enumerate(items):
            own = codes[bounds[i]:bounds[i + 1]].tolist()
            length = min(width, len(own))
            for j in range(len(own) - length + 1 if length else 0):
                by_length[length][tuple(own[j:j + length])].add(item)
        self.classes = [Windows(dict(w), length) for length, w in sorted(by_length.items())]


def mark(df: DataFrame, items: DataFrame, width: int = 10, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with n_words, hits (one bit per word, high bit first, set inside an occurrence), n_hit and items (ids
    of the items that occur, as strings, sorted).

    Null and empty texts have no words. Items without words occur nowhere; rows that repeat an item's id add windows to it; a null id
    counts as the empty string. No items: nothing is hit. Repeated rows are marked alike. A column of ``df`` that has
    one of the four names is replaced.
    """
    spark = df.sparkSession
    named = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    passes = max(1, -(-named.count() // ITEMS_PER_PASS))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(passes))
    out = df.drop("n_words", "hits", "n_hit", "items").selectExpr(
        "*", "cast(0 as bigint) n_words", "cast(null as binary) hits", "cast(0 as bigint) n_hit", "cast(array() as array<string>) items")
    for k in range(passes):
        rows = named.where(part == k).collect()     # bounded: about ITEMS_PER_PASS items
        patterns = spark.sparkContext.broadcast(Patterns([(r.item, r.text) for r in rows], width))
        out = out.mapInArrow(lambda batches, p=patterns: _search(batches, p.value, text_col), out.schema)
    return out


def _search(batches, patterns: Patterns, text_col: str):
    for batch in slices(batches, text_col, lean=True):
        codes, words, bounds = words_of(batch.column(text_col))
        known = pc.fill_null(pc.add(pc.index_in(words, value_set=patterns.vocabulary), 1), 0).to_numpy(zero_copy_only=False).astype(np.int32)
        codes = known[codes] if len(codes) else np.zeros(0, np.int32)
        cover = np.zeros(len(codes) + 1, np.int64)
        found: dict[int, set[str]] = defaultdict(set)
        for windows in patterns.classes:
            ends, which = windows.find(codes, bounds)
            np.add.at(cover, ends - windows.length + 1, 1)
            np.add.at(cover, ends + 1, -1)
            for row, w in set(zip((np.searchsorted(bounds, ends, side="right") - 1).tolist(), which.tolist())):
                found[row].update(windows.items[w])
        hit = np.cumsum(cover[:-1]) > 0
        yield _updated(batch, hit, bounds, found)


def _updated(batch: pa.RecordBatch, hit: np.ndarray, bounds: np.ndarray, found: dict[int, set[str]]) -> pa.RecordBatch:
    """The batch with what this pass has found joined to what earlier passes have."""
    n_hit = batch.column("n_hit").to_numpy().copy()
    hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
    for row, own in found.items():
        bits = hit[bounds[row]:bounds[row + 1]]
        if hits[row] is not None:
            bits = bits | np.unpackbits(np.frombuffer(hits[row], np.uint8), count=len(bits)).astype(bool)
        hits[row], n_hit[row], items[row] = np.packbits(bits).tobytes(), bits.sum(), sorted(own.union(items[row]))
    new = {"n_words": pa.array(np.diff(bounds)), "hits": pa.array(hits, pa.binary()), "n_hit": pa.array(n_hit), "items": pa.array(items, pa.list_(pa.string()))}
    return pa.RecordBatch.from_arrays([new.get(name, batch.column(name)) for name in batch.schema.names], batch.schema.names)
