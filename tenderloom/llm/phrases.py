"""Phrase collocations by stripes: each prefix keys an associative counter of the words that follow it.

A task makes stripes of a block of text at a time (distinct runs are found on integer codes, so a run is spelled once per block), Spark merges them
elementwise: a stripe of a prefix comes as one row of next words and counts, is dealt by (language, prefix, lane of the next word), and its
elements are added up there. A prefix whose first word makes up more than 1/``SHARES`` of all words has ``LANES`` lanes, others have one; there can't be
more than ``SHARES`` such words. After the count per block a prefix brings at most one element per next word and block, however many rows hold it.

The merged structure gives everything: an element is the count of a prefix with one more word, and also the total of the prefix that it makes; the
largest element under a prefix says whether an extension to the right subsumes it, and the largest under the same words without the first one
whether an extension to the left does. A longer phrase that holds a candidate as often as the candidate occurs can be cut down to one that is a word
longer, so one word suffices.

Stripes of longer prefixes hold only runs whose parts are frequent themselves, which loses nothing: a run occurs no oftener than its parts. What is
frequent comes to the tasks as a bit table of fixed size. One is made of the frequent runs of a length; another of counters that each task keeps
while it reads the shorter runs, one per hash of a longer run, added up over all tasks. Either can be wrong only by letting a rare run through, which costs a
count, never a result; on tables of so many words that every counter fills up, all runs of frequent parts are counted. Three passes over the texts: words, pairs
of frequent words, runs of frequent pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import buffer_of, slices, stored, string_array

LANES = 32
SHARES = 256
#: Size of a bit table: 8 MB.
BITS = 1 << 26
#: Counters of longer runs a task keeps while it reads the shorter ones, and how many go into a row.
COUNTERS, PER_CHUNK = 1 << 25, 1 << 16
#: Bytes of text whose runs are counted together before they are sent on.
BLOCK = 8 << 20
#: Elements a task adds up before it sends them on.
FOLD = 1 << 19
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PER_ROW = 1 << 15      # bits in a row of Spark's bitmap functions
_STRIPES = "lang string, prefix string, lane long, next array<string>, n array<long>, chunk int, counters binary"
_WORDS = "lang string, next string, n long, chunk int, counters binary"

_CLASS = np.zeros(256, np.uint8)      # 0 in a word, 1 between words, 2 between pieces
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


@dataclass
class Words:
    """The words of some texts in order: codes of (language, word), their hashes, and the piece each word stands in."""

    codes: np.ndarray
    langs: pa.Array        # by code
    words: pa.Array        # by code
    hashes: np.ndarray     # by code
    piece: np.ndarray


def words_of(texts: pa.Array, langs: pa.Array) -> Words:
    data, offsets = buffer_of(pc.ascii_lower(texts))
    kind = _CLASS[data]
    inside = kind == 0
    letters = data[inside]
    # a break before and behind each text, so that neither words nor pieces go over their ends
    kind = np.insert(kind, offsets, 2)
    inside = kind == 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    owner = np.searchsorted(offsets + np.arange(len(offsets)), starts) - 1
    coded = string_array(letters, np.concatenate([[0], np.cumsum(ends - starts)])).dictionary_encode()
    spoken = pc.fill_null(langs, "und").dictionary_encode()
    n = max(len(coded.dictionary), 1)
    both = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner] * n + coded.indices.to_numpy(zero_copy_only=False)
    distinct, codes = _numbered(both, n * len(spoken.dictionary))
    seeds = [xxhash.xxh3_64_intdigest(x) for x in spoken.dictionary.cast(pa.binary()).to_pylist()]
    plain = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    by_lang, by_word = distinct // n, distinct % n
    hashes = _mix(np.array(seeds, np.uint64)[by_lang], plain[by_word]) if len(distinct) else np.zeros(0, np.uint64)
    return Words(codes, spoken.dictionary.take(pa.array(by_lang)), coded.dictionary.take(pa.array(by_word)), hashes, piece)


def _numbered(values: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and which of them each value is; all are below ``room``."""
    if room > 8 * len(values) + 1024:
        return np.unique(values, return_inverse=True)
    met = np.zeros(room, bool)
    met[values] = True
    return np.flatnonzero(met), (np.cumsum(met, dtype=np.int32) - 1)[values]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * _ODD[0] + b) * _ODD[1]
    h ^= h >> np.uint64(29)
    return h * _ODD[0] >> np.uint64(1)


def _runs(w: Words, may: dict[int, np.ndarray], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """lang, prefix, lane, next and count of runs of words. ``may`` tells for each length whether the words from word i on may be a frequent run; runs
    of each length go on from those of the length before. ``hot``: word codes whose stripes have lanes."""
    shortest, longest = min(may), max(may)
    at = np.flatnonzero(may[shortest])
    n = max(len(w.words), 1)
    lane_of = (w.hashes % np.uint64(LANES)).astype(np.int64)
    code, spelled = w.codes[at].astype(np.int64), w.words
    for length in range(2, longest + 1):
        follow = w.codes[at + length - 1].astype(np.int64)
        values = (code * LANES + np.where(hot[code], lane_of[follow], 0)) * n + follow
        ordered = np.sort(values)
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        distinct, counts = ordered[first], np.diff(first, append=len(ordered))
        prefix, follow = distinct // (n * LANES), distinct % n
        if length >= shortest:
            yield pa.RecordBatch.from_arrays(
                [w.langs.take(pa.array(follow)), spelled.take(pa.array(prefix)), pa.array(distinct // n % LANES), w.words.take(pa.array(follow)),
                 pa.array(counts)], ["lang", "prefix", "lane", "next", "n"])
        if length == longest:
            return
        going = np.ones(len(at), bool)
        if length >= shortest:
            inside = at < len(may[length + 1])
            going[~inside] = False
            going[inside] = may[length + 1][at[inside]]
        if not going.any():
            return
        spelled = pc.binary_join_element_wise(spelled.take(pa.array(prefix)), w.words.take(pa.array(follow)), " ")
        at, code, hot = at[going], np.searchsorted(distinct, values[going]), hot[prefix]


def _folded(elements: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Elements of a task with equal keys added up; ``FOLD`` elements or about twice as many are held at a time."""
    held: list[pa.Table] = []
    size, added = 0, 0
    for batch in elements:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        added += batch.num_rows
        if added > FOLD:
            held, added = [_sums(held, keys)], 0
            size = len(held[0])
            if size > FOLD:
                yield held[0]
                held, size = [], 0
    if held:
        yield _sums(held, keys)


def _sums(held: list[pa.Table], keys: list[str]) -> pa.Table:
    return pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def _stripes(elements: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_STRIPES``: what the elements of a prefix and lane add up to, as one row."""
    for folded in _folded(elements, ["lang", "prefix", "lane", "next"]):
        lists = folded.group_by(["lang", "prefix", "lane"], use_threads=False).aggregate([("next", "list"), ("n", "list")])
        yield from map(_wide, lists.rename_columns(["lang", "prefix", "lane", "next", "n"]).to_batches(max_chunksize=1 << 16))


class Counters:
    """How often each hash (modulo ``COUNTERS``) was met; a counter stops at the largest value it holds, which is not below ``least``."""

    def __init__(self, least: int) -> None:
        self.n = np.zeros(COUNTERS, np.uint8 if least < 256 else np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        at, n = np.unique(hashes % np.uint64(COUNTERS), return_counts=True)
        self.n[at] += np.minimum(n, np.iinfo(self.n.dtype).max - self.n[at]).astype(self.n.dtype)

    def chunks(self) -> tuple[list[int], list[bytes]]:
        rows = self.n.reshape(-1, PER_CHUNK)
        met = np.flatnonzero(rows.any(axis=1))
        return met.tolist(), [zstandard.compress(rows[i].tobytes(), 1) for i in met]


def full_counters(rows: DataFrame, least: int) -> np.ndarray:
    """A bit per counter whose sum over all tasks is ``least`` or more. ``COUNTERS`` bits come to the driver."""
    kind = Counters(least).n.dtype

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}      # a partition has some of the fixed number of chunks
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("counters").to_pylist()):
                n = np.frombuffer(zstandard.decompress(packed), kind)
                held = sums.setdefault(chunk, np.zeros(PER_CHUNK, kind))
                held += np.minimum(n, np.iinfo(kind).max - held)
        bits = [np.packbits(n >= least, bitorder="little").tobytes() for n in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], ["chunk", "bits"])

    table = np.zeros(COUNTERS // 8, np.uint8)
    dealt = rows.where("chunk is not null").select("chunk", "counters").repartition("chunk")
    for r in dealt.mapInArrow(run, "chunk int, bits binary").collect():
        table[r.chunk * PER_CHUNK // 8:(r.chunk + 1) * PER_CHUNK // 8] = np.frombuffer(r.bits, np.uint8)
    return table


def _wide(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Elements or stripes, with empty columns for counters."""
    none = [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())]
    return pa.RecordBatch.from_arrays([*batch.columns, *none], [*batch.schema.names, "chunk", "counters"])


def _counter_rows(counters: Counters, schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    chunk, packed = counters.chunks()
    none = [pa.nulls(len(chunk), t) for t in schema.values()]
    return pa.RecordBatch.from_arrays([*none, pa.array(chunk, pa.int32()), pa.array(packed, pa.binary())], [*schema, "chunk", "counters"])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Words]:
    """Words of up to ``BLOCK`` bytes of text at a time."""
    held, size = [], 0
    for batch in slices(batches, limit=BLOCK):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= BLOCK:
            yield _words(held)
            held, size = [], 0
    if held:
        yield _words(held)


def _words(held: list[pa.RecordBatch]) -> Words:
    column = lambda name: pa.concat_arrays([b.column(name) for b in held])
    return words_of(column("text"), column("lang"))


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """lang, prefix, next, n of ``least`` or more: stripes are dealt by prefix and lane once, stand together there and are added up elementwise, so one
    prefix and lane is held at a time."""
    key = ["lang", "prefix", "lane"]

    def added(rows: pa.Table) -> pa.Table:
        owner = pc.list_parent_indices(rows.column("next").combine_chunks())
        flat = {**{k: rows.column(k).take(owner) for k in key}, "next": pc.list_flatten(rows.column("next").combine_chunks()),
                "n": pc.list_flatten(rows.column("n").combine_chunks())}
        return _sums([pa.table(flat)], [*key, "next"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.Table] = []      # elements of the last prefix and lane so far

        def told(rows: list[pa.Table]) -> Iterator[pa.RecordBatch]:
            sums = _sums(rows, [*key, "next"])
            yield from sums.filter(pc.greater_equal(sums.column("n"), least)).drop_columns(["lane"]).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            elements = added(pa.Table.from_batches([batch]))
            last = batch.slice(batch.num_rows - 1)
            ends = pc.and_(pc.equal(elements.column("prefix"), last.column("prefix")[0]),
                           pc.and_(pc.equal(elements.column("lang"), last.column("lang")[0]), pc.equal(elements.column("lane"), last.column("lane")[0])))
            tail, rest = elements.filter(ends), elements.filter(pc.invert(ends))
            goes_on = open_ and all(open_[0].column(k)[0] == last.column(k)[0] for k in key)
            if goes_on and not len(rest):
                open_ = [_sums([*open_, tail], [*key, "next"])]
            else:
                yield from told([*open_, rest])
                open_ = [tail]
        if open_:
            yield from told(open_)

    dealt = stripes.select(*key, "next", "n").repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "lang string, prefix string, next string, n long")


def bit_table(df: DataFrame, positions: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """A bit per position that any row has. ``BITS`` bits come to the driver, whatever the number of rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(positions(batch) % np.uint64(BITS)).astype(np.int64))], ["p"])

    p = F.col("p")
    rows = df.mapInArrow(run, "p long").groupBy((p / _PER_ROW).cast("long").alias("row")).agg(F.bitmap_construct_agg(p % _PER_ROW).alias("bits"))
    table = np.zeros(BITS // 8, np.uint8)
    for r in rows.collect():
        table[r.row * _PER_ROW // 8:(r.row + 1) * _PER_ROW // 8] = np.frombuffer(r.bits, np.uint8)
    return table


def _has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(8 * len(table))).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _hash_of(lang: pa.Array, word: pa.Array) -> np.ndarray:
    both = ([xxhash.xxh3_64_intdigest(x or b"") for x in c.cast(pa.binary()).to_pylist()] for c in (lang, word))
    return _mix(*(np.array(x, np.uint64) for x in both))


def phrase_counts(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, prefix, next, n) of all runs of 1 to ``longest`` words that occur ``least`` times, a single word having an empty prefix; (lang, all words)."""
    together = lambda w: w.piece[:-1] == w.piece[1:]
    pair_hash = lambda w: _mix(w.hashes[w.codes[:-1]], w.hashes[w.codes[1:]])

    def words(batches):
        seen = Counters(least)

        def elements():
            for w in _blocks(batches):
                yield pa.RecordBatch.from_arrays([w.langs, w.words, pa.array(np.bincount(w.codes, minlength=len(w.words)))], ["lang", "next", "n"])
                seen.add(pair_hash(w)[together(w)])

        for folded in _folded(elements(), ["lang", "next"]):
            yield from map(_wide, folded.to_batches(max_chunksize=1 << 16))
        yield _counter_rows(seen, {"lang": pa.string(), "next": pa.string(), "n": pa.int64()})

    # the stripe of the empty prefix: its elements are its lanes
    read = stored(docs.mapInArrow(words, _WORDS), "read")
    single = stored(read.where("chunk is null").groupBy("lang", "next").agg(F.sum("n").alias("n")), "words")
    totals = single.groupBy("lang").agg(F.sum("n").alias("total"))
    all_words = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    single = single.where(F.col("n") >= least).select("lang", F.lit("").alias("prefix"), "next", "n")
    most = [(r.lang, r.next) for r in single.where(F.col("n") * SHARES > all_words).collect()]      # fewer than SHARES
    hot = _hash_of(*(pa.array([m[i] for m in most], pa.string()) for i in (0, 1)))
    share = docs.sparkSession.sparkContext.broadcast
    word = share(bit_table(single, lambda b: _hash_of(b.column("lang"), b.column("next"))))
    counted = share(full_counters(read, least))

    def pairs(batches):
        seen = Counters(least)

        def elements():
            for w in _blocks(batches):
                good, hashes = _has(word.value, w.hashes)[w.codes], pair_hash(w)
                pair = good[:-1] & good[1:] & together(w) & _has(counted.value, hashes)
                yield from _runs(w, {2: pair}, np.isin(w.hashes, hot))
                for _ in range(3, longest + 1):
                    hashes, pair = _mix(hashes[:-1], hashes[1:]), pair[:-1] & pair[1:]
                    seen.add(hashes[pair])

        yield from _stripes(elements())
        kinds = {"lang": pa.string(), "prefix": pa.string(), "lane": pa.int64(), "next": pa.list_(pa.string()), "n": pa.list_(pa.int64())}
        yield _counter_rows(seen, kinds)

    read = stored(docs.mapInArrow(pairs, _STRIPES), "read")
    two = stored(merged(read.where("chunk is null"), least), "pairs")
    met = share(bit_table(two, lambda b: _mix(_hash_of(b.column("lang"), b.column("prefix")), _hash_of(b.column("lang"), b.column("next")))))
    met_longer = share(full_counters(read, least))

    def longer(batches):
        def elements():
            for w in _blocks(batches):
                hashes = pair_hash(w)
                runs, may = {}, _has(met.value, hashes) & together(w)
                for length in range(3, longest + 1):
                    hashes = _mix(hashes[:-1], hashes[1:])
                    may = runs[length] = may[:-1] & may[1:] & _has(met_longer.value, hashes)
                yield from _runs(w, runs, np.isin(w.hashes, hot))

        yield from _stripes(elements())

    more = stored(merged(docs.mapInArrow(longer, _STRIPES), least), "runs")
    return single.unionByName(two).unionByName(more), totals


def _said(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(df: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and those into words at spaces and tabs. A phrase of 2 to
    ``longest`` words that occurs a >= ``least`` times scores floor(1000 * a * n / (l * r)), least over its cuts (ties: the shortest first part),
    where l and r are how often the two parts occur and n the language's words. Phrases inside a longer one that occurs as often are left out.
    Order: score and a descending, phrase ascending. A null language is ``und``; null and empty texts have no words; repeated rows count each
    time; an empty table gives an empty one; other columns are not looked at.
    """
    docs = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return scored(*phrase_counts(docs, least, longest), longest, top)


def scored(elements: DataFrame, totals: DataFrame, longest: int, top: int) -> DataFrame:
    """Ranked phrases from the merged stripes (lang, prefix, next, n) and each language's words (lang, total)."""
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    counted = stored(elements.select("lang", phrase.alias("phrase"), F.split(phrase, " ").alias("words"), "n"), "phrases")
    candidates = counted.where(F.size("words") > 1)
    cuts = candidates.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("*", _said(F.slice("words", 1, F.col("k"))).alias("left"), _said(F.slice("words", F.col("k") + 1, F.lit(longest))).alias("right"))
    part = lambda name, n: counted.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product = (wide("a") * wide("total")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    cuts = cuts.withColumn("product", product).withColumn("under", wide("l") * wide("r")).withColumn("score", F.expr("product div under"))
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("total").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    wider = candidates.where(F.size("words") > 2)
    shorter = lambda start: wider.select("lang", _said(F.slice("words", start, F.size("words") - 1)).alias("phrase"), "n")
    held = shorter(1).union(shorter(2)).groupBy("lang", "phrase").agg(F.max("n").alias("held"))
    free = best.join(held, ["lang", "phrase"], "left").where(F.col("held").isNull() | (F.col("held") < F.col("a")))
    free = free.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = free.withColumn("lane", F.pmod(F.xxhash64("phrase"), F.lit(64)))      # a language's phrases are first ranked in lanes
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lane").orderBy(*order))).where(F.col("rank") <= top).drop("lane", "rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
