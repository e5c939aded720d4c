"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit universe of shingles make all signature coordinates: the first breaks up structure in the data, the second is applied
after a circular shift by the coordinate's number (a shift is an addition modulo 2^32). Equal sets are one class from the start. Bands of class
representatives meet in buckets, which are worked off in three rounds, each followed by the components of all links so far:
members against their bucket's smallest member in the first few bands; the same in all bands, where the two are not connected yet; and members of buckets that still hold several components, which are joined on their rarest
shingles (``rare_partners``). So a bucket of thousands of copies costs a few comparisons per member, members that are alike but below the limit are not
paired with each other, and no pair that shares a bucket goes unexamined unless its ends are known to be connected.

A pair is first judged by its set sizes and by how many of ``KEPT`` signature coordinates agree; what is left is confirmed on the whole shingle sets
(64-bit hashes of the shingles). With 130 bands of 10 coordinates a pair at the limit of 0.8 shares no bucket with probability
(1 - 0.8^10)^130 = 4e-7, and one at 0.3, as texts with a common passage are, shares one with 8e-4. The agreement asked for is six standard
deviations below what a pair at the limit has, which one in 1e9 such pairs misses.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import SLICE_BYTES, slices, split_words, stored
from tenderloom.llm.components import components

BANDS, ROWS = 130, 10
# Bands of the first round; coordinates of which one byte each is kept for judging pairs.
FIRST, KEPT = 8, 256
# One bit each of so many coordinates for judging members of a bucket that are left for the last round.
FINE = 4096
# Shingles whose permuted values are held at a time: they stay in a core's cache.
TILE = 1 << 16
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_PI = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_SIGMA = (np.uint32(0x7FEB352D), np.uint32(0x846CA68B))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[3]
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, one text after the other, and their offsets."""
    codes, distinct, bounds = split_words(pc.ascii_lower(texts.fill_null("")))
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    h = hashed[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(bounds)
    room = max(0, len(h) - words + 1)
    rolled = np.zeros(room, np.uint64)
    for j in range(words):
        rolled = (rolled + h[j:j + room]) * _ODD[j % 3]
        rolled ^= rolled >> np.uint64(31)
    rolled = _mix(rolled)
    sets = []
    for i, at in enumerate(bounds[:-1]):
        if n[i] >= words:
            sets.append(np.unique(rolled[at:at + n[i] - words + 1]))
        elif n[i]:
            whole = np.uint64(n[i])
            for x in h[at:at + n[i]]:
                whole = np.uint64((int(whole) + int(x)) * int(_ODD[0]) & 0xFFFFFFFFFFFFFFFF)
                whole ^= whole >> np.uint64(31)
            sets.append(_mix(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def signatures(shingles: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """size x sets: the smallest permuted value of each set under each circular shift. Sets must not be empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    x = x * _SIGMA[0]
    x ^= x >> np.uint32(16)
    x *= _SIGMA[1]
    x ^= x >> np.uint32(15)
    x *= _PI[0]       # the first step of the second permutation; shifts are added after it
    out = np.empty((size, len(offsets) - 1), np.uint32)
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + TILE, side="right")) - 1)
        tile = x[offsets[first]:offsets[last]]
        starts = offsets[first:last] - offsets[first]
        y, z = np.empty_like(tile), np.empty_like(tile)
        for k in range(size):
            np.add(tile, np.uint32(k * int(_PI[0]) & 0xFFFFFFFF), out=y)
            np.right_shift(y, np.uint32(15), out=z)
            np.bitwise_xor(y, z, out=y)
            np.multiply(y, _PI[1], out=y)
            out[k, first:last] = np.minimum.reduceat(y, starts)
        first = last
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """sets x bands: one 64-bit key per band, different for different bands; the first ``FIRST`` bands have odd keys."""
    keys = np.empty((signature.shape[1], bands), np.uint64)
    for b in range(bands):
        h = np.full(signature.shape[1], b + 1, np.uint64)
        for r in range(rows):
            h = (h + signature[b * rows + r].astype(np.uint64)) * _ODD[r % 3]
            h ^= h >> np.uint64(31)
        keys[:, b] = _mix(h) & ~np.uint64(1) | np.uint64(b < FIRST)
    return keys.view(np.int64)


def sketch(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the set; null if empty), bands, signature (a byte of each of the first coordinates)."""
    def run(batches):
        for batch in slices(batches, lean=True):
            sets, offsets = shingle_sets(batch.column("text"), words)
            n = np.diff(offsets)
            full = np.flatnonzero(n)
            drawn = signatures(sets, np.concatenate([offsets[:-1][full], offsets[-1:]]), bands * rows)
            keys, short = band_keys(drawn, bands, rows), np.ascontiguousarray(drawn[:KEPT].T.astype(np.uint8))
            ids: list[bytes | None] = [None] * len(n)
            signs: list[bytes | None] = [None] * len(n)
            for k, i in enumerate(full):
                signs[i] = short[k].tobytes()
                ids[i] = xxhash.xxh3_128_digest(sets[offsets[i]:offsets[i + 1]])
            lists = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(lists, pa.array(keys.ravel())),
                 pa.array(signs, pa.binary())], ["doc_id", "n_shingles", "set_id", "bands", "signature"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, set_id binary, bands array<long>, signature binary")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, shingles: the whole set as 64-bit hashes."""
    def run(batches):
        for batch in slices(batches, lean=True):
            sets, offsets = shingle_sets(batch.column("text"), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(sets.view(np.int64)))], ["doc_id", "shingles"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, shingles array<long>")


def alike(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of which enough signature coordinates agree."""
    left = signatures.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
                share = percent / 100
                least = x.shape[1] * share - 6 * np.sqrt(x.shape[1] * share * (1 - share))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, pairs.schema)


def confirmed(pairs: DataFrame, signatures: DataFrame, docs: DataFrame, words: int, percent: int, spread: bool = False) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * intersection >= percent * union. ``spread``: texts are met by a shuffle whatever the number of
    pairs; else Spark may broadcast the ids if their size allows it."""
    pairs = stored(alike(pairs, signatures, percent), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = wanted.hint("merge") if spread else wanted
    sets = stored(full_sets(docs.join(wanted, "doc_id", "left_semi"), words), "sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    linked = common * 100 >= (F.size("sa") + F.size("sb") - common) * percent
    return stored(both.where(linked).select("a", "b").distinct(), "confirmed")


def fine_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, shingles, fine (one bit of each of ``FINE`` signature coordinates) of texts with words."""
    def run(batches):
        for batch in slices(batches, limit=SLICE_BYTES // 4, lean=True):
            sets, offsets = shingle_sets(batch.column("text"), words)
            full = np.flatnonzero(np.diff(offsets))
            if len(full):
                bounds = np.concatenate([offsets[:-1][full], offsets[-1:]])
                low = (signatures(sets, bounds, FINE) & np.uint32(1)).astype(np.uint8)
                bits = np.packbits(np.ascontiguousarray(low.T), axis=1).view(np.int64)
                each = np.arange(len(full) + 1, dtype=np.int32) * bits.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(full)), pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(sets.view(np.int64))),
                     pa.ListArray.from_arrays(each, pa.array(bits.ravel()))], ["doc_id", "shingles", "fine"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, shingles array<long>, fine array<long>")


def rare_partners(members: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of members (doc_id, n, at) of different components ``at`` that can be alike; no pair that is goes missing.

    A set's shingles are put in order, rarest among the members first. Two sets of n >= m shingles with the asked similarity t have t/(1+t) * (n + m) in
    common, so at least one among the first n - ceil(t n) + 1 of the larger and the first m - ceil(2t/(1+t) m) + 1 of the other. Texts that are edits
    of one text but not alike have only their own edits there and don't meet. Of the component with most members under a shingle only
    pairs with other components are looked at, so a large one isn't compared with itself. Where edits coincide, texts below the limit meet all the same;
    only pairs come out of the join whose fine signatures agree about as often as those of a pair at the limit do, less six standard deviations (which
    one in 1e9 such pairs misses).
    """
    sets = stored(fine_sets(docs.join(members.select("doc_id"), "doc_id", "left_semi"), words).join(members, "doc_id"), "fine")
    spread = sets.select("doc_id", "n", "at", F.explode("shingles").alias("s"))
    held = spread.groupBy("s").agg(F.count("*").alias("held"), F.min("at").alias("c"), F.max("at").alias("d"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("held", "s"))      # a set at a time
    last = lambda share, whole: F.col("n") - F.ceil(F.col("n") * share / whole) + 1
    prefix = spread.join(held, "s").withColumn("place", place).where(F.col("place") <= last(percent, 100)).where("c < d")
    prefix = stored(prefix.select("s", "doc_id", "n", "at", "place", (F.col("place") <= last(2 * percent, 100 + percent)).alias("near")), "prefix")
    shares = prefix.groupBy("s", "at").agg(F.count("*").alias("k"))
    most = shares.groupBy("s").agg(F.max(F.struct("k", "at")).alias("m"), F.count("*").alias("several")).where("several > 1")
    met = prefix.join(most.select("s", F.col("m.at").alias("main")), "s")
    firsts = prefix.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "s"))), lambda e: e["s"]).alias("firsts"))
    met = met.join(sets.select("doc_id", "fine").join(firsts, "doc_id"), "doc_id")
    one = met.where(F.col("at") != F.col("main")).select("s", F.col("doc_id").alias("a"), "n", "at", F.col("near").alias("na"), F.col("fine").alias("fa"),
                                                                  F.col("place").alias("i"), "main", F.col("firsts").alias("pa"))
    two = met.select("s", F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("at").alias("other"), F.col("near").alias("nb"), F.col("fine").alias("fb"),
                     F.col("place").alias("j"), F.col("firsts").alias("pb"))
    agree = (1 + percent / 100) / 2
    most_apart = FINE * (1 - agree) + 6 * float(np.sqrt(FINE * agree * (1 - agree)))
    apart = F.aggregate(F.zip_with("fa", "fb", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda x, y: x + y)
    # a pair comes out once: at its first common shingle, and if neither is of the main component from the smaller id
    once = (F.get(F.array_intersect("pa", "pb"), F.lit(0)) == F.col("s")) & ((F.col("other") == F.col("main")) | (F.col("a") < F.col("b")))
    # what two sets can have in common at best, if their first common shingle is the i-th of one and the j-th of the other
    common = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) + 1
    can = (F.col("at") != F.col("other")) & (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent) & (
        common * (100 + percent) >= (F.col("n") + F.col("m")) * percent)
    smaller_near = F.when(F.col("n") < F.col("m"), F.col("na")).when(F.col("n") > F.col("m"), F.col("nb")).otherwise(F.col("na") | F.col("nb"))
    return one.join(two, "s").where(can & smaller_near & once & (apart <= most_apart)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id linked with it, directly or through others; itself included), kept (it is
    that one).

    A set holds the distinct runs of ``words`` words (white space splits, A-Z lower-cased), a shorter text its whole sequence; null and empty
    texts have an empty set and no links. Rows that repeat an id are one document with several texts. A null id is linked with nothing and kept.
    An empty table gives an empty one; other columns are not looked at.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketches = stored(sketch(docs, words, bands, rows), "sketches")
    classes = stored(sketches.where("doc_id is not null and n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n")), "classes")
    heads = sketches.join(classes.select("set_id", F.col("class_id").alias("doc_id")), ["set_id", "doc_id"], "left_semi")
    signatures_ = heads.select("doc_id", "signature")
    members = heads.select(F.explode("bands").alias("key"), "doc_id", F.col("n_shingles").alias("n"))
    bucket = Window.partitionBy("key")
    lowest = F.min(F.struct("doc_id", "n")).over(bucket)
    shared = stored(members.select("*", lowest.alias("low"), F.count("*").over(bucket).alias("size")).where("size > 1").select(
        "key", "doc_id", "n", F.col("low.doc_id").alias("lo"), F.col("low.n").alias("lo_n")), "buckets")
    close = lambda m, n: F.least(m, n) * 100 >= F.greatest(m, n) * percent  # noqa: E731  sizes alone rule out the rest
    stars = shared.where("doc_id <> lo").where(close(F.col("n"), F.col("lo_n")))
    same = stored(_same_document(sketches, classes), "same")

    def placed(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Nodes with their components, and members of buckets that hold several."""
        known = components(links.union(same))
        own = shared.join(known, shared["doc_id"] == known["node"], "left").withColumn("at", F.coalesce("component", "doc_id")).drop("node", "component")
        mixed = own.groupBy("key").agg(F.min("at").alias("c"), F.max("at").alias("d")).where("c < d").select("key")
        return known, own.join(mixed, "key")

    pairs = stars.where("key & 1 = 1").select(F.col("lo").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = confirmed(pairs, signatures_, docs, words, percent, spread=True)
    known, open_ = placed(links)
    other = known.select(F.col("node").alias("lo"), F.col("component").alias("other"))
    apart = open_.where("doc_id <> lo").where(close(F.col("n"), F.col("lo_n"))).join(other, "lo", "left").where(F.col("at") != F.coalesce("other", "lo"))
    pairs = apart.select(F.col("lo").alias("a"), F.col("doc_id").alias("b")).distinct().exceptAll(pairs)
    links = stored(links.union(confirmed(pairs, signatures_, docs, words, percent)), "links")

    _, open_ = placed(links)
    open_ = stored(open_.select("doc_id", "n", "at").distinct(), "open")
    rest = stored(rare_partners(open_, docs, words, percent), "rest")
    links = links.union(confirmed(rest, signatures_, docs, words, percent))

    final = components(links.union(same))
    classed = sketches.select("doc_id", "n_shingles", "set_id").join(classes.select("set_id", "class_id"), "set_id", "left")
    placed = classed.join(final, F.coalesce("class_id", "doc_id") == final["node"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "class_id", "doc_id")).otherwise(F.col("doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), (component.eqNullSafe(F.col("doc_id"))).alias("kept"))


def _same_document(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between classes that one document belongs to, as rows that repeat an id with another text do."""
    several = sketches.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
    own = sketches.join(several, "doc_id").select("doc_id", "set_id").join(classes, "set_id")
    return own.select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
