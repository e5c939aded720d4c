"""Repeated substrings across documents by blockwise suffix sorting with difference-cover ranks.

Every run of ``length`` bytes that also starts in a document with a smaller id is removed. The suffixes to be sorted are dealt into buckets by
content: a suffix belongs to the bucket of the smallest hashed gram among its first ``length`` bytes, so equal runs meet, and neighbouring
suffixes nearly always go together, as one stretch of text. Texts are shuffled once, into parts of bounded size. A first pass sends a hash of each part's distinct
grams only, and learns which of them other parts have; stretches whose gram no other document has stay at home. A stretch that a smaller document
of the same part has as a whole is settled there, so a passage that a third of the documents share comes from each part once.

One bucket is sorted at a time, in the memory that it needs. Stretches that are equal as a whole are settled first; then suffixes are told apart by a few places of
the run, its first and its last bytes. Ties that are left are long ones and are resolved by ranks of a difference cover: positions whose
number modulo ``PERIOD`` is in ``COVER`` are ranked by the bytes that follow, and any two suffixes have an offset below ``PERIOD`` at
which both meet ranked positions, so they are equal if their ranks there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import buffer_of, give_back

# A difference cover: each of 0 to 12 is a difference of two of its numbers modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)
GRAM = 16
# Buckets that one row of pieces holds side by side; they are sorted one after the other.
SIDE = 8
#: Bytes of text that a part, which is worked off as one, holds on average.
PART_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
RESULT = ["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_text", "carried"]
_NONE = np.iinfo(np.int64).max


def _words(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes from each position on as a number; ``data`` must be padded by eight."""
    return np.ndarray((len(data) - 8,), kind, np.ascontiguousarray(data), 0, (1,))


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring suffixes with the same smallest gram: document, first position, number of suffixes, gram."""
    gram = min(GRAM, length)
    span = length - gram + 1
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 4
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = _words(padded)
    low, high = max(0, 8 - gram) * 8, max(0, gram - 8)
    h = (words[:n] << np.uint64(low)) * _MIX
    if high:
        h ^= (words[high:n + high] * _MIX) >> np.uint64(7)
    h = (h ^ (h >> np.uint64(29))) * _MIX
    h ^= h >> np.uint64(32)
    least, width = h, 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    least = least[:n - length + 1]
    doc = np.searchsorted(offsets, np.arange(0, len(least)), side="right") - 1 if len(offsets) > 2 else np.zeros(len(least), np.int64)
    inside = np.arange(len(least)) + length <= offsets[doc + 1]
    begins = inside.copy()
    begins[1:] &= (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    first = np.flatnonzero(begins)
    total = np.concatenate([[0], np.cumsum(inside)])
    return doc[first], first, np.diff(np.append(total[first], total[-1])), least[first]


def _of_part(texts: pa.Table, length: int, buckets: int) -> tuple | None:
    """The stretches of one part of the texts, in an order that depends on its rows alone: document, key, start, size, bucket (-1: settled, as a smaller
    document of the part has the same stretch), gram, text."""
    give_back()     # of the part before
    texts = texts.filter(pc.is_valid(texts["doc_id"])).combine_chunks()
    order = np.lexsort((texts["key"].to_numpy(), texts["doc_id"].to_numpy()))
    batch = texts.take(pa.array(order)).combine_chunks()
    column = lambda name: pa.concat_arrays(batch[name].chunks) if batch.num_rows else pa.array([], batch.schema.field(name).type)
    data, offsets = buffer_of(column("text"))
    ids, keys = column("doc_id").to_numpy(), column("key").to_numpy()
    doc, first, size, gram = stretches(data, offsets, length)
    if not len(doc):
        return None
    raw, owner = data.tobytes(), ids[doc]
    text = [raw[a:b] for a, b in zip(first.tolist(), (first + size + length - 1).tolist())]
    seen: dict[bytes, int] = {}
    settled = np.fromiter((seen.setdefault(t, o) < o for t, o in zip(text, owner.tolist())), bool, len(text))
    mixed = gram * _MIX
    bucket = ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
    bucket[settled] = -1
    return owner, keys[doc], first - offsets[doc], size, bucket, ((mixed ^ gram) & np.uint64(0xFFFFFFFF)).astype(np.uint32), text


def _runs(bucket: np.ndarray) -> list[np.ndarray]:
    """Indexes by bucket, buckets ascending."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-2)), len(order))
    return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _shared_grams(grams: DataFrame) -> DataFrame:
    """Of the distinct grams that a part has in a lane, which another part has, too: a bit for each."""
    def settle(held):
        if not held:
            return
        all_ = np.concatenate([g for _, g in held])
        _, where, count = np.unique(all_, return_inverse=True, return_counts=True)
        bits, at = count[where] > 1, 0
        rows = []
        for part, g in held:
            rows.append((part, lane_of[0], np.packbits(bits[at:at + len(g)]).tobytes()))
            at += len(g)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))], ["part", "lane", "bits"])

    lane_of = [None]

    def run(batches):
        held = []
        for batch in batches:
            for b, part, g in zip(batch.column("lane").to_pylist(), batch.column("part").to_pylist(), batch.column("grams")):
                if b != lane_of[0]:
                    yield from settle(held)
                    held, lane_of[0] = [], b
                held.append((part, np.frombuffer(g.as_buffer(), np.uint32)))
        yield from settle(held)

    return grams.repartition("lane").sortWithinPartitions("lane").mapInArrow(run, "part int, lane int, bits binary")


def _pieces(texts: DataFrame, length: int, lanes: int) -> DataFrame:
    """Stretches with their text, but those whose gram no other document has: a row for each lane, its buckets side by side as arrays. Settled
    ones go in rows of their own, without text."""
    def grams(table: pa.Table) -> pa.Table:
        found, rows = _of_part(table, length, lanes * SIDE), []
        if found:
            lane, gram = np.where(found[4] < 0, -1, found[4] // SIDE), found[5]
            part = table["part"][0].as_py()
            rows = [(part, int(lane[own[0]]), np.unique(gram[own]).tobytes()) for own in _runs(lane) if lane[own[0]] >= 0]
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["part", "lane", "grams"])

    def pieces(table: pa.Table, flags: pa.Table) -> pa.Table:
        found, rows = _of_part(table, length, lanes * SIDE) if table.num_rows else None, []
        if found:
            owner, keys, starts, sizes, bucket, gram, text = found
            bits = dict(zip(flags["lane"].to_pylist(), flags["bits"].to_pylist()))
            squeeze = zstandard.ZstdCompressor(level=3)

            def packed(own: np.ndarray, with_text: bool) -> tuple[bytes, bytes, bytes]:
                head = np.concatenate([np.diff(owner[own], prepend=0), starts[own], sizes[own]])
                return squeeze.compress(head.tobytes()), keys[own].tobytes(), squeeze.compress(b"".join([text[i] for i in own])) if with_text else b""

            for own in _runs(np.where(bucket < 0, -1, bucket // SIDE)):
                if bucket[own[0]] < 0:
                    rows.append((-1, *([x] for x in packed(own, False))))
                    continue
                lane = int(bucket[own[0]]) // SIDE
                distinct, where = np.unique(gram[own], return_inverse=True)
                elsewhere = np.unpackbits(np.frombuffer(bits[lane], np.uint8), count=len(distinct)).astype(bool)
                low, high = np.full(len(distinct), _NONE), np.full(len(distinct), -_NONE)
                np.minimum.at(low, where, owner[own])
                np.maximum.at(high, where, owner[own])
                own = own[(elsewhere | (low < high))[where]]
                if len(own):
                    rows.append((lane, *map(list, zip(*(packed(own[bucket[own] % SIDE == k], True) for k in range(SIDE))))))
        kinds = (pa.int32(), *[pa.list_(pa.binary())] * 3)
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["lane", "head", "keys", "text"])

    flags = _shared_grams(texts.groupBy("part").applyInArrow(grams, "part int, lane int, grams binary"))
    return texts.groupBy("part").cogroup(flags.groupBy("part")).applyInArrow(
        pieces, "lane int, head array<binary>, keys array<binary>, text array<binary>")


def _tied(groups: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts by group and key; indexes of those that are not alone, in order, and their new groups."""
    if not len(keys):
        return np.zeros(0, np.int64), groups
    order = np.lexsort((keys, groups))
    g, k = groups[order], keys[order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])])
    label = np.cumsum(new) - 1
    alone = np.append(new[1:], True) & new
    return order[~alone], label[~alone]


def _ranks(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for positions that are followed by the same ``length`` bytes."""
    rank = np.zeros(len(at), np.int64)
    for step in [*range(0, length - 7, 8), max(0, length - 8)]:
        key = words[at + step]
        if length < 8:
            key = key >> np.uint64(8 * (8 - length))
        order = np.lexsort((key, rank))
        r, k = rank[order], key[order]
        rank[order] = np.cumsum(np.concatenate([[0], (r[1:] != r[:-1]) | (k[1:] != k[:-1])]))
    return rank


def first_owners(data: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int) -> np.ndarray:
    """For each suffix, the smallest owner of a suffix that begins with the same ``length`` bytes."""
    best = owners.copy()
    if not len(starts):
        return best
    words = _words(np.concatenate([data, np.zeros(8, np.uint8)]), ">u8")
    word = lambda at: words[at].astype(np.uint64)
    short = length < 2 * PERIOD
    period, cover = (1, (0,)) if short else (PERIOD, COVER)
    alive, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    if not short:
        # a fingerprint of three places drops most suffixes that stand alone
        mixed = (word(starts) * _MIX ^ word(starts + (length - 8) // 2)) * _MIX ^ word(starts + length - 8)
        tied, group = _tied(group, mixed)
        alive = alive[tied]
        group = np.zeros(len(alive), np.int64)
        for step in (0, period - 8, length - period, length - 8):
            tied, group = _tied(group, word(starts[alive] + step))
            alive = alive[tied]
    if not len(alive):
        return best
    at = starts[alive]
    shifts = [(c - at) % period for c in cover]
    sample, where = np.unique(np.concatenate([at + s for s in shifts]), return_inverse=True)
    rank = _ranks(words, sample, length - period + 1)
    # two suffixes meet under the offset that both have, whichever ranked positions it leads to
    label, groups = rank[where] * period + np.concatenate(shifts), np.tile(group, len(cover))
    order = np.lexsort((label, groups))
    g, k = groups[order], label[order]
    cuts = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])]))
    least = np.minimum.reduceat(np.tile(owners[alive], len(cover))[order], cuts)
    met = np.empty(len(order), np.int64)
    met[order] = np.repeat(least, np.diff(np.append(cuts, len(order))))
    best[alive] = met.reshape(len(cover), -1).min(axis=0)
    return best


def _settle(rows: list[tuple], length: int) -> tuple[np.ndarray, ...]:
    """One bucket: key, start and size of every run of suffixes that a smaller document has, too."""
    unpack = zstandard.ZstdDecompressor()
    docs, keys, starts, sizes = (np.concatenate([r[i] for r in rows]) for i in range(4))
    ends = np.cumsum(sizes + length - 1)
    raw = b"".join(unpack.decompress(r[4]) for r in rows)
    seen: dict[bytes, int] = {}
    kind = np.fromiter((seen.setdefault(raw[a:b], len(seen)) for a, b in zip((ends - sizes - length + 1).tolist(), ends.tolist())), np.int64, len(ends))
    owner = np.full(len(seen), _NONE)
    np.minimum.at(owner, kind, docs)
    data = np.frombuffer(b"".join(seen), np.uint8)
    room = np.fromiter(map(len, seen), np.int64, len(seen))
    count, first = room - length + 1, np.cumsum(room) - room
    base = np.cumsum(count) - count
    at = np.repeat(first - base, count) + np.arange(count.sum())
    mine = np.repeat(owner, count)
    gone = first_owners(data, at, mine, length) < mine
    # runs of removed suffixes inside each kind, for its owner; other documents lose the whole stretch
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    inner = np.zeros(len(gone) + 1, bool)
    inner[base] = True
    begins = np.flatnonzero((edge == 1) | (inner & np.append(gone, False)))
    run_kind = np.searchsorted(base, begins, side="right") - 1
    last = np.flatnonzero(edge == -1)
    stops = np.minimum(last[np.searchsorted(last, begins, side="right")] if len(begins) else begins, (base + count)[run_kind])
    behind = docs > owner[kind]
    own = np.flatnonzero(~behind)
    per = np.searchsorted(run_kind, kind[own], side="right") - np.searchsorted(run_kind, kind[own], side="left")
    rep = np.repeat(own, per)
    which = np.repeat(np.searchsorted(run_kind, kind[own], side="left") - np.cumsum(per) + per, per) + np.arange(per.sum())
    return (np.concatenate([keys[behind], keys[rep]]), np.concatenate([starts[behind], starts[rep] + begins[which] - base[kind[rep]]]),
            np.concatenate([sizes[behind], stops[which] - begins[which]]))


def _by_bucket(pieces: DataFrame, length: int, parts: int) -> DataFrame:
    """Removed runs, packed by the part that their row of text will be in."""
    def run(batches):
        held: list[tuple] = []
        found: list[tuple[np.ndarray, ...]] = []
        lane, unpack = None, zstandard.ZstdDecompressor()

        def flush():
            key, start, size = (np.concatenate(c) for c in zip(*found))
            found.clear()
            part = (key % parts).astype(np.int32)
            order = np.argsort(part, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order))
            own = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(part[o[0]]) for o in own], pa.int32()), *(pa.array([c[o].tobytes() for o in own], pa.binary()) for c in (key, start, size))],
                ["part", "keys", "starts", "sizes"])

        def opened(head, keys, text):
            docs, starts, sizes = np.frombuffer(unpack.decompress(head), np.int64).reshape(3, -1)
            return np.cumsum(docs), np.frombuffer(keys, np.int64), starts, sizes, text

        def settle():
            for k in range(SIDE if held else 0):
                rows = [opened(*(column[k] for column in row)) for row in held]
                if any(len(r[0]) for r in rows):
                    found.append(_settle(rows, length))
                if sum(len(f[0]) for f in found) > 1 << 19:
                    yield flush()
            held.clear()
            give_back()

        for batch in batches:
            for at, *row in zip(*(batch.column(c).to_pylist() for c in ("lane", "head", "keys", "text"))):
                if at != lane:
                    yield from settle()
                    lane = at
                if at < 0:
                    found.append(opened(*(column[0] for column in row))[1:4])
                else:
                    held.append(row)
        yield from settle()
        if found and sum(len(f[0]) for f in found):
            yield flush()

    return pieces.mapInArrow(run, "part int, keys binary, starts binary, sizes binary")


def _spans(start: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed byte ranges of one text."""
    order = np.argsort(start, kind="stable")
    first, last = start[order], np.maximum.accumulate(start[order] + size[order] + length - 1)
    new = np.concatenate([[True], first[1:] > last[:-1]])
    return first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]


def _whole_characters(raw: bytes, first: np.ndarray, last: np.ndarray) -> str:
    """The text without the ranges and without characters that a range cuts into."""
    pieces, at = [], 0
    for a, b in zip(first.tolist(), last.tolist()):
        while a > at and raw[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(raw) and raw[b] & 0xC0 == 0x80:
            b += 1
        pieces.append(raw[at:a])
        at = b
    return b"".join([*pieces, raw[at:]]).decode()


def remove_repeats(df: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, spans (array of start, end in bytes; maximal, in order), kept (binary: the bytes that are left).

    With ``carry`` also kept_text (characters that a span cuts into are left out) and carried, a struct of those columns of the row.

    Ids are whole numbers. Texts are UTF-8 bytes, null counts as empty; matches never cross rows. A run counts as repeated if a row with a smaller
    id has it, judged on the input; rows that repeat an id do not remove from each other. A row with a null id keeps all and removes
    nothing. Texts shorter than ``length`` are kept. An empty table stays empty; other columns are not looked at.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = df.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long"))).first()[0] or 0
    parts = max(4 * tasks, -(-size // PART_BYTES))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                     F.struct(*(carry or [F.lit(0).alias("none")])).alias("carried"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text")).withColumn("part", F.pmod("key", F.lit(parts)).cast("int"))
    pieces = _pieces(docs, length, tasks)
    spread = F.when(F.col("lane") < 0, F.xxhash64("keys")).otherwise(F.col("lane").cast("long"))
    removed = _by_bucket(pieces.withColumn("to", spread).repartition("to").sortWithinPartitions("lane"), length, parts)

    def run(table: pa.Table, lines: pa.Table) -> pa.Table:
        gather = lambda name: np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in lines[name].to_pylist())])
        key, start, size = gather("keys"), gather("starts"), gather("sizes")
        order = np.argsort(key, kind="stable")
        key, start, size = key[order], start[order], size[order]
        rows = []
        for doc, mine, text in zip(table["doc_id"].to_pylist(), table["key"].to_pylist(), table["text"]):
            raw = text.as_buffer().to_pybytes()
            a, b = np.searchsorted(key, mine, "left"), np.searchsorted(key, mine, "right")
            first, last = _spans(start[a:b], size[a:b], length) if a < b and doc is not None else (np.zeros(0, np.int64),) * 2
            kept = b"".join(raw[x:y] for x, y in zip([0, *last.tolist()], [*first.tolist(), len(raw)]))
            spans = [{"start": x, "end": y} for x, y in zip(first.tolist(), last.tolist())]
            rows.append((doc, len(raw), len(raw) - len(kept), spans, kept, _whole_characters(raw, first, last) if carry else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string()]
        return pa.table([*(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)), table["carried"]], RESULT)

    empty = docs.selectExpr("doc_id", "0L n_bytes", "0L n_removed", "cast(null as array<struct<start: bigint, end: bigint>>) spans",
                            "cast(null as binary) kept", "cast(null as string) kept_text", "carried")
    out = docs.groupBy("part").cogroup(removed.groupBy("part")).applyInArrow(run, empty.schema)
    return out if carry else out.drop("kept_text", "carried")
