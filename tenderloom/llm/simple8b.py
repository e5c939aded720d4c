"""Simple-8b files of token ids: 64-bit words, each with a selector in its top four bits that says how many ids of how many bits follow.

A file is a Parquet table of segments in ascending document order: the words of a segment, the first word of each block of
``BLOCK`` ids (a block begins a word, so blocks decode on their own and all at once), and the documents' ids and lengths.
Ids over 30 bits use the last selector, one id a word, as their escape. Encoding and decoding walk blocks side by side in
numpy; only a document's ids, never a partition's, need memory beyond a slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.llm.common import slices, with_base
from tenderloom.llm.tokens import WORD_BPE, encoder

BLOCK = 1024
# Ids in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

SEGMENTS = ("shard int, segment_start long, n_ids long, doc_ids array<{id}>, doc_lengths array<long>, block_words binary, words binary")


def pack_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all ids, and the first word of each block."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    index = np.arange(n, dtype=np.int32)
    left = np.minimum((index // BLOCK + 1) * BLOCK, n).astype(np.int32) - index     # ids up to the block's end
    selector = np.full(n, 15, np.int8)
    narrow = None       # places of ids that fit; None: all do
    for s in range(14, -1, -1):
        fits = (ids if narrow is None else ids[narrow]) < np.uint64(1 << int(BITS[s]))
        if narrow is None and fits.all():
            selector[left >= COUNTS[s]] = s
            continue
        narrow = index[fits] if narrow is None else narrow[fits]
        if not len(narrow):
            break       # no narrower id either
        last = np.append(np.flatnonzero(np.diff(narrow) != 1), len(narrow) - 1)     # of each run of neighbours
        room = np.minimum(np.repeat(narrow[last] + 1, np.diff(last, prepend=-1)) - narrow, left[narrow])
        selector[narrow[room >= COUNTS[s]]] = s
    ids = ids.astype(np.uint64)
    # every block takes its next word at once
    starts, at, last = [], np.arange(0, n, BLOCK), np.minimum(np.arange(BLOCK, n + BLOCK, BLOCK), n)
    while len(at):
        starts.append(at)
        at = at + COUNTS[selector[at]]
        going = at < last
        at, last = at[going], last[going]
    starts = np.sort(np.concatenate(starts))
    chosen = selector[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        if BITS[s]:
            here = np.flatnonzero(chosen == s)
            shifts = (np.arange(COUNTS[s]) * BITS[s]).astype(np.uint64)
            words[here] |= np.bitwise_or.reduce(ids[starts[here][:, None] + np.arange(COUNTS[s])] << shifts, axis=1)
    return words, np.searchsorted(starts, np.arange(0, n, BLOCK)).astype(np.uint32)


def unpack_words(words: np.ndarray) -> np.ndarray:
    """All ids of whole words; any run of blocks can be given."""
    chosen = (words >> np.uint64(60)).astype(np.intp)
    ends = np.cumsum(COUNTS[chosen])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
    for s in np.unique(chosen):
        if BITS[s]:
            here = np.flatnonzero(chosen == s)
            first, body = (ends[here] - COUNTS[s])[:, None], words[here][:, None]
            shifts = (np.arange(COUNTS[s]) * BITS[s]).astype(np.uint64)
            out[first + np.arange(COUNTS[s])] = (body >> shifts) & np.uint64((1 << int(BITS[s])) - 1)
    return out


def write(df: DataFrame, path: str, tokenizer: str = WORD_BPE, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text (null: empty), closes it with ``end_id``, and writes all in ascending id order.

    Each row is a document of its own; a null id comes first, repeated ids stay side by side in the order of their texts. An empty table writes an
    empty file. Other columns are not looked at.
    """
    source = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = SEGMENTS.format(id=source.schema["doc_id"].dataType.simpleString())

    def run(batches):
        codec, shard, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids, offsets = codec.encode(batch.column("text"), end_id)
            words, blocks = pack_words(ids)
            one = np.array([0, batch.num_rows], np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(one, batch.column("doc_id")), pa.ListArray.from_arrays(one, pa.array(np.diff(offsets))),
                 pa.array([blocks.tobytes()], pa.binary()), pa.array([words.tobytes()], pa.binary())],
                ["shard", "segment_start", "n_ids", "doc_ids", "doc_lengths", "block_words", "words"])
            before += len(ids)

    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian 32-bit)."""
    segments = with_base(spark.read.parquet(path), "shard", "n_ids", "base")
    schema = f"doc_id {segments.schema['doc_ids'].dataType.elementType.simpleString()}, start long, n_tokens long, ids binary"

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = unpack_words(np.frombuffer(batch.column("words")[i].as_buffer(), np.uint64))
                docs, lengths = batch.column("doc_ids")[i].values, batch.column("doc_lengths")[i].values.to_numpy()
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                at = batch.column("base")[i].as_py() + batch.column("segment_start")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(offsets[:-1] + at), pa.array(lengths),
                     pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(ids)])],
                    ["doc_id", "start", "n_tokens", "ids"])

    return segments.mapInArrow(run, schema)


def block(words: bytes, block_words: bytes, number: int) -> np.ndarray:
    """Ids of one block, by its offset alone."""
    words, firsts = np.frombuffer(words, np.uint64), np.append(np.frombuffer(block_words, np.uint32), len(words) // 8)
    return unpack_words(words[firsts[number]:firsts[number + 1]])


