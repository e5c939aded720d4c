"""Concatenate and cut: documents become one stream of token ids, cut into sequences of a fixed number of tokens.

Pass one encodes every document once and writes its ids with its place inside its part (the task that wrote it). The prefix
sum over the parts' totals gives each part its place in the whole stream. Pass two is plain column arithmetic over the
written ids: a document becomes one piece per window that it touches, and a piece at a seam says so. No row is moved: the
order of the stream is that of the scan, and the only data that meet in one place are one total per part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.common import slices, stored, with_base
from tenderloom.llm.tokens import WORD_BPE, encoder

ENCODED = "part int, doc_id {id}, local_start long, doc_tokens long, ids binary"


def encode(df: DataFrame, tokenizer: str = WORD_BPE, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its part, the ids before it in the part, the number of its ids, its ids as little-endian 32-bit integers."""
    source = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, lean=True):
            ids, offsets = codec.encode(batch.column("text"), end_id)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), batch.column("doc_id"), pa.array(offsets[:-1] + before), pa.array(np.diff(offsets)),
                 pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(ids)])],
                ["part", "doc_id", "local_start", "doc_tokens", "ids"])
            before += int(offsets[-1])

    return source.mapInArrow(run, ENCODED.format(id=source.schema["doc_id"].dataType.simpleString()))


def pack(df: DataFrame, length: int = 4096, tokenizer: str = WORD_BPE, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length, ids (binary), doc_tokens, sequence_id, offset,
    opens and closes (it holds its document's first or last id).

    Sequences are filled to the last token; only the last of all is shorter. Null and empty texts are the end id alone. Each input row is a
    document, repeated rows and repeated or null ids too. An empty table gives no pieces. Other columns are not looked at.
    """
    placed = with_base(stored(encode(df, tokenizer, end_id, id_col, text_col), "packing"), "part", "doc_tokens", "base")
    at, size = F.col("base") + F.col("local_start"), F.col("doc_tokens")
    windows = F.sequence(F.floor(at / length), F.floor((at + size - 1) / length))
    pieces = placed.select("doc_id", "doc_tokens", "ids", at.alias("at"), F.explode(windows).alias("sequence_id"))
    opens = F.greatest(F.col("at"), F.col("sequence_id") * length)
    closes = F.least(F.col("at") + size, (F.col("sequence_id") + 1) * length)
    pieces = pieces.select("*", (opens - F.col("at")).alias("start"), (closes - opens).alias("length"), (opens % length).alias("offset"))
    return pieces.select(
        "doc_id", "start", "length", cut("ids", F.col("start"), F.col("length")).alias("ids"), "doc_tokens", "sequence_id", "offset",
        (F.col("start") == 0).alias("opens"), (F.col("start") + F.col("length") == F.col("doc_tokens")).alias("closes"))


def cut(ids: str, start: Column, length: Column) -> Column:
    return F.substr(F.col(ids), (start * 4 + 1).cast("int"), (length * 4).cast("int"))
