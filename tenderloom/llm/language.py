"""Language of a text by compression: the language whose dictionary makes it smallest.

The dictionary of a language is raw text: passages from a bounded number of its documents, drawn by hash. A text is lower-cased, cut into blocks,
and every block is compressed with each dictionary; the sizes of all blocks are summed. The margin is how much larger the
second smallest total is, as a share of the smallest. Texts with a narrow margin are compressed again at a higher level and both totals
count; where the margin stays narrow the text is rejected.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import slices

# The fitted sample: so many documents of a language, one passage of so many characters from each.
SAMPLE_DOCS, SAMPLE_CHARS = 600, 300
BLOCK_BYTES = 4096
LEVEL, SECOND_LEVEL = 3, 12
NARROW = 0.01
MIN_MARGIN = 0.002
UNKNOWN = "und"
NEW = {"lang_pred": "string", "lang_score": "double", "lang_margin": "double", "lang_rejected": "boolean"}


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
          sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionaries by language, from at most ``sample_docs`` different passages of ``sample_chars`` characters each; only those reach the driver.

    Rows without a language or without text take no part. Copies of a text, and texts whose passages are the same in lower case, count once.
    """
    drawn = F.xxhash64(F.col(text_col))
    room = F.greatest(F.lit(1), F.length(text_col) - sample_chars + 1)
    passages = labelled.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.lower(F.substr(F.col(text_col), (F.pmod(drawn, room) + 1).cast("int"), F.lit(sample_chars))).alias("passage"),
        drawn.alias("drawn")).groupBy("lang", "passage").agg(F.min("drawn").alias("drawn"))
    ranked = passages.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "passage")))
    texts: dict[str, list[str]] = {}
    for row in ranked.where(F.col("rank") <= sample_docs).orderBy("lang", "rank").collect():
        texts.setdefault(row.lang, []).append(row.passage)
    return {lang: "\n".join(t).encode() for lang, t in texts.items()}


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.languages = sorted(dictionaries)
        self.by_level = {level: [self._one(dictionaries[lang], level) for lang in self.languages] for level in (LEVEL, SECOND_LEVEL)}

    @staticmethod
    def _one(content: bytes, level: int) -> zstandard.ZstdCompressor:
        plan = zstandard.ZstdCompressionParameters.from_level(level, source_size=BLOCK_BYTES, dict_size=len(content), write_content_size=0,
                                                              write_checksum=0, write_dict_id=0)
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=plan)
        return zstandard.ZstdCompressor(dict_data=raw, compression_params=plan)

    def sizes(self, text: bytes, level: int) -> np.ndarray:
        return np.array([sum(len(c.compress(text[i:i + BLOCK_BYTES])) for i in range(0, len(text), BLOCK_BYTES)) for c in self.by_level[level]], float)

    def classify(self, text: bytes) -> tuple[str, float, float]:
        """Language, score and margin."""
        sizes = self.sizes(text, LEVEL)
        if len(sizes) > 1 and np.partition(sizes, 1)[1] < sizes.min() * (1 + NARROW):
            sizes += self.sizes(text, SECOND_LEVEL)
        excess = sizes / sizes.min() - 1
        margin = np.partition(excess, 1)[1] if len(sizes) > 1 else 1.0
        score = 1 / sum(math.exp(-min(50 * e, 700)) for e in excess)
        return self.languages[int(excess.argmin())], score, float(margin)


def identify(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """All rows and columns with lang_pred, lang_score (0 to 1), lang_margin and lang_rejected; columns of these names are replaced.

    Null texts and texts without a letter are ``und``, score 0, rejected. Equal sizes go to the first language by name and are rejected as
    narrow. No dictionaries: all are ``und``, score 0, and none is rejected. An empty table stays empty.
    """
    kept = df.drop(*NEW)
    schema = kept.selectExpr("*", *(f"cast(null as {t}) {n}" for n, t in NEW.items())).schema

    def run(batches):
        compressors = Compressors(dictionaries)
        for batch in slices(batches, text_col, lean=True):
            texts = batch.column(text_col)
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_pylist()
            lowered = pc.utf8_lower(texts).to_pylist()
            if compressors.languages:
                found = [compressors.classify(t.encode()) if ok else (UNKNOWN, 0.0, 0.0) for t, ok in zip(lowered, lettered)]
                rejected = [m < min_margin for _, _, m in found]
            else:
                found, rejected = [(UNKNOWN, 0.0, 0.0)] * len(lettered), [False] * len(lettered)
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                   pa.array([f[2] for f in found], pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *NEW])

    return kept.mapInArrow(run, schema)
