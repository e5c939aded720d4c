"""From documents to packed training sequences: language, near-duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet in the shared folder and reads them
back as the next one's documents. All stages but the last return the columns of their documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.llm import decontaminate, language, minhash, packing, suffixes
from tenderloom.llm.common import stored, table


def _carried(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one struct, out of reach of the names that an operator adds."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("carried"))


def _restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col("text") if c == "text" else F.col(f"carried.`{c}`").alias(c) for c in columns))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject: those with letters and a clear language. Learnt from the documents' own language marks.

    Null and empty texts and texts without a letter go; without any marked text all stay. Rows that repeat an id or a text are judged alike, each
    by its text. An empty table stays empty; columns keep their values whatever their names.
    """
    return _restored(language.identify(_carried(docs), language.learn(docs)).where("not lang_rejected"), docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked near-duplicates (five words, 0.8) the one with the smallest id stays.

    Null and empty texts are linked with nothing and stay, so do rows without an id. Rows that repeat an id are one document and stay or go
    together. An empty table stays empty; other columns are carried along.
    """
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def first_of_each_passage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte runs that a document with a smaller id has are cut out; all documents stay. Ids are whole numbers.

    Null texts stay null, empty ones empty; a row without an id keeps its text and takes none from others, rows that repeat an id don't take from
    each other. ``n_chars`` follows the text. An empty table stays empty; other columns are carried along.
    """
    found = suffixes.remove_repeats(docs, carry=docs.columns)
    new = {"text": F.when(F.col("carried.text").isNotNull(), F.col("kept_text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*(new.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have no words and stay; rows are judged one by one, so repeated ones alike. An empty table stays empty; columns keep
    their values whatever their names.
    """
    return _restored(decontaminate.mark(_carried(docs), table(spark, sf_dir, "benchmark")).where("n_hit = 0"), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 token ids, one row per piece. Null and empty texts are one end id; an empty table gives no rows; other columns are left out."""
    return packing.pack(docs)


STAGES = [("language", known_language), ("near_duplicates", one_of_each_group), ("repeats", first_of_each_passage),
          ("benchmarks", without_benchmarks), ("packing", packed)]

#: Compression, permutations, suffix ranks and token ids are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
