"""From document texts to amounts, key points and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.functions.amounts import find_amount, format_amount
from tenderloom.functions.text import SPACE, key_points, padded, pattern, strip

OCR_BELOW = 100
MODEL_ABOVE = 100
DOCS_PER_PIECE = 256
PIECE_BYTES = 1 << 26       # a tender with more text has several rows in join_texts
SEAM = "\n\n"
# What key points may need behind a piece: the longest line or amount shown; a number after its first digit.
REST_CHARS, NUMBER_CHARS = 256, 15
_REPLY_SCHEMA = ", ".join(
    f"{f.name} {'STRING' if f.name == 'montant_estime' else f.dataType.simpleString()}" for f in S.REPLY.fields)


def parse_reply(raw: Column) -> Column:
    """Structured reply from a model's answer: code fences off, then JSON; null when it is no object."""
    bare = F.regexp_replace(strip(raw), r"(?mU)^```(?:json)?\s*", "")
    bare = F.regexp_replace(bare, r"(?mU)\s*```$", "")
    parsed = F.from_json(bare, _REPLY_SCHEMA + ", _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    ok = parsed.isNotNull() & parsed["_bad"].isNull() & F.coalesce(bare.startswith("{"), F.lit(False))
    fields = [parsed[f.name].try_cast(f.dataType).alias(f.name) for f in S.REPLY.fields]
    return F.when(ok, F.struct(*fields, parsed["montant_estime"].alias("montant_texte")))


def tiers_to_columns(layers: DataFrame) -> DataFrame:
    """One row per document from one row per document and tier."""
    tier = lambda name: F.max(F.when(F.col("tier") == name, F.col("text"))).alias(name)
    return layers.groupBy("tender_id", "doc_path", "ord").agg(tier("native"), tier("tables"), tier("ocr"))


def cascade(docs: DataFrame) -> DataFrame:
    """Text and amount of each document from its tiers.

    Tables are added when the text does not hold them; scanned text only below 100 characters; the
    amount is the first one found on a tier; the reply counts only for longer texts without an amount.
    Expects ``native, tables, ocr`` and optionally ``reply`` (raw).
    """
    d = docs.withColumns({c: F.coalesce(strip(F.col(c)), F.lit("")) for c in ("native", "tables", "ocr")})
    joined = lambda a, b: F.when(a == "", b).otherwise(F.concat(a, F.lit("\n"), b))
    use_tables = (F.col("tables") != "") & ~F.col("native").contains(F.col("tables"))
    d = d.withColumns({"use_tables": use_tables, "text2": F.when(
        use_tables, joined(F.col("native"), F.col("tables"))).otherwise(F.col("native"))})
    use_ocr = (F.length("text2") < OCR_BELOW) & (F.col("ocr") != "")
    d = d.withColumns({"use_ocr": use_ocr, "text": F.when(
        use_ocr, joined(F.col("text2"), F.col("ocr"))).otherwise(F.col("text2"))})
    d = d.withColumn("found", F.coalesce(
        find_amount(F.col("native")), F.when(F.col("use_tables"), find_amount(F.col("tables"))),
        F.when(F.col("use_ocr"), find_amount(F.col("ocr")))))
    tier = F.when(F.col("use_ocr"), "ocr").when(F.col("use_tables"), "tables").when(F.col("text") != "", "native")
    if "reply" in docs.columns:
        asked = F.col("found").isNull() & (F.length("text") > MODEL_ABOVE)
        d = d.withColumn("reply", F.when(asked, parse_reply(F.col("reply"))))
        d = d.withColumn("amount", F.coalesce("found", F.nullif(F.col("reply.montant_estime"), F.lit(0.0))))
        d = d.withColumn("tier", F.when(F.col("reply").isNotNull(), "reply").otherwise(tier))
        return d.select("tender_id", "doc_path", "ord", "text", "amount", "reply", "tier")
    return d.select("tender_id", "doc_path", "ord", "text", F.col("found").alias("amount"), tier.alias("tier"))


def first_findings(docs: DataFrame) -> DataFrame:
    """First amount and first reply of each tender in document order."""
    order = F.struct("ord", "doc_path")
    amount = (F.col("amount").isNotNull()) & (F.col("amount") != 0)
    first = lambda value, when: F.min_by(F.when(when, value), F.when(when, order))
    aggregates = [first(F.col("amount"), amount).alias("amount"), F.count(F.lit(1)).alias("n_docs"),
                  F.max(F.col("text") != "").alias("has_text")]
    if "reply" in docs.columns:
        aggregates.append(first(F.col("reply"), F.col("reply").isNotNull()).alias("reply"))
    return docs.groupBy("tender_id").agg(*aggregates)


def _piece(per_piece: int) -> Column:
    return F.floor(F.col("ord") / per_piece).alias("piece")


def _joined(value: Column) -> Column:
    """Aggregate: values in document order, an empty line between them; documents without text are skipped."""
    text = F.when(F.length("text") > 0, F.struct(F.col("ord"), F.col("doc_path"), value.alias("text")))
    return F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda d: d.text), SEAM)


def join_texts(docs: DataFrame, per_piece: int = DOCS_PER_PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Joined text of each tender: one row, piece 0.

    Only a tender with more than ``piece_bytes`` of text comes in several pieces, which follow one another to the whole
    text; each has at most so many bytes and ``per_piece`` documents more.
    """
    rows = docs.filter(F.length("text") > 0).withColumn("_block", _piece(per_piece))
    sizes = rows.groupBy("tender_id", "_block").agg(F.sum(F.octet_length("text").cast("long") + 2).alias("size"))
    large = sizes.groupBy("tender_id").agg(F.sum("size").alias("size")).filter(F.col("size") > piece_bytes).select("tender_id")
    before = Window.partitionBy("tender_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.join(large, "tender_id", "left_semi").select(
        "tender_id", "_block", F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / piece_bytes).alias("_at"))
    placed = rows.join(places, ["tender_id", "_block"], "left").withColumn("piece", F.coalesce("_at", F.lit(0).cast("long")))
    return placed.groupBy("tender_id", "piece").agg(_joined(F.col("text")).alias("text"))


def _following(docs: DataFrame, per_piece: int) -> DataFrame:
    """What a match that starts in a piece can need of the texts behind it: (tender_id, piece, _rest, _number).

    Of all key points only the telephone runs on without a bound, over anything but digits: it needs the first digit
    behind the piece and what a number can hold. The others cross an empty line by white space or, in an amount, by
    digits, and show at most ``KEY_POINT_CHARS`` or 200 characters; ``_rest`` is ``REST_CHARS`` long, up to the next
    character that isn't white space. Texts are stripped, so ``REST_CHARS // 3`` pieces hold as much. Only tenders
    with several pieces have rows.
    """
    rows = docs.withColumn("piece", _piece(per_piece))
    several = rows.filter(F.coalesce(F.col("piece") != 0, F.lit(False))).select("tender_id").distinct()
    cut = lambda c: F.regexp_extract(c, rf"(?s)\A.{{0,{REST_CHARS}}}[{SPACE}]*[^{SPACE}]?", 0)
    digits = F.nullif(F.regexp_extract("text", rf"(?sU)\d.{{0,{NUMBER_CHARS}}}", 0), F.lit(""))
    heads = rows.filter(F.length("text") > 0).select(
        "tender_id", "piece", "ord", "doc_path", cut(F.col("text")).alias("text"), digits.alias("digits"))
    # An inner join: a semi join would be pushed below the cut and shuffle whole texts.
    heads = heads.join(several, "tender_id").groupBy("tender_id", "piece").agg(
        cut(_joined(F.col("text"))).alias("head"),
        F.min_by("digits", F.when(F.col("digits").isNotNull(), F.struct("ord", "doc_path"))).alias("digits"))
    behind = Window.partitionBy("tender_id").orderBy("piece")
    return heads.select(
        "tender_id", "piece",
        cut(F.array_join(F.collect_list("head").over(behind.rowsBetween(1, REST_CHARS // 3 + 1)), SEAM)).alias("_rest"),
        F.first("digits", ignorenulls=True).over(behind.rowsBetween(1, Window.unboundedFollowing)).alias("_number"))


def _own_key_points(text: Column, rest: Column, number: Column) -> Column:
    """Key points whose match starts in ``text``, though it may end in what follows."""
    whole = {label: F.concat(text, F.lit(SEAM), F.coalesce(number, F.lit("")) if label == "Téléphone" else rest) for label, _ in S.KEY_POINTS}
    units = F.octet_length(F.encode(text, "UTF-16BE")) / 2      # places of matches are counted in these
    return F.struct(*[
        F.when(F.regexp_instr(whole[label], F.lit(pattern(regex))) <= units, key_points(whole[label])[label]).alias(label)
        for label, regex in S.KEY_POINTS])


def tender_findings(docs: DataFrame, per_piece: int = DOCS_PER_PIECE) -> DataFrame:
    """First amount, first reply and key points of each tender, as its whole joined text gives them.

    Key points are sought in pieces of ``per_piece`` documents, each followed by what a match over its end can need
    (see :func:`_following`); the first piece in which a match starts gives it. Whole texts stay within their piece.
    """
    order = F.struct("ord", "doc_path")
    found = lambda name, value, when: F.min_by(F.when(when, value), F.when(when, order)).alias(name)
    aggregates = [_joined(F.col("text")).alias("text"),
                  found("amount", F.col("amount"), F.col("amount").isNotNull() & (F.col("amount") != 0)),
                  F.count(F.lit(1)).alias("n_docs"), F.max(F.col("text") != "").alias("has_text")]
    names = ["amount"]
    if "reply" in docs.columns:
        aggregates.append(found("reply", F.col("reply"), F.col("reply").isNotNull()))
        names.append("reply")
    pieces = docs.withColumn("piece", _piece(per_piece)).groupBy("tender_id", "piece").agg(*aggregates)
    pieces = pieces.join(_following(docs, per_piece), ["tender_id", "piece"], "left")
    points = F.when(F.coalesce(F.col("_rest"), F.lit("")) == "", key_points(F.col("text"))).otherwise(
        _own_key_points(F.col("text"), F.col("_rest"), F.col("_number")))
    pieces = pieces.select("tender_id", "piece", *names, "n_docs", "has_text", points.alias("k"))
    first = lambda c: F.min_by(c, F.when(c.isNotNull(), F.col("piece")))
    return pieces.groupBy("tender_id").agg(
        *[first(F.col(n)).alias(n) for n in names], F.sum("n_docs").alias("n_docs"), F.max("has_text").alias("has_text"),
        *[first(F.col(f"k.`{label}`")).alias(label) for label, _ in S.KEY_POINTS])


def summaries(tenders: DataFrame, docs: DataFrame, without_texts: bool = False) -> DataFrame:
    """Summary text per tender that has documents (``docs`` as :func:`cascade` returns them).

    ``without_texts``: one also for each tender whose documents gave no text.
    """
    rows = tenders.select(F.col("id").alias("tender_id"), "reference").join(
        tender_findings(docs), "tender_id", "left" if without_texts else "inner")
    line = lambda label, value: F.concat(padded(F.lit(label)), F.lit(": "), value)
    shown = lambda c: F.nullif(c, F.lit(""))
    reply = F.col("reply")
    money = shown(F.when(F.coalesce(F.col("reply.montant_estime"), F.lit(1.0)) != 0, F.col("reply.montant_texte")))
    from_reply = F.concat_ws(
        "\n", F.lit("── Extraction IA (Mistral) ──"),
        F.concat(shown(F.col("reply.resume")), F.lit("\n")), F.lit("── Données extraites ──"),
        *[line(label, money if key == "montant_estime" else shown(F.col(f"reply.{key}"))) for label, key in S.REPLY_LABELS])
    from_text = F.concat_ws("\n", F.lit("── Points clés (extraction regex) ──"),
                            *[line(label, F.col(label)) for label, _ in S.KEY_POINTS])
    amount = F.col("amount")
    spoken = F.concat(F.lit("\n"), padded(F.lit("Montant PDF")), F.lit(": "),
                      F.replace(format_amount(amount), F.lit(" "), F.lit(",")), F.lit(" DH"))
    level = F.when(reply.isNotNull(), "Ollama/Mistral").when(F.col("has_text"), "OCR").otherwise("PyMuPDF")
    text = F.concat_ws(
        "\n", F.concat(F.lit("=== RÉSUMÉ — "), F.col("reference"), F.lit(" ===\n")),
        F.when(reply.isNotNull(), from_reply).otherwise(from_text),
        F.when(amount.isNotNull(), spoken), F.lit("\n── Niveau d'extraction utilisé ──"),
        line("Source", level))
    return rows.select("tender_id", "reference", "amount", text.alias("summary"))


def analysis_outcomes(queue: DataFrame, entries: DataFrame, docs: DataFrame) -> DataFrame:
    """Result of the analyse stage for each queued tender: missing archive, no document, or success.

    ``entries``: (tender_id, n_pdf) of the archives that were read.
    """
    found = first_findings(docs).select("tender_id", "amount")
    q = queue.select(F.col("id").alias("tender_id"), "estimation").join(entries, "tender_id", "left").join(
        found, "tender_id", "left")
    gone, empty = F.col("n_pdf").isNull(), F.col("n_pdf") == 0
    return q.select(
        F.lit("analyze").alias("stage"), "tender_id", F.lit(0).cast("long").alias("seq"), (~(gone | empty)).alias("ok"),
        F.when(gone, S.ERROR_NO_ARCHIVE).when(empty, S.ERROR_NO_PDF).alias("error"),
        F.when(~(gone | empty), F.lit("TO_SYNC")).alias("next_status"),
        F.coalesce(F.nullif("estimation", F.lit(0.0)), "amount").alias("estimation"))
