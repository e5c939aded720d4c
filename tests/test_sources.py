"""Pages, archives, documents, schema conformance, retention."""

import time
import datetime as dt
import hashlib
import io
import random
import re
import zipfile
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderloom import schemas as S
from tenderloom.operators import quality, retention, summary
from tenderloom.sources import archives, pages
from tenderloom.sources.tables import append, keyed

BASE = "B"


def page(spark, html):
    return spark.createDataFrame([(1, html)], "page_id long, html string")


ROW = ("<tr><td>a</td><td>le 01/02/2024</td><td><span class='x ref'>R/12</span><div id='z_panelBlocObjet' style='display:none'>Objet : "
       "Route<script>var a='<td>';</script></div></td><td>Lieu d'exécution : Fès</td><td>05/03/2024 10:00</td>"
       "<td><a href='?page=EntrepriseDetailConsultation&amp;refConsultation=7'>v</a></td></tr>")


def test_listing_falls_back_to_any_table(spark):
    r = pages.listing_rows(page(spark, f"<table>{ROW}</table>"), BASE).first()
    assert (r.reference, r.date_publication, r.objet, r.lieu, r.date_limite, r.url_id) == (
        "R/12", "01/02/2024", "Route", "Fès", "05/03/2024 10:00", "7")
    assert r.lien_detail == "B?page=EntrepriseDetailConsultation&refConsultation=7"


def test_listing_prefers_the_result_table(spark):
    html = f"<table>{ROW.replace('R/12', 'OTHER')}</table><table class='table-results'><thead>{ROW}</thead><tr><td>1</td></tr>{ROW}</table>"
    assert [r.reference for r in pages.listing_rows(page(spark, html), BASE).collect()] == ["R/12"]


def test_broken_markup(spark):
    html = "<table><tr><td>1<td>2<td><span class=ref>R1<b>23</span><td>l<td>d</table><tr><td>"
    assert [r.reference for r in pages.listing_rows(page(spark, html), BASE).collect()] == ["R123"]
    assert pages.listing_rows(page(spark, ""), BASE).count() == 0
    assert pages.listing_rows(page(spark, None), BASE).count() == 0
    assert pages.listing_rows(page(spark, "<table><tr><td>1</td><td></td><td><span class='ref'>AB</span></td><td></td><td></td></tr></table>"), BASE).count() == 0


def test_detail_of_an_empty_page(spark):
    r = pages.detail_records(page(spark, "<html></html>"), BASE).first()
    assert (r.objet, r.acheteur, r.contact_nom, r.lien_dce, r.estimation, r.nb_soumissionnaires) == ("", "", "", "", None, None)


def test_detail_first_award_container_only(spark):
    html = "<div id='x_attribution'>Titulaire : NON SA</div><div id='y_resultat'>Attributaire : OUI SA<br>3 candidats</div>"
    r = pages.detail_records(page(spark, html), BASE).first()
    assert (r.attributaire, r.nb_soumissionnaires) == ("OUI SA", 3)


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files:
            z.writestr(name, body)
    return out.getvalue()


def test_archive_depth_and_damage(spark, tmp_path):
    data = zipped([("deep.pdf", b"7")])
    for depth in range(6):
        data = zipped([("n.zip", data), (f"f{depth}.pdf", b"x")])
    (tmp_path / "nested.zip").write_bytes(data)
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    broken = bytearray(zipped([("a.pdf", b"A" * 50), ("b.pdf", b"B" * 50)]))
    at = bytes(broken).index(b"B" * 50)
    broken[at] = 65
    (tmp_path / "broken.zip").write_bytes(bytes(broken))
    rows = archives.expand(archives.read_archives(spark, str(tmp_path))).collect()
    by = lambda name: [r for r in rows if r.archive.endswith(name)]
    assert sorted(r.depth for r in by("nested.zip")) == [0, 1, 2, 3, 4, 5]   # the innermost archive is dropped unopened
    assert all(r.is_valid for r in by("nested.zip"))
    assert [(r.entry_path, r.is_valid) for r in by("bad.zip")] == [(None, False)]
    assert [r.entry_path for r in by("broken.zip")] == ["a.pdf", None] and not by("broken.zip")[0].is_valid


def test_large_entries_come_in_parts(spark):
    """No byte of an entry above the bound of one value is lost; a damaged one gives no part."""
    large = random.Random(5).randbytes(10_500)
    good = zipped([("a.pdf", b"A" * 1000), ("large.pdf", large), ("n.zip", zipped([("even.pdf", large[:3000])]))])
    broken = bytearray(zipped([("large.pdf", large)]))
    broken[bytes(broken).index(large) + 9_000] ^= 1
    df = spark.createDataFrame([("good", good), ("broken", bytes(broken))], "archive string, content binary")
    rows = archives.expand(df, value_bytes=1000, part_bytes=1500).collect()
    of = lambda path: sorted((r for r in rows if r.entry_path == path), key=lambda r: r.part)
    for path, body in (("large.pdf", large), ("n/even.pdf", large[:3000])):
        assert b"".join(r.content for r in of(path)) == body and [r.part for r in of(path)] == list(range(-(-len(body) // 1500)))
        assert {(r.size, r.content_md5, r.error, r.archive) for r in of(path)} == {(len(body), hashlib.md5(body).hexdigest(), None, "good")}
    assert [(r.size, bytes(r.content), r.content_md5) for r in of("a.pdf")] == [(1000, b"A" * 1000, None)]
    full = spark.createDataFrame([("z", zipped([("a.pdf", bytes((1 << 24) + 1))]))], "archive string, content binary")
    assert [r.entry_path for r in archives.expand(full).select("entry_path").collect()] == ["a.pdf"]   # nothing left to send after it
    assert [(r.entry_path, r.is_valid, r.content) for r in rows if r.archive == "broken"] == [(None, False, None)]
    listed = archives.expand(df, with_content=False, value_bytes=1000).where("archive = 'good'").collect()
    assert sorted((r.entry_path, r.size, r.content) for r in listed) == [("a.pdf", 1000, None), ("large.pdf", 10_500, None), ("n/even.pdf", 3000, None)]


def test_document_order(spark):
    e = spark.createDataFrame([("z", "B.PDF"), ("z", "b.pdf"), ("z", "a.Pdf"), ("z", "x.txt")], "archive string, entry_path string")
    assert [r.entry_path for r in archives.select_documents(e).orderBy("is_upper", "entry_path").collect()] == ["b.pdf", "B.PDF"]


def test_cascade_boundaries(spark):
    docs = [(1, "a", 0, "x" * 100, "", "OCR text", '{"montant_estime": 5}'), (2, "a", 0, "x" * 99, "", "scan", None),
            (3, "a", 0, "abc", "bc", "", None), (4, "a", 0, "x" * 101, None, "scan", '{"montant_estime": 5}')]
    ddl = "tender_id long, doc_path string, ord int, native string, tables string, ocr string, reply string"
    got = {r.tender_id: r for r in summary.cascade(spark.createDataFrame(docs, ddl)).collect()}
    assert (got[1].text, got[1].amount, got[1].tier) == ("x" * 100, None, "native")   # neither scanned nor asked
    assert got[2].text == "x" * 99 + "\nscan" and got[2].tier == "ocr"
    assert got[3].text == "abc"
    assert (got[4].amount, got[4].tier) == (5.0, "reply")


def test_pieces_give_the_whole_text(spark):
    rng = random.Random(3)
    words = ["Objet", " : ", "Tél", "0522334455", "Estimation", "12 000", "mot", "a@b.ma", "Date limite", "01/02/2024", "Acheteur : V"]
    docs = [(t, f"d{i}", i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))).strip(), float(i) if i % 3 else None)
            for t in range(12) for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(docs, "tender_id long, doc_path string, ord int, text string, amount double")
    whole = {t: "\n\n".join(d[3] for d in docs if d[0] == t) for t in range(12)}
    pieces = summary.join_texts(df, per_piece=4).orderBy("tender_id", "piece").collect()
    assert {t: "\n\n".join(p.text for p in pieces if p.tender_id == t) for t in range(12)} == whole
    for found in summary.tender_findings(df, per_piece=4).collect():
        amounts = [d[4] for d in docs if d[0] == found.tender_id and d[4]]
        assert found.amount == (amounts[0] if amounts else None)
        assert found.n_docs == sum(d[0] == found.tender_id for d in docs)
        for label, pattern in S.KEY_POINTS:
            m = re.search(pattern, whole[found.tender_id], re.I)
            assert found[label] == (m.group(1).strip()[:150] or None if m else None), (label, whole[found.tender_id])


def test_conform(spark):
    old = spark.createDataFrame([(1, "R")], "id long, reference string")
    new = quality.conform(old, S.TENDERS, quality.TENDER_DEFAULTS)
    assert new.schema.names == S.TENDERS.names and new.first().retry_count == 0
    assert set(quality.added_columns(old, S.TENDERS)) == set(S.TENDERS.names) - {"id", "reference"}


def test_retention_boundary(spark):
    now = dt.datetime(2024, 3, 10, 12)
    rows = [("archive", now - dt.timedelta(days=7, hours=23)), ("archive", now - dt.timedelta(days=8)), ("other", now - dt.timedelta(days=900))]
    df = spark.createDataFrame(rows, "kind string, modified_at timestamp")
    kept, gone = retention.split(df, F.lit(now))
    assert (kept.count(), gone.count()) == (2, 1)


def test_formats_round_trip(spark, tmp_path):
    rows = [(1, None, "R'1", "a,\"b\"\nc", 1.5), (2, "", "é", None, None)]
    df = spark.createDataFrame(rows, "id long, url_id string, reference string, objet string, estimation double")
    for fmt in ("parquet", "orc", "csv", "json"):
        append(df, str(tmp_path / fmt), fmt)
        append(df, str(tmp_path / fmt), fmt)
        back = keyed(spark, str(tmp_path / fmt), df.schema, fmt)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect() * 2)), fmt


def test_stray_and_unclosed_quotes(spark):
    """A quote delimits only behind an equals sign; one that is never closed doesn't swallow the rows after it."""
    html = f"<table><tr><td title='l'ete'>a</td></tr>{ROW}<tr><td title=it's b\"c>d</td></tr>{ROW.replace('R/12', 'R/13')}<tr><td id=\"x>e</td></tr></table>"
    assert [r.reference for r in pages.listing_rows(page(spark, html), BASE).collect()] == ["R/12", "R/13"]
    assert [r.reference for r in pages.listing_rows(page(spark, "<table>" + ROW.replace("<td>a", "<td data-x='1>0'>a") + "</table>"), BASE).collect()] == ["R/12"]


def test_key_points_over_a_gap_in_the_order(spark):
    """The next document with text is the next one, whatever lies between their numbers."""
    for last in (1, 255, 256, 600, 100_000):
        rows = [(1, "a", 0, "Tel", None), (1, "b", last, "0612345678", 5.0), (1, "c", last + 1, "", 7.0), (2, "a", 0, "x", None)]
        docs = spark.createDataFrame(rows, "tender_id long, doc_path string, ord int, text string, amount double")
        got = {r.tender_id: r for r in summary.tender_findings(docs).collect()}
        assert (got[1]["Téléphone"], got[1].amount, got[1].n_docs) == ("0612345678", 5.0, 3) and got[2]["Téléphone"] is None


def test_key_points_over_any_number_of_documents(spark):
    """Matches that start in one document and end many documents later are those of the whole joined text."""
    rng = random.Random(11)
    words = ["Tel", "Tél +", "Montant : 1", "1", "2 3", ".", "0612345678", "+212 612345678", "Objet", "Objet : ab", "abc", "\U0001f600 mot", "DH 5", "Date limite",
             "01/02/2024 10h", "Acheteur :", "x" * 300, "7" + " " * 400 + "8", "Lieu d'exécution", "a@b", "c.ma", "12\n000"]
    kinds = [words, ["Tel", "mot", "0612345678"], ["Montant 5", "1", "2", "."], ["Objet", "ab", "\U0001f600", "Acheteur", "un mot"]]
    docs = [(t, f"d{i:03}", i * (1 + t % 3), "" if rng.random() < 0.1 else rng.choice(kinds[t % 4]), None)
            for t in range(60) for i in range(rng.choice([3, 20, 120]))]
    docs += [(100, f"d{i:04}", i, "Tel" if i == 0 else "0522334455" if i == 799 else "mot", None) for i in range(800)]
    df = spark.createDataFrame(docs, "tender_id long, doc_path string, ord int, text string, amount double").repartition(4)
    whole = {t: "\n\n".join(d[3] for d in docs if d[0] == t and d[3]) for t in {d[0] for d in docs}}
    assert {(r.tender_id, r.piece): r.text for r in summary.join_texts(df, per_piece=2).collect()} == {(t, 0): w for t, w in whole.items() if w}
    pieces = summary.join_texts(df, per_piece=2, piece_bytes=100).orderBy("tender_id", "piece").collect()
    assert {t: "\n\n".join(p.text for p in pieces if p.tender_id == t) for t in whole} == whole and len(pieces) > len(whole)
    for per_piece in (1, 2, 7, 256):
        found = {r.tender_id: r for r in summary.tender_findings(df, per_piece).collect()}
        assert found.keys() == whole.keys() and found[100]["Téléphone"] == "0522334455"
        for t, text in whole.items():
            for label, pattern in S.KEY_POINTS:
                m = re.search(pattern, text, re.I)
                assert found[t][label] == (m.group(1).strip()[:150] if m else None), (per_piece, t, label)


@pytest.mark.parametrize("unit,end", [("<!--", ""), ("<script ", ""), ('<a x="', ""), ("<td x", ""), ('<a x="', '=">"'), ("<a", ' =">"'), ("<a ", '=">"'),
                                      ("<a x='<b y=\"", '=">"'), ("<b>", "</i>" * 1000), ("<!--", ">")])
def test_page_reader_takes_linear_time_on_unclosed_markup(unit, end):
    """Four times the page takes about four times as long, not sixteen times; the text in front is read all the same."""
    from tenderloom.sources.pages import DETAIL_MARKS, _Page

    def seconds(size):
        start = time.perf_counter()
        page = _Page('<td id="x">front</td>' + unit * (size // len(unit)) + end, DETAIL_MARKS)
        assert page.texts(page.found[0])[0] == "front"
        return time.perf_counter() - start

    small, large = min(seconds(250_000) for _ in range(2)), seconds(1_000_000)
    assert large < 8 * small + 0.3 and large < 3


def test_scanner_splits_tags():
    from tenderloom.sources.pages import _Scanner
    page = "a<!-- <b> --><p class='x > y' id=z>t</P ><script>if (a<b) '<i>'</script ><br/><!D><a x='>\"<a =\"><b"
    assert [t[2:] for t in _Scanner(page).tags()] == [
        (False, "", ""), (False, "p", " class='x > y' id=z"), (True, "p", " "), (False, "", ""), (False, "br", "/"), (False, "", ""), (False, "a", " x='"),
        (False, "a", ' ="')]


def test_archives_are_built_and_read_in_batches_of_bounded_size():
    """One Arrow batch of many texts gives many small ones, whatever the number of rows Spark hands over at once."""
    from tenderloom.sources import batches, bindings

    texts = [random.Random(i).randbytes(50_000).hex() for i in range(120)] + [None]
    given = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(121), pa.int64()), "text": pa.array(texts, pa.string())})
    built = list(bindings._build_archives(iter([given])))
    assert sum(b.num_rows for b in built) == 121 and len(built) >= 3 and max(b.nbytes for b in built) < 2.5 * batches.SLICE_BYTES
    whole = pa.Table.from_batches(built).combine_chunks().select(["archive", "content"]).to_batches()
    read = list(archives._read(iter(whole), True, archives.MAX_VALUE_BYTES, archives.PART_BYTES))
    assert len(read) >= 3 and max(b.nbytes for b in read) < 2 * batches.SLICE_BYTES
    paths = [p for b in read for p in b.column(1).to_pylist()]
    assert Counter(paths) == {"avis.pdf": 31, "lisez-moi.txt": 31, "a.txt": 30, "lot/sub/B.PDF": 30, "lot/b.pdf": 30, "notes.txt": 30, None: 30}
    listed = list(archives._read(iter(whole), False, archives.MAX_VALUE_BYTES, archives.PART_BYTES))
    assert len(listed) == 1 and listed[0].column(3).to_pylist() == [s for b in read for s in b.column(3).to_pylist()]


def test_outcomes_read_archives_once(spark):
    """Entries are unpacked a single time, also for a null or repeated archive name."""
    bad = spark.createDataFrame([("/a", zipped([("x.pdf", b"1"), ("y.txt", b"2")])), ("/b", zipped([("y.txt", b"2")])), ("/b", b""), (None, b"")],
                                "archive string, content binary")
    queue = spark.createDataFrame([(1, "/a"), (2, "/b"), (3, "/c"), (4, None), (5, "/b")], "id long, zip_path string")
    failed = archives.archive_outcomes(queue, archives.expand(bad, with_content=False))
    assert failed._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    none, gone = "Aucun PDF dans le ZIP", "ZIP introuvable"
    assert sorted((r.tender_id, r.error) for r in failed.collect()) == [(2, none), (3, gone), (4, gone), (5, none)]


def test_whole_tags_are_read_in_one_match(monkeypatch):
    """Ordinary tags are never walked sign by sign; odd ones are read as the walk alone reads them."""
    from tenderloom.sources.pages import DETAIL_MARKS, ROW_MARKS, _Page, _Scanner

    bits = ["<", "</", ">", "a", "td", "tr", "table", "div", "script", "</script>", "<!--", "-->", "<!", "=", " ", "\n", "\"", "'", "id=", "class=", "href=",
            "/", "&amp;", "_panelBlocObjet", "info-bulle", "<br>", "<p>", "<td id='k_panelBlocObjet'>", "</div>", "<a href=\"/x>y\">"]
    rng = random.Random(7)
    sources = ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(3000)] + ["<a x=" + "y" * 5000 + "><b>1</b>", ROW]
    read = lambda: [[(n["tag"], n["id"], n["css"], n["href"], n["within"], page.texts(n)) for n in page.found]
                    for source in sources for marks in (DETAIL_MARKS, ROW_MARKS) for page in [_Page(source, marks)]]
    found = read()
    monkeypatch.setattr(pages, "_TAG_CHARS", 0)
    assert read() == found
    monkeypatch.undo()
    monkeypatch.delattr(_Scanner, "_end")
    assert [n["tag"] for n in _Page(ROW * 3, ROW_MARKS).found].count("a") == 3


def test_an_ordinary_tag_takes_one_match(monkeypatch):
    """The next sign is looked at as a whole tag first; kinds of tags are told apart only where that fails."""
    from tenderloom.sources.pages import _Scanner

    sought, opening = [], pages._OPENING

    class Counted:
        @staticmethod
        def search(source, at):
            sought.append(at)
            return opening.search(source, at)

    monkeypatch.setattr(pages, "_OPENING", Counted)
    page = "<p id='a'>1</p>" * 50
    assert len(list(_Scanner(page).tags())) == 100 and len(sought) <= 1
    assert [t[3] for t in _Scanner("<scripted><script a>b<i></script><style><u></style><b>").tags()] == ["scripted", "", "", "b"]
