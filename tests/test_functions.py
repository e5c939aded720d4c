"""Golden rows of the column functions."""

import datetime as dt

from conftest import values
from pyspark.sql import functions as F

from tenderloom.functions import amounts, dates, keys, links, phones, text
from tenderloom.operators.history import number_text
from tenderloom.operators.summary import parse_reply

NBSP = " "


def check(spark, expression, pairs, ddl="x string"):
    assert values(spark, [p[0] for p in pairs], expression, ddl) == [p[1] for p in pairs]


def test_parse_amount(spark):
    check(spark, amounts.parse_amount, [
        ("1 500 000,00 DH", 1500000.0), ("1.500.000,00", None), (f"1{NBSP}234,5", 1234.5), ("N/A", None), ("12,5,3", None),
        ("500 DH 700 DH", 500700.0), ("Lot 2: 3000", 2.0), ("", None), (None, None), ("٣٥٠ DH", 350.0), ("1.5.0", None), ("7.", 7.0)])


def test_format_amount(spark):
    check(spark, amounts.format_amount, [(None, ""), (2.5, "2"), (3.5, "4"), (15000000.0, "15 000 000"), (-0.4, "0"), (-1234.5, "-1 234")],
          "x double")
    check(spark, amounts.format_amount_text, [("abc", "abc"), ("1234.5", "1 234"), (None, "")])
    check(spark, amounts.truncated_amount, [(None, "N/A"), (0.0, "N/A"), (1999.9, "1 999")], "x double")


def test_normalize_date(spark):
    check(spark, dates.normalize_date, [
        ("2024-03-15", "15/03/2024"), ("2024-03-15T10:30:59", "15/03/2024 10:30"), (" 15/03/2024 10:00 ", "15/03/2024 10:00"),
        ("mars 2024", "mars 2024"), ("", ""), (None, ""), ("2024-03-15 10:30\nsuite", "15/03/2024 10:30"), (f"{NBSP}2024-03-15", "15/03/2024")])


def test_days_left(spark):
    as_of = F.lit(dt.date(2024, 3, 10))
    rows = [("15/03/2024 10:00", "5"), ("10/03/2024", "0"), ("09/03/2024", "Expiré"), ("1/4/2024", "22"), ("31/02/2024", ""),
            ("15/03/2024\n10:00", ""), (None, ""), ("", ""), (" 15/03/2024", ""), ("15/03/24", "")]
    check(spark, lambda c: dates.days_left_label(dates.days_left(c, as_of)), rows)


def test_normalize_phone(spark):
    check(spark, phones.normalize_phone, [
        ("+212 5 22-33.44.55", "0522334455"), ("0522334455/56", "0522334455\n0522334456"), ("none", "none"),
        ("0522334455 / 0522334455", "0522334455\n0522334405"), ("0522334455 0522334455", "0522334455\n0522334455"), (None, ""), ("", "")])


def test_links(spark):
    check(spark, links.url_id, [("?page=x&refConsultation=12&orgAcronyme=a", "12"), ("?page=x&id=12", ""), (None, "")])
    check(spark, lambda c: links.rebuild_pdf(c, "B"), [("index.php?page=dl&id=1", "B?page=dl&id=1"), ("a?b?c", "B?b"), ("/f.pdf", "/f.pdf")])
    check(spark, lambda c: links.resolve(c, "B"), [("?a=1", "B?a=1"), ("x?a", "x?a")])
    check(spark, lambda c: links.absolute(c, "https://h/index.php"), [("http://z/a", "http://z/a"), ("//a/b", "https://h/a/b")])
    check(spark, lambda c: links.archive_url(c, "B"), [
        ("B?refConsultation=5&orgAcronyme=a%20b", "B?page=entreprise.EntrepriseDownloadCompleteDce&reference=5&orgAcronym=a b"),
        ("B?refConsultation=5&orgAcronyme=", None), ("B?orgAcronyme=x", None), (None, None)])


def test_first_minutes_href(spark):
    check(spark, links.first_minutes_href, [
        ("<a title='x' href='?EntrepriseDownloadAvis&amp;i=1'>p</a><a href='EntrepriseDownloadAvis2'>", "?EntrepriseDownloadAvis&i=1"),
        ("<a href='x'>EntrepriseDownloadAvis</a>", "")])


def test_texts(spark):
    check(spark, text.best_text, [(["", "-", "Objet : x : y"], "x : y"), (["Label:"], "N/A"), ([], "N/A"), ([f"{NBSP}N/A ", "a"], "a")],
          "x array<string>")
    check(spark, text.first_text, [(["-", " a : b "], "a : b"), (["N/A"], "")], "x array<string>")
    check(spark, text.collapse, [(f" a{NBSP}\n b\t", "a b"), ("\x1c", "")])
    check(spark, lambda c: text.padded(c, 5), [("ab", "ab   "), ("abcdefg", "abcdefg")])
    check(spark, text.table_line, [([" a ", None, "b"], "a |  | b")], "x array<string>")
    check(spark, lambda c: text.keep_non_empty(c, F.lit("old")), [("n", "n"), ("", "old"), (None, "old")])


def test_find_amount(spark):
    check(spark, amounts.find_amount, [
        ("Estimation : 1 500 000,00 DH", 1500000.0), ("Budget prévisionnel 900 puis 2 000 000 DH", 2000000.0), ("1 250 000 MAD", 1250000.0),
        ("1.250.000,00 DH", None), ("prix 500", None), ("VALEUR ESTIMÉE\n: 2 000", 2000.0), (f"1{NBSP}250{NBSP}000 dhs", 1250000.0)])


def test_award(spark):
    t = "Attributaire : ACME SARL\nMontant attribué : 1 234 567,89\n5 soumissionnaires"
    from tenderloom import schemas as S
    check(spark, lambda c: text.strip(text.first_group(c, S.PATTERN_AWARDEE)), [(t, "ACME SARL")])
    check(spark, amounts.bidder_count, [(t, 5)])
    check(spark, amounts.awarded_amount, [(t, 1234567.895)])


def test_key_points(spark):
    t = "OBJET : Voirie urbaine\nAcheteur : Ville\nTél fixe : 0522334455 a@b.ma"
    got = values(spark, [t], text.key_points)[0]
    # the pattern is greedy after the label, so it swallows up to five characters of the value
    assert (got["Objet"], got["Acheteur"], got["Téléphone"], got["Email"]) == ("irie urbaine", "lle", "0522334455", "a@b.ma")
    assert got["Estimation"] is None


def test_parse_reply(spark):
    good = values(spark, ['```json\n{"montant_estime": 12, "objet": "x"}\n```'], parse_reply)[0]
    assert (good.montant_estime, good.montant_texte, good.objet) == (12.0, "12", "x")
    assert values(spark, ["nope", "[1]", "", None, '{"objet": '], parse_reply) == [None] * 5
    assert values(spark, ['{"objet": null}'], parse_reply)[0] is not None


def test_hashes(spark):
    import hashlib
    want = hashlib.sha256("R1||ville é".encode()).hexdigest()
    df = spark.createDataFrame([(" R1 ", None, " Ville É ")], "r string, d string, b string")
    assert df.select(keys.tender_hash(F.col("r"), F.col("d"), F.col("b")).alias("h")).first().h == want
    assert keys.tender_key(F.lit("5"), F.lit("R")) is not None


def test_number_text(spark):
    check(spark, number_text, [(15000000.0, "15000000.0"), (112946.26, "112946.26"), (0.5, "0.5"), (None, None), (-3.0, "-3.0")], "x double")


def test_priority(spark):
    check(spark, lambda c: amounts.priority_flag(c, 10.0), [(10.0, "NON"), (10.5, "OUI"), (None, "NON")], "x double")
    check(spark, lambda c: amounts.priority_flag(c, 10.0, F.lit(31)), [(11.0, "OUI")], "x double")
    check(spark, lambda c: amounts.priority_flag(c, 10.0, F.lit(30)), [(11.0, "NON")], "x double")
    check(spark, amounts.priority_flag, [("abc", "NON"), ("71000000", "OUI")])


def test_numbers_of_any_size_are_printed(spark):
    from tenderloom.operators.history import number_text
    rows = [1e45, float("nan"), float("inf"), 1.5e-12, 1e30, -2.5, 1e19, None]
    assert values(spark, rows, number_text, "x double") == ["1.0E45", "NaN", "Infinity", "1.5E-12", "1.0E30", "-2.5", "10000000000000000000.0", None]
    assert values(spark, rows, amounts.format_amount, "x double") == [
        "1.0E45", "NaN", "Infinity", "0", "1 000 000 000 000 000 000 000 000 000 000", "-2", "10 000 000 000 000 000 000", ""]
    assert values(spark, rows, amounts.truncated_amount, "x double") == [
        "1.0E45", "NaN", "Infinity", "0", "1 000 000 000 000 000 000 000 000 000 000", "-2", "10 000 000 000 000 000 000", "N/A"]
