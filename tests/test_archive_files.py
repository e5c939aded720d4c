"""Archives as files, read by ranges of entries, against the reader of whole values."""

import hashlib
import io
import random
import zipfile

import pytest

from tenderloom.sources import archive_files, archives

COLUMNS = ["archive", "entry_path", "depth", "size", "is_valid"]


def zipped(files, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, body in files:
            z.writestr(name, body)
    return out.getvalue()


def damaged(data, mark):
    broken = bytearray(data)
    broken[bytes(broken).index(mark)] ^= 1
    return bytes(broken)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Plain, nested, empty and damaged archives; damage in front, in the middle, in an inner archive and of one."""
    rnd, root = random.Random(3), tmp_path_factory.mktemp("zips")
    body = [rnd.randbytes(900 + 37 * i) for i in range(40)]
    plain = [(f"d{i}/f{i}.pdf", b) for i, b in enumerate(body)]
    inner = zipped([("x.pdf", body[0]), ("deeper.zip", zipped([("y.PDF", body[1] * 20), ("z.txt", b"")])), ("w.txt", body[2])])
    stored = zipped(plain, zipfile.ZIP_STORED)
    deep = zipped([("deep.pdf", b"7")])
    for depth in range(6):
        deep = zipped([("n.zip", deep), (f"f{depth}.pdf", b"x")])
    files = {
        "plain": zipped(plain), "mixed": zipped([("a.zip", inner), *plain[:5], ("e/", b""), ("b.zip", inner)]),
        "middle": damaged(stored, body[20][100:140]), "front": damaged(stored, body[0][100:140]),
        "no_inner": zipped([("bad.zip", b"no zip"), ("good.zip", inner), plain[0]]),
        "inner_damage": zipped([("in.zip", damaged(zipped(plain[:6], zipfile.ZIP_STORED), body[3][5:40])), ("after.zip", inner), plain[7]]),
        "lost_inner": damaged(zipped([("one.zip", inner), ("two.zip", inner[:-1] + b"\1"), plain[2]], zipfile.ZIP_STORED), inner[60:100]),
        "empty": zipped([]), "folders": zipped([("a/", b""), ("b/", b"")]), "none": b"", "text": b"no archive at all", "deep": deep,
    }
    for name, data in files.items():
        (root / f"{name}.zip").write_bytes(data)
    return root


@pytest.mark.parametrize("range_bytes, held_bytes", [(1 << 26, 1 << 26), (5000, 300), (20_000, 1000)])
def test_ranges_give_the_entries_of_whole_archives(spark, folder, range_bytes, held_bytes):
    files = archive_files.archive_files(spark, str(folder))
    got = archive_files.scan(files, range_bytes, held_bytes).collect()
    want = archives.expand(archives.read_archives(spark, str(folder))).collect()
    key = lambda r: tuple(str(r[c]) for c in COLUMNS) + (str(r["error"] is not None and r["depth"] > -1),)
    of = lambda rows: sorted(key(r) for r in rows if r.entry_path is not None or r.size is not None or r.error is None)
    assert of(got) == of(want)
    assert {r.archive for r in got} == {r.archive for r in want} and len(got) == len(want)
    digest = {(r.archive, r.entry_path): hashlib.md5(r.content).hexdigest() for r in want if r.content is not None}
    assert {(r.archive, r.entry_path): r.content_md5 for r in got if r.entry_path is not None} == digest


def test_one_archive_goes_to_many_ranges(spark, folder):
    files = archive_files.archive_files(spark, str(folder)).filter("archive LIKE '%/plain.zip'")
    ranges = archive_files.entry_ranges(files, 3000).orderBy("first").collect()
    assert len(ranges) > 10 and ranges[0].first == 0 and ranges[-1].last == 40
    assert all(a.last == b.first for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("value_bytes, held_bytes", [(1 << 20, 1 << 20), (1000, 300)])
def test_chosen_entries_are_read_whole(spark, folder, value_bytes, held_bytes):
    entries = archive_files.scan(archive_files.archive_files(spark, str(folder)))
    docs = archives.select_documents(entries)
    parts = archive_files.read_contents(docs, value_bytes, 700, held_bytes=held_bytes).collect()
    whole = {}
    for r in sorted(parts, key=lambda r: r.part):
        whole.setdefault((r.archive, r.entry_path), []).append(bytes(r.content))
    want = {(r.archive, r.entry_path): r.content_md5 for r in docs.collect()}
    assert {k: hashlib.md5(b"".join(v)).hexdigest() for k, v in whole.items()} == want
    if value_bytes == 1000:
        assert max(len(r.content) for r in parts) <= 1000 and max(r.part for r in parts) > 0


def test_no_archives(spark, folder):
    none = archive_files.archive_files(spark, str(folder)).limit(0)
    entries = archive_files.scan(none)
    assert entries.count() == 0 and archive_files.read_contents(entries).count() == 0


def test_archive_above_two_gib(spark, tmp_path):
    """More bytes than one value can hold, most of them of few kinds so that the file is made quickly."""
    block = random.Random(9).randbytes(1 << 24)
    with zipfile.ZipFile(tmp_path / "large.zip", "w", zipfile.ZIP_STORED) as z:
        for i in range(9):
            with z.open(f"f{i}.pdf", "w", force_zip64=True) as out:
                for _ in range(15):
                    out.write(block)
    assert (tmp_path / "large.zip").stat().st_size > 1 << 31
    digest = hashlib.md5()
    for _ in range(15):
        digest.update(block)
    rows = archive_files.scan(archive_files.archive_files(spark, str(tmp_path))).collect()
    assert {(r.size, r.content_md5, r.is_valid) for r in rows} == {(15 << 24, digest.hexdigest(), True)} and len(rows) == 9
    (tmp_path / "large.zip").write_bytes(b"")   # the disk is given back at once


def test_downloads_as_files(spark, folder):
    files = archive_files.archive_files(spark, str(folder)).selectExpr("archive AS url", "archive", "length")
    valid = {r.url.rsplit("/", 1)[1]: r.is_valid for r in archives.stored_files(files).collect()}
    assert valid == {**{f"{n}.zip": True for n in ("plain", "mixed", "no_inner", "inner_damage", "empty", "folders", "deep")},
                     **{f"{n}.zip": False for n in ("middle", "front", "lost_inner", "text")}}   # files without a byte are not listed


def test_entries_written_as_archives_come_back(spark, tmp_path):
    rows = [(f"{i}.pdf", bytes([i]) * i) for i in range(200)] + [("null.pdf", None)]
    stored = archive_files.store(spark.createDataFrame(rows, "entry_path string, content binary").repartition(3), str(tmp_path))
    got = {r.entry_path: bytes(r.content) for r in archive_files.read_contents(archive_files.scan(stored)).collect()}
    assert got == {path: body or b"" for path, body in rows} and stored.count() >= 3
