import hashlib
import io
import zipfile

import pytest
from pricewatch.llm import warc_zip


@pytest.fixture
def pages(spark):
    def make(*rows):
        return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")

    return make


def expected(rows):
    best = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 1000:
            best[raw] = max(best.get(raw, -1), i if i is not None else -1)
    out = []
    for i, u, h in rows:
        raw = (h or "").encode()
        keep = best.get(raw, -1)
        revisit = keep >= 0 and keep != i
        out.append((i, u, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages, tmp_path):
    big = "é" * 500
    rows = [(1, "http://a/ü?x=1\r\ny", "<p>hi</p>"), (2, None, big), (3, "u", big), (None, "u", big), (3, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "é" * 499), (7, "u", "é" * 499)]
    rows += [(8, "u", "long \r\n\r\n WARC/1.1 " * 100_000)]
    manifest = warc_zip.write_packages(pages(*rows), str(tmp_path), package_bytes=3000)
    assert manifest.count() > 1
    got = warc_zip.read_packages(manifest, range_bytes=500)
    fields = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[f] for f in fields) for r in got.collect()), key=str) == expected(rows)
    payloads = {(r.page_id, bytes(r.payload)) for r in got.filter("record_type = 'response'").collect()}
    assert {(i, (h or "").encode()) for i, _, h in rows if len((h or "").encode()) < 1000} <= payloads
    assert got.filter("not intact").count() == 0


def test_empty(pages, tmp_path):
    assert warc_zip.read_packages(warc_zip.write_packages(pages(), str(tmp_path))).count() == 0


@pytest.mark.parametrize("count", [3, 70_000])  # more than 65,535 members need the ZIP64 directory
def test_directory_forms(count):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open("wide", "w", force_zip64=True) as f:
            f.write(b"wide member")
        for i in range(count):
            z.writestr(f"m{i}", b"%d" % i)
        z.comment = b"PK a comment"
    size = len(out.getvalue())
    found = warc_zip.directory(out, size)
    assert len(found) == count + 1
    for name, text in (("wide", b"wide member"), ("m2", b"2"), (f"m{count - 1}", b"%d" % (count - 1))):
        start, n = warc_zip.member(out, found[name])
        assert out.getvalue()[start : start + n] == text


def test_wide_sizes_come_from_the_extra_field():
    import struct

    extra = struct.pack("<HHI", 7, 4, 0) + struct.pack("<HHQQ", 1, 16, 1 << 33, 1 << 34)
    assert warc_zip._wide(extra, [False, True, True], [5, 0xFFFFFFFF, 0xFFFFFFFF]) == [5, 1 << 33, 1 << 34]


def test_compressed_member_is_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError, match="stored"):
        warc_zip.member(out, warc_zip.directory(out, len(out.getvalue()))["a"])
