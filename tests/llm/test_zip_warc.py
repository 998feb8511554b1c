"""ZIP packages against the standard library, and the round trip of pages."""

import gzip
import hashlib
import io
import zipfile

import pytest

from pairprep.llm import zip_warc as Z


@pytest.mark.parametrize("zip64", [False, True])
def test_package_is_a_zip_archive(zip64):
    out = io.BytesIO()
    package = Z.Package(out, zip64)
    records = [Z.record(i, "http://a/\n%", b"x" * i, i == 2, 1) for i in range(4)]
    for i, data in enumerate(records):
        package.add(i, data)
    package.close()
    archive = zipfile.ZipFile(io.BytesIO(out.getvalue()))
    assert archive.testzip() is None and archive.namelist() == [Z.DATA, Z.INDEX]
    assert all(m.compress_type == zipfile.ZIP_STORED for m in archive.infolist())
    members = Z.members_of(out, len(out.getvalue()))
    for name, (at, size) in members.items():
        assert archive.read(name) == out.getvalue()[at : at + size]
    back = [gzip.decompress(Z.read_range(out, at, size)) for at, size in Z.index_of(out, members)]
    assert back == records


def test_archives_of_others_and_comments():
    """A comment that holds an end signature, a compressed member, a ZIP64 field out of place."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("packed.txt", "a" * 100, zipfile.ZIP_DEFLATED)
        with archive.open(zipfile.ZipInfo("large.txt"), "w", force_zip64=True) as member:
            member.write(b"large")
        archive.comment = b"some comment"
    members = Z.members_of(out, len(out.getvalue()))
    at, size = members["large.txt"]
    assert out.getvalue()[at : at + size] == b"large" and "packed.txt" not in members
    assert Z._large(b"\x01\x00\x10\x00" + (7).to_bytes(8, "little") + (9).to_bytes(8, "little"), Z.FULL32, Z.FULL32, 3) == (9, 3)
    with pytest.raises(ValueError):
        Z.members_of(io.BytesIO(b"none"), 4)


def test_damage_is_found():
    data = Z.record(1, "u", b"payload")
    with pytest.raises(ValueError):
        Z.parse_record(data.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def pages(spark):
    rows = [(1, "http://a", "same", "x"), (5, "http://b\r\nX: y", "same", "x"), (3, None, "same", "x"), (4, "", "", "x")]
    rows += [(8, "u", None, "x"), (9, "u", "é" * 3000, "x"), (10, "u", "twice", "x"), (10, "u", "twice", "x"), (None, "u", "same", "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def test_round_trip(spark):
    rows = Z.round_trip(spark, pages(spark)).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.page_id, []).append(r)
    kinds = {i: sorted((r.record_type, r.refers_to) for r in found) for i, found in by_id.items()}
    assert kinds[5] == [("response", None)] and kinds[1] == kinds[3] == kinds[None] == [("revisit", 5)]
    assert kinds[8] == [("response", None)] and kinds[4] == [("revisit", 8)]
    assert kinds[10] == [("response", None), ("revisit", 10)]
    for r in rows:
        said = {8: "", 4: "", 9: "é" * 3000, 10: "twice"}.get(r.page_id, "same").encode()
        assert r.payload_bytes == len(said) and len(r.payload_digest) == 32
        assert (r.payload is None) == (r.record_type == "revisit")
        assert Z.base64.b32decode(r.payload_digest) == hashlib.sha1(said).digest()
    assert by_id[5][0].url == "http://b\r\nX: y"


def test_small_payloads_are_never_revisits(spark):
    kinds = [r.record_type for r in Z.round_trip(spark, pages(spark), min_revisit=5).collect()]
    assert kinds.count("revisit") == 1
    assert Z.round_trip(spark, pages(spark).limit(0)).count() == 0


def test_many_small_packages(spark, tmp_path):
    packages = Z.write_packages(pages(spark), str(tmp_path / "w"), package_bytes=1)
    assert packages.count() == 9 and {r.n_records for r in packages.collect()} == {1}
    places = Z.list_records(packages, str(tmp_path / "w"))
    assert Z.read_records(places, str(tmp_path / "w")).count() == 9
