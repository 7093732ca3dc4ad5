"""Archives written and read back: round trip, copies, lookups, damage."""

import base64
import hashlib
from pathlib import Path

import pytest
import zstandard
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from skyspark.llm import warc

DDL = "page_id long, url string, html string, record_id int, payload int, uid int, digest int, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0, 0, 0) for r in rows], DDL)


@pytest.fixture(scope="module")
def rows():
    same = "<p>copied page</p>"
    rows = [(i, f"http://x/{i}", f"<p>page {i} é漢\r\n\r\nWARC/1.1\r\n</p>" * (i % 7)) for i in range(100, 160)]
    rows += [(i, f"http://copy/{i}", same) for i in range(90, 40, -1)]
    rows += [(None, "http://nameless/", same), (200, None, None), (201, "", ""), (202, "http://a b\n c:\x07/é\u2028", "x"), (203, "http://big/", "漢" * 1_500_000)]
    rows += [(204, "http://twice/", "twice"), (204, "http://twice/", "twice"), (None, None, "never named"), (None, None, "never named")]
    return rows


@pytest.fixture(scope="module")
def archive(spark, rows, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('warc')}/a"
    return warc.write_archive(table(spark, rows).repartition(3), folder, frame_bytes=2000, bundle_bytes=3000)


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) for each row."""
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        page, _, html = rows[i]
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        seen = digest in first
        out.append((page, len(payload), digest, "revisit" if seen else "response", first.setdefault(digest, page) if seen else None))
        first.setdefault(digest, page)
    return sorted(map(repr, out))


def test_round_trip(archive, rows):
    got = archive.read().collect()
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(rows)
    assert len({r.record_id for r in got}) == len(rows)
    by_record = {r.record_id: r for r in got}
    texts = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    for r in got:
        if r.record_type == "response":
            assert r.page_id is None or bytes(r.payload) == texts[r.page_id]
        else:
            target = by_record[r.refers_to_record]
            assert target.record_type == "response" and target.payload_digest == r.payload_digest and target.page_id == r.refers_to
    assert {r.url for r in got if r.page_id == 202} == {"http://a%20b%0A%20c:%07/é%E2%80%A8"}


def test_bundles_are_plain_zstandard_and_seekable(archive, rows):
    folder = Path(archive.folder.removeprefix("file://")) / "bundles"
    index = archive.index().collect()
    assert len(index) == len(rows) and {r.bundle for r in index} == {p.name for p in folder.iterdir()}
    assert len({(r.bundle, r.frame) for r in index}) > 20
    whole = {}
    for path in folder.iterdir():
        with path.open("rb") as file:
            data = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        at, names = 0, []
        while at < len(data):
            headers, _, at = warc.parse_record(data, at)
            names.append(headers["WARC-Record-ID"])
        assert warc.parse_record(data)[0]["WARC-Type"] == "warcinfo"
        whole[path.name] = names
    assert sorted(n for names in whole.values() for n in names[1:]) == sorted(r.record_id for r in index)
    for r in index[:40]:  # one frame alone, one record in it
        packed = (folder / r.bundle).read_bytes()[r.frame_offset : r.frame_offset + r.frame_bytes]
        data = zstandard.ZstdDecompressor().decompress(packed)
        headers, _, end = warc.parse_record(data, r.offset)
        assert headers["WARC-Record-ID"] == r.record_id and end - r.offset == r.length


def test_lookup_and_payloads(spark, archive, rows):
    read = archive.read().select("record_id", "page_id", "record_type")
    asked = read.filter((F.col("page_id") % 10 == 5) | F.col("page_id").isin(200, 203)).select("record_id")
    twice = asked.unionByName(asked).unionByName(spark.createDataFrame([("<urn:uuid:none>",)], "record_id string"))
    found = archive.lookup(twice).collect()
    want = [r for r in rows if r[0] is not None and (r[0] % 10 == 5 or r[0] in (200, 203))]
    assert sorted(r.page_id for r in found) == sorted(r[0] for r in want)
    pages = {r.record_id: r.page_id for r in found}
    texts = {r[0]: (r[2] or "").encode() for r in want}
    payloads = archive.payloads(twice).collect()
    assert len(payloads) == len(want) and all(bytes(r.payload) == texts[pages[r.record_id]] for r in payloads)


def test_payloads_below_the_least_size_are_not_revisited(spark, tmp_path):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "a" * 50), (4, "u", "a" * 50)]
    got = warc.write_archive(table(spark, rows), f"{tmp_path}/b", min_bytes=10).read().collect()
    assert {r.page_id: r.refers_to for r in got} == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark, tmp_path):
    archive = warc.write_archive(table(spark, []), f"{tmp_path}/none")
    assert archive.read().count() == 0 and archive.index().count() == 0


def test_damage_is_found(spark, tmp_path):
    archive = warc.write_archive(table(spark, [(1, "u", "some text " * 50), (2, "u", "other text " * 40)]).coalesce(1), f"{tmp_path}/d")
    (path,) = (tmp_path / "d" / "bundles").iterdir()
    data = path.read_bytes()
    path.write_bytes(data[:-1] + b"\0")
    with pytest.raises(PythonException, match="seek table"):
        archive.read().count()
    (offset, packed, _), *_ = frames = frames_of(path, data)
    plain = zstandard.ZstdDecompressor().decompress(data[offset : offset + packed]).replace(b"other text", b"0ther text", 1)
    again = zstandard.ZstdCompressor().compress(plain)
    path.write_bytes(again + warc.seek_table([(len(again), len(plain))]))
    assert len(frames) == 1
    with pytest.raises(PythonException, match="damaged"):
        archive.read().count()


def frames_of(path, data):
    from pyarrow import fs

    path.write_bytes(data)
    with fs.LocalFileSystem().open_input_file(str(path)) as file:
        return warc.read_seek_table(file)
