import glob
import hashlib
import io
import struct

import numpy as np
import pytest
import zstandard

from lakemart.llm import warc


def test_round_trip_of_odd_pages(spark, tmp_path, rows):
    long, other = "<p>é" * 600, "x" * 1500
    data = [
        (1, "http://a/", long), (2, "http://b/\r\nEvil: 1", long), (7, None, long), (3, "u", other), (4, "u", None),
        (5, "u", ""), (6, "u", "short"), (8, "u", "short"), (9, "u", "\r\n\r\nWARC/1.1\r\n" + "a" * 2_000_000),
        (None, "n", other), (None, None, "z" * 1200), (10, "u", "q" * 1100), (10, "u", "q" * 1100),
    ]
    pages = spark.createDataFrame([(*x, "extra") for x in data], "page_id long, url string, html string, digest string")
    out = warc.round_trip(pages.repartition(3))
    got = rows(out, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

    def wanted(page_id, html):
        body = (html or "").encode()
        same = [p for p, _, h in data if h == html and p is not None]
        first = max(same) if len(body) >= 1000 and same else page_id
        kind = "response" if page_id == first else "revisit"
        return (page_id, len(body), hashlib.sha1(body).hexdigest(), kind, first if kind == "revisit" else None)

    assert got == sorted((wanted(p, h) for p, _, h in data), key=repr)
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in out.where("record_type = 'response' and page_id < 10").collect()}
    assert payloads == {7: long, 3: other, 4: "", 5: "", 6: "short", 8: "short", 9: data[8][2]}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_hold_a_dictionary_and_one_frame_per_record(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<html><title>page {i}</title>{'lorem ipsum ' * (i % 90)}") for i in range(3000)], "page_id long, url string, html string")
    warc.write(pages.coalesce(1), str(tmp_path / "out"))
    records = 0
    for name in glob.glob(f"{tmp_path}/out/part-*"):
        with open(name, "rb") as f:
            data = f.read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_FRAME and size > 1000
        known = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        # Another decoder, reading across all frames, sees the same records.
        stream = zstandard.ZstdDecompressor(dict_data=known).stream_reader(io.BytesIO(data), read_across_frames=True)
        whole = stream.read()
        assert whole == b"".join(warc.frames(data))
        records += sum(1 for _ in warc.frames(data))
        assert data.count(struct.pack("<I", warc.FRAME)) >= records
    assert records == 3000


def sample_archive():
    digest = hashlib.sha1(b"body").hexdigest()
    frame = zstandard.ZstdCompressor().compress(warc.record(1, "http://a/", b"body", digest, None))
    return struct.pack("<II", 0x184D2A50, 0) + frame


@pytest.mark.parametrize(
    "spoil",
    [
        lambda d: d[:-5],
        lambda d: d + b"\0\0\0\0\0",
        lambda d: d + b"PK",
        lambda d: d[:4] + b"\xff\xff\0\0" + d[8:],
    ],
)
def test_broken_archives_are_refused(spoil):
    assert warc.page(warc.parse(next(warc.frames(sample_archive()))))["page_id"] == 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.frames(spoil(sample_archive())))


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"WARC/9.9"),
        (b"Content-Length: 8", b"Content-Length: 9"),
        (b"WARC-Date", b"WARC-Dato"),
        (b"body", b"bodx"),
        (b"response", b"revisit!"),
        (b"WARC-Type: ", b"WARC-Type "),
    ],
)
def test_wrong_headers_and_lengths_are_refused(old, new):
    data = next(warc.frames(sample_archive()))
    assert old in data
    with pytest.raises((ValueError, KeyError)):
        warc.page(warc.parse(data.replace(old, new, 1)))


def test_compressed_dictionary():
    samples = [f"<html>{i} some text about page {i % 7}</html>".encode() * 3 for i in range(500)]
    raw = warc.dictionary(samples, 2048)
    assert raw and warc.dictionary([], 2048) == b""
    body = zstandard.ZstdCompressor().compress(raw)
    frame = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)).compress(b"record")
    lead = struct.pack("<II", warc.DICTIONARY_FRAME, len(body)) + body
    assert list(warc.frames(lead + frame)) == [b"record"]


@pytest.mark.parametrize("parts, rows_at_most, bytes_at_most", [("1", 50, 1 << 30), ("4", 10**6, 30_000), ("2", 7, 20_000)])
def test_archives_are_closed_by_rows_and_bytes_whatever_the_tasks(
    spark, tmp_path, conf, monkeypatch, parts, rows_at_most, bytes_at_most
):
    conf(spark__sql__shuffle__partitions=parts)
    monkeypatch.setattr(warc, "ARCHIVE_ROWS", rows_at_most)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", bytes_at_most)
    noise = np.random.default_rng(3)
    html = [noise.bytes(int(noise.integers(0, 4000))).hex() for _ in range(300)] + [noise.bytes(200_000).hex()]
    pages = spark.createDataFrame([(i, None, x) for i, x in enumerate(html)], "page_id long, url string, html string")
    warc.write(pages.coalesce(1), str(tmp_path / "w"))
    files = sorted((tmp_path / "w").glob("part-*"))
    for file in files:
        frames = list(warc.frames(file.read_bytes()))
        assert 0 < len(frames) <= rows_at_most
        # Without its last record, and the dictionary, an archive is below the limit.
        assert sum(map(len, frames[:-1])) // 2 <= bytes_at_most + 70_000
    assert len(files) >= (301 / rows_at_most if rows_at_most < 10**6 else sum(map(len, html)) / 2 / (bytes_at_most + 210_000))
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert got == dict(enumerate(html))
