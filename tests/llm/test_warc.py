import base64
import hashlib
import io

import pytest
import zstandard

from clickmart.llm import warc

SCHEMA = "page_id long, url string, html string, fetched string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, min_bytes):
    found = []
    for page_id, _, html, _ in rows:
        size = len((html or "").encode())
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        largest = max(same, default=None)
        revisit = size >= min_bytes and page_id != largest
        found.append((str(page_id), size, digest(html), "revisit" if revisit else "response", largest if revisit else None))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def pages():
    rows = [(n, f"http://example.org/{n}", f"<p>page é {n % 7} " + "word " * (n % 7) * 50, "x") for n in range(60)]
    rows += [(100, None, None, "x"), (101, "http://a\r\nWARC-Type: evil", "", "x"), (102, "u", "once\r\n\r\nWARC/1.1\r\n", None)]
    return [*rows, (103, "big", "long text " * 200_000, "x"), (None, "u", "<p>no id", "x"), (None, "v", "<p>page é 1 ", "x")]


@pytest.mark.parametrize(("min_bytes", "archive_bytes"), [(0, 1 << 20), (40, 2_000)])
def test_round_trip(spark, pages, min_bytes, archive_bytes):
    folder = warc.new_folder(spark)
    made = warc.write_archives(spark.createDataFrame(pages, SCHEMA).repartition(3), folder, min_bytes, archive_bytes)
    rows = warc.read_archives(spark, folder, made).collect()
    assert sorted([(str(r[0]), *r[1:5]) for r in rows], key=str) == brute(pages, min_bytes)
    assert sum(r.records for r in made.collect()) == len(pages)
    assert made.count() > 3 or archive_bytes > 10_000


def test_files_of_tries_that_were_not_committed_are_not_read(spark, pages):
    folder = warc.new_folder(spark)
    frame = spark.createDataFrame(pages, SCHEMA).repartition(2)
    warc.write_archives(frame, folder, archive_bytes=2_000)
    made = warc.write_archives(frame, folder, archive_bytes=5_000)
    rows = warc.read_archives(spark, folder, made).collect()
    assert sorted([(str(r[0]), *r[1:5]) for r in rows], key=str) == brute(pages, 0)
    names = [r.file for r in made.collect()]
    assert len(set(names)) == len(names)


def test_archive_is_one_frame_per_record_after_the_dictionary():
    records = [warc.record(n, f"http://a/{n}", digest(f"page {n}"), f"page {n}".encode()) for n in range(500)]
    data = warc.archive(records)
    size = int.from_bytes(data[4:8], "little")
    assert data[:4] == bytes.fromhex("5D2A4D18")
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    rest, found = data[8 + size :], []
    while rest:
        one = press.decompressobj()
        found.append(one.decompress(rest))
        rest = one.unused_data
    assert found == records
    assert [r["payload"] for r in warc.read_archive(data)] == [f"page {n}".encode() for n in range(500)]
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) < plain


def test_no_pages_and_bad_files(spark):
    folder = warc.new_folder(spark)
    made = warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert made.count() == 0
    with pytest.raises(ValueError, match="dictionary"):
        list(warc.read_archive(io.BytesIO(b"x" * 40).getvalue()))
