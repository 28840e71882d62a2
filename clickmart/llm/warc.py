"""Archives of web pages: WARC records, each a Zstandard frame of its own, with a dictionary for each archive.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, built from records of that archive,
and then has one frame per record, so that any record can be read alone. Pages with equal payloads are stored once.
"""

import base64
import hashlib
import io
import re
import struct

import pyarrow as pa
import zstandard

from pyspark.sql import functions as F

from clickmart.llm.exchange import to_batch
from clickmart.llm.wavelet import put_file
from clickmart.session import scratch_path, stored

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 3 << 20
ARCHIVE_BYTES = 24 << 20
MIN_BYTES = 0
DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record(page_id, url, digest, payload=b"", size=None, refers_to=None, date=DATE):
    """The bytes of one record: a response with its payload, or a revisit of ``refers_to`` with the payload's ``size``."""
    body = payload if refers_to is None else b""
    size = len(body) if refers_to is None else size
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}", "", ""]
    return "\r\n".join(head).encode() + http + body + b"\r\n\r\n"


def build_dictionary(records, size=DICTIONARY_BYTES, sample_bytes=SAMPLE_BYTES):
    """A dictionary from evenly spaced records, ``sample_bytes`` of them at most; too few records serve as they are."""
    step = max(1, sum(map(len, records)) // sample_bytes)
    samples = records[::step]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def archive(records, level=3):
    """The bytes of an archive of ``records``."""
    dictionary = build_dictionary(records)
    press = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
    frame = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
    return b"".join([frame, *map(press.compress, records)])


def read_archive(data):
    """Dictionaries of the records of an archive, in order: the headers, ``http`` headers and ``payload``."""
    magic, size = struct.unpack("<II", data[:8])
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive has no dictionary frame")
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    frames = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data[8 + size :], read_across_frames=True)
    stream = io.BufferedReader(frames, 1 << 20)
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError("a record does not begin with its version")
        found = _headers(stream)
        block = io.BytesIO(stream.read(int(found["content-length"])))
        stream.read(4)
        block.readline()
        found["http"] = _headers(block)
        found["payload"] = block.read()
        yield found


def _headers(stream):
    found = {}
    while line := stream.readline().strip():
        name, _, value = line.decode().partition(":")
        found[name.lower()] = value.strip()
    return found


def page_of(uri):
    """The page id in a record's id, None for a page without one."""
    text = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def base32_digest(hexadecimal):
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def write_archives(pages, folder, min_bytes=MIN_BYTES, archive_bytes=ARCHIVE_BYTES):
    """Writes a record per row of ``pages`` (``page_id, url, html``); one row per archive: ``file``, ``records``.

    The payload is the html in UTF-8, null counts as empty. Of rows with equal payloads of at least ``min_bytes`` bytes
    that with the largest id is the response and the others are revisits of it; rows that share this id are all
    responses, and a null id is smaller than any other. Smaller payloads are all responses. An archive holds about
    ``archive_bytes`` of records, so a task never holds more, whatever its share; a payload stays whole, however long, and a
    larger one fills an archive alone or last. Other columns of ``pages`` are left out. An empty table gives no archive.

    A file's name carries the try of the task that wrote it. The returned rows, read from storage, are those of the tries
    that were committed: what a lost or repeated task leaves in the folder is in none of them.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    # one small row per digest, whatever the number of its pages; a digest with many pages is split by the skew join
    largest = rows.groupBy("sha1").agg(F.max("page_id").alias("largest")).withColumnRenamed("sha1", "of")
    revisits = (F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("largest"))
    rows = rows.join(largest, F.col("sha1") == F.col("of"))
    refers_to = F.when(revisits, F.col("largest")).alias("refers_to")
    size = F.octet_length("html").alias("size")
    rows = rows.select("page_id", "url", "sha1", size, refers_to, F.when(~revisits, F.col("html")).alias("html"))

    def write(batches):
        from pyspark import TaskContext

        import pyarrow.fs  # noqa: F401

        held, total, number, task = [], 0, 0, TaskContext.get()
        schema = pa.schema([("file", pa.string()), ("records", pa.int64())])

        def close():
            name = f"{task.partitionId():08d}-{number:06d}-{task.taskAttemptId()}.warc.zst"
            put_file(folder, name, archive(held))
            return to_batch([(name, len(held))], schema)

        for batch in batches:
            for page_id, url, sha1, size, refers_to, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.append(record(page_id, url, base32_digest(sha1), (html or "").encode(), size, refers_to))
                total += len(held[-1])
                if total >= archive_bytes:
                    yield close()
                    held, total, number = [], 0, number + 1
        if held:
            yield close()

    return stored(rows.mapInArrow(write, "file string, records long"), "archives")


def read_archives(spark, folder, archives):
    """One row per record of the files in ``folder`` that ``archives``, the rows of ``write_archives``, name.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: taken from the payload itself for responses,
    from the record's headers for revisits. Fails on a response whose payload does not have its digest.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    schema = pa.schema(
        [("file", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
         ("refers_to", pa.int64()), ("url", pa.string())]
    )

    def read(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name, rows = path.rsplit("/", 1)[-1], []
                for found in read_archive(data.as_py()):
                    kind, digest = found["warc-type"], found["warc-payload-digest"].removeprefix("sha1:")
                    size, refers_to = int(found["http"]["content-length"]), None
                    if kind == "response":
                        size, own = len(found["payload"]), base64.b32encode(hashlib.sha1(found["payload"]).digest()).decode()
                        if own != digest:
                            raise ValueError(f"{found['warc-record-id']}: the payload has the digest {own}, not {digest}")
                    else:
                        refers_to = page_of(found["warc-refers-to"])
                    page, url = page_of(found["warc-record-id"]), found.get("warc-target-uri")
                    rows.append((name, page, size, digest, kind, refers_to, url))
                yield to_batch(rows, schema)

    columns = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    # Joined after the payloads are gone, so that no archive is shuffled, however many there are.
    found = files.mapInArrow(read, f"file string, {columns}")
    return found.join(archives.select("file"), "file", "left_semi").drop("file")


def new_folder(spark):
    return scratch_path(spark, "warc")
