"""Token ids on disk as wavelet matrices: one compressed file per shard that answers access, rank and select.

A file is the magic ``WVM1``, a little-endian header length, a JSON header with the section sizes, and the zstd sections:
document ids, document lengths, then per bit-plane (highest bit first) its bits with a directory of set bits before each
block of 512. The matrix stores the ids stably parted by each bit in turn, so that every query walks the planes once.
"""

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import Window, functions as F

from clickmart.llm.exchange import row_groups, to_batch
from clickmart.llm.tokens import encoder_of
from clickmart.session import scratch_path, stored

MAGIC = b"WVM1"
BLOCK = 512
FILE_TOKENS = 8_000_000
_TEXT_BYTES = 12 << 20


def write_matrix(ids, doc_ids, lengths):
    """The bytes of one file. ``doc_ids`` may hold None."""
    ids = np.asarray(ids, np.uint32)
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    level = ids.astype(np.uint16) if bits <= 16 else ids
    null = np.array([d is None for d in doc_ids], bool)
    sections = [
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.packbits(null).tobytes(),
        np.asarray(lengths, "<i8").tobytes(),
    ]
    ones = []
    for bit in range(bits - 1, -1, -1):
        plane = (level & level.dtype.type(1 << bit)).astype(bool)
        packed = np.packbits(plane)
        padded = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)])
        blocks = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
        sections += [packed.tobytes(), np.cumsum(np.concatenate(([0], blocks)), dtype="<u4").tobytes()]
        ones.append(int(blocks.sum()))
        level = np.concatenate([np.compress(~plane, level), np.compress(plane, level)])
    press = zstandard.ZstdCompressor(level=1)
    sections = [press.compress(x) for x in sections]
    header = json.dumps({"tokens": len(ids), "docs": len(doc_ids), "bits": bits, "ones": ones, "sizes": [len(x) for x in sections]})
    header = header.encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *sections])


class WaveletMatrix:
    """Reads one file. Positions count from 0 over all ids of the shard."""

    def __init__(self, data):
        data = memoryview(data)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = int.from_bytes(data[4:8], "little")
        self.header = json.loads(bytes(data[8 : 8 + size]))
        self.tokens, self.bits = self.header["tokens"], self.header["bits"]
        place, press, sections = 8 + size, zstandard.ZstdDecompressor(), []
        for length in self.header["sizes"]:
            sections.append(press.decompress(data[place : place + length]))
            place += length
        docs = self.header["docs"]
        null = np.unpackbits(np.frombuffer(sections[1], np.uint8), count=docs).view(bool)
        self.doc_ids = [None if n else d for d, n in zip(np.frombuffer(sections[0], "<i8").tolist(), null, strict=True)]
        self.lengths = np.frombuffer(sections[2], "<i8")
        self._planes = [np.frombuffer(x, np.uint8) for x in sections[3::2]]
        self._ranks = [np.frombuffer(x, "<u4") for x in sections[4::2]]
        self._zeros = [self.tokens - ones for ones in self.header["ones"]]

    def _bit(self, level, place):
        return int(self._planes[level][place >> 3]) >> (7 - (place & 7)) & 1

    def _ones(self, level, place):
        """Set bits before ``place``."""
        block = place // BLOCK
        count = int(self._ranks[level][block])
        first, end = block * BLOCK >> 3, place >> 3
        plane = self._planes[level]
        count += int(np.bitwise_count(plane[first:end]).sum())
        if place & 7:
            count += int(np.bitwise_count(plane[end] >> (8 - (place & 7))))
        return count

    def _nth(self, level, value, n):
        """Place of the n-th (from 0) bit of ``value`` on a level."""
        low, high = 0, self.tokens
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            if (ones if value else middle + 1 - ones) > n:
                high = middle
            else:
                low = middle + 1
        return low

    def access(self, place):
        """The id at a position."""
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        value = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, place), self._ones(level, place)
            value = value << 1 | bit
            place = self._zeros[level] + ones if bit else place - ones
        return value

    def _range(self, token, end):
        """Where the occurrences of ``token`` before ``end`` lie below the last level."""
        start = 0
        if token < 0 or token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            ones = self._ones(level, start), self._ones(level, end)
            if token >> (self.bits - 1 - level) & 1:
                start, end = (self._zeros[level] + x for x in ones)
            else:
                start, end = start - ones[0], end - ones[1]
        return start, end

    def rank(self, token, end):
        """How often ``token`` occurs before position ``end``."""
        start, end = self._range(token, min(max(end, 0), self.tokens))
        return end - start

    def count(self, token):
        return self.rank(token, self.tokens)

    def select(self, token, n):
        """Position of the n-th (from 0) occurrence of ``token``; -1 if there are not so many."""
        start, end = self._range(token, self.tokens)
        if not 0 <= n < end - start:
            return -1
        place = start + n
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            place = self._nth(level, bit, place - self._zeros[level] if bit else place)
        return place

    def occurrences(self, token):
        """All positions of ``token``, ascending."""
        return [self.select(token, n) for n in range(self.count(token))]

    def all_ids(self):
        """Every id, decoded plane by plane from the last."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        found = np.zeros(self.tokens, kind)
        for level in range(self.bits - 1, -1, -1):
            plane = np.unpackbits(self._planes[level], count=self.tokens).view(bool)
            above = np.empty(self.tokens, kind)
            zeros = self._zeros[level]
            above[np.flatnonzero(~plane)] = found[:zeros]
            above[np.flatnonzero(plane)] = found[zeros:] | kind(1 << (self.bits - 1 - level))
            found = above
        return found.astype(np.uint32)


def put_file(folder, name, data):
    """Writes a file into a shared folder of any kind; a repeated try replaces it whole."""
    filesystem, path = pa.fs.FileSystem.from_uri(folder)
    filesystem.create_dir(path, recursive=True)
    trial = f"{path}/_{name}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(trial) as out:
        out.write(data)
    filesystem.move(trial, f"{path}/{name}")


def write_shards(docs, folder, tokenizer, text="text", end=0, file_tokens=FILE_TOKENS):
    """Writes the ids of all documents in ascending ``doc_id`` order; one row per file: ``file``, ``docs``, ``tokens``.

    Null ids come first, equal ids in the order of their texts' hashes. Null and empty texts are the ``end`` id alone,
    repeated rows are kept. The rows are dealt by ranges of (doc_id, hash), so that one id with many rows spans several
    shards, and a shard is cut into files of about ``file_tokens`` ids. An empty table gives no file. Returns the rows
    read back from storage, so the files are complete when it returns.
    """

    def write(batches):
        from pyspark import TaskContext

        import pyarrow.fs  # noqa: F401

        shard = TaskContext.get().partitionId()
        held, doc_ids, lengths, size, number = [], [], [], 0, 0
        schema = pa.schema([("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])

        def close():
            name = f"{shard:08d}-{number:06d}.wvm"
            put_file(folder, name, write_matrix(np.concatenate(held), doc_ids, np.concatenate(lengths)))
            return to_batch([(name, len(doc_ids), size)], schema)

        for table in row_groups(batches, text, _TEXT_BYTES):
            ids, counts = encoder_of(tokenizer).encode(table.column(text), end=end)
            held.append(ids)
            lengths.append(counts)
            doc_ids += table.column("doc_id").to_pylist()
            size += len(ids)
            if size >= file_tokens:
                yield close()
                held, doc_ids, lengths, size, number = [], [], [], 0, number + 1
        if held:
            yield close()

    spread = F.xxhash64(text)
    dealt = docs.select("doc_id", text).repartitionByRange("doc_id", spread).sortWithinPartitions("doc_id", spread)
    return stored(dealt.mapInArrow(write, "file string, docs long, tokens long"), "shards")


def read_shards(spark, folder, shards):
    """One row per document from the files: ``doc_id``, ``start`` over all shards, ``n_tokens``, ``ids_crc32``."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("path", "content")

    def decode(batches):
        schema = pa.schema(
            [("file", pa.string()), ("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        )
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                matrix = WaveletMatrix(content.as_buffer())
                ids = matrix.all_ids().astype("<u4")
                ends = np.cumsum(matrix.lengths).tolist()
                name = path.rsplit("/", 1)[-1]
                yield to_batch(
                    [
                        (name, doc, end - size, size, zlib.crc32(ids[end - size : end]))
                        for doc, end, size in zip(matrix.doc_ids, ends, matrix.lengths.tolist(), strict=True)
                    ],
                    schema,
                )

    found = files.mapInArrow(decode, "file string, doc_id long, place long, n_tokens long, ids_crc32 long")
    return found.join(starts, "file").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def new_folder(spark):
    return scratch_path(spark, "wavelet")
