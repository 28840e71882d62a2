"""Counting over a whole corpus with few, large shuffle rows.

A corpus is cut into batches of documents, written once to the shared checkpoint folder. Each batch sends its distinct
64-bit keys, sorted, packed and cut by key range, to the partition that owns the range; the owner adds up what all
batches sent and answers every batch in the order it asked. A key costs about six bytes on the wire and a hot key at
most one entry per batch, however often it occurs. No answer depends on how documents fell into batches.
"""

import uuid

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import types as T

BATCH_WORDS = 1_500_000
PART_KEYS = 3_000_000


def packed(numbers):
    """An integer or float array as bytes: byte planes, compressed."""
    numbers = np.ascontiguousarray(numbers)
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T if len(numbers) else numbers
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data, kind):
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).reshape(-1)


def packed_sorted(keys):
    """Sorted keys as differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_sorted(data):
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def cuts(keys, parts):
    """Where each of ``parts`` equal key ranges begins in sorted keys, and the end."""
    edges = np.array([(part << 64) // parts for part in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def parts_for(batches, words=BATCH_WORDS, least=1):
    """How many key ranges keep an owner's keys near ``PART_KEYS`` when every word gives a key."""
    return max(least, -(-batches * words // PART_KEYS))


def new_batch():
    """A batch number. It is only ever read back from the table it was written to."""
    return uuid.uuid4().int >> 65


def table_bytes(table):
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def bytes_table(data):
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all()


def row_groups(batches, text, limit_bytes):
    """Arrow tables of successive rows with about ``limit_bytes`` of text; a longer text stays whole, alone or last."""
    held, size = [], 0
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for place, length in enumerate(lengths):
            if size and size + length > limit_bytes:
                held.append(batch.slice(start, place - start))
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, start = [], 0, place
            size += int(length) + 16
        held.append(batch.slice(start))
    if sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks()


def document_batches(docs, text="text", limit_bytes=6 * BATCH_WORDS):
    """(batch, size, rows): the rows of ``docs`` in batches, all columns kept, as compressed Arrow bytes."""

    def pack(batches):
        for table in row_groups(batches, text, limit_bytes):
            yield pa.RecordBatch.from_pydict({"batch": [new_batch()], "size": [len(table)], "rows": [table_bytes(table)]})

    return docs.mapInArrow(pack, "batch long, size long, rows binary")


REQUEST = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("batch", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def requests(batch, kind, keys, parts, counts=()):
    """Request rows of one batch: its sorted distinct keys and, aligned with them, arrays to be added up."""
    edges = cuts(keys, parts)
    for part in range(parts):
        start, end = edges[part], edges[part + 1]
        if end > start:
            values = b"".join(
                len(data).to_bytes(4, "little") + data for data in (packed(array[start:end]) for array in counts)
            )
            yield kind, part, batch, packed_sorted(keys[start:end]), values


def arrays_of(data, *kinds):
    """The arrays that ``requests`` packed into ``counts``."""
    found, place = [], 0
    for kind in kinds:
        size = int.from_bytes(data[place : place + 4], "little")
        found.append(unpacked(data[place + 4 : place + 4 + size], kind))
        place += 4 + size
    return found


def to_batch(rows, schema):
    """Tuples as one Arrow record batch with the given Arrow schema."""
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ask(rows, size=32):
    """Request rows in Arrow record batches of ``size`` rows."""
    schema = pa.schema(
        [("kind", pa.int32()), ("part", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
    )
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield to_batch(held, schema)
            held = []
    if held:
        yield to_batch(held, schema)


class Gathered:
    """All requests of one owner: distinct keys, and for each request the places of its keys among them."""

    def __init__(self, table):
        self.batches = table.column("batch").to_pylist()
        self.counts = table.column("counts").to_pylist()
        each = [unpacked_sorted(data) for data in table.column("keys").to_pylist()]
        self.edges = np.cumsum([0, *map(len, each)])
        keys = np.concatenate(each)
        del each
        # as np.unique with its inverse, in half the memory
        order = np.argsort(keys)
        keys = keys[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        self.keys = keys[new]
        del keys
        self.places = np.empty(len(order), np.int32)
        self.places[order] = np.cumsum(new, dtype=np.int32) - 1

    def total(self, values):
        """``values`` aligned with the concatenated requests, added up by key."""
        return np.bincount(self.places, values, len(self.keys))

    def senders(self):
        """How many batches sent each key."""
        return np.bincount(self.places, minlength=len(self.keys))

    def answers(self, values):
        """For each request: its batch and the values of its keys."""
        for row, batch in enumerate(self.batches):
            yield batch, values[self.places[self.edges[row] : self.edges[row + 1]]]
