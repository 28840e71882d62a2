"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark; repeated windows give the removal."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from clickmart.llm import exchange as X
from clickmart.llm.words import RunHashes
from clickmart.session import stored

WINDOW = 35
BATCH_WORDS = 750_000


def _words(column):
    """All words of a text column in one array, and how many each row has."""
    texts = pc.fill_null(column.combine_chunks().cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(texts)
    words = parts.flatten()
    filled = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
    return words.filter(filled), np.diff(before[parts.offsets.to_numpy()])


def _windows(table, text, size, runs):
    """Words, how many each row has, and hashes and starts of the windows inside rows; each distinct word is hashed once."""
    words, lengths = _words(table.column(text))
    distinct = words.dictionary_encode()
    known = distinct.dictionary.cast(pa.large_binary()).to_pylist()
    numbers = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))[distinct.indices.to_numpy()]
    del distinct, known
    hashes = runs.windows(numbers, size)
    inside = np.repeat(np.cumsum(lengths), lengths)[: len(hashes)] - np.arange(len(hashes)) >= size
    starts = np.flatnonzero(inside)
    return words, lengths, hashes[starts], starts


def _covered(starts, size, count):
    """Which of ``count`` words lie in a window that begins at one of ``starts``."""
    steps = np.bincount(starts, minlength=count + 1) - np.bincount(starts + size, minlength=count + 1)
    return np.cumsum(steps[:-1]) > 0


def _intervals(hit):
    """Maximal runs of true values as (first, end) pairs."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return edges.reshape(-1, 2)


def repeated_spans(docs, text="text", window=WINDOW):
    """``docs`` with ``kept_text``, ``n_words``, ``n_removed`` and ``removed`` (word intervals ``[first, end)``).

    A word goes when it lies in a window of ``window`` words whose word sequence also begins anywhere else, in another
    row or the same. Every occurrence goes, none is kept. Words are runs of anything but blank and \\x09-\\x0D,
    compared as they are. Null and empty texts and texts shorter than a window have no window and stay as they are;
    repeated rows are separate rows, so each repeats the other. ``kept_text`` is the kept words joined by one blank (null
    stays null). Columns of ``docs`` named like those added are replaced.

    Batches send distinct window hashes to their owners (see ``exchange``); the answer is one bit per window.
    """
    added = {"kept_text": "string", "n_words": "long", "n_removed": "long", "removed": "array<struct<first:long,end:long>>"}
    docs = docs.drop(*(set(added) - {text}))
    batches = stored(X.document_batches(docs, text, 6 * BATCH_WORDS), "windows")
    # As many owners as the batches need; two at least, so that a small corpus takes the same way.
    parts = X.parts_for(batches.count(), BATCH_WORDS, least=2)

    def send(rows):
        runs = RunHashes()

        def sent():
            for record in rows:
                for batch, data in zip(record.column("batch").to_pylist(), record.column("rows"), strict=True):
                    hashes = _windows(X.bytes_table(data.as_py()), text, window, runs)[2]
                    yield from X.requests(batch, 0, np.unique(hashes), parts)

        yield from X.ask(sent())

    def answer(table: pa.Table) -> pa.Table:
        found = X.Gathered(table)
        shared = found.senders() > 1
        part = table.column("part")[0].as_py()
        rows = [(batch, part, np.packbits(bits).tobytes()) for batch, bits in found.answers(shared)]
        schema = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("bits", pa.binary())])
        return pa.Table.from_batches([X.to_batch(rows, schema)])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        table = X.bytes_table(left.column("rows")[0].as_py())
        words, lengths, hashes, starts = _windows(table, text, window, RunHashes())
        keys, places, times = np.unique(hashes, return_inverse=True, return_counts=True)
        shared = times > 1
        edges = X.cuts(keys, parts)
        for part, bits in zip(right.column("part").to_pylist(), right.column("bits").to_pylist(), strict=True):
            start, end = edges[part], edges[part + 1]
            shared[start:end] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=end - start).view(bool)
        hit = _covered(starts[shared[places]], window, int(lengths.sum()))
        removed = np.diff(np.concatenate(([0], np.cumsum(hit)))[np.concatenate(([0], np.cumsum(lengths)))])
        edges = np.cumsum(np.concatenate(([0], lengths - removed)))
        kept = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), words.filter(pa.array(~hit)))
        kept = pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string())
        kept = pc.if_else(table.column(text).combine_chunks().is_null(), None, kept)
        spans, ends = [[] for _ in lengths], np.cumsum(lengths)
        for row in np.flatnonzero(removed).tolist():
            mine = hit[ends[row] - lengths[row] : ends[row]]
            spans[row] = [{"first": int(a), "end": int(b)} for a, b in _intervals(mine)]
        fields = [pa.field("first", pa.int64()), pa.field("end", pa.int64())]
        for name, values in (
            ("kept_text", kept),
            ("n_words", pa.array(lengths, pa.int64())),
            ("n_removed", pa.array(removed, pa.int64())),
            ("removed", pa.array(spans, pa.list_(pa.struct(fields)))),
        ):
            table = table.append_column(name, values)
        return table

    answers = (
        batches.mapInArrow(send, X.REQUEST)
        .groupBy("part")
        .applyInArrow(answer, "batch long, part int, bits binary")
    )
    schema = docs.limit(0).selectExpr("*", *[f"cast(null as {kind}) as {name}" for name, kind in added.items()]).schema
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, schema)

