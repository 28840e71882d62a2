"""Katz backoff over words: Good-Turing discounted bigrams with exactly normalised backoff weights.

The order of a model is two: p(w|h) = d(c(hw)) c(hw) / c(h) where hw was seen, else alpha(h) p(w), and alpha(h) = (what
the discounts leave at h) / (what p gives to words not seen after h). p(w) is the discounted unigram; what its discounts
leave goes to one unknown word. Counts, alphas and answers are tables cut by key range (see ``exchange``): no table of
words or bigrams is ever held by one task or by the driver, and each batch of documents is told only about its own.
"""

import zlib

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from clickmart.llm import exchange as X
from clickmart.llm.words import WordHashes, mixed, split_words, utf8
from clickmart.session import stored

END = xxhash.xxh3_64_intdigest(b"")
TURING = 5
FOLDS, HELD_OUT = 5, 1


def held_out(doc_id):
    """Whether the document is kept out of training. A null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


class Discounts:
    """Share of a count that is kept, from counts of counts n_1 .. n_(TURING+1).

    Turing's (r+1) n_(r+1) / (r n_r) up to ``TURING`` where it lies between 0 and 1; elsewhere that of a power law fitted
    to the counts of counts, (1 + 1/r)^(slope+1), which lies between 0 and 1 for every r. With ``tail`` false counts
    above ``TURING`` keep all.
    """

    def __init__(self, counts, tail=True):
        seen = [(np.log(r), np.log(n)) for r, n in enumerate(counts, 1) if n > 0]
        slope = float(np.polyfit(*zip(*seen, strict=True), 1)[0]) if len(seen) > 1 else -2.0
        self.slope, self.tail = min(slope, -1.1), tail
        self.low = np.ones(TURING + 1)
        for r in range(1, TURING + 1):
            share = (r + 1) * counts[r] / (r * counts[r - 1]) if counts[r - 1] else 0
            self.low[r] = share if 0 < share < 1 else self._fitted(r)

    def _fitted(self, r):
        return (1 + 1 / r) ** (self.slope + 1)

    def __call__(self, counts):
        counts = np.asarray(counts, np.float64)
        high = self._fitted(np.maximum(counts, 1)) if self.tail else 1.0
        return np.where(counts <= TURING, self.low[np.minimum(counts, TURING).astype(int)], high)


class Unigrams:
    """p(w) by count, and that of the unknown word at count 0. ``counts``: n_1 .. , ``total``: all tokens."""

    def __init__(self, counts, total):
        self.discounts, self.total = Discounts(counts, tail=False), total
        r = np.arange(1, TURING + 1)
        self.left = float((r * counts[:TURING] * (1 - self.discounts.low[1:])).sum())

    def __call__(self, counts):
        counts = np.asarray(counts, np.float64)
        if not self.total:
            return np.ones(len(counts))
        if not self.left:  # no rare word to judge by: the unknown word counts as one token
            return np.where(counts > 0, counts, 1) / (self.total + 1)
        return np.where(counts > 0, counts * self.discounts(counts), self.left) / self.total


def _coded(table, words):
    """Tokens of the rows as places in the sorted distinct hashes, tokens per row."""
    rows = [split_words(data, lower=True) for data in utf8(table.column("text"))]
    lengths = np.fromiter((len(row) + 1 for row in rows), np.int64, len(rows))
    numbers = np.full(int(lengths.sum()), END, np.uint64)
    inside = np.ones(len(numbers), bool)
    inside[np.cumsum(lengths) - 1] = False
    numbers[inside] = words.array([word for row in rows for word in row])
    vocabulary, tokens = np.unique(numbers, return_inverse=True)
    return vocabulary, tokens, lengths


def _pairs(vocabulary, tokens, lengths):
    """Distinct (history, word) places sorted by key, their keys, and each token's place among them."""
    history = np.empty_like(tokens)
    history[1:] = tokens[:-1]
    history[np.cumsum(lengths) - lengths] = np.searchsorted(vocabulary, np.uint64(END))
    size = len(vocabulary)
    codes, at = np.unique(history * size + tokens, return_inverse=True)
    first, second = codes // size, codes % size
    keys = mixed(vocabulary[first] * np.uint64(0x9FB21C651E98DF25) + vocabulary[second])
    order = np.argsort(keys, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return first[order], second[order], keys[order], place[at]


def _read(row):
    vocabulary = X.unpacked_sorted(row["vocabulary"])
    return vocabulary, X.unpacked(row["tokens"], np.uint32).astype(np.int64), X.unpacked(row["lengths"], np.int64)


def _code_batches(docs, limit_bytes):
    def code(batches):
        words = WordHashes()
        for table in X.row_groups(batches, "text", limit_bytes):
            vocabulary, tokens, lengths = _coded(table, words)
            ids = table.column("doc_id")
            yield pa.RecordBatch.from_pydict(
                {
                    "batch": [X.new_batch()],
                    "ids": [X.table_bytes(pa.table({"doc_id": ids}))],
                    "vocabulary": [X.packed_sorted(vocabulary)],
                    "tokens": [X.packed(tokens.astype(np.uint32))],
                    "lengths": [X.packed(lengths)],
                }
            )

    schema = "batch long, ids binary, vocabulary binary, tokens binary, lengths binary"
    return docs.select("doc_id", "text").mapInArrow(code, schema)


def _by_range(rows, keys, parts, kind):
    """Answers of all owners, in the order of the batch's sorted keys."""
    edges = X.cuts(keys, parts)
    totals, owned = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    for row in rows:
        if row["kind"] == kind:
            start, end = edges[row["part"]], edges[row["part"] + 1]
            totals[start:end] = X.unpacked(row["totals"], np.int64)
            owned[start:end] = np.unpackbits(np.frombuffer(row["owned"], np.uint8), count=end - start).view(bool)
    return totals, owned


def score(docs, batch_words=X.BATCH_WORDS):
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the rows whose id is not held out and scores all rows. Null and empty texts are the end token
    alone; repeated rows count, and are scored, each on its own; other columns are ignored. Without training rows every
    token is the unknown word and both scores are 0.
    """
    batches = stored(_code_batches(docs, 6 * batch_words), "tokens")
    parts = X.parts_for(batches.count(), batch_words, least=2)

    def send(tables):
        def sent():
            for table in tables:
                for row in table.to_pylist():
                    vocabulary, tokens, lengths = _read(row)
                    ids = X.bytes_table(row["ids"]).column(0).to_pylist()
                    train = np.repeat([not held_out(i) for i in ids], lengths)
                    counts = np.bincount(tokens[train], minlength=len(vocabulary))
                    yield from X.requests(row["batch"], 0, vocabulary, parts, [counts])
                    _, _, keys, at = _pairs(vocabulary, tokens, lengths)
                    yield from X.requests(row["batch"], 1, keys, parts, [np.bincount(at[train], minlength=len(keys))])

        yield from X.ask(sent())

    def count(table: pa.Table) -> pa.Table:
        kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
        found = X.Gathered(table)
        totals = found.total(np.concatenate([X.arrays_of(d, np.int64)[0] for d in found.counts])).astype(np.int64)
        owner = np.zeros(len(found.places), bool)
        owner[np.unique(found.places, return_index=True)[1]] = True
        stats = [int((totals == r).sum()) for r in range(1, TURING + 2)] + [int((totals > 0).sum()), int(totals.sum())]
        rows = [
            (kind, part, batch, X.packed(values), np.packbits(owner[found.edges[n] : found.edges[n + 1]]).tobytes(), stats if n == 0 else None)
            for n, (batch, values) in enumerate(found.answers(totals))
        ]
        schema = [("kind", pa.int32()), ("part", pa.int32()), ("batch", pa.int64()), ("totals", pa.binary()), ("owned", pa.binary()), ("stats", pa.list_(pa.int64()))]
        return pa.Table.from_batches([X.to_batch(rows, pa.schema(schema))])

    counted = stored(
        batches.mapInArrow(send, X.REQUEST)
        .groupBy("kind", "part")
        .applyInArrow(count, "kind int, part int, batch long, totals binary, owned binary, stats array<long>"),
        "counts",
    )
    sums = [F.sum(F.col("stats")[n]).alias(f"s{n}") for n in range(TURING + 3)]
    stats = {row["kind"]: [row[f"s{n}"] or 0 for n in range(TURING + 3)] for row in counted.groupBy("kind").agg(*sums).collect()}
    one, two = (np.array(stats.get(kind, [0] * (TURING + 3)), np.float64) for kind in (0, 1))
    known_types, train_tokens = int(one[-2]), int(one[-1])
    unigrams, discounts = Unigrams(one[: TURING + 1], train_tokens), Discounts(two[: TURING + 1])
    base_total = np.log10(train_tokens + 0.5 * (known_types + 1))

    part_schema = pa.schema(
        [("kind", pa.int32()), ("part", pa.int32()), ("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()), ("need", pa.binary())]
    )

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        """Scores but for the backoff weights, and this batch's share of the sums that these need."""
        row = left.to_pylist()[0]
        vocabulary, tokens, lengths = _read(row)
        ids = X.bytes_table(row["ids"]).column(0).to_pylist()
        answers = right.to_pylist()
        counts, _ = _by_range(answers, vocabulary, parts, 0)
        history, word, keys, at = _pairs(vocabulary, tokens, lengths)
        totals, owned = _by_range(answers, keys, parts, 1)
        p = unigrams(counts)
        shares = discounts(totals)
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log10(shares * totals / counts[history])
            back = np.log10(p[word]) - np.where(counts[history] > 0, np.log10(counts[history]), 0)
        logs = np.where(totals > 0, seen, back)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        partial = np.bincount(doc, logs[at], len(lengths))
        base = np.bincount(doc, (np.log10(counts + 0.5) - base_total)[tokens], len(lengths))
        known = np.bincount(doc, (counts > 0)[tokens], len(lengths)).astype(np.int64)
        mine = owned & (totals > 0)
        freed = np.bincount(history[mine], ((1 - shares) * totals)[mine], len(vocabulary))
        covered = np.bincount(history[mine], p[word[mine]], len(vocabulary))
        open_tokens = np.flatnonzero((totals[at] == 0) & (counts[history[at]] > 0))
        needed = history[at[open_tokens]]
        used = (freed > 0).copy()
        used[needed] = True
        place = np.cumsum(used) - 1
        table = pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": [held_out(i) for i in ids],
                "n_tokens": lengths,
                "n_known": known,
                "base_score": base,
                "score": partial,
            }
        )
        need = b"".join(
            len(data).to_bytes(4, "little") + data
            for data in (X.packed(doc[open_tokens].astype(np.uint32)), X.packed(place[needed].astype(np.uint32)), X.packed_sorted(vocabulary[used]))
        )
        rows = [(-1, -1, row["batch"], None, None, X.table_bytes(table), need)]
        rows += [(*r, None, None) for r in X.requests(row["batch"], 2, vocabulary[used], parts, [freed[used], covered[used]])]
        return pa.Table.from_batches([X.to_batch(rows, part_schema)])

    weighed = stored(
        batches.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(
            weigh, "kind int, part int, batch long, keys binary, counts binary, docs binary, need binary"
        ),
        "weights",
    )

    def weights(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        found = X.Gathered(table)
        freed, covered = (
            found.total(np.concatenate(arrays))
            for arrays in zip(*[X.arrays_of(d, np.float64, np.float64) for d in found.counts], strict=True)
        )
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.log10(freed / (1 - covered))
        rows = [(part, batch, X.packed(values)) for batch, values in found.answers(ratio)]
        schema = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("ratio", pa.binary())])
        return pa.Table.from_batches([X.to_batch(rows, schema)])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        table = X.bytes_table(left.column("docs")[0].as_py())
        need, pieces, start = left.column("need")[0].as_py(), [], 0
        while start < len(need):
            size = int.from_bytes(need[start : start + 4], "little")
            pieces.append(need[start + 4 : start + 4 + size])
            start += 4 + size
        doc, place = (X.unpacked(data, np.uint32) for data in pieces[:2])
        keys = X.unpacked_sorted(pieces[2])
        edges, ratio = X.cuts(keys, parts), np.zeros(len(keys))
        for part, data in zip(right.column("part").to_pylist(), right.column("ratio").to_pylist(), strict=True):
            ratio[edges[part] : edges[part + 1]] = X.unpacked(data, np.float64)
        more = np.bincount(doc, ratio[place], len(table))
        scores = table.column("score").to_numpy() + more
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        table = table.drop_columns("score").append_column("score", pa.array(scores))
        return table.append_column("train_tokens", pa.array([train_tokens] * len(table), pa.int64())).select(names)

    replies = (
        weighed.where("kind = 2").select("kind", "part", "batch", "keys", "counts")
        .groupBy("part")
        .applyInArrow(weights, "part int, batch long, ratio binary")
    )
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    own = weighed.where("kind = -1").select("batch", "docs", "need")
    return own.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(finish, schema)
