"""Benchmark decontamination: a generalised suffix automaton of the test items, over which document words stream."""

import re

import pyarrow as pa

from pyspark.sql import functions as F

from clickmart.llm.words import plain_words, utf8

WINDOW = 13
BLOCK_WORDS = 200_000
_ADDED = {
    "n_words": "long",
    "n_hit": "long",
    "items": "array<string>",
    "hits": "array<struct<first:long,end:long>>",
}


def automaton(items, window=WINDOW):
    """(transitions, links, lengths, marks) of all ``(item id, words)``; states are numbered, the root is 0.

    ``marks[state]`` lists (length, item ids): the state's matches of at least that length end with a window of those
    items. A window is ``window`` successive words, or all words of a shorter item.
    """
    steps, links, lengths = [{}], [-1], [0]

    def state(length, link, moves):
        steps.append(moves)
        links.append(link)
        lengths.append(length)
        return len(steps) - 1

    def target(at, word):
        """The state for ``at`` extended by ``word`` where that move exists, split if it also holds longer strings."""
        found = steps[at][word]
        if lengths[found] == lengths[at] + 1:
            return found
        part = state(lengths[at] + 1, links[found], dict(steps[found]))
        links[found] = part
        while at >= 0 and steps[at].get(word) == found:
            steps[at][word] = part
            at = links[at]
        return part

    for _, words in items:
        last = 0
        for word in words:
            if word in steps[last]:
                last = target(last, word)
                continue
            new, at = state(lengths[last] + 1, 0, {}), last
            while at >= 0 and word not in steps[at]:
                steps[at][word] = new
                at = links[at]
            if at >= 0:
                links[new] = target(at, word)
            last = new

    own = [{} for _ in steps]
    for item, words in items:
        size, at, length = min(window, len(words)), 0, 0
        for word in words:
            at, length = steps[at][word], length + 1
            if length > size:
                length = size
            while at and lengths[links[at]] >= length:
                at = links[at]
            if size and length == size:
                own[at].setdefault(size, set()).add(item)
    marks = [()] * len(steps)
    for at in sorted(range(len(steps)), key=lengths.__getitem__):
        found = [(size, tuple(sorted(ids))) for size, ids in sorted(own[at].items())]
        above = marks[links[at]] if at else ()
        marks[at] = tuple(sorted([*above, *found]))
    return steps, links, lengths, marks


def scan(words, machine):
    """(words hit, item ids) of one document: a list of word intervals, ascending and apart, and a set."""
    steps, links, lengths, marks = machine
    at, length, moves, root = 0, 0, steps[0], steps[0]
    spans, found = [], set()
    for place, word in enumerate(words):
        to = moves.get(word)
        if to is None:
            if at == 0:
                continue
            while to is None and at:
                at = links[at]
                to = steps[at].get(word)
            if to is None:
                length, moves = 0, root
                continue
            length = lengths[at]
        length += 1
        at, moves = to, steps[to]
        if marks[at]:
            longest = 0
            for size, ids in marks[at]:
                if size <= length:
                    longest = size
                    found.update(ids)
            if longest:
                first = place + 1 - longest
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = place + 1
                else:
                    spans.append([first, place + 1])
    return spans, found


def _blocks(benchmark, block_words):
    """Lists of (item id as text, words) with about ``block_words`` words each, streamed to the driver one by one."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = plain_words(row[1].encode() if row[1] else None)
        if not words:
            continue
        held.append((row[0] or "", words))
        size += len(words)
        if size >= block_words:
            yield held
            held, size = [], 0
    if held:
        yield held


def benchmark_hits(docs, benchmark, text="text", window=WINDOW, block_words=BLOCK_WORDS):
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (ids as text, sorted as text) and ``hits`` (word intervals).

    Words are runs of letters, digits and characters outside ASCII, A-Z in lower case. Null and empty texts have no
    words; an item without words has no window; repeated rows are judged alike; columns named like those added are
    replaced. One automaton, and so one broadcast, holds about ``block_words`` words of the items, whatever their
    number; further blocks pass over the documents in turn.
    """
    found = docs.drop(*_ADDED)
    names = found.columns
    found = found.selectExpr(
        "*", *[f"cast({'0' if kind == 'long' else 'array()'} as {kind}) as {name}" for name, kind in _ADDED.items()]
    )
    schema = found.schema
    fields = pa.struct([("first", pa.int64()), ("end", pa.int64())])
    sets = list(_blocks(benchmark, block_words)) or [[]]
    for block in sets:
        shared = docs.sparkSession.sparkContext.broadcast(automaton(block, window))

        def pass_over(batches, shared=shared):
            machine = shared.value
            for batch in batches:
                sizes, hit, items, hits = [], [], [], []
                earlier_hits = batch.column("hits").to_pylist()
                earlier_items = batch.column("items").to_pylist()
                for data, old_hits, old_items in zip(utf8(batch.column(text)), earlier_hits, earlier_items, strict=True):
                    words = plain_words(data)
                    spans, ids = scan(words, machine)
                    if old_hits:
                        spans = joined([[s["first"], s["end"]] for s in old_hits] + spans)
                    sizes.append(len(words))
                    hit.append(sum(end - first for first, end in spans))
                    items.append(sorted(ids.union(old_items)) if ids else old_items)
                    hits.append([{"first": first, "end": end} for first, end in spans])
                added = [
                    pa.array(sizes, pa.int64()),
                    pa.array(hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(hits, pa.list_(fields)),
                ]
                columns = [batch.column(name) for name in names] + added
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *_ADDED])

        found = found.mapInArrow(pass_over, schema)
    return found


def joined(spans):
    """Intervals, overlapping and touching ones as one."""
    found = []
    for first, end in sorted(spans):
        if found and first <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([first, end])
    return found


def contaminated(share=20):
    """Whether at least one word, and at least one in ``share`` words, is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def without_spans(found, text="text", longest=2 * WINDOW):
    """Documents of ``benchmark_hits`` with hit spans of more than ``longest`` words cut out of the text, else as is.

    A cut takes everything from the first letter of the span's first word to the last letter of its last.
    """
    word = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

    def cut(batches):
        for batch in batches:
            texts = []
            for data, hits in zip(utf8(batch.column(text)), batch.column("hits").to_pylist(), strict=True):
                long = [h for h in hits or () if h["end"] - h["first"] > longest]
                if long and data:
                    places = [m.span() for m in word.finditer(data)]
                    for h in reversed(long):
                        data = data[: places[h["first"]][0]] + data[places[h["end"] - 1][1] :]
                texts.append(None if data is None else data.decode())
            place = batch.schema.get_field_index(text)
            yield batch.set_column(place, text, pa.array(texts, pa.string()))

    return found.mapInArrow(cut, found.schema)
