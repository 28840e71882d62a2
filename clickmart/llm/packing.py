"""Best-fit packing of documents into sequences, improved by swaps between underfull sequences."""

import heapq
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from clickmart.llm.exchange import row_groups, to_batch
from clickmart.llm.tokens import encoder_of
from clickmart.session import stored

LIMIT = 2048
TEXT_BYTES = 4 << 20
GROUP = 20_000
NEAR_FULL = 4
MOST_ROUNDS = 256  # numbered below the sequences of whole pieces
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_TABLE = pa.schema(
    [("row", pa.int64()), ("length", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())]
)


def pieces(docs, tokenizer, limit=LIMIT, text="text"):
    """One row per piece of each document: its ids with the end id 0, cut only where longer than ``limit``.

    Null and empty texts are one piece of one id. Repeated rows give repeated pieces. ``tokenizer`` comes
    from ``shared_tokenizer``.
    """

    def cut(batches):
        schema = pa.schema(
            [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        )
        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker left
        for table in row_groups(batches, text, TEXT_BYTES):
            ids, lengths = encoder_of(tokenizer).encode(table.column(text), end=0)
            ids = ids.astype("<u4")
            ends = np.cumsum(lengths)
            rows = []
            for doc_id, end, length in zip(table.column("doc_id").to_pylist(), ends.tolist(), lengths.tolist(), strict=True):
                for piece, start in enumerate(range(0, length, limit)):
                    size = min(limit, length - start)
                    place = end - length + start
                    rows.append((doc_id, piece, start, size, zlib.crc32(ids[place : place + size].tobytes())))
            yield to_batch(rows, schema)

    return docs.select("doc_id", text).mapInArrow(cut, _PIECES)


def best_fit(lengths, limit):
    """Bins (lists of places in ``lengths``), longest first, each into the fullest bin that has room."""
    by_room = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r: a bin with room r
    bins = []
    for place in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[place])
        found = rooms >> length
        if found:
            room = length + (found & -found).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[number].append(place)
        else:
            number, room = len(bins), limit
            bins.append([place])
        room -= length
        if room:
            by_room[room].append(number)
            rooms |= 1 << room
    return bins


class _Takes:
    """What underfull bins can give back for a piece: nothing, one piece or two, by what then fits.

    Taking ``a`` ids from a bin with room r makes space for r + a. ``least[pairs][space]`` is the smallest such ``a`` over
    all bins, with pairs of pieces or without; what belongs to a bin that has changed since is dropped from the heaps.
    """

    def __init__(self, limit):
        self.limit, self.versions = limit, {}
        self.heaps = [[[] for _ in range(limit + 1)] for _ in range(2)]
        self.least = np.full((2, limit + 1), 2 * limit)
        self.spaces = {}

    def add(self, number, sizes, room):
        version = self.versions.get(number, 0)
        found = {}
        for pairs, takes in enumerate(([(), *((x,) for x in sorted(set(sizes)))], _pairs(sizes))):
            for take in takes:
                size = sum(take)
                found.setdefault((pairs, size + room), (size, version, number, take))
        for (pairs, space), entry in found.items():
            heapq.heappush(self.heaps[pairs][space], entry)
            self._refresh(pairs, space)
        self.spaces[number] = list(found)

    def drop(self, number):
        self.versions[number] = self.versions.get(number, 0) + 1
        for pairs, space in self.spaces.pop(number, ()):
            self._refresh(pairs, space)

    def _refresh(self, pairs, space):
        heap = self.heaps[pairs][space]
        while heap and self.versions.get(heap[0][2], 0) != heap[0][1]:
            heapq.heappop(heap)
        self.least[pairs, space] = heap[0][0] if heap else 2 * self.limit

    def best(self, gives, room, pairs):
        """The exchange of one of ``gives`` that raises the sum of squared fills most, as (rise, give, taken, bin)."""
        sizes = np.array([sum(give) for give in gives])
        least = self.least[:1].min(0) if not pairs else self.least.min(0)
        steps = np.arange(room)
        rise = (sizes[:, None] - least[sizes[:, None] + steps]) * (room - steps)
        give, step = divmod(int(rise.argmax()), room)
        if rise[give, step] <= 0:
            return 0, (), (), -1
        space = int(sizes[give]) + step
        _, _, number, take = min(heap[space][0] for heap in self.heaps[: 2 if pairs else 1] if heap[space])
        return int(rise[give, step]), gives[give], take, number


def _pairs(sizes):
    """The distinct pairs of pieces among ``sizes``."""
    kinds = sorted(set(sizes))
    twice = [(x, x) for x in kinds if sizes.count(x) > 1]
    return [(x, y) for n, x in enumerate(kinds) for y in kinds[n + 1 :]] + twice


def improve(bins, lengths, limit):
    """Local search: moves and swaps among all underfull bins while the sum of squared fills grows.

    Each bin, emptiest first, makes the best exchange with any other: move one or two pieces, one for one, two for one,
    one for two. It gives more than it takes, and the other gets fuller than the giver was, so the sum rises and the
    search ends: when the bins are as few as the total length allows, or when no bin has an exchange left.
    """
    lengths = [int(x) for x in lengths]
    least = -(-sum(lengths) // limit)
    bins = [b for b in bins if b]
    if len(bins) <= least:
        return bins
    sizes = [[lengths[p] for p in b] for b in bins]
    room = [limit - sum(x) for x in sizes]
    takes = _Takes(limit)
    for number, own in enumerate(sizes):
        if room[number]:
            takes.add(number, own, room[number])
    count, moved = len(bins), True
    while moved and count > least:
        moved = False
        for low in sorted((n for n, own in enumerate(sizes) if own and room[n]), key=lambda n: -room[n]):
            while sizes[low] and room[low] and count > least:
                takes.drop(low)
                gives = _pairs(sizes[low])
                rise, give, take, high = max(
                    takes.best([(x,) for x in sorted(set(sizes[low]))], room[low], True),
                    takes.best(gives, room[low], False) if gives else (0, (), (), -1),
                )
                if rise:
                    takes.drop(high)
                    for out, into, parts in ((low, high, give), (high, low, take)):
                        for part in parts:
                            sizes[out].remove(part)
                            sizes[into].append(part)
                    room[high] -= sum(give) - sum(take)
                    room[low] += sum(give) - sum(take)
                    takes.add(high, sizes[high], room[high])
                    count -= not sizes[low]
                    moved = True
                if sizes[low]:
                    takes.add(low, sizes[low], room[low])
                if not rise:
                    break
    places = {}
    for place in (p for b in bins for p in b):
        places.setdefault(lengths[place], []).append(place)
    return [[places[size].pop() for size in own] for own in sizes if own]


def _pack_group(table, limit, near_full):
    """Sequences of a group. Pieces that come in sequences (``old``) keep them unless best fit needs fewer, and where
    they need as many as before all are closed: another round would repeat the work."""
    lengths = table.column("length").to_numpy()
    row = table.column("row").to_numpy()
    bins = improve(best_fit(lengths, limit), lengths, limit)
    kept = {}
    for place, old in enumerate(table.column("old").to_pylist()):
        if old is not None:
            kept.setdefault(old, []).append(place)
    if kept:
        before = len(kept)
        bins = min(improve(list(kept.values()), lengths, limit), bins, key=len)
        if len(bins) >= before:
            near_full = limit
    rows = []
    for number, members in enumerate(bins):
        offset, size = 0, sum(int(lengths[p]) for p in members)
        for place in members:
            rows.append((int(row[place]), int(lengths[place]), number, offset, size < limit - near_full))
            offset += int(lengths[place])
    return pa.Table.from_batches([to_batch(rows, _TABLE)])


def pack(found, limit=LIMIT, group=GROUP, near_full=NEAR_FULL):
    """``found`` pieces with ``sequence_id`` and ``offset``: at most ``limit`` ids per sequence, without gaps from 0.

    Pieces of exactly ``limit`` ids are sequences of their own. The others are dealt at random into groups of about
    ``group`` pieces, each packed in one task by best fit and local search. What lies in sequences that are more than
    ``near_full`` ids short goes on to the next round, dealt sequence by sequence into as many fewer groups, until one
    group is left. A group that a round gave no fewer sequences is done, so pieces of which no two fit together end after
    two rounds. Repeated rows are packed as separate pieces; an empty table gives an empty one.
    """
    numbered = stored(found.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = numbered.where(F.col("length") == limit).select(
        "row", (F.col("row") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    left = numbered.where(F.col("length") < limit).select("row", "length", F.lit(None).cast("long").alias("old"))
    rounds, places = 0, whole
    count = left.count()
    while count:
        groups = -(-count // group)
        dealt = left.withColumn("group", F.pmod(F.xxhash64(F.coalesce("old", "row"), F.lit(rounds)), F.lit(groups)).cast("int"))
        key = (F.lit(rounds << 54) + F.col("group").cast("long") * (1 << 24)).alias("key")

        def packed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            done = _pack_group(table, limit, near_full)
            return done.append_column("key", pa.array([key[0].as_py()] * len(done), pa.int64()))

        schema = "row long, length long, bin long, offset long, open boolean, key long"
        done = stored(dealt.select("row", "length", "old", key).groupBy("key").applyInArrow(packed, schema), "packed")
        last = groups == 1 or rounds == MOST_ROUNDS - 1
        closed = done if last else done.where(~F.col("open"))
        sequence = F.col("key") + F.col("bin")
        places = places.unionByName(closed.select("row", sequence.alias("sequence_id"), "offset"))
        left = done.where(F.col("open")).select("row", "length", sequence.alias("old"))
        count = 0 if last else left.count()
        rounds += 1
    return numbered.join(places, "row").drop("row")
