"""N-gram Jaccard self-join: all links of at least 80 % between sets of 5-word shingles, and their components.

1. Documents with the same set are one node. A table of bucket counts, of bounded size, gives a global order of all shingles,
   rare ones first; any order is right, this one keeps passages that many documents share out of the prefixes.
2. Two sets with a Jaccard similarity of s share one of the first n - ceil(s n) + 1 shingles of each. Batches send those
   prefixes to the owners of the shingles; sets that share a shingle form a tile. Equal tiles are kept once.
3. In each tile the node that most tiles share is verified against the others, and neighbours by size against each other
   where that left them apart. This joins groups of near copies without looking at all their pairs.
4. Tiles that still hold several components are cut into size bands (a link spans at most two) and, where large, into
   blocks. Bitmaps of hashed shingles bound the overlap of a pair from above; pairs of different components that pass
   are verified by intersecting the sorted sets: first the most promising partner of each node, and when these are joined
   every pair that is left. No link between components is lost.
"""

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import functions as F

from clickmart.llm import exchange as X
from clickmart.llm.components import components
from clickmart.llm.words import RunHashes, WordHashes, split_words, utf8
from clickmart.session import stored

SHINGLE = 5
SHARE = 80  # of 100
BATCH_BYTES = 4 << 20
SKETCH_BITS = 16, 24  # at least and at most
SKETCH_LOAD = 24  # words for a bucket
SLICES = 16
MARK_BITS = 24
BLOCK = 2_000
BLOCK_SHINGLES = 4_000_000


def _sets(table, text, words, runs, size):
    """The sorted distinct shingle hashes of each row. Fewer words than a shingle make one; no words make none."""
    rows = [split_words(data, lower=True) for data in utf8(table.column(text))]
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    ends = np.cumsum(lengths)
    numbers = words.array([word for row in rows for word in row])
    hashes = runs.windows(numbers, size)
    for end, length in zip(ends.tolist(), lengths.tolist(), strict=True):
        if length >= size:
            yield np.unique(hashes[end - length : end - size + 1])
        elif length:
            yield runs.whole(numbers[end - length : end])
        else:
            yield hashes[:0]


def band_width(share=SHARE):
    """Width of a size band in logarithms, such that a link spans at most two bands. Equal sizes alone need no band."""
    return float(np.log(100 / min(share, 99)))


def prefix_size(n, share=SHARE):
    return n + n * -share // 100 + 1


def needed_overlap(n, m, share=SHARE):
    """The least overlap of two sets of these sizes that makes a link."""
    return -(-share * (n + m) // (100 + share))


def bitmap(shingles):
    """Hashed shingles as bits, between two and four bits for each."""
    size = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits, length):
    """Bitmaps (rows of 64-bit words) brought down to ``length`` words."""
    while bits.shape[1] > length:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def overlap_bounds(left, n, right, m):
    """Upper bounds of the overlaps of one set with many: a bit that only one has is a shingle that the other lacks."""
    only_left = np.bitwise_count(left & ~right).sum(axis=1, dtype=np.int64)
    only_right = np.bitwise_count(right & ~left).sum(axis=1, dtype=np.int64)
    return np.minimum(n - only_left, m - only_right)


def _sketch_bits(words):
    """Bits of the bucket table for so many words: a fixed load up to the largest table, of 2^24 bytes."""
    return min(max(SKETCH_BITS[0], int(np.ceil(np.log2(max(1, words) / SKETCH_LOAD)))), SKETCH_BITS[1])


def _levels(batches, text, size, bits):
    """How frequent the shingles of each of 2^bits buckets are, as half powers of two: one byte per bucket."""
    width = 1 << bits
    shift = np.uint64(64 - bits)

    def count(rows):
        words, runs, totals = WordHashes(), RunHashes(), np.zeros(width, np.uint32)
        for record in rows:
            for data in record.column("rows"):
                found = [*_sets(X.bytes_table(data.as_py()), text, words, runs, size)]
                bucket, times = np.unique(np.concatenate(found) >> shift, return_counts=True)
                totals[bucket.astype(np.int64)] += times.astype(np.uint32)
        slices = totals.reshape(SLICES, -1)
        yield pa.RecordBatch.from_pydict({"slice": list(range(SLICES)), "counts": [X.packed(part) for part in slices]})

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width // SLICES, np.int64)
        for data in table.column("counts").to_pylist():
            total += X.unpacked(data, np.uint32)
        levels = np.ceil(2 * np.log2(total + 1)).astype(np.uint8)
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([X.packed(levels)], pa.binary())})

    schema = "slice long, counts binary"
    found = batches.mapInArrow(count, schema).groupBy("slice").applyInArrow(add, schema).collect()
    levels = np.zeros((SLICES, width // SLICES), np.uint8)
    for row in found:
        levels[row["slice"]] = X.unpacked(bytes(row["counts"]), np.uint8)
    return levels.reshape(-1)


_NODES = pa.schema(
    [("place", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())]
)


def _prefixes(batches, text, id_column, size, share, parts, bits):
    """Stored rows: requests of each batch (kind 0), and its documents with node, size and bitmap (kind 1)."""
    shared = batches.sparkSession.sparkContext.broadcast(_levels(batches, text, size, bits))
    shift = np.uint64(64 - bits)

    def send(rows):
        words, runs, levels = WordHashes(), RunHashes(), shared.value

        def sent():
            for record in rows:
                for batch, data in zip(record.column("batch").to_pylist(), record.column("rows"), strict=True):
                    table = X.bytes_table(data.as_py())
                    keys, owners, nodes, sizes, seen, docs = [], [], [], [], set(), []
                    for place, found in enumerate(_sets(table, text, words, runs, size)):
                        if not len(found):
                            docs.append((place, None, 0, None))
                            continue
                        node = xxhash.xxh3_64_intdigest(found.tobytes())
                        new = node not in seen
                        docs.append((place, node - (1 << 64) if node >> 63 else node, len(found), bitmap(found) if new else None))
                        if not new:
                            continue
                        seen.add(node)
                        level = levels[(found >> shift).astype(np.int64)].astype(np.uint64)
                        order = np.argsort(level << np.uint64(57) | found >> np.uint64(7), kind="stable")
                        first = found[order[: prefix_size(len(found), share)]]
                        keys.append(first)
                        owners.append(np.full(len(first), len(nodes), np.uint32))
                        nodes.append(node)
                        sizes.append(len(found))
                    info = pa.Table.from_batches([X.to_batch(docs, _NODES)])
                    yield 1, -1, batch, b"", X.table_bytes(info.append_column("doc_id", table.column(id_column)))
                    if keys:
                        keys, owners = np.concatenate(keys), np.concatenate(owners)
                        order = np.argsort(keys, kind="stable")
                        keys, owners = keys[order], owners[order]
                        edges = X.cuts(keys, parts)
                        nodes, sizes = np.array(nodes, np.uint64), np.array(sizes, np.uint32)
                        for part in np.flatnonzero(np.diff(edges)).tolist():
                            mine = slice(edges[part], edges[part + 1])
                            # only the nodes of this range go along
                            used, places = np.unique(owners[mine], return_inverse=True)
                            arrays = places.astype(np.uint32), nodes[used], sizes[used]
                            counts = b"".join(len(d).to_bytes(4, "little") + d for d in map(X.packed, arrays))
                            yield 0, part, batch, X.packed_sorted(keys[mine]), counts

        yield from X.ask(sent())

    return stored(batches.mapInArrow(send, X.REQUEST), "prefixes")


def _tiles(table, share=SHARE):
    """Tiles of one owner: ``tile, node, n, before, hub``, the last two where they may be linked with the node.

    ``before`` is the next smaller node, ``hub`` that of the tile's nodes which is in most of the owner's tiles: among copies
    with changes of their own it is the one with the fewest.
    """
    keys, nodes, sizes = [], [], []
    for data, values in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True):
        owners, node, size = X.arrays_of(values, np.uint32, np.uint64, np.uint32)
        keys.append(X.unpacked_sorted(data))
        nodes.append(node[owners])
        sizes.append(size[owners])
    keys, nodes, sizes = map(np.concatenate, (keys, nodes, sizes))
    order = np.lexsort((nodes, sizes, keys))
    keys, nodes, sizes = keys[order], nodes[order], sizes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes, sizes = keys[new], nodes[new], sizes[new]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(starts, append=len(keys))
    # a tile is named after its nodes, so that equal tiles are one
    names = np.add.reduceat(nodes * np.uint64(0xD6E8FEB86659FD93) ^ (nodes >> np.uint64(32)), starts)
    several = np.flatnonzero(counts > 1)
    chosen = several[np.unique(names[several], return_index=True)[1]]
    keep = np.zeros(len(starts), bool)
    keep[chosen] = True
    rows = np.flatnonzero(np.repeat(keep, counts))
    tile = np.repeat(names, counts)[rows]
    first = np.isin(rows, starts)
    before = np.where(first, 0, rows - 1)
    linked = ~first & (sizes[before].astype(np.int64) * 100 >= share * sizes[rows].astype(np.int64))
    # places by tile, then by how many tiles the node is in
    _, number, times = np.unique(nodes[rows], return_inverse=True, return_counts=True)
    begin = np.flatnonzero(first)
    length = np.diff(begin, append=len(rows))
    which = np.repeat(np.arange(len(begin)), length)
    order = np.lexsort((times[number], which))
    hub = rows[order[np.repeat(begin + length - 1, length)]]
    small, large = (f(sizes[hub], sizes[rows]).astype(np.int64) for f in (np.minimum, np.maximum))
    around = (hub != rows) & (100 * small >= share * large)
    return pa.table(
        {
            "tile": tile.view(np.int64),
            "node": nodes[rows].view(np.int64),
            "n": sizes[rows].astype(np.int64),
            "before": pa.array(nodes[before].view(np.int64), mask=~linked),
            "hub": pa.array(nodes[hub].view(np.int64), mask=~around),
        }
    )


def _one_of_each(nodes):
    """``node, n, bits, batch, place``: one document of each node."""
    first = nodes.where("bits is not null").groupBy("node").agg(F.min(F.struct("batch", "place", "n", "bits")).alias("at"))
    return stored(first.select("node", "at.*"), "nodes")


def _marks(places):
    """A bit for each wanted (batch, place), hashed into a table of fixed size."""
    width = 1 << MARK_BITS

    def mark(records):
        marks = np.zeros(width, bool)
        for record in records:
            marks[record.column(0).to_numpy()] = True
        slices = np.packbits(marks).reshape(SLICES, -1)
        yield pa.RecordBatch.from_pydict({"slice": list(range(SLICES)), "marks": [X.packed(part) for part in slices]})

    def either(table: pa.Table) -> pa.Table:
        found = np.bitwise_or.reduce([X.unpacked(data, np.uint8) for data in table.column("marks").to_pylist()])
        return pa.table({"slice": table.column("slice")[:1], "marks": pa.array([X.packed(found)], pa.binary())})

    hashed = F.pmod(F.xxhash64("batch", "place"), F.lit(width)).alias("mark")
    schema = "slice long, marks binary"
    rows = places.select(hashed).mapInArrow(mark, schema).groupBy("slice").applyInArrow(either, schema).collect()
    found = np.zeros((SLICES, width // 8 // SLICES), np.uint8)
    for row in rows:
        found[row["slice"]] = X.unpacked(bytes(row["marks"]), np.uint8)
    return found.reshape(-1)


def _with_sets(wanted, batches, text, size):
    """``wanted`` with the packed ``shingles`` of the documents at its ``batch, place``, made again from their texts.

    The places are hashed into a bit table of fixed size, so that the other texts are not shuffled (when it fills up, more of
    them are, and the join drops them). Shingles keep 48 bits.
    """
    shared = batches.sparkSession.sparkContext.broadcast(_marks(wanted))

    def chosen(rows):
        marks = np.unpackbits(shared.value).view(bool)
        schema = pa.schema([("batch", pa.int64()), ("place", pa.int64()), ("shingles", pa.binary())])
        words, runs = WordHashes(), RunHashes()
        for record in rows:
            for batch, data, mark in zip(record.column("batch").to_pylist(), record.column("rows"), record.column("marks").to_pylist(), strict=True):
                places = np.flatnonzero(marks[mark])
                if len(places):
                    sets = _sets(X.bytes_table(data.as_py()).take(pa.array(places)), text, words, runs, size)
                    found = [(batch, p, X.packed_sorted(x >> np.uint64(16))) for p, x in zip(places.tolist(), sets, strict=True)]
                    yield X.to_batch(found, schema)

    places = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda p: F.pmod(F.xxhash64("batch", p.cast("long")), F.lit(1 << MARK_BITS)))
    sets = batches.withColumn("marks", places).mapInArrow(chosen, "batch long, place long, shingles binary")
    return wanted.join(sets, ["batch", "place"])


def _verified(pairs, batches, one_of_each, text, size, share):
    """The pairs ``a, b`` that are links: bitmaps first, then exact intersection of the sorted sets.

    Sets are made again from the texts, for the documents of pairs that pass the bitmaps only.
    """
    one, two = (one_of_each.select(*[F.col(c).alias(f"{c}_{side}") for c in one_of_each.columns]) for side in "ab")

    def bounded(records):
        for record in records:
            keep = []
            for n, m, left, right in zip(*[record.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")], strict=True):
                left, right = (np.frombuffer(x, np.uint64).reshape(1, -1) for x in (left, right))
                width = min(left.shape[1], right.shape[1])
                need = needed_overlap(n, m, share)
                keep.append(min(n, m) >= need and overlap_bounds(_folded(left, width), n, _folded(right, width), m)[0] >= need)
            yield record.select(["a", "b", "batch_a", "place_a", "batch_b", "place_b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(one, F.col("a") == F.col("node_a")).join(two, F.col("b") == F.col("node_b")).drop("node_a", "node_b")
    schema = "a long, b long, batch_a long, place_a long, batch_b long, place_b long"
    passed = stored(both.mapInArrow(bounded, schema), "pairs")
    if passed.isEmpty():
        return passed.select("a", "b")
    sides = F.array(*[F.struct(F.col(f"batch_{x}").alias("batch"), F.col(f"place_{x}").alias("place")) for x in "ab"])
    wanted = passed.select("a", "b", F.explode(sides).alias("at")).select("a", "b", "at.*")
    sides = _with_sets(wanted, batches, text, size).select("a", "b", "shingles")

    def check(records):
        held, a, b = None, [], []
        for record in records:
            for row in zip(*[c.to_pylist() for c in record.columns], strict=True):
                if held is not None and held[:2] == row[:2]:
                    one, two = (X.unpacked_sorted(x[2]) for x in (held, row))
                    common = np.intersect1d(one, two, assume_unique=True)
                    if len(common) >= needed_overlap(len(one), len(two), share):
                        a.append(row[0])
                        b.append(row[1])
                held = row
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stored(sides.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(check, "a long, b long"), "verified")


def _apart(pairs, groups):
    """The pairs ``a, b`` whose components differ."""
    for side in "ab":
        known = groups.select(F.col("node").alias(f"node_{side}"), F.col("component").alias(f"component_{side}"))
        pairs = pairs.join(known, F.col(side) == F.col(f"node_{side}"), "left")
    component = {side: F.coalesce(f"component_{side}", side) for side in "ab"}
    return pairs.where(component["a"] != component["b"]).select("a", "b")


def _between(tiles, one_of_each, groups, share, block, best):
    """Pairs ``a, b`` of different components inside tiles whose bitmaps leave a link possible: the best one of each node and
    tile. Without ``best`` the nodes ``tile, node`` that are in any such pair, each once a block.

    A tile is cut by size bands: each band meets itself and the band below. Its own nodes are cut into blocks of
    ``block``, each of which meets the whole band and the one below in one task, row by row.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / band_width(share) + 1e-9).cast("int")
    known = tiles.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")).withColumn("band", band)
    open_tiles = (
        known.groupBy("tile")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("size"),
            F.collect_set("band").alias("bands"),  # there are only as many as powers of 5/4
        )
        .where("low <> high")
        .select("tile", "size", "bands")
    )
    rows = known.join(open_tiles, "tile").join(one_of_each.select("node", "bits"), "node")
    band = F.col("band")
    blocks = F.ceil(F.col("size") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # every block of its own band, and of the band above if the tile has any there; in its own block it is a query
    places = F.flatten(
        F.transform(
            F.when(F.array_contains("bands", band + 1), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))),
            lambda up: F.transform(
                F.sequence(F.lit(0), blocks - 1),
                lambda at: F.struct((band + up).alias("band"), at.alias("block"), ((up == 0) & (at == mine)).alias("query")),
            ),
        )
    )
    rows = rows.select("tile", "node", "n", "component", "bits", F.explode(places).alias("at"))
    rows = rows.select("tile", "at.*", "node", "n", "component", "bits")

    def compare(records):
        held = None
        for record in records:
            table = pa.Table.from_batches([record])
            table = pa.concat_tables([held, table]) if held is not None else table
            place = [table.column(c).to_numpy() for c in ("tile", "band", "block")]
            change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in place], axis=0)) + 1 if len(table) > 1 else []
            edges = [0, *change]
            for start, end in zip(edges, edges[1:], strict=False):
                if end - start > 1:
                    yield _compared(table.slice(start, end - start), share, best)
            held = table.slice(edges[-1])
        if held is not None and len(held) > 1:
            yield _compared(held, share, best)

    dealt = rows.repartition("tile", "band", "block").sortWithinPartitions("tile", "band", "block")
    return dealt.mapInArrow(compare, "a long, b long" if best else "tile long, node long").distinct()


def _compared(tile, share, best):
    """Candidates of one block of a tile: the pair with the highest bound for each query, or the nodes that are in any pair."""
    node, n, component = (tile.column(c).to_numpy() for c in ("node", "n", "component"))
    query = tile.column("query").to_numpy(zero_copy_only=False)
    found_a, found_b, possible = [node[:0]], [node[:0]], np.zeros(len(node), bool)
    if query.any() and (component != component[0]).any():
        each = [np.frombuffer(x, np.uint64) for x in tile.column("bits").to_pylist()]
        width = min(map(len, each))
        bits = np.concatenate([_folded(x.reshape(1, -1), width) for x in each])
        for at in np.flatnonzero(query):
            other = np.flatnonzero((component != component[at]) & (100 * np.minimum(n, n[at]) >= share * np.maximum(n, n[at])))
            if not best:
                # each pair once: the query is the larger, or has the larger node
                other = other[(n[other] < n[at]) | ((n[other] == n[at]) & (node[other] < node[at]))]
            if len(other):
                room = overlap_bounds(bits[at], n[at], bits[other], n[other]) - -(-share * (n[other] + n[at]) // (100 + share))
                fits = other[room >= 0]
                if best and len(fits):
                    found_a.append(node[[at]])
                    found_b.append(node[[other[room.argmax()]]])
                elif len(fits):
                    possible[at] = possible[fits] = True
    if not best:
        return pa.RecordBatch.from_pydict({"tile": tile.column("tile").to_numpy()[possible], "node": node[possible]})
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _links_left(tiles, batches, one_of_each, groups, text, size, share, block):
    """Links ``a, b`` between different components inside tiles, verified in place, that join all that can be joined.

    The nodes that have a possible partner are cut into blocks, of ``block`` nodes and ``BLOCK_SHINGLES`` shingles at most on
    average. Every two blocks of a band, and of a band and the one below, meet in one task.
    """
    possible = stored(_between(tiles, one_of_each, groups, share, block, best=False), "possible")
    if possible.isEmpty():
        return possible.select(F.col("tile").alias("a"), F.col("node").alias("b"))
    places = one_of_each.select("node", "n", "batch", "place")
    band = F.floor(F.log(F.col("n").cast("double")) / band_width(share) + 1e-9).cast("int")
    known = possible.join(places, "node").join(groups, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node")).withColumn("band", band)
    blocks = F.ceil(F.greatest(F.count("*") / block, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    cut = known.groupBy("tile").agg(blocks.alias("blocks"), F.collect_set("band").alias("bands"))
    rows = known.join(cut, "tile").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    band, mine, blocks = F.col("band"), F.col("mine"), F.col("blocks")

    def cells(place, when=F.lit(True)):
        none = F.array().cast("array<struct<band:int,low:int,high:int,side:int>>")
        return F.when(when, F.transform(F.sequence(F.lit(0), blocks - 1), place)).otherwise(none)

    def cell(of, low, high, side):
        return F.struct(of.alias("band"), low.alias("low"), high.alias("high"), side.cast("int").alias("side"))

    met = F.concat(
        cells(lambda at: cell(band, F.least(mine, at), F.greatest(mine, at), at < mine)),
        cells(lambda at: cell(band + 1, at, blocks + mine, F.lit(1)), F.array_contains("bands", band + 1)),
        cells(lambda at: cell(band, mine, blocks + at, F.lit(0)), F.array_contains("bands", band - 1)),
    )
    nodes = rows.select("node", "batch", "place").distinct()
    sets = _with_sets(nodes, batches, text, size).select("node", "shingles")
    rows = rows.select("tile", "node", "n", "component", F.explode(met).alias("at")).join(sets, "node")
    key = ["tile", "band", "low", "high"]

    def compare(records):
        held = None
        for record in records:
            table = pa.Table.from_batches([record])
            table = pa.concat_tables([held, table]) if held is not None else table
            place = [table.column(c).to_numpy() for c in key]
            change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in place], axis=0)) + 1
            edges = [0, *change.tolist()]
            for start, end in zip(edges, edges[1:], strict=False):
                if end - start > 1:
                    yield _linked(table.slice(start, end - start), share)
            held = table.slice(edges[-1])
        if held is not None and len(held) > 1:
            yield _linked(held, share)

    dealt = rows.select(*[F.col(f"at.{c}").alias(c) if c != "tile" else F.col(c) for c in key], "at.side", "node", "n", "component", "shingles")
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)
    return stored(dealt.mapInArrow(compare, "a long, b long").distinct(), "left")


def _linked(cell, share):
    """Links between the components of one cell, as many as join them; exact on the sorted sets, bitmaps first."""
    node, n, component, side, low, high = (cell.column(c).to_numpy() for c in ("node", "n", "component", "side", "low", "high"))
    inside, component, found_a, found_b = low[0] == high[0], component.copy(), [], []
    if (component != component[0]).any():
        sets = [X.unpacked_sorted(x) for x in cell.column("shingles").to_pylist()]
        each = [np.frombuffer(bitmap(x), np.uint64) for x in sets]
        width = min(map(len, each))
        bits = np.concatenate([_folded(x.reshape(1, -1), width) for x in each])
        del each
        for at in np.flatnonzero(side == 0).tolist():
            fits = (component != component[at]) & (100 * np.minimum(n, n[at]) >= share * np.maximum(n, n[at]))
            other = np.flatnonzero(fits & (np.arange(len(node)) > at if inside else side == 1))
            room = overlap_bounds(bits[at], n[at], bits[other], n[other]) - -(-share * (n[other] + n[at]) // (100 + share))
            for to in other[room >= 0].tolist():
                if component[to] != component[at]:
                    common = np.intersect1d(sets[at], sets[to], assume_unique=True)
                    if len(common) >= needed_overlap(len(sets[at]), len(sets[to]), share):
                        found_a.append(min(node[at], node[to]))
                        found_b.append(max(node[at], node[to]))
                        component[component == component[to]] = component[at]
    return pa.RecordBatch.from_pydict({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def _joined(docs, text, id_column, size, share, block):
    """(batches, documents): all rows in batches; ``batch, place, doc_id, n, group`` with a null group for empty sets."""
    batches = stored(X.document_batches(docs, text, BATCH_BYTES), "documents")
    words = batches.count() * BATCH_BYTES // 6
    # a prefix has about a fifth of the shingles
    parts = X.parts_for(1, words // 4, least=4)
    prefixes = _prefixes(batches, text, id_column, size, share, parts, _sketch_bits(words))

    def unpack(records):
        for record in records:
            for batch, data in zip(record.column(0).to_pylist(), record.column(1), strict=True):
                table = X.bytes_table(data.as_py())
                yield from table.append_column("batch", pa.array([batch] * len(table), pa.int64())).to_batches()

    kind = dict(docs.dtypes)[id_column]
    schema = f"place long, node long, n long, bits binary, doc_id {kind}, batch long"
    nodes = prefixes.where("kind = 1").select("batch", "counts").mapInArrow(unpack, schema)

    def met(table: pa.Table) -> pa.Table:
        return _tiles(table, share)

    tiles = (
        prefixes.where("kind = 0").select("part", "keys", "counts")
        .groupBy("part").applyInArrow(met, "tile long, node long, n long, before long, hub long")
    )
    tiles = stored(tiles, "tiles")
    one_of_each = _one_of_each(nodes)

    def with_node(name):
        near = tiles.where(F.col(name).isNotNull())
        return near.select(F.least(name, "node").alias("a"), F.greatest(name, "node").alias("b")).distinct()

    def verified(pairs):
        return _verified(pairs, batches, one_of_each, text, size, share)

    links = verified(with_node("hub"))
    groups = stored(components(links), "groups")
    members = tiles.select("tile", "node", "n").distinct()
    for find in (
        lambda: verified(_apart(with_node("before"), groups)),
        lambda: verified(_between(members, one_of_each, groups, share, block, best=True)),
        lambda: _links_left(members, batches, one_of_each, groups, text, size, share, block),
    ):
        more = find()
        if not more.isEmpty():
            links = links.unionAll(more)
            groups = stored(components(links), "groups")
    rows = nodes.drop("bits").join(groups, "node", "left")
    return batches, rows.withColumn("group", F.coalesce("component", "node")).drop("component", "node")


def near_duplicate_classes(docs, text="text", id_column="doc_id", size=SHINGLE, share=SHARE, block=BLOCK):
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id`` (the smallest id reachable by links).

    Words are runs of anything but blank and \\x09-\\x0D, A-Z in lower case; a text with fewer words than a shingle is
    one shingle; a null or empty text has no shingles and is linked with nothing. Equal texts, and repeated rows, are
    linked. Null ids count as larger than all others. Other columns are ignored; an empty table gives an empty one.
    """
    _, rows = _joined(docs.select(id_column, text), text, id_column, size, share, block)
    least = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    found = rows.join(least, "group", "left")
    component = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def first_of_each_class(docs, text="text", id_column="doc_id", size=SHINGLE, share=SHARE, block=BLOCK):
    """The rows of ``docs``, one of each class: that with the smallest id. Empty and null texts are no class and stay."""
    batches, rows = _joined(docs, text, id_column, size, share, block)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "batch", "place")
    kept = rows.where("group is not null").groupBy("group").agg(F.min(order).alias("row")).select("row.batch", "row.place")
    kept = kept.unionAll(rows.where("group is null").select("batch", "place"))

    def take(left: pa.Table, right: pa.Table) -> pa.Table:
        table = X.bytes_table(left.column("rows")[0].as_py())
        return table.take(pa.array(sorted(right.column("place").to_pylist()), pa.int64()))

    return batches.groupBy("batch").cogroup(kept.groupBy("batch")).applyInArrow(take, docs.schema)
