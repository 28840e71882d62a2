"""Near-duplicate documents by min-max hashing: links of at least 85 % between sets of 3-word shingles, and their components.

A permutation of the shingle hashes gives a set two slots, its least and its greatest value. Either is equal in two sets with
the probability of their Jaccard similarity, so 64 permutations give 128 unbiased slots for half the hash evaluations that
128 minima take, and the two slots of one permutation vary together less than copies of one would.

1. Documents with equal sets are one node. Bands of four slots, each of minima or of maxima only, put nodes into buckets. A
   link of 85 % shares none of the 32 bands with a probability of 6e-11.
2. Each bucket links its first node, the hub, with the others where enough slots agree and the full sets confirm it. That
   costs one row per node and bucket however many copies meet, and joins groups of near copies.
3. Buckets that still hold several components are opened: their nodes are compared by slots, in blocks of bounded size, and a
   node goes on to the exact comparison only if a node of another component agrees with it. Each pair is looked at in the first
   band that it shares, pairs joined meanwhile are passed over, and only links leave a task.

A pair of 85 % has fewer than ``LEAST_EQUAL`` equal slots with a probability below 1e-6; all links are confirmed on full sets.
"""

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmart.llm.components import components
from clickmart.llm.exchange import row_groups
from clickmart.llm.words import RunHashes, WordHashes, mixed, split_words, utf8
from clickmart.session import stored

SHINGLE = 3
SHARE = 85  # of 100
PERMUTATIONS = 64
BAND_SLOTS = 4
BANDS = 2 * PERMUTATIONS // BAND_SLOTS
LEAST_EQUAL = 88  # of 128 slots
GROUP_BYTES = 2 << 20
BLOCK_NODES, BLOCK_SHINGLES = 2_000, 2_000_000

_FACTORS = mixed(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
_SALTS = mixed(np.arange(1001, 1001 + BANDS, dtype=np.uint64))


class Shingles:
    """Sorted distinct shingle hashes of texts. Fewer words than a shingle make one; no words make none."""

    def __init__(self, size):
        self.size, self.words, self.runs = size, WordHashes(), RunHashes()

    def __call__(self, data):
        numbers = self.words.array(split_words(data, lower=True))
        if len(numbers) >= self.size:
            return np.unique(self.runs.windows(numbers, self.size))
        return self.runs.whole(numbers) if len(numbers) else numbers


def min_max_slots(sets):
    """One row of slots per non-empty set: the minima of all permutations, then the maxima."""
    numbers = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    slots = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for place, factor in enumerate(_FACTORS):
        permuted = numbers * factor
        slots[:, place] = np.minimum.reduceat(permuted, starts)
        slots[:, PERMUTATIONS + place] = np.maximum.reduceat(permuted, starts)
    return slots


def band_keys(slots):
    """A 64-bit number per band and row of slots."""
    bands = slots.reshape(len(slots), BANDS, BAND_SLOTS)
    keys = np.tile(_SALTS, (len(slots), 1))
    for place in range(BAND_SLOTS):
        keys = mixed(keys ^ bands[:, :, place])
    return keys


def short_slots(slots):
    """The upper byte of each slot after mixing: slots that differ agree there one time in 256."""
    return (mixed(slots) >> np.uint64(56)).astype(np.uint8)


def is_link(a, b, share=SHARE):
    """Whether two sorted sets overlap by ``share`` of 100 of their union."""
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < share * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= share * (len(a) + len(b) - both)


def _fixed(rows):
    """Rows of equal width as an Arrow binary column."""
    data = np.ascontiguousarray(rows)
    width = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _wide(column, kind, width):
    """The reverse of ``_fixed``, of a column of a table."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def signatures(docs, text="text", id_column="doc_id", size=SHINGLE):
    """(node, doc_id, text, n, high, low, slots, keys): size and digest of each set, its short slots and band keys."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("node"), F.col(id_column).alias("doc_id"), F.col(text).alias("text")
    )

    def sign(batches):
        shingles = Shingles(size)
        for table in row_groups(batches, "text", GROUP_BYTES):
            sets = [shingles(data) for data in utf8(table.column("text"))]
            counts = np.fromiter(map(len, sets), np.int64, len(sets))
            digests = np.zeros((len(sets), 2), np.uint64)
            slots = np.zeros((len(sets), 2 * PERMUTATIONS), np.uint64)
            if filled := [found for found in sets if len(found)]:
                slots[counts > 0] = min_max_slots(filled)
            for place, found in enumerate(sets):
                digests[place] = divmod(xxhash.xxh3_128_intdigest(found.tobytes()), 1 << 64)
            columns = {
                **{name: table.column(name) for name in ("node", "doc_id", "text")},
                "n": counts,
                "high": digests[:, 0].view(np.int64),
                "low": digests[:, 1].view(np.int64),
                "slots": _fixed(short_slots(slots)),
                "keys": _fixed(band_keys(slots)),
            }
            yield from pa.table(columns).to_batches()

    kind = dict(rows.dtypes)["doc_id"]
    schema = f"node long, doc_id {kind}, text string, n long, high long, low long, slots binary, keys binary"
    return rows.mapInArrow(sign, schema)


def _buckets(nodes):
    """(key, node): one row per node and band."""

    def cut(batches):
        for batch in batches:
            if len(batch):
                keys = _wide(batch.column("keys"), np.int64, BANDS)
                columns = {
                    "key": keys.reshape(-1),
                    "node": np.repeat(batch.column("node").to_numpy(), BANDS),
                }
                yield from pa.table(columns).to_batches()

    return nodes.select("node", "keys").mapInArrow(cut, "key long, node long")


def _needed(nodes, rows, *columns):
    """``columns`` of those ``nodes`` that ``rows`` name. Their names are a table of their own, whose size Spark knows: where it
    is small, it goes to the nodes, and only the wide rows in need are moved."""
    names = stored(rows.select("node").distinct(), "needed")
    return nodes.select("node", *columns).join(names, "node", "left_semi")


def _both(pairs, nodes, *columns):
    """``pairs`` (a, b) with ``columns`` of both nodes."""
    nodes = _needed(nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")), *columns)
    for end in ("a", "b"):
        named = [F.col(name).alias(f"{name}_{end}") for name in columns]
        pairs = pairs.join(nodes.select(F.col("node").alias(end), *named), end)
    return pairs


def _agreeing(pairs, nodes):
    """Pairs whose slots agree often enough."""

    def agree(batches):
        for batch in batches:
            if len(batch):
                a, b = (_wide(batch.column(name), np.uint8, 2 * PERMUTATIONS) for name in ("slots_a", "slots_b"))
                enough = (a == b).sum(axis=1) >= LEAST_EQUAL
                yield batch.select(["a", "b"]).filter(pa.array(enough))

    return _both(pairs, nodes, "slots").mapInArrow(agree, "a long, b long")


def _confirmed(pairs, nodes, size, share):
    """Pairs whose full sets make a link."""

    def confirm(batches):
        shingles = Shingles(size)
        for batch in batches:
            texts = zip(utf8(batch.column("text_a")), utf8(batch.column("text_b")), strict=True)
            yield batch.select(["a", "b"]).filter(
                pa.array([is_link(shingles(a), shingles(b), share) for a, b in texts], pa.bool_())
            )

    return _both(pairs, nodes, "text").mapInArrow(confirm, "a long, b long")


def _runs(batches, *names):
    """Arrow tables of all rows that are equal in ``names``, of rows sorted by them."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        table, held = table.combine_chunks(), None
        if not len(table):
            continue
        new = np.zeros(len(table), bool)
        for name in names:
            values = table.column(name).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        edges = np.flatnonzero(new).tolist()
        for start, end in zip([0, *edges], edges, strict=False):
            yield table.slice(start, end - start)
        held = table.slice(edges[-1] if edges else 0)
    if held is not None and len(held):
        yield held


def _candidates(table):
    """Pairs (i, j) of one run of an open bucket that agree in slots, belong to different components and meet here first."""
    slots = _wide(table.column("slots"), np.uint8, 2 * PERMUTATIONS)
    keys = _wide(table.column("keys"), np.int64, BANDS)
    band = int((keys[0] == table.column("key")[0].as_py()).argmax())
    groups, sides = table.column("component").to_numpy(), table.column("side").to_numpy()
    crossing = len(np.unique(sides)) > 1
    for i in range(len(table) - 1):
        apart = groups[i + 1 :] != groups[i]
        if crossing:  # two blocks: pairs within one of them meet elsewhere
            apart &= sides[i + 1 :] != sides[i]
        others = np.flatnonzero(apart) + i + 1
        if len(others):
            equal = (slots[others] == slots[i]).sum(axis=1)
            others, equal = others[equal >= LEAST_EQUAL], equal[equal >= LEAST_EQUAL]
            first = (keys[others] == keys[i]).argmax(axis=1) == band
            for j, score in zip(others[first].tolist(), equal[first].tolist(), strict=True):
                yield score, i, j


def _blocks(rows, limits):
    """Runs of bounded size: a small bucket is one; a large one is cut, and every pair of its blocks is a run."""
    nodes, shingles = limits
    count = F.greatest(F.lit(1), F.ceil(F.col("met") / nodes), F.ceil(F.col("shingles") / shingles)).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cut = rows.withColumn("blocks", count).withColumn("mine", mine)
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("other", other)
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    return cut.select(
        "key", "node", "component", (low * F.col("blocks") + high).alias("run"),
        F.when(low == high, 0).otherwise(F.col("mine")).alias("side"),
    )


def _between(met, nodes, found, size, share, limits):
    """Links between components (``found``: node, component) of nodes that share a bucket (``met``)."""
    group = F.coalesce("component", "node").alias("component")
    placed = met.join(found, "node", "left").select("key", "node", group)
    mixed_keys = placed.groupBy("key").agg((F.min("component") < F.max("component")).alias("open")).where("open")
    placed = stored(placed.join(mixed_keys.select("key"), "key"), "open-buckets")
    placed = placed.join(nodes.select("node", "n"), "node")
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("met"), F.sum("n").alias("shingles"))
    rows = stored(_blocks(placed.join(sizes, "key"), limits), "open-blocks")
    columns = rows.columns

    def with_columns(frame, *names):
        joined = frame.join(_needed(nodes, frame, *names), "node")
        return joined.repartition("key", "run").sortWithinPartitions("key", "run")

    def flag(batches):
        for table in _runs(batches, "key", "run"):
            wanted = {place for _, *pair in _candidates(table) for place in pair}
            if wanted:
                chosen = table.take(pa.array(sorted(wanted))).select(columns)
                yield from chosen.combine_chunks().to_batches()

    def link(batches):
        shingles = Shingles(size)
        for table in _runs(batches, "key", "run"):
            groups = table.column("component").to_pylist()
            names, leads, sets, links = table.column("node").to_pylist(), {}, {}, []
            texts = utf8(table.column("text"))

            def lead(group, leads=leads):
                while group in leads:
                    group = leads[group]
                return group

            for _, *pair in sorted(_candidates(table), reverse=True):
                left, right = (lead(groups[place]) for place in pair)
                if left != right:
                    for place in pair:
                        if place not in sets:
                            sets[place] = shingles(texts[place])
                    if is_link(*(sets[place] for place in pair), share):
                        leads[max(left, right)] = min(left, right)
                        links.append([names[place] for place in pair])
            if links:
                yield pa.RecordBatch.from_pydict(dict(zip("ab", map(pa.array, zip(*links, strict=True)), strict=True)))

    flagged = stored(with_columns(rows, "slots", "keys").mapInArrow(flag, rows.schema), "flagged")
    return with_columns(flagged, "slots", "keys", "text").mapInArrow(link, "a long, b long")


def near_duplicates(docs, text="text", id_column="doc_id", size=SHINGLE, share=SHARE, limits=(BLOCK_NODES, BLOCK_SHINGLES)):
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``component_id`` is the smallest id that links reach, the own one included; ``kept`` marks the document that has it. Null,
    empty and blank texts have no shingles, are linked with nothing and kept. Null ids count for no component; a component
    without any other id has a null one and all its rows are kept. Rows with equal ids and texts are copies of one another,
    and kept alike. Texts of any length are hashed whole, one at a time where they are long. Other columns of ``docs`` are not
    read. An empty table gives an empty result.
    """
    signed = stored(signatures(docs, text, id_column, size), "min-max")
    filled = signed.where("n > 0")
    copies = stored(filled.groupBy("high", "low").agg(F.min("node").alias("first")), "copies")
    nodes = filled.join(copies.select(F.col("first").alias("node")), "node", "left_semi")

    bucket = Window.partitionBy("key").orderBy("node")
    rows = _buckets(nodes).select("*", F.first("node").over(bucket).alias("hub"), F.lead("node").over(bucket).alias("next"))
    met = stored(rows.where("hub < node OR next IS NOT NULL").drop("next"), "buckets")
    pairs = met.where("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = _confirmed(stored(_agreeing(pairs, filled), "pairs"), filled, size, share)
    found = stored(components(links), "components")
    more = stored(_between(met.drop("hub"), filled, found, size, share, limits), "links")
    if not more.isEmpty():
        known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = stored(components(known.unionAll(more)), "components")

    members = filled.select("node", "doc_id", "high", "low").join(copies, ["high", "low"])
    found = found.select(F.col("node").alias("first"), "component")
    members = members.join(found, "first", "left").select("node", "doc_id", F.coalesce("component", "first").alias("group"))
    members = stored(members, "members")
    least = members.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    least = members.join(least.where("size > 1"), "group").select("node", "component_id", F.lit(True).alias("grouped"))
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        signed.select("node", "doc_id", "n")
        .join(least, "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
