import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from clickmart.llm import exchange as X
from clickmart.llm import jaccard_join
from clickmart.llm.components import components
from clickmart.llm.jaccard_join import bitmap, first_of_each_class, near_duplicate_classes, needed_overlap, overlap_bounds, prefix_size


def shingles(text):
    text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g, s in zip(rows, group, sets, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return sorted((str(d), len(s), str(least.get(g) if s else d)) for (d, _), g, s in zip(rows, group, sets, strict=True))


def result(found):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found.collect())


def near_copies():
    """Chains of texts, each a few words off the one before, and texts that share a passage only."""
    draw = random.Random(1)
    rows = []
    for group in range(12):
        words = [f"g{group}x{draw.randint(0, 5000)}" for _ in range(draw.randint(8, 160))]
        for _ in range(draw.randint(1, 7)):
            words = words.copy()
            for _ in range(draw.randint(0, max(1, len(words) // 40))):
                words[draw.randrange(len(words))] = f"n{draw.randint(0, 10**6)}"
            rows.append(" ".join(words))
    passage = " ".join(f"p{n}" for n in range(60))
    for n in range(25):
        rows.append(f"{passage} " + " ".join(f"u{draw.randint(0, 10**6)}" for _ in range(12 + n % 3)))
    return [(100 + 3 * n, t) for n, t in enumerate(rows)]


@pytest.mark.parametrize("block", [2_000, 3])
def test_same_as_brute_force(spark, documents, corpus, block):
    assert result(near_duplicate_classes(documents, block=block)) == brute(corpus)
    rows = near_copies()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(near_duplicate_classes(table, block=block)) == brute(rows)


def test_one_document_of_each_class_stays(documents, corpus):
    table = documents.withColumn("batch", F.lit(1)).withColumn("node", F.lit("mine"))
    found = first_of_each_class(table)
    assert found.columns == table.columns
    classes = {(c if n else f"empty {d} {i}") for i, (d, n, c) in enumerate(brute(corpus))}
    kept = found.collect()
    assert len(kept) == len(classes)
    assert {str(r.doc_id) for r in kept} >= {c for d, n, c in brute(corpus) if n}


def test_empty_table(no_documents):
    assert near_duplicate_classes(no_documents).count() == 0
    assert first_of_each_class(no_documents).count() == 0


def test_bounds_never_fall_below_the_overlap():
    draw = np.random.default_rng(3)
    for _ in range(200):
        both, one, two = (draw.integers(0, 2**63, draw.integers(1, 60), dtype=np.uint64) for _ in range(3))
        a, b = np.unique(np.concatenate([both, one])), np.unique(np.concatenate([both, two]))
        left, right = (np.frombuffer(bitmap(x), np.uint64).reshape(1, -1) for x in (a, b))
        if left.shape == right.shape:
            assert overlap_bounds(left, len(a), right, len(b))[0] >= len(np.intersect1d(a, b))
    for n in range(1, 200):
        assert prefix_size(n) == n - -(-80 * n // 100) + 1
        for m in range(1, 200):
            least = needed_overlap(n, m)
            assert 100 * least >= 80 * (n + m - least) and 100 * (least - 1) < 80 * (n + m - least + 1)


def test_components(spark):
    draw = random.Random(2)
    links = [(n, n + 1) for n in range(60)] + [(100, n) for n in range(101, 140)] + [(500, 500)]
    links += [(draw.randint(200, 300), draw.randint(200, 300)) for _ in range(60)]
    wanted = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in range(100):
        for a, b in links:
            if a != b:
                wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == wanted
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("share", [30, 50, 100])
def test_other_shares_same_as_brute_force(spark, share):
    # halves and thirds of long texts, several bands of 80 % apart
    rows = []
    for group in range(6):
        words = [f"w{group}x{n}" for n in range(90 + 14 * group)]
        for part in (1, 2, 3):
            rows.append((10 * group + part, " ".join(words[: 4 + (len(words) - 4) // part])))
    sets = [shingles(t) for _, t in rows]
    assert sum(len(a & b) * 100 >= 50 * len(a | b) for a in sets for b in sets if len(a) > len(b)) >= 6
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        least[g] = min(doc_id, least.get(g, doc_id))
    wanted = sorted((str(d), len(s), str(least[g])) for (d, _), g, s in zip(rows, group, sets, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicate_classes(docs, share=share)) == wanted


def test_candidates_grow_with_the_nodes_of_a_tile():
    """Forty sets that overlap in pairs, as far as bitmaps tell: one row a node, not one a pair, and fewer links than nodes."""
    draw = np.random.default_rng(5)
    sets = [np.sort(draw.choice(np.arange(1, 121, dtype=np.uint64), 100, replace=False)) for _ in range(40)]
    node = np.arange(40)
    columns = {"tile": np.zeros(40, np.int64), "node": node, "n": np.full(40, 100), "component": node}
    full = pa.array([b"\xff" * 32] * 40, pa.binary())
    found = jaccard_join._compared(pa.table({**columns, "query": np.ones(40, bool), "bits": full}), 70, False)
    assert sorted(zip(*found.to_pydict().values(), strict=True)) == [(0, n) for n in range(40)]
    packed = pa.array([X.packed_sorted(x) for x in sets], pa.binary())

    def links(low, high, side):
        cell = {**columns, "side": side, "low": np.full(40, low), "high": np.full(40, high), "shingles": packed}
        return list(zip(*jaccard_join._linked(pa.table(cell), 70).to_pydict().values(), strict=True))

    def groups(pairs):
        group = list(range(40))
        for a, b in pairs:
            group = [group[a] if g == group[b] else g for g in group]
        return [group.index(g) for g in group]

    def linked(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return 100 * both >= 70 * (200 - both)

    for low, high, side in ((0, 0, np.zeros(40, int)), (0, 1, node % 2)):
        pairs = [(a, b) for a in range(40) for b in range(a) if linked(a, b) and (low == high or side[a] != side[b])]
        found = links(low, high, side)
        assert groups(found) == groups(pairs) and all(linked(*pair) for pair in found)
        assert 0 < len(found) < 40 < len(pairs)
