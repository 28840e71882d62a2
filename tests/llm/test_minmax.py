import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from clickmart.llm import minmax


def shingles(text, size=3):
    text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    found = [(d, len(s), least.get(g) if s else d) for (d, _), g, s in zip(rows, group, sets, strict=True)]
    return sorted(((*row, row[0] == row[2]) for row in found), key=str)


def result(found):
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, found.collect()), key=str)


def near_copies():
    """Chains and crowds of texts a few words apart, and texts that share most of a passage only."""
    draw, rows = random.Random(5), []
    for group in range(10):
        words = [f"g{group}x{draw.randint(0, 5000)}" for _ in range(draw.randint(6, 200))]
        for _ in range(draw.randint(1, 9)):
            words = words.copy()
            for _ in range(draw.randint(0, max(1, len(words) // 40))):
                words[draw.randrange(len(words))] = f"n{draw.randint(0, 10**6)}"
            rows.append(" ".join(words))
    crowd = [f"c{n}" for n in range(150)]
    for _ in range(120):
        words = crowd.copy()
        for _ in range(draw.randint(1, 6)):
            words[draw.randrange(150)] = f"m{draw.randint(0, 10**6)}"
        rows.append(" ".join(words))
    for n in range(40):
        rows.append(" ".join([*crowd[:70], *[f"u{draw.randint(0, 10**6)}" for _ in range(5 + n % 9)]]))
    return [(1000 - 3 * n, text) for n, text in enumerate(rows)]


@pytest.mark.parametrize("limits", [(minmax.BLOCK_NODES, minmax.BLOCK_SHINGLES), (7, 1_000)])
def test_same_as_brute_force(spark, documents, corpus, limits):
    assert result(minmax.near_duplicates(documents.withColumn("node", F.lit(0)), limits=limits)) == brute(corpus)
    rows = near_copies()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(minmax.near_duplicates(table, limits=limits)) == brute(rows)


def test_empty_table(no_documents):
    assert minmax.near_duplicates(no_documents).count() == 0


def test_null_ids_and_clashing_columns(spark):
    rows = [(None, "a b c d"), (None, "A b c d"), (5, "x y z"), (5, "x y z"), (9, ""), (7, None), (2, "one"), (None, "x y z")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("component", "key", "n", "slots", "kept", "a"):
        table = table.withColumn(name, F.lit("mine"))
    assert result(minmax.near_duplicates(table)) == brute(rows)


def test_slots_estimate_similarity_without_bias():
    draw = np.random.default_rng(8)
    for share in (0.3, 0.6, 0.85):
        found = []
        for _ in range(40):
            both = draw.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            a, b = (np.append(both, draw.integers(0, 2**63, (400 - len(both)) // 2, dtype=np.uint64)) for _ in range(2))
            left, right = minmax.min_max_slots([a, b])
            found.append((left == right).mean())
            assert ((minmax.short_slots(left) == minmax.short_slots(right)) | (left != right)).all()
        assert abs(np.mean(found) - share) < 0.02
