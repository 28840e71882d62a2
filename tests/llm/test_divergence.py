import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from clickmart.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for _, text, lang, source in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    frequency, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        words = [word.translate(lower) for word in words]
        frequency[lang].update(set(words))
        sources[lang].add(source)
        counts[lang, source].update(words)
        counts[lang].update(words)
    found = []
    for lang, names in sources.items():
        kept = [term for term, n in frequency[lang].items() if n >= least]

        def shares(of, kept=kept):
            total = sum(of[term] for term in kept)
            return {term: 1 + 10**9 * (of[term] + 5) // (total + 5 * len(kept)) for term in kept}

        general, own = shares(counts[lang]), {name: shares(counts[lang, name]) for name in names}
        for name in names:
            p = own[name]
            pairs = [(-sum(abs(p[t] - own[o][t]) for t in kept), o.encode(), o) for o in names if o != name]
            terms = [(general[t] - p[t], t.encode(), t) for t in kept if counts[lang, name][t] and p[t] > general[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found += [(lang, name, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(found)


def table():
    draw = random.Random(3)
    words = [f"wört{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(200)] + ["The", "THE", "the", "don't", "x1y", "日本", "naïve"]
    rows = []
    for n in range(400):
        text = " ".join(words[min(int(draw.paretovariate(0.5)), 206)] for _ in range(draw.randint(0, 40)))
        rows.append((n, text, draw.choice(["en", "en", "fr", None, "de"]), draw.choice(["hot", "hot", "a", "b", None, "ç", "src,;"])))
    rows += [(1, None, "xx", "lonely"), (2, "", "yy", "one"), (3, "12 34", "yy", "two"), (None, "the wörtaa", None, None)]
    return [*rows, rows[0], (900, "the long wörtab " * 120_000, "fr", "a")]


@pytest.mark.parametrize(("held", "group", "least", "top"), [(D.HELD_COUNTS, D.GROUP_TERMS, 30, 50), (40, 5, 3, 4)])
def test_same_as_brute_force(spark, monkeypatch, held, group, least, top):
    monkeypatch.setattr(D, "HELD_COUNTS", held)
    monkeypatch.setattr(D, "GROUP_TERMS", group)
    rows = table()
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit("mine")).withColumn("total", F.lit(1)).repartition(5)
    found = D.source_divergence(frame, least, top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute(rows, least, top)


def test_empty_table(spark):
    assert D.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact():
    draw = random.Random(1)
    for _ in range(500):
        total = draw.randint(1, 9 * 10**13)
        count = draw.randint(0, total)
        assert D.scaled_shares(np.int64(count), np.int64(total)) == 1 + 10**9 * count // total
