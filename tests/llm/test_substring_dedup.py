import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from clickmart.llm import exchange as X
from clickmart.llm.substring_dedup import repeated_spans


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    runs = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    found = []
    for (doc_id, text), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if runs[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = None if text is None else " ".join(x for i, x in enumerate(w) if i not in gone)
        found.append((str(doc_id), kept, len(w), len(gone)))
    return sorted(found, key=str)


def test_same_as_brute_force(documents, corpus):
    for window in (1, 5, 35):
        found = repeated_spans(documents, window=window).select("doc_id", "kept_text", "n_words", "n_removed", "removed")
        rows = found.collect()
        assert sorted([(str(r[0]), *r[1:4]) for r in rows], key=str) == brute(corpus, window)
        assert all(sum(s["end"] - s["first"] for s in r[4]) == r[3] for r in rows)


def test_other_columns_stay_and_clashing_ones_are_replaced(documents):
    found = repeated_spans(documents.withColumn("n_words", F.lit("old")).withColumn("batch", F.lit("mine")))
    assert {"lang", "source", "n_chars", "batch"} <= set(found.columns)
    assert found.where("batch = 'mine' and lang = 'en'").count() == documents.count()
    assert dict(found.dtypes)["n_words"] == "bigint"


def test_empty_table(no_documents):
    assert repeated_spans(no_documents).count() == 0


def test_an_owner_holds_little_beyond_its_keys():
    draw = np.random.default_rng(4)
    sent = [np.unique(draw.integers(0, 10**6, 20_000, dtype=np.uint64)) for _ in range(20)]
    table = pa.table({"batch": range(20), "keys": [X.packed_sorted(k) for k in sent], "counts": [b""] * 20})
    tracemalloc.start()
    found = X.Gathered(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    keys, times = np.unique(np.concatenate(sent), return_counts=True)
    assert np.array_equal(found.keys, keys) and np.array_equal(found.senders(), times)
    assert all(np.array_equal(keys[places], k) for (_, places), k in zip(found.answers(np.arange(len(keys))), sent, strict=True))
    assert peak < 5 * 8 * sum(map(len, sent))
