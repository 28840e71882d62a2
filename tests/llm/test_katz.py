import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickmart.llm.katz import TURING, Discounts, Unigrams, held_out, score


def tokens_of(text):
    text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), None]


class Model:
    def __init__(self, texts):
        self.one, self.two, self.after = Counter(), Counter(), defaultdict(set)
        for text in texts:
            before = None
            for token in tokens_of(text):
                self.one[token] += 1
                self.two[before, token] += 1
                self.after[before].add(token)
                before = token
        self.p = Unigrams(self.of_counts(self.one), sum(self.one.values()))
        self.d = Discounts(self.of_counts(self.two))

    @staticmethod
    def of_counts(counter):
        return np.array([sum(1 for c in counter.values() if c == r) for r in range(1, TURING + 2)], float)

    def word(self, token):
        return float(self.p([self.one[token]])[0])

    def given(self, token, before):
        total = sum(self.two[before, t] for t in self.after[before])
        if not total:
            return self.word(token)
        if self.two[before, token]:
            return float(self.d([self.two[before, token]])[0]) * self.two[before, token] / total
        left = 1 - sum(self.given(t, before) for t in self.after[before])
        return left / (1 - sum(self.word(t) for t in self.after[before])) * self.word(token)


@pytest.fixture(scope="module")
def model(corpus):
    return Model([t for n, t in corpus if not held_out(n)])


def test_distributions_sum_to_one(model):
    every = [*model.one, "a word not seen"]
    assert math.isclose(sum(map(model.word, every)), 1, rel_tol=1e-9)
    for before in [None, "one", "a", "w1é", "a word not seen"]:
        assert math.isclose(sum(model.given(t, before) for t in every), 1, rel_tol=1e-9)


@pytest.mark.parametrize("batch_words", [1_000_000, 400])
def test_same_as_brute_force(documents, corpus, model, batch_words):
    rows = score(documents, batch_words).collect()
    total, types = sum(model.one.values()), len(model.one)
    wanted = []
    for doc_id, text in corpus:
        tokens = tokens_of(text)
        base = sum(math.log10((model.one[t] + 0.5) / (total + 0.5 * (types + 1))) for t in tokens)
        logs = sum(math.log10(model.given(t, b)) for b, t in zip([None, *tokens], tokens, strict=False))
        wanted.append((str(doc_id), held_out(doc_id), len(tokens), sum(model.one[t] > 0 for t in tokens), total, base, logs))
    got = sorted([(str(r[0]), *r[1:]) for r in rows])
    for mine, theirs in zip(got, sorted(wanted), strict=True):
        assert mine[:5] == theirs[:5]
        assert mine[5:] == pytest.approx(theirs[5:], rel=1e-7)


def test_better_than_unigrams_on_held_out_text(spark):
    rows = [(n, " ".join(f"a{(n * 7 + i * i) % 40} b{(n * 7 + i * i) % 40}" for i in range(60))) for n in range(80)]
    found = score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert found and all(r.score > r.base_score for r in found)


def test_without_training_rows(spark, no_documents):
    assert score(no_documents).count() == 0
    out = next(n for n in range(100) if held_out(n))
    row = score(spark.createDataFrame([(out, "some text")], "doc_id long, text string")).first()
    assert (row.train_tokens, row.n_known, row.base_score, row.score) == (0, 0, 0.0, 0.0)
