import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from clickmart.llm import ordinal
from tests.llm.conftest import prose


def graded(seed, words):
    """(text, quality, toxic): good prose, noise, or prose with a rude word somewhere."""
    draw = random.Random(seed)
    text = prose(seed, words).split()
    kind = draw.choice(["good", "good", "noise", "rude"])
    if kind == "noise":
        text = [w + draw.choice(["***", "&&&", "$$$"]) for w in text]
    if kind == "rude":
        text.insert(draw.randrange(len(text)), draw.choice(["Nasty,", "nastily.", "nastier"]))
    return " ".join(text), int(kind != "noise"), int(kind == "rude")


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(n, *graded(n, 20 + n % 150)) for n in range(900)]
    docs = spark.createDataFrame([(n, t) for n, t, _, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(n, q, x) for n, _, q, x in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_held_out_documents_are_judged_right(tables):
    rows, docs, labels = tables
    model = ordinal.fit_sample(docs, labels.where("doc_id < 600"))
    found = {r.doc_id: r for r in ordinal.rate(docs, model).where("doc_id >= 600").collect()}
    right = sum(found[n].selected == (q == 1 and x == 0) for n, _, q, x in rows if n >= 600)
    assert right >= 0.97 * len(found)
    means = [np.mean([found[n].expected_grade for n, _, q, x in rows if n >= 600 and (x, q) == k]) for k in [(1, 1), (0, 0), (0, 1)]]
    assert means == sorted(means)
    assert (np.diff(model.thresholds) > 0).all()


def test_sample_is_bounded_and_repeatable(tables):
    _, docs, labels = tables
    first, again = (ordinal.training_sample(docs, ordinal.grades(labels), 100).collect() for _ in range(2))
    assert first == again and 60 <= len(first) <= 100


def test_gradients_lower_the_loss_of_a_known_model():
    draw = np.random.default_rng(0)
    slots = sorted(ordinal.shape_slots()[:6])
    rows = []
    for _ in range(3000):
        x = [s for s in slots if draw.random() < 0.5]
        score = 2.0 * (slots[0] in x) - 2.0 * (slots[1] in x) + draw.logistic()
        rows.append((int(score > -1) + int(score > 1), np.array(x, np.int64)))
    model = ordinal.fit(rows, rounds=400)
    assert model.weights[slots[0]] == pytest.approx(2, abs=0.3) and model.weights[slots[1]] == pytest.approx(-2, abs=0.3)
    others = model.weights[slots[2:]].sum() / 2
    assert model.thresholds - others == pytest.approx([-1, 1], abs=0.4)


def test_odd_rows(spark, documents, no_documents, tables):
    labels = tables[2]
    model = ordinal.fit_sample(documents, labels.withColumn("quality", F.when(F.col("doc_id") > 3, F.col("quality"))))
    found = ordinal.rate(documents.withColumn("selected", F.lit("old")), model)
    assert found.count() == documents.count() and dict(found.dtypes)["selected"] == "boolean"
    assert ordinal.rate(no_documents, model).count() == 0
    nothing = ordinal.fit_sample(documents, labels.limit(0))
    assert ordinal.rate(documents, nothing).where("selected and expected_grade > 1.99").count() == documents.count()
