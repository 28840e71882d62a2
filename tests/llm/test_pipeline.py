import pytest

import corpus_pipeline
from clickmart.llm import decontaminate
from tests.llm.test_decontaminate import brute, words_of
from tests.llm.test_jaccard_join import brute as classes
from tests.llm.test_substring_dedup import brute as windows


@pytest.fixture(scope="module")
def folder(spark, documents, corpus, tmp_path_factory):
    """Tables with extra columns whose names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs = documents.selectExpr("*", "'a' as selected", "1 as batch", "'b' as n_words", "'c' as hits", "2 as node")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(n, int(n % 5 > 0), 0) for n in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    texts = dict(corpus)
    items = [(n, texts[n]) for n in (5, 11)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, columns = [name for name, _ in corpus_pipeline.STAGES], docs.columns
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)

    kept = stage[names[1]](spark, docs, folder)
    assert kept.columns == columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(str(r.doc_id) for r in kept.collect())
    wanted = {c for _, n, c in classes(rows) if n} | {d for d, n, _ in classes(rows) if not n}
    assert found == sorted(wanted)

    cut = stage[names[2]](spark, docs, folder)
    assert cut.columns == columns
    wanted = [(d, text) for d, text, _, gone in windows(rows, 35) if gone]
    wanted += [(str(d), t) for d, t in rows if str(d) not in dict(wanted)]
    assert sorted(((str(r.doc_id), r.text) for r in cut.collect()), key=str) == sorted(wanted, key=str)
    assert cut.where("text is not null and n_chars <> length(text)").count() == 0

    clean = stage[names[3]](spark, docs, folder)
    assert clean.columns == columns
    items = [(str(r.item_id), words_of(r.text)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    wanted = []
    for doc_id, text in rows:
        hit, _ = brute(words_of(text), items, decontaminate.WINDOW)
        if not (hit and 20 * len(hit) >= len(words_of(text))):
            wanted.append(str(doc_id))
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(wanted)

    good = stage[names[0]](spark, docs, folder)
    assert good.columns == columns and 0 < good.count() <= docs.count()


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())
    sizes = {}
    for row in rows:
        sizes[row.sequence_id] = sizes.get(row.sequence_id, 0) + row.length
    assert max(sizes.values()) <= 2048


def test_run_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
