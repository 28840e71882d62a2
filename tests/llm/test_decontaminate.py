import random
import re

from pyspark.sql import functions as F

from clickmart.llm.decontaminate import automaton, benchmark_hits, contaminated, scan, without_spans


def words_of(text):
    text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(words, items, window):
    hit, found = set(), set()
    for item, own in items:
        size = min(window, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                found.add(item)
                hit.update(range(i, i + size))
    return hit, found


def test_automaton_on_random_words():
    draw = random.Random(5)
    for _ in range(150):
        letters = "ab" if draw.random() < 0.5 else "abcd"
        items = [(str(n), [draw.choice(letters) for _ in range(draw.randint(0, 12))]) for n in range(draw.randint(1, 5))]
        window = draw.randint(1, 6)
        words = [draw.choice(letters + "x") for _ in range(60)]
        spans, found = scan(words, automaton(items, window))
        assert (set().union(*[range(a, b) for a, b in spans]), found) == brute(words, items, window)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def benchmark(spark, corpus):
    texts = {n: t for n, t in corpus if n is not None}
    rows = [(1, texts[3]), (2, texts[4].upper()), (10, "one, TWO"), (11, None), (12, ""), (13, " ".join(texts[5].split()[:20])), (14, texts[3])]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_same_as_brute_force_in_one_block_and_in_several(spark, documents, corpus):
    rows, table = benchmark(spark, corpus)
    items = [(str(n), words_of(t)) for n, t in rows]
    wanted = []
    for doc_id, text in corpus:
        words = words_of(text)
        hit, found = brute(words, items, 13)
        wanted.append((str(doc_id), len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)))
    for block_words in (100_000, 30):
        found = benchmark_hits(documents, table, block_words=block_words).withColumn("bad", contaminated())
        got = [(str(r.doc_id), r.n_words, r.n_hit, r["items"], r.bad) for r in found.collect()]
        assert sorted(got) == sorted(wanted)


def test_long_spans_are_cut(spark):
    passage = " ".join(f"p{n}" for n in range(40))
    docs = spark.createDataFrame([(1, f"Before, {passage}! After."), (2, "p1 p2 Before"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    found = {r.doc_id: r.text for r in without_spans(benchmark_hits(docs, items)).collect()}
    assert found == {1: "Before, ! After.", 2: "p1 p2 Before", 3: None}


def test_empty_tables_and_clashing_columns(spark, documents, no_documents, corpus):
    _, table = benchmark(spark, corpus)
    assert benchmark_hits(no_documents, table).count() == 0
    found = benchmark_hits(documents.withColumn("hits", F.lit("old")), table.limit(0))
    assert found.where("n_hit = 0 and size(items) = 0 and size(hits) = 0 and source like 'src%'").count() == documents.count()
