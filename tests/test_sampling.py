import pytest
from pyspark.sql import functions as F

from clickmart.operators import ranking, sampling
from clickmart.plans import sampling as job


def test_exact_size_and_repeatable(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "key")
    one = {r.key for r in sampling.sample(rows, 777, "key", "random", 3).collect()}
    again = {r.key for r in sampling.sample(rows.repartition(5), 777, "key", "random", 3).collect()}
    other = {r.key for r in sampling.sample(rows, 777, "key", "random", 4).collect()}
    assert len(one) == 777 and one == again and one != other


def test_first(spark):
    rows = spark.range(-500, 20_000).withColumnRenamed("id", "key")
    assert {r.key for r in sampling.sample(rows, 600, "key", "first").collect()} == set(range(-500, 100))
    assert sampling.sample(rows, 10**9, "key", "first").count() == 20_500


def test_cut_is_refined(spark, monkeypatch):
    """Wide and clustered keys, one value repeated: the cut goes through several levels."""
    monkeypatch.setattr(sampling, "_SPLITS", 8)
    keys = [0] * 300 + list(range(1000, 1400)) + [2**62 + i for i in range(300)] + [-(2**62)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key BIGINT, n BIGINT")
    for n in (1, 150, 301, 302, 650, 900, 1001):
        found = sorted((r.key, r.n) for r in sampling.smallest_rows(rows, "key", n, ties=("n",)).collect())
        assert found == sorted((k, i) for i, k in enumerate(keys))[:n]


def test_null_keys_come_last_and_count(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "key BIGINT, n STRING")
    for mode in ("first", "random"):
        assert sampling.sample(rows, 10, "key", mode).count() == 3
        assert sampling.sample(rows, 2, "key", mode).count() == 2
    assert {r.n for r in sampling.smallest_rows(rows, "key", 2).collect()} == {"a", "b"}
    assert sampling.smallest_rows(rows, "key", 0).count() == 0


def test_equal_keys_are_taken_in_a_total_order(spark):
    rows = spark.createDataFrame([(7, f"n{i:03}") for i in range(100)], "key BIGINT, n STRING").repartition(4)
    assert sorted(r.n for r in sampling.smallest_rows(rows, "key", 30).collect()) == [f"n{i:03}" for i in range(30)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode must be"):
        sampling.sample(spark.range(3), 1, "id", "middle")


def test_job_replaces_or_adds(spark):
    rows = spark.range(100).select(F.col("id").alias("key"))
    assert job.run(rows, "sampled", "key", size=10) == 10
    assert job.run(rows, "sampled", "key", size=10, seed=1) == 10
    assert spark.table("sampled").count() == 10
    job.run(rows, "sampled", "key", size=5, mode="first", keep_target=True)
    assert spark.table("sampled").count() == 15


@pytest.mark.parametrize("heap", [0, 10_000])
def test_first_rows_at_every_cut(spark, monkeypatch, heap):
    """Null keys first, one key for most rows, and ranges that are cut again and again."""
    monkeypatch.setattr(ranking, "HEAP_ROWS", heap)
    monkeypatch.setattr(ranking, "_SPLITTERS", 4)
    monkeypatch.setattr(ranking, "_SORTED_AT_ONCE", 5)
    rows = [(None, 1), (None, 2)] + [("hot", n) for n in range(200)] + [(f"k{n % 90:03}", n) for n in range(300)]
    table = spark.createDataFrame(rows, "key STRING, n BIGINT").repartition(3)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for n in (1, 2, 3, 150, 202, 203, 377, 501, 502, 900):
        found = sorted(((r.key, r.n) for r in ranking.first_rows(table, n, ["key", "n"]).collect()), key=order.index)
        assert found == order[:n]
    assert [r.key for r in ranking.first_rows(table, 50, ["key"]).filter("key = 'hot'").collect()] == ["hot"] * 48
    assert ranking.first_rows(table.limit(0), 3, ["key"]).count() == 0


@pytest.mark.parametrize("error", [0.0, 0.002, 1.0])
def test_sketch_only_bounds_the_cut(spark, monkeypatch, error):
    """Whatever the bounds say, the rows are exact: a sketch that is far off, keys that cluster, most rows of one key."""
    monkeypatch.setattr(sampling, "SKETCH_SIZE", 8)
    monkeypatch.setattr(sampling, "SKETCH_ERROR", error)
    keys = [n * n * (-1) ** n for n in range(4_000)] + [777] * 3_000 + [2**62, -(2**62)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key BIGINT, n BIGINT").repartition(6)
    for n in (1, 1_999, 2_500, 5_100, 7_001):
        found = sorted((r.key, r.n) for r in sampling.smallest_rows(rows, "key", n, ties=("n",)).collect())
        assert found == sorted((k, i) for i, k in enumerate(keys))[:n]


def test_few_rows_are_a_heap_in_each_task(spark):
    plan = ranking.first_rows(spark.range(10_000), 20, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
