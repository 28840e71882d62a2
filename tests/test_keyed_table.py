import json
import random

import pytest

from pyspark.sql import functions as F

from clickmart.sources.keyed_table import KeyedTable

SCHEMA = "key STRING, n BIGINT, note STRING"


def rows_of(table, version=None):
    found = table.read(version)
    return {} if found is None else {row.key: (row.n, row.note) for row in found.collect()}


@pytest.mark.parametrize(("splits", "most_layers"), [(1, 1), (4, 2), (16, 8)])
def test_same_as_a_dict(spark, tmp_path, splits, most_layers):
    table = KeyedTable(spark, tmp_path / "t", "key", splits, most_layers)
    assert table.read() is None
    draw, wanted = random.Random(splits), {}
    for batch_id in range(7):
        rows = [(f"k{draw.randint(0, 60)}", batch_id * 100 + n, draw.choice([None, "a", "é"])) for n in range(draw.choice([0, 1, 5, 80]))]
        for key, n, note in rows:
            if key not in wanted or (n, note) > wanted[key]:
                wanted[key] = n, note
        batch = spark.createDataFrame([*rows, (None, 1, "no key"), ("", 2, "no key")], SCHEMA).repartition(3)
        table.merge(batch, batch_id)
        assert rows_of(table) == wanted
        assert table.merge(batch.withColumn("n", F.lit(10**6)), batch_id) == 0
        assert rows_of(table) == wanted
    assert rows_of(KeyedTable(spark, tmp_path / "t", "key")) == wanted  # what the table is made of stands in it


def test_writes_follow_the_batch(spark, tmp_path):
    table = KeyedTable(spark, tmp_path / "t", "key", splits=8, most_layers=4)
    first = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("n"), F.lit("x").alias("note"))
    assert table.merge(first) == 20_000
    written = [table.merge(spark.createDataFrame([(f"k{n % 3}", -n, "new")], SCHEMA)) for n in range(8, 18)]
    assert 10 <= sum(written) <= 20  # the base stays as it is, its later layers become one now and then
    assert max(map(len, table.manifest()["layers"].values())) <= 4
    found = rows_of(table)
    assert len(found) == 20_000 and found["k2"] == (-17, "new") and found["k17"] == (17, "x")


def test_layers_are_merged_and_files_cleaned(spark, tmp_path):
    table = KeyedTable(spark, tmp_path / "t", "key", splits=2, most_layers=2, keep_versions=1)
    for n in range(9):
        table.merge(spark.createDataFrame([(f"k{place}", n, None) for place in range(40)], SCHEMA))
    manifest = table.manifest()
    assert max(map(len, manifest["layers"].values())) <= 2
    named = {layer["version"] for each in manifest["layers"].values() for layer in each}
    assert {int(folder.name) for folder in (tmp_path / "t" / "data").iterdir()} == named
    assert len(table.versions()) == 1
    assert rows_of(table) == {f"k{place}": (8, None) for place in range(40)}


def test_readers_see_whole_batches_only(spark, tmp_path):
    table = KeyedTable(spark, tmp_path / "t", "key", splits=3)
    table.merge(spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], SCHEMA), 0)
    before = table.read()
    version = table.manifest()["version"]

    class Lost(KeyedTable):
        def _publish(self, manifest):
            raise RuntimeError("writer lost")

    batch = spark.createDataFrame([("a", 2, "new"), ("c", 2, "new")], SCHEMA)
    with pytest.raises(RuntimeError, match="writer lost"):
        Lost(spark, tmp_path / "t", "key", splits=3).merge(batch, 1)
    assert rows_of(table) == {"a": (1, "old"), "b": (1, "old")}
    table.merge(batch, 1)
    assert rows_of(table) == {"a": (2, "new"), "b": (1, "old"), "c": (2, "new")}
    assert {row.key: row.n for row in before.collect()} == {"a": 1, "b": 1}  # a reader that began earlier goes on
    assert rows_of(table, version) == {"a": (1, "old"), "b": (1, "old")}


def test_other_columns_are_refused(spark, tmp_path):
    table = KeyedTable(spark, tmp_path / "t", "key")
    table.merge(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    with pytest.raises(ValueError, match="other columns"):
        table.merge(spark.createDataFrame([("a", 1)], "key STRING, n BIGINT"))


def test_manifest_is_plain_json(spark, tmp_path):
    table = KeyedTable(spark, tmp_path / "t", "key", splits=1)
    table.merge(spark.createDataFrame([("a", 1, "x")], SCHEMA), 5)
    (file,) = (tmp_path / "t" / "manifests").glob("*.json")
    found = json.loads(file.read_text())
    assert (found["version"], found["batch"], found["layers"]) == (1, 5, {"0": [{"version": 1, "rows": 1}]})
