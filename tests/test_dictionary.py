from pyspark.sql import functions as F

from clickmart.operators import dictionary as D


def test_flatten_and_profile_of_declared_records(spark):
    rows = spark.createDataFrame(
        [(1, ("x", None), [1], True), (2, ("", 2.5), None, None), (None, None, None, None), (4, ("x" * 300, 1.0), None, None)],
        "a INT, b STRUCT<c: STRING, d: DOUBLE>, l ARRAY<INT>, t BOOLEAN",
    )
    assert D.flatten(rows).columns == ["a", "b.c", "b.d", "l", "t"]
    found = {r.field_name: r for r in D.profile(rows).collect()}
    assert (found["a"].data_type, found["a"].observed_types, found["a"].non_null_count) == ("integer", "integer,null", 3)
    assert found["a"].sample_values == "1 | 2 | 4" and found["a"].null_pct == 25.0
    assert (found["b.c"].data_type, found["b.c"].non_null_count, found["b.c"].example) == ("string", 2, "x")
    assert found["b.c"].sample_values == "x | " + "x" * 200
    assert (found["b.d"].data_type, found["b.d"].observed_types) == ("float", "float,null")
    assert (found["l"].data_type, found["l"].example, found["t"].example) == ("null", "[1]", "true")
    assert D.profile(rows, sample_size=1).filter("field_name = 'a'").first().sample_values == "1"


def variants(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "t STRING").select(F.parse_json("t").alias("v"))


DOCUMENTS = (
    '{"a":1,"b":{"c":"x","d":null},"l":[1]}', '{"a":"s","b":{"c":""}}', '{"a":2.5,"b":5,"t":true,"e":{}}',
)


def test_profile_of_undeclared_records(spark):
    found = {r.field_name: r for r in D.profile_variants(variants(spark, *DOCUMENTS), "v").collect()}
    assert set(found) == {"a", "b", "b.c", "b.d", "l", "t"}
    assert (found["a"].observed_types, found["a"].non_null_count, found["a"].data_type) == ("float,integer,string", 3, "float")
    assert (found["b"].data_type, found["b"].non_null_count) == ("integer", 1)
    assert (found["b.c"].non_null_count, found["b.c"].null_pct) == (1, 66.67)
    assert (found["b.d"].data_type, found["b.d"].non_null_count) == ("null", 0)
    assert (found["l"].data_type, found["t"].data_type) == ("array", "boolean")
    assert found["a"].sample_values == "1 | 2.5 | s"


def test_any_depth(spark):
    text = '{"a":' * 11 + "7" + "}" * 11
    rows = variants(spark, text, '{"b":{}}', "{}")
    assert [tuple(r)[:3] for r in D.variant_cells(rows, "v").collect()] == [(".".join("a" * 11), "integer", "7")]
    found = D.profile_variants(rows, "v").collect()
    assert [(r.field_name, r.non_null_count, r.null_pct) for r in found] == [(".".join("a" * 11), 1, 66.67)]


def test_fields_come_in_order(spark):
    rows = variants(spark, '{"b":1,"c":{"z":1,"a":2},"a":3}')
    assert [r.field_name for r in D.profile_variants(rows, "v").collect()] == ["a", "b", "c.a", "c.z"]


def test_variant_column_of_declared_records(spark):
    rows = variants(spark, "true", '"x"', "null")
    assert {(r.value_type, r["values"], r.filled) for r in D.field_types(rows).collect()} == {
        ("boolean", 1, 1), ("string", 1, 1), ("null", 1, 0),
    }


def test_leaves_of_odd_records(spark):
    rows = variants(spark, '{"l":[{"a":1},2,[]],"n":null,"e":{},"f":{"e":{}}}', "[1,2]", "7", "null", '{"l":[],"x":{"y":{"z":{"l":[0]}}}}', "{}")
    found = sorted(tuple(row) for row in D.variant_cells(rows, "v").collect())
    assert [row[:2] for row in found] == [("l", "array"), ("l", "array"), ("n", "null"), ("x.y.z.l", "array")]


def test_samples_same_as_sorted_texts(spark, monkeypatch):
    """Few buckets, so that small texts hide behind smaller ones; more samples than texts; text that is blank."""
    monkeypatch.setattr(D, "SAMPLE_BUCKETS", 1)
    texts = [f"t{n * 7919 % 1000:04}" for n in range(1_500)]
    rows = variants(spark, *[f'{{"a":"{t}","b":{{"c":"{t[-1]}"}},"d":" "}}' for t in texts]).repartition(5)
    for size in (1, 3, 30):
        found = {r.field_name: r for r in D.profile_variants(rows, "v", size).collect()}
        assert found["a"].sample_values == " | ".join(sorted(set(texts))[:size])
        assert found["b.c"].sample_values == " | ".join(sorted({t[-1] for t in texts})[:size])
        assert (found["d"].sample_values, found["d"].non_null_count, found["a"].non_null_count) == ("", 0, 1_500)
