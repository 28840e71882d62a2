from pyspark.sql import functions as F

from clickmart.functions.text import WHITESPACE, clean_text, collapse_spaces, first_filled, percentage


def test_clean_text(spark):
    cases = [
        ("  P1 ", "P1"), (" P1　", "P1"), ("\x1cP1\x85", "P1"), ("", None), ("   ", None),
        (" NaN ", None), ("None", None), ("NULL", None), ("nullx", "nullx"), ("x y", "x y"), (None, None),
    ]
    rows = spark.createDataFrame(cases, "given STRING, wanted STRING").withColumn("got", clean_text(F.col("given")))
    for row in rows.collect():
        assert row["got"] == row["wanted"], row


def test_whitespace_is_what_python_strips():
    assert all(char.isspace() for char in WHITESPACE)
    assert set(WHITESPACE) == {chr(code) for code in range(0x3001) if chr(code).isspace()}


def test_collapse_and_first_filled(spark):
    row = (
        spark.createDataFrame([(" a \n b c ", "", None, "z")], "t STRING, a STRING, b STRING, c STRING")
        .select(
            collapse_spaces(F.col("t")).alias("t"),
            first_filled(F.col("a"), F.col("b"), F.col("c")).alias("first"),
            collapse_spaces(F.lit(" \t")).alias("blank"),
        )
        .first()
    )
    assert (row["t"], row["first"], row["blank"]) == ("a b c", "z", None)


def test_percentage(spark):
    rows = spark.createDataFrame([(1, 3), (5, 0), (2, 2)], "part BIGINT, whole BIGINT")
    assert [r[0] for r in rows.select(percentage(F.col("part"), F.col("whole"))).collect()] == [33.33, 0.0, 100.0]
