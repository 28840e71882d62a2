"""File and table scans."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.schemas import EVENTS, as_strings

BAD_LINE = "_corrupt_record"

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


def read_events(spark, path, fmt="parquet", schema=EVENTS):
    """Raw events. ``schema=None`` takes the schema stored in the files."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv(spark, path, schema):
    """CSV with a header; every column is text. Quoted values may hold quotes and line ends."""
    return spark.read.schema(as_strings(schema)).options(**CSV_OPTIONS).csv(path)


def read_jsonl(spark, path, schema):
    return spark.read.schema(schema).json(path)


def read_rows(spark, path, schema):
    """JSON lines by the ``.jsonl`` suffix, CSV otherwise."""
    if str(path).lower().rstrip("/").endswith(".jsonl"):
        return read_jsonl(spark, path, schema)
    return read_csv(spark, path, schema)


# Stands behind a line when it is read as the first element of an array: text after the object shows as a wrong element.
_LINE_END = "\\u0001line end"


def _lines(spark, path):
    """(value, file, block, at): the lines of text files with their place among the rows of a task."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def _is_object(line):
    """Whether a line is one JSON object and nothing else. Types of its fields do not matter, keys may repeat."""
    parsed = F.try_parse_json(F.concat(F.lit("["), line, F.lit(f',"{_LINE_END}"]')))
    closed = F.try_variant_get(parsed, "$[1]", "string") == "\u0001line end"
    return F.coalesce(closed & F.schema_of_variant(F.try_variant_get(parsed, "$[0]", "variant")).startswith("OBJECT"), F.lit(False))


def bad_lines(spark, path):
    """(file, line, value): the lines of JSON-lines files that are no object, with their numbers from 1; blank lines are none.

    A file may be cut into blocks that many tasks read. Each block counts its lines, sums over the blocks before it give the
    number of its first line, and only bad lines are numbered.
    """
    lines = _lines(spark, path)
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("lines").over(before), F.lit(0))).drop("lines")
    bad = lines.filter(F.col("value").rlike(r"\S") & ~_is_object(F.col("value")))
    number = F.col("before") + F.col("at") - F.col("first") + 1
    return bad.join(blocks, ["file", "block"]).select("file", number.alias("line"), "value")


class BadLine(ValueError):
    """A line of JSON-lines files that is no object: ``file`` and ``line``, counted from 1."""

    def __init__(self, file, line, value):
        super().__init__(f"{file}, line {line}: no JSON object: {value[:80]!r}")
        self.file, self.line = file, line


def read_jsonl_strict(spark, path, schema):
    """JSON lines where every line has to be an object: the first one that is not raises ``BadLine`` with file and number.

    All lines are checked when the function is called, which only looks for their ends and brackets. Fields with a value of
    another type than ``schema`` has are null.
    """
    first = bad_lines(spark, path).orderBy("file", "line").limit(1).first()
    if first:
        raise BadLine(*first)
    return read_jsonl(spark, path, schema)


def read_jsonl_tolerant(spark, path, schema):
    """JSON lines with one more column that holds the text of a line that could not be read."""
    with_bad = T.StructType(schema.fields + [T.StructField(BAD_LINE, T.StringType())])
    return (
        spark.read.schema(with_bad)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .json(path)
    )


def with_file_order(df, name="seq"):
    """Adds a sortable struct that follows the order of lines over all files of a file scan."""
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ),
    )


def read_target_ids(spark, path, field="product_id"):
    """Distinct trimmed product ids of a target file."""
    from clickmart.functions.text import strip

    one_field = T.StructType([T.StructField(field, T.StringType())])
    if str(path).lower().rstrip("/").endswith(".jsonl"):
        rows = read_jsonl(spark, path, one_field)
    else:
        rows = spark.read.options(**CSV_OPTIONS).csv(path)
    ids = rows.select(strip(F.col(field)).alias("product_id"))
    return ids.filter(F.col("product_id") != "").distinct()
