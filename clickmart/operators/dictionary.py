"""Data dictionary: what fields a record set has, of which types, how filled, with sample values."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions.text import percentage, strip
from clickmart.session import stored

# Type names of the dictionary.
TYPE_NAMES = {
    "boolean": (T.BooleanType,),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "array": (T.ArrayType,),
    "object": (T.MapType,),
}

SAMPLE_LENGTH = 200


def leaf_fields(schema, path=()):
    """(path, type) of every field that is no struct, in order."""
    leaves = []
    for field in schema:
        here = path + (field.name,)
        if isinstance(field.dataType, T.StructType):
            leaves += leaf_fields(field.dataType, here)
        else:
            leaves.append((here, field.dataType))
    return leaves


def _leaf(path):
    return F.col(".".join(f"`{name}`" for name in path))


def flatten(df):
    """Nested structs as columns with dotted names; arrays stay whole."""
    return df.select(*[_leaf(path).alias(".".join(path)) for path, _ in leaf_fields(df.schema)])


def type_name(data_type):
    for name, kinds in TYPE_NAMES.items():
        if isinstance(data_type, kinds):
            return name
    return "string"


def value_type(value):
    """Type name of a VARIANT value."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", "null")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "integer")
        .when((kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL"), "float")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("string")
    )


def _leaf_text(path, data_type):
    column = _leaf(path)
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.try_cast("string")


def _filled(text, data_type=None):
    """Whether a value is more than white space, which only text can fail."""
    if data_type is not None and type_name(data_type) in ("integer", "float", "boolean"):
        return text.isNotNull()
    return strip(text) != ""


def _count_columns(place, path, data_type):
    """Aggregates per observed type: (type name, number of values, number of filled values)."""
    column, filled = _leaf(path), _filled(_leaf_text(path, data_type), data_type)
    if isinstance(data_type, T.VariantType):
        kind = F.coalesce(value_type(column), F.lit("null"))
        kinds = ["array", "boolean", "float", "integer", "null", "object", "string"]
        tests = [(name, kind == name) for name in kinds]
    else:
        tests = [(type_name(data_type), column.isNotNull()), ("null", column.isNull())]
    return [
        (
            name,
            F.count_if(test).alias(f"n{place}_{name}"),
            (F.lit(0).cast("bigint") if name == "null" else F.count_if(test & filled)).alias(f"f{place}_{name}"),
        )
        for name, test in tests
    ]


COUNTS = "field_name STRING, value_type STRING, values BIGINT, filled BIGINT"


def _count_rows(leaves, row):
    """The one row of counts, turned into one row per field and observed type."""
    rows = []
    for place, (path, data_type) in enumerate(leaves):
        for name, _, _ in _count_columns(place, path, data_type):
            if row[f"n{place}_{name}"]:
                rows.append((".".join(path), name, row[f"n{place}_{name}"], row[f"f{place}_{name}"]))
    return rows


def _all_counts(leaves):
    return [
        count
        for place, (path, data_type) in enumerate(leaves)
        for _, values, filled in _count_columns(place, path, data_type)
        for count in (values, filled)
    ]


def field_types(df):
    """Values per field and observed type, and how many of them hold more than white space.

    One aggregate over the table; what leaves it is one row, as wide as the schema.
    """
    leaves = leaf_fields(df.schema)
    row = df.agg(*_all_counts(leaves)).first()
    return df.sparkSession.createDataFrame(_count_rows(leaves, row), COUNTS)


def profile(df, sample_size=3):
    """The data dictionary of records with a declared schema.

    Sample values are the smallest distinct ones: each is the minimum above the one before, found by
    one more aggregate over the table, so no task ever holds the values of a field. Equal type
    counts go to the type first in the alphabet.
    """
    spark = df.sparkSession
    leaves = leaf_fields(df.schema)
    texts = [_leaf_text(path, data_type) for path, data_type in leaves]
    counts, total = None, 0
    last = [None] * len(leaves)
    samples = [[] for _ in leaves]
    for step in range(max(1, sample_size)):
        wanted = []
        for place, text in enumerate(texts):
            rest = _filled(text, leaves[place][1])
            if step:
                rest = rest & (text > F.lit(last[place]))
            wanted.append(F.min(F.when(rest, text)).alias(f"s{place}"))
        if step == 0:
            row = df.agg(F.count(F.lit(1)).alias("total"), *_all_counts(leaves), *wanted).first()
            counts, total = _count_rows(leaves, row), row["total"]
        else:
            row = df.agg(*wanted).first()
        for place in range(len(leaves)):
            last[place] = row[f"s{place}"]
            samples[place].append(last[place])
    names = ", ".join(f"s{step + 1} STRING" for step in range(max(1, sample_size)))
    found = [(".".join(path), *values) for (path, _), values in zip(leaves, samples)]
    return _report(
        spark.createDataFrame(counts, COUNTS),
        spark.createDataFrame(found, f"field_name STRING, {names}"),
        total,
        sample_size,
    )


def _report(counts, samples, total_records, sample_size):
    """Dictionary rows from type counts and sample values: a few rows per field."""
    fields = counts.groupBy("field_name").agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("values")).alias("rank"), F.col("value_type").alias("type")))
        ).alias("types"),
        F.sum("filled").alias("non_null_count"),
    )
    fields = fields.join(samples, "field_name", "left")
    texts = [F.left(F.col(f"s{step + 1}"), F.lit(SAMPLE_LENGTH)) for step in range(sample_size)]
    texts = texts or [F.lit(None).cast("string")]
    total = F.lit(total_records).cast("bigint")
    missing = F.greatest(total - F.col("non_null_count"), F.lit(0))
    type_names = F.transform("types", lambda entry: entry["type"])
    return fields.select(
        "field_name",
        F.col("types")[0]["type"].alias("data_type"),
        F.array_join(F.sort_array(type_names), ",").alias("observed_types"),
        "non_null_count",
        percentage(missing, total).alias("null_pct"),
        F.coalesce(texts[0], F.lit("")).alias("example"),
        F.concat_ws(" | ", *texts).alias("sample_values"),
    ).orderBy("field_name")


# Values of a field are dealt to so many buckets at least, whose least values bound the sample values of the field.
SAMPLE_BUCKETS = 256


# Levels that one step of the walk opens.
LEVELS = 4


def _opened(cells):
    """``cells`` (field_name, value, leaf) one level further down: values become their members, or leaves if they have none.

    An array is a leaf; it shows by elements without a name, of which the first stands for it.
    """
    spark = cells.sparkSession
    opened = cells.select("field_name", F.col("value").alias("object"), "leaf")
    opened = opened.lateralJoin(spark.tvf.variant_explode_outer(F.col("object").outer()))
    named, known = F.col("key").isNotNull(), F.col("object").isNull()
    return opened.filter(named | F.coalesce(F.col("pos") == 0, F.lit(True))).select(
        F.when(named, F.concat_ws(".", "field_name", "key")).otherwise(F.col("field_name")).alias("field_name"),
        F.when(named, F.col("value")).alias("value"),
        F.when(known, F.col("leaf")).when(~named, F.col("object")).alias("leaf"),
    )


def _step(cells):
    for _ in range(LEVELS):
        cells = _opened(cells)
    kind = F.coalesce(value_type(F.col("leaf")), F.lit("null"))
    typed = F.when(F.col("value").isNull(), kind)
    return cells.filter("field_name IS NOT NULL").select(
        "field_name", "value", typed.alias("value_type"), F.try_variant_get("leaf", "$", "string").alias("text")
    )


def variant_cells(records, column):
    """(field_name, value_type, text) of all leaves of VARIANT records, whose fields differ from row to row.

    A walk down the records: each step opens some levels of what the step before has left and stores the leaves beside the
    values that are still to be opened. Records are read once, every leaf is written once, and a deeper level only costs
    what is nested that deep. Empty objects and records that are no object have no leaves.
    """
    no_leaf = F.lit(None).cast("variant").alias("leaf")
    cells, leaves = records.select(F.lit(None).cast("string").alias("field_name"), F.col(column).alias("value"), no_leaf), None
    while True:
        cells = stored(_step(cells), "cells")
        here = cells.filter("value IS NULL AND value_type <> 'object'").select("field_name", "value_type", "text")
        leaves = here if leaves is None else leaves.unionAll(here)
        rest = cells.filter("value IS NOT NULL").select("field_name", "value", no_leaf)
        if rest.isEmpty():
            return leaves
        cells = rest


def _least_texts(rows, counts, size):
    """The ``size`` smallest distinct texts of each field, as columns s1, s2, ...

    ``counts`` has the least text of each bucket of each field. The ``size`` smallest of these are texts of the field, so
    the largest of them bounds the samples from above: a second look at the rows takes the few distinct texts up to it.
    """
    ordered = Window.partitionBy("field_name").orderBy("least")
    least = counts.filter("least IS NOT NULL").groupBy("field_name", "bucket").agg(F.min("least").alias("least"))
    ranked = least.withColumn("place", F.row_number().over(ordered)).filter(F.col("place") <= size)
    bounds = ranked.groupBy("field_name").agg(F.max("least").alias("bound"), F.max("place").alias("found"))
    # a field with fewer buckets than samples has few distinct texts; all of them are taken
    bounds = bounds.select("field_name", F.when(F.col("found") >= size, F.col("bound")).alias("bound"))
    texts = rows.join(bounds, "field_name").filter(F.col("bound").isNull() | (F.col("text") <= F.col("bound")))
    texts = texts.groupBy("field_name", "text").agg(F.lit(1).alias("one"))
    places = Window.partitionBy("field_name").orderBy("text")
    texts = texts.withColumn("place", F.row_number().over(places)).filter(F.col("place") <= size)
    samples = [F.min(F.when(F.col("place") == step, F.col("text"))).alias(f"s{step}") for step in range(1, size + 1)]
    return texts.groupBy("field_name").agg(*samples)


def profile_variants(records, column, sample_size=3):
    """The data dictionary of VARIANT records: one pass over the records, two over their stored leaves.

    The number of passes depends neither on the depth of the records nor on the number of samples. Fields are not known
    beforehand, so there may be many; whatever is kept for each is of bounded size and merged before it is moved.
    """
    rows = variant_cells(records, column)
    size = max(1, sample_size)
    filled = F.coalesce((F.col("value_type") != "null") & _filled(F.col("text")), F.lit(False))
    bucket = F.pmod(F.xxhash64("text"), F.lit(max(SAMPLE_BUCKETS, 64 * size)))
    counts = stored(
        rows.groupBy("field_name", "value_type", F.when(filled, bucket).alias("bucket")).agg(
            F.count(F.lit(1)).alias("values"),
            F.count_if(filled).alias("filled"),
            F.min(F.when(filled, F.col("text"))).alias("least"),
        ),
        "fields",
    )
    samples = _least_texts(rows.filter(filled).select("field_name", "text"), counts, size)
    totals = counts.groupBy("field_name", "value_type").agg(F.sum("values").alias("values"), F.sum("filled").alias("filled"))
    return _report(totals, samples, records.count(), sample_size)
