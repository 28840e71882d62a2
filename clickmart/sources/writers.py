"""Sinks."""

import json
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T


# The writer would trim values unless told otherwise.
CSV_OPTIONS = {
    "header": "true",
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _flat(df):
    """CSV has no nested values: they are written as JSON text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.VariantType):
            column = column.try_cast("string").alias(field.name)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            column = F.to_json(column).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def write_csv(df, path, fields=None, mode="overwrite"):
    """Header, columns in the order of ``fields``, nothing written for null or empty text."""
    rows = _flat(df.select(*fields) if fields else df)
    rows.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_jsonl(df, path, fields=None, mode="overwrite"):
    """One object per line; keys with null stay."""
    rows = df.select(*fields) if fields else df
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


WRITERS = {"csv": write_csv, "jsonl": write_jsonl}


def writer_for(fmt, what="output"):
    if fmt not in WRITERS:
        raise ValueError(f"Unsupported {what} format: {fmt}")
    return WRITERS[fmt]


def write_table(df, table, keep=False):
    """Replace the table, or add to it with ``keep``."""
    df.write.mode("append" if keep else "overwrite").saveAsTable(table)


def finish_summary(spark, summary, started, path):
    """Adds the elapsed time to the counts of a run and writes them where a path is given."""
    summary["elapsed_seconds"] = round(time.monotonic() - started, 3)
    if path:
        line = json.dumps(summary, default=str, ensure_ascii=False)
        spark.createDataFrame([(line,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
    return summary
