"""Samples with an exact number of rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmart.operators.ranking import first_rows
from clickmart.session import stored

_SPLITS = 1 << 20
# Size of the quantile sketch; its error in rank is below SKETCH_ERROR of the rows with near certainty.
SKETCH_SIZE = 4096
SKETCH_ERROR = 0.002


def _cut(keys, n):
    """The ``n``-th smallest key, how many rows of that key are among the first ``n``, and how many it has.

    ``keys`` has BIGINT ``_key``, no nulls, a number of rows ``_rows`` for each, and more than ``n`` rows in all. Counts per key
    prefix, at most 2^20 of them, show in which prefix the row lies; that prefix is split again until it is one key.
    """
    low, high = keys.agg(F.min("_key"), F.max("_key")).first()
    shift = 0
    while (high >> shift) - (low >> shift) >= _SPLITS:
        shift += 1
    while True:
        prefix = F.shiftright("_key", shift)
        counts = keys.groupBy(prefix.alias("_prefix")).agg(F.sum("_rows").alias("_rows"))
        upto = F.sum("_rows").over(Window.orderBy("_prefix"))
        cut, rows, reached = (
            counts.withColumn("_upto", upto).filter(F.col("_upto") >= n).orderBy("_prefix").first()
        )
        n -= reached - rows
        if shift == 0:
            return cut, n, rows
        keys = keys.filter(prefix == F.lit(cut).cast("bigint"))
        shift = max(0, shift - 20)


def _cut_of(df, key, n, found):
    """``_cut`` of a column in one more look at the input.

    The quantile sketch of the first look bounds the key from both sides. Rows are counted by key between the bounds and in
    one row below them, and stored; the cut is made there. Should the bounds have missed it, all keys are counted.
    """
    column = F.col(key)
    reach = found["filled"] * SKETCH_ERROR + 1
    low, high = (min(max((n + side * reach) / found["filled"], 0.0), 1.0) for side in (-1, 1))
    sketch = F.unhex(F.lit(bytes(found["sketch"]).hex()))
    quantiles = [F.kll_sketch_get_quantile_bigint(sketch, F.lit(share)) for share in (low, high)]
    low, high = df.sparkSession.range(1).select(*quantiles).first()
    for lower, upper in ((low, high), (None, None)):
        rest = df.filter(column.isNotNull())
        if upper is not None:
            rest = rest.filter(column <= upper)
        shown = F.when(column >= lower, column) if lower is not None else column
        counts = stored(rest.groupBy(shown.alias("_key")).agg(F.count(F.lit(1)).alias("_rows")), "keys")
        below, within = counts.agg(
            F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_rows"))), F.lit(0)),
        ).first()
        if below < n <= below + within:
            return _cut(counts.filter("_key IS NOT NULL"), n - below)
    raise ValueError("the input changed while it was read")


def smallest_rows(df, key, n, ties=()):
    """Exactly the ``n`` rows with the smallest value of a BIGINT column, null keys last; all of fewer rows.

    Two looks at the key column: the first counts and sketches it, the second counts the rows near the n-th key. Rows below
    that key are a filter; of the rows with that very key some are taken in the order of ``ties`` and then of all other
    columns. When the key decides, nothing is sorted or shuffled; many equal keys are sorted by range over many tasks, so no
    task ever holds all of them.
    """
    column = F.col(key)
    sketch = F.kll_sketch_agg_bigint(column.cast("bigint"), SKETCH_SIZE)
    sums = df.agg(F.count(F.lit(1)).alias("total"), F.count(column).alias("filled"), sketch.alias("sketch"))
    found = sums.first()
    total, filled = found["total"], found["filled"]
    if total <= n:
        return df
    if n <= 0:
        return df.limit(0)
    if filled <= n:
        below, edge, left, rows = df.filter(column.isNotNull()), df.filter(column.isNull()), n - filled, total - filled
    else:
        cut, left, rows = _cut_of(df, key, n, found)
        cut = F.lit(cut).cast("bigint")
        below, edge = df.filter(column < cut), df.filter(column == cut)
    if left == 0:
        return below
    if left == rows:
        return below.unionAll(edge)
    return below.unionAll(_some_of(edge, left, ties))


def _some_of(edge, n, ties):
    """``n`` of rows with equal keys: the first in a total order, numbered by a sort over many tasks."""
    plain = [name for name, kind in edge.dtypes if not kind.startswith(("map", "variant")) and "variant" not in kind]
    return first_rows(edge, n, [*ties, *[name for name in plain if name not in ties]])


def hash_key(column, seed):
    """A BIGINT that puts rows in a random but repeatable order."""
    digest = F.md5(F.concat(F.coalesce(column.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sample(df, n, key, mode="random", seed=0):
    """``n`` rows: at random by a hash of a key, or the first by a BIGINT key.

    Rows with a null key can be sampled too: they come last by key, and by chance like others with one hash.
    """
    if mode == "first":
        return smallest_rows(df, key, n)
    if mode == "random":
        hashed = df.withColumn("_hash", hash_key(F.col(key), seed))
        return smallest_rows(hashed, "_hash", n, ties=(key,)).drop("_hash")
    raise ValueError("mode must be 'random' or 'first'")
