"""Ranks that hold up when one group has a large share of the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmart.session import stored


def best_per_group(df, group, order):
    """First row of each group.

    Spark keeps one row per group in every map task before the shuffle (WindowGroupLimit), so a
    hot group costs one row per task.
    """
    first = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")


def running_rank(df, group, order, name):
    """1, 2, 3, ... within each group, exact for groups of any size.

    One sort by range cuts a large group over many tasks, because the sort goes on inside the group.
    The sorted rows are stored with their position; each task then counts from the first row of the
    group it holds, and the few groups that began in an earlier task start from that offset.
    ``order`` has to be total, or equal rows rank in any order.
    """
    part, at = "_part", "_at"
    placed = df.orderBy(*group, *order).withColumn(at, F.monotonically_increasing_id())
    rows = stored(placed, "ranked").withColumn(part, F.shiftright(at, 33))

    pieces = rows.groupBy(*group, part).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieces.withColumn("_offset", F.sum("_rows").over(earlier))
        .filter(F.col("_offset").isNotNull())
        .drop("_rows")
    )
    here = Window.partitionBy(*group, part).orderBy(at)
    # At most one group per task began in an earlier task, so this side has no more rows than the
    # sort had tasks, whatever the size of the data.
    ranked = rows.withColumn("_here", F.row_number().over(here)).join(
        F.broadcast(offsets), [*group, part], "left"
    )
    rank = F.col("_here") + F.coalesce(F.col("_offset"), F.lit(0))
    return ranked.select(*df.columns, rank.cast("bigint").alias(name))


def running(df, group, order, value, how, name, line):
    """Running sum (``how`` "sum") or last value that is not null ("last") within each group, of any size.

    As in ``running_rank`` the rows are sorted over all tasks and stored, and each task goes on from what the group it
    begins with had in the tasks before. ``line`` names a new column that numbers the sorted rows upwards, not closely.
    """
    part = "_part"
    placed = df.withColumn("_value", value).orderBy(*group, *order).withColumn(line, F.monotonically_increasing_id())
    rows = stored(placed, "running").withColumn(part, F.shiftright(line, 33))
    if how == "sum":
        total, gather = F.sum("_value"), F.sum
    else:
        total = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(line)))
        gather = lambda column: F.last(column, ignorenulls=True)
    pieces = rows.groupBy(*group, part).agg(total.alias("_total"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # No more rows than the sort had tasks: at most one group of a task began in an earlier one.
    before = pieces.select(*group, part, gather("_total").over(earlier).alias("_before")).where("_before is not null")
    here = Window.partitionBy(*group, part).orderBy(line).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_here", gather("_value").over(here)).join(F.broadcast(before), [*group, part], "left")
    if how == "sum":
        result = F.col("_here") + F.coalesce("_before", F.lit(0))
    else:
        result = F.coalesce("_here", "_before")
    return found.select(*df.columns, line, result.alias(name))


_SPLITTERS = 32
_SORTED_AT_ONCE = 100_000
# Up to so many rows Spark's own limit on a sort is taken: every task keeps its first rows in a heap.
HEAP_ROWS = 10_000


def first_rows(df, n, order):
    """Exactly the first ``n`` rows in the order of columns; of rows that are equal in ``order`` any are taken.

    Few rows are a limit on a sort, one pass in which no task holds more than ``n`` rows of another. For more rows the keys
    are stored once and the last key is looked for in them: a few sampled keys cut the rest into ranges (each key is a range
    of its own), counts show in which range it lies, and that range is cut again until few keys are left to sort. The rows
    before the last key are then a filter on the input.
    """
    if not n:
        return df
    if n <= HEAP_ROWS:
        return df.orderBy(*order).limit(n)
    key = F.struct(*[F.col(f"_{place}") for place in range(len(order))])
    keys = stored(df.select(*[F.expr(c) if isinstance(c, str) else c for c in order]).toDF(*[f"_{p}" for p in range(len(order))]), "keys")
    last, left = _last_key(keys, key, n)
    if last is None:
        return df
    mine = F.struct(*[F.col(c).alias(f"_{p}") if isinstance(c, str) else c.alias(f"_{p}") for p, c in enumerate(order)])
    return df.filter(mine < last).unionAll(_any_rows(df.filter(mine == last), left))


def _literal(row, fields):
    return F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, fields)])


def _last_key(keys, key, n):
    """The ``n``-th key and how many rows of that key are among the first ``n``; None for no more than ``n`` keys."""
    rest, fields, left, first = keys, keys.schema, n, True
    while True:
        sample = rest.select(key.alias("key")).orderBy(F.xxhash64("key")).limit(_SPLITTERS).distinct().orderBy("key")
        splitters = [_literal(row["key"], fields) for row in sample.collect()]
        if not splitters:
            return None, 0
        # 2i is the range below splitter i, 2i + 1 the splitter itself
        place = F.lit(0)
        for splitter in splitters:
            place = place + (splitter <= key).cast("int") + (splitter < key).cast("int")
        counts = sorted(tuple(row) for row in rest.groupBy(place.alias("place")).count().collect())
        if first and sum(count for _, count in counts) <= n:
            return None, 0
        first = False
        for at, count in counts:
            if count >= left:
                break
            left -= count
        rest = rest.filter(place == at)
        if at % 2:
            return splitters[at // 2], left
        if count <= _SORTED_AT_ONCE:
            upto = rest.orderBy(key).limit(left)
            last = _literal(upto.agg(F.max(key)).first()[0], fields)
            return last, left - rest.filter(key < last).count()


def _any_rows(df, n):
    """Any ``n`` rows, numbered where they are stored instead of passed through one task."""
    at = "_at"
    rows = stored(df.withColumn(at, F.monotonically_increasing_id()), "ties").withColumn("_part", F.shiftright(at, 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per task on both sides of this window and of the broadcast.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(offsets), "_part").filter(place < n).select(*df.columns)
