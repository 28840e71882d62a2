"""Point in range lookup without a pair-wise comparison."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickmart.operators.ranking import running
from clickmart.session import stored


def innermost(ranges, name="range"):
    """Where the innermost of nested ranges changes: ``_at``, ``_kind``, ``_spread``, ``_range``.

    From a mark of kind 0 on, ``_at`` included, and behind a mark of kind 2, positions have the range of the mark, until the
    next one; of marks with equal ``_at`` and ``_kind`` the one with the largest ``_spread`` counts. ``_range`` has the range's
    end and its fields, which are null where no range is open.

    Ranges may lie in one another to any depth. Of equal ranges the one with the greatest fields counts; ranges with a null
    end, or that end before they start, are left out. Two ranges that cross (each has positions that the other lacks, and
    they share some) are an error.

    A sweep over starts and ends: the number of open ranges is a running sum, and while ranges nest, the innermost open
    one is the last that started at the present number. The same look tells whether the range that ends is the innermost.
    """
    fields = [field for field in ranges.columns if field not in ("ip_from", "ip_to")]
    item = F.struct(F.col("ip_to").alias("_to"), F.struct(*fields).alias(name)).alias("_range")
    edges = F.array(
        F.struct(F.col("ip_from").alias("_at"), F.lit(0).alias("_kind"), F.lit(1).alias("_step")),
        F.struct(F.col("ip_to").alias("_at"), F.lit(2).alias("_kind"), F.lit(-1).alias("_step")),
    )
    events = ranges.where("ip_from <= ip_to").select(F.explode(edges).alias("_edge"), item).select("_edge.*", "_range")
    # Of ranges with one start the longest comes first.
    order = ["_at", "_kind", F.desc("_range._to"), "_range"]
    events = running(events, [], order, F.col("_step"), "sum", "_open", "_spread")

    starts = F.col("_kind") == 0
    looks = F.when(starts, F.array("_open")).otherwise(F.array("_open", F.col("_open") + 1))
    events = events.withColumn("_level", F.explode(looks))
    events = running(events, ["_level"], ["_at", "_kind"], F.when(starts, F.col("_range")), "last", "_inner", "_line")

    ends = F.col("_level") > F.col("_open")
    text = F.concat(F.lit("ranges cross: one ends at "), F.col("_at"), F.lit(" inside one that ends at "), F.col("_inner._to"))
    crossed = ends & (F.col("_inner._to") != F.col("_at"))
    marks = events.where(F.when(crossed, F.raise_error(text).cast("boolean")).otherwise(~ends))
    closed = F.struct(F.col("_at").alias("_to"), F.lit(None).cast(events.schema["_range"].dataType[name].dataType).alias(name))
    return marks.select("_at", "_kind", "_spread", F.coalesce("_inner", closed).alias("_range"))


def attach_ranges(points, ranges, position, name="range", nested=False):
    """Adds to each point the range that ``position`` falls into, as a struct, or null.

    ``ranges`` has ``ip_from`` and ``ip_to`` (inclusive) of the type of ``position``: BIGINT numbers of IPv4, or 32 hex
    digits of IPv6. Ranges must not overlap, or with ``nested`` may lie in one another, and the innermost counts (see
    ``innermost``). Points without a position come back with null.

    Points and range starts are sorted together by range over all tasks and stored in that order. Inside a task each
    point takes the last range that started; where none has, it takes the last of the tasks before, which is one row per
    task. No range is repeated, and addresses that lie close together or repeat are cut over many tasks like any others.
    """
    if nested:
        starts = innermost(ranges, name)
    else:
        fields = [field for field in ranges.columns if field not in ("ip_from", "ip_to")]
        starts = ranges.select(
            F.col("ip_from").alias("_at"),
            F.lit(0).alias("_kind"),
            F.lit(0).cast("bigint").alias("_spread"),
            F.struct(F.col("ip_to").alias("_to"), F.struct(*fields).alias(name)).alias("_range"),
        )
    # The spread cuts equal points, and those without a position, over tasks.
    spread = F.xxhash64(*points.columns)
    placed = points.select(
        position.alias("_at"), F.lit(1).alias("_kind"), spread.alias("_spread"), F.struct(*points.columns).alias("_point")
    )
    both = placed.unionByName(starts, allowMissingColumns=True).orderBy("_at", "_kind", "_spread")
    rows = stored(both.withColumn("_line", F.monotonically_increasing_id()), "placed")
    rows = rows.withColumn("_part", F.shiftright("_line", 33))

    last = F.max_by("_range", F.when(F.col("_kind") != 1, F.col("_line"))).alias("_carried")
    ends = rows.groupBy("_part").agg(last)
    # One row per sort task on both sides of this window and of the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_part", F.last("_carried", ignorenulls=True).over(before).alias("_carried"))
    here = Window.partitionBy("_part").orderBy("_line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_last", F.last("_range", ignorenulls=True).over(here)).filter("_kind = 1")
    found = found.join(F.broadcast(carried), "_part").withColumn("_last", F.coalesce("_last", "_carried"))
    return found.select("_point.*", F.when(F.col("_at") <= F.col("_last._to"), F.col(f"_last.{name}")).alias(name))
