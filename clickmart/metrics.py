"""Row counts taken while a job writes, without a pass of their own."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from clickmart.sources.keyed_table import KeyedTable


def counted(df, name, **more):
    """The same rows, and an observation that holds ``rows`` once they were written.

    ``more`` adds further named aggregate columns. Has to be the last step before the write: a sort
    above it reads its input twice, and the counts with it.
    """
    observation = Observation(name)
    extra = [column.alias(label) for label, column in more.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra), observation


def rows_of(observation):
    """Counts of an observation after its action; an empty input leaves zeros."""
    return {name: value or 0 for name, value in observation.get.items()}


class BatchCounts:
    """Counts of the batches of a stream, stored under the number of the batch.

    A batch that is repeated after a loss keeps the counts it has, so sums over batches equal what the stream has written.
    """

    def __init__(self, spark, path):
        self.spark, self.table = spark, KeyedTable(spark, path, "batch", splits=1)

    def write(self, rows, batch_id, save, **more):
        """Writes the rows of a batch with ``save`` and stores how many there were, and the named counts of ``more``."""
        rows, observation = counted(rows, f"batch_{batch_id}", **more)
        save(rows)
        found = rows_of(observation)
        counts = [F.lit(int(found.get(name) or 0)).cast("bigint").alias(name) for name in ("rows", *more)]
        batch = F.lit(f"{batch_id}").alias("batch")
        self.table.merge(self.spark.range(1).select(batch, *counts), batch_id)

    def read(self):
        """One row per batch, or None before the first one."""
        found = self.table.read()
        return None if found is None else found.withColumn("batch", F.col("batch").cast("bigint"))
