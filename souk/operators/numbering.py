"""Global surrogate keys without a single-partition sort.

``ROW_NUMBER() OVER (ORDER BY k)`` with no partition moves every row into one
task.  ``global_row_number`` computes the same numbers distributively:

1. range-partition on the order key and sort inside each partition;
2. number rows inside their partition (``monotonically_increasing_id`` keeps
   the partition-local position in its low 33 bits);
3. count rows per partition — one small row per partition — turn the counts
   into offsets with a running sum and broadcast them (size bounded by the
   partition count, not by the data);
4. number = offset + local position + 1.

The order key must be total (append a unique tiebreak) so the numbering is
deterministic.  Steps 2 and 3 must see the *same* partitioning, but range
bounds are sampled from the input, whose row order after a shuffle is not
fixed — two evaluations could split differently.  The tagged rows are
therefore checkpointed once (reliable checkpoint in the session's shared
``spark.checkpoint.dir``) and both steps read that copy; it also survives a
lost executor without recomputation.

``small_row_number`` is for inputs whose size a rule set bounds (a handful
of labels); there the plain window is cheaper than the extra stages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def global_row_number(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``partitions`` fixes the range partition count; by default AQE sizes it
    from the data (the ids are read back from the checkpoint, so whatever
    partitioning AQE settles on is the one both passes see)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    tagged = (ranged
              .sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)))
              .checkpoint(eager=True))
    offsets = (tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
               .withColumn("_off", F.coalesce(
                   F.sum("_cnt").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0))))
    return (tagged.join(F.broadcast(offsets.select("_part", "_off")), "_part")
            .withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("bigint"))
            .drop("_part", "_pos", "_off"))


def small_row_number(df: DataFrame, order: Sequence[Column], name: str, dense: bool = False) -> DataFrame:
    """Plain global window; only for inputs bounded by a fixed rule set."""
    fn = F.dense_rank() if dense else F.row_number()
    return df.withColumn(name, fn.over(Window.orderBy(*order)).cast("bigint"))
