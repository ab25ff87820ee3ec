"""Running values over ordered rows of a group, however many rows a group has.

An associative scan in levels: rows are sorted over the cluster and numbered, every ``fanout`` consecutive numbers are a
block, blocks are composed into one row each, and so on until a group is one row (up-sweep); then every block learns what
comes before it, and tells its items (down-sweep). Every shuffle is keyed by group and block, so no task or row holds more
than ``fanout`` items of a group.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .arrays import running_state

FANOUT = 1024


def exclusive_scan(items: DataFrame, keys: list[str], order: str, value: str, compose: Callable[[Column, Column], Column],
                   start: Column, entry_type: str, advance: Callable[[Column, Column], Column] | None = None,
                   fanout: int | None = None) -> DataFrame:
    """(keys, order, entry): for each item, ``start`` advanced over the values of the items before it in its group.

    ``compose`` joins the values of two neighbouring stretches and is associative; ``advance`` moves an entry over a
    value, ``compose`` if not given. Keys and order name an item.
    """
    fanout, advance = fanout or FANOUT, advance or compose
    spark, sort = items.sparkSession, [*keys, order]
    # the range partitioning reads its input twice, first for the bounds
    items = store(items.select(*sort, F.col(value).alias("_v")), f"scan/{uuid.uuid4().hex}")
    ranged = items.repartitionByRange(*sort).sortWithinPartitions(*sort)
    numbered = store(ranged.withColumns({"_pid": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), f"scan/{uuid.uuid4().hex}")
    numbered = numbered.withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
    partitions, rows = numbered.agg(F.max("_pid") + 1, F.max("_row") + 1).first()
    if not rows:
        return spark.createDataFrame([], numbered.select(*sort, start.cast(entry_type).alias("entry")).schema)
    numbered = numbered.withColumn("_at", F.col("_pid").cast("bigint") * rows + F.col("_row"))

    def before(values: Column, initial: Column) -> Column:
        """The entry of each value of a block: the running state, shifted by one."""
        after = running_state(values, initial, advance, entry_type)
        return F.concat(F.array(initial.cast(entry_type)), F.slice(after, F.lit(1), F.greatest(F.size(after) - 1, F.lit(0))))

    sweeps, level, left = [], numbered.select(*keys, "_at", "_v"), partitions * rows
    while not sweeps or left > 1:
        blocks = (level.groupBy(*keys, F.floor(F.col("_at") / fanout).alias("_blk"))
                  .agg(F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("items")))
        sweeps.append(blocks)
        values = F.col("items._v")
        composed = F.aggregate(F.slice(values, F.lit(2), F.size(values) - 1), F.get(values, F.lit(0)), compose)
        level, left = blocks.select(*keys, F.col("_blk").alias("_at"), composed.alias("_v")), -(-left // fanout)
    entry = level.select(*keys, "_at", start.cast(entry_type).alias("entry"))
    for blocks in reversed(sweeps):
        told = blocks.join(entry.withColumnRenamed("_at", "_blk"), [*keys, "_blk"])
        entry = told.select(*keys, F.inline(F.arrays_zip(F.col("items._at").alias("_at"), before(F.col("items._v"), F.col("entry")).alias("entry"))))
    return numbered.select(*sort, "_at").join(entry, [*keys, "_at"]).select(*sort, "entry")
