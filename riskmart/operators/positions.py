"""Positions of ordered rows without a one-task window.

Rows are range-partitioned by the order's columns and sorted within their partitions, and
written once with the number of their partition and their number in it.  The counts of the
partitions (one small row each) give every partition's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.sources.tables import LayerStore

_LOCAL = (1 << 33) - 1            # monotonically_increasing_id: partition above, row below these bits


def with_position(df: DataFrame, order: list[Column], store: LayerStore, name: str,
                  column: str = "position") -> DataFrame:
    """``df`` with its rows' places (from 1) in ``order``, which must tell all rows apart.

    The sorted rows are written as table ``name`` of ``store``, so that counting and reading
    see the same partitions whatever happens to executors in between.
    """
    part, place = f"{column}__part", f"{column}__place"
    mark = F.monotonically_increasing_id()
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumns({part: F.shiftright(mark, 33), place: mark.bitwiseAND(F.lit(_LOCAL))}))
    written = store.write(name, ranged)
    # one row for each partition: bounded by the number of shuffle partitions
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (written.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
               .select(part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")))
    return (written.join(F.broadcast(offsets), part)
            .withColumn(column, F.col(place) + F.col("offset") + 1)
            .drop(part, place, "offset"))
