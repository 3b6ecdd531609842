"""Random cycles over all rows: every row gets the value of the row that follows it in a random order.

The order is kept by ranges, so no task sees more than its range. A range's last row takes the first row of the next range
that holds its job, the last row of all the job's very first one. These heads are one row per range and job at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import written


def donors(rows: DataFrame, job: str, row_id: str, values: Sequence[str], seed: int) -> DataFrame:
    """``rows`` (job, id, values) as (job, id, donor, values): in each job one random cycle through all its rows.

    Only these columns travel. The ranges are written once, so that both looks at them agree.
    """
    mix = F.xxhash64(row_id, job, F.lit(seed))
    order = ["_mix", row_id]
    keyed = rows.select(job, row_id, mix.alias("_mix"), *values)
    ranges = written(keyed.repartitionByRange(job, *order).withColumn("_range", F.spark_partition_id()), "cycle")
    taken = F.struct(F.col(row_id).alias("donor"), *values)
    inside = Window.partitionBy("_range", job).orderBy(*order)
    heads = ranges.groupBy(job, "_range").agg(F.min(F.struct(*order, taken.alias("taken"))).alias("head"))
    onwards = Window.partitionBy(job).orderBy("_range")
    whole = onwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select(
        job, "_range", F.coalesce(F.lead("head.taken").over(onwards), F.first("head.taken").over(whole)).alias("_head")
    )  # fewer rows than ranges and jobs together
    met = ranges.withColumn("_next", F.lead(taken).over(inside)).join(F.broadcast(following), [job, "_range"])
    got = F.coalesce("_next", "_head")
    return met.select(job, row_id, got["donor"].alias("donor"), *[got[v].alias(v) for v in values])
