"""Running sums and places inside groups of any size: range partitions, an offset for each, a second pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.logs import write_verified


def running(df: DataFrame, group: list[str], order: list[Column | str], totals: dict[str, Column]) -> DataFrame:
    """Adds for each name in totals the sum of its column over the rows of a group up to this one, in order (a total order).

    Rows are range-partitioned by group and order, so a hot group is spread over many partitions, and written once, which
    fixes where each row lies. The sums of a group's partitions give every partition its offset (a row for each group and
    partition); a window then runs inside one partition of one group only. Null groups are groups. Writes a table.
    """
    keys = [F.col(f"`{g}`") for g in group]
    sums = {f"__sum_{n}": c for n, c in totals.items()}
    placed = df.select("*", *[c.alias(n) for n, c in sums.items()]).repartitionByRange(*keys, *[F.col(o) if isinstance(o, str) else o for o in order])
    placed = write_verified(placed.withColumn("__part", F.spark_partition_id()), "placed")
    names = [f"__group{i}" for i in range(len(group))]
    each = placed.groupBy(*[k.alias(n) for k, n in zip(keys, names, strict=True)], F.col("__part").alias("__of")).agg(*[F.sum(n).alias(n) for n in sums])
    earlier = Window.partitionBy(*names).orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select(*names, "__of", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__off_{t}") for n, t in zip(sums, totals, strict=True)])
    same = F.col("__part") == F.col("__of")
    for k, n in zip(keys, names, strict=True):
        same = same & k.eqNullSafe(F.col(n))
    within = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = placed.join(offsets, same)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[(F.sum(n).over(within) + F.col(f"__off_{t}")).alias(t) for n, t in zip(sums, totals, strict=True)])


def numbered(df: DataFrame, group: list[str], order: list[Column | str], out: str, first: int = 1) -> DataFrame:
    """Adds a row's place in its group, from first on."""
    return running(df, group, order, {"__place": F.lit(1)}).withColumn(out, (F.col("__place") + (first - 1)).cast("int")).drop("__place")
