"""Places, running sums and trailing windows over a whole table, without one task that sees all of it.

Rows are range partitioned by their order and kept so; each part sorts its own.  Sums of parts,
a row for each, give every part its offset, and the last rows before a part are sent to it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.shared import settled

#: Columns that an Ordered adds: the part of a row, and its place in all rows from 1.
PART, PLACE = "_part", "_place"


@dataclass(frozen=True)
class Ordered:
    """rows with PART and PLACE; starts: (PART, first PLACE, last PLACE) of each part, as many rows as there are parts."""

    rows: DataFrame
    starts: DataFrame

    def done(self) -> DataFrame:
        """The rows as they are to be used, without PART and PLACE."""
        return self.rows.drop(PART, PLACE)

    def running(self, **sums: Column) -> Ordered:
        """The rows with running sums under these names, each with those of all rows before."""
        named = self.rows.select("*", *[v.alias(f"_v_{k}") for k, v in sums.items()])
        parts = named.groupBy(PART).agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in sums])
        before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        offsets = parts.select(PART, *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
        own = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
        sums_ = [(F.col(f"_o_{k}") + F.coalesce(F.sum(f"_v_{k}").over(own), F.lit(0))).alias(k) for k in sums]
        return replace(self, rows=named.join(F.broadcast(offsets), PART).select(*self.rows.columns, *sums_))

    def trailing(self, rows: int, **values: Callable[[WindowSpec], Column]) -> Ordered:
        """The rows with values over the last `rows` rows, their own the last; values: functions of a window.

        The rows before a part that its windows reach are those within `rows` - 1 places of its
        start: each part is sent as many at most.
        """
        if rows < 1:
            raise ValueError("a trailing window has a row at least")
        starts = self.starts.agg(F.collect_list(F.struct(F.col(PART), F.col("first"))).alias("_starts"))  # as many as there are parts
        near = self.rows.join(F.broadcast(self.starts.select(PART, "last")), PART).where(F.col(PLACE) > F.col("last") - (rows - 1)).drop("last")
        reached = F.filter("_starts", lambda s: (s["first"] > F.col(PLACE)) & (s["first"] - F.col(PLACE) < rows))
        sent = near.crossJoin(F.broadcast(starts)).withColumn(PART, F.explode(F.transform(reached, lambda s: s[PART]))).drop("_starts")
        both = self.rows.select("*", F.lit(True).alias("_own")).unionByName(sent.select(*self.rows.columns, F.lit(False).alias("_own")))
        window = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(-(rows - 1), 0)
        return replace(self, rows=both.select("*", *[f(window).alias(k) for k, f in values.items()]).where("_own").drop("_own"))


def in_order(df: DataFrame, order: list[Column | str], parts: int | None = None) -> Ordered:
    """df in this order, which should be total: rows that tie stand in any order, and in one part."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settled(df.repartitionByRange(n, *order).withColumn(PART, F.spark_partition_id()))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    starts = settled(sizes.select(PART, (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).alias("first"), "n").select(PART, "first", (F.col("first") + F.col("n") - 1).alias("last")))
    own = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    rows = ranged.withColumn("_own", own).join(F.broadcast(starts.select(PART, "first")), PART).withColumn(PLACE, F.col("first") + F.col("_own") - 1).drop("_own", "first")
    return Ordered(settled(rows), starts)


def numbered(df: DataFrame, order: list[Column | str], name: str = "row") -> DataFrame:
    """df with the place of each row in this order, from 1 without gaps."""
    return in_order(df, order).rows.withColumnRenamed(PLACE, name).drop(PART)
