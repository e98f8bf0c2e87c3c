"""Order over a whole table, by ranges: pages and neighbours without a task that sees every row.

Rows are dealt into ranges of their order and stored by range, so a page reads only the ranges that it lies in,
and what a row has before it is the sum of the smaller ranges plus its rank within its own. Only one row per
range is ever sorted as a whole.

Cases: nulls come first; rows of equal order share a range and may stand either way round, so an order that
ends with a key gives the same pages each time; an empty table has no pages; other columns go along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinfold.sources.scratch import new_path, stored

#: Rows of a range, about, and ranges that a small table has at least.
RANGE_ROWS, LEAST_RANGES = 1 << 20, 8


@dataclass(frozen=True)
class RangedTable:
    """rows with their range (in the folder names of its files), and one row per range: range, n, before."""

    rows: DataFrame
    ranges: DataFrame
    order: tuple[str, ...]

    @classmethod
    def of(cls, rows: DataFrame, *order: str, range_rows: int = RANGE_ROWS) -> RangedTable:
        spark, path = rows.sparkSession, new_path(rows.sparkSession, "ranges")
        many = max(LEAST_RANGES, -(-rows.count() // range_rows))
        dealt = rows.repartitionByRange(many, *order).withColumn("__range", F.spark_partition_id())
        dealt.write.partitionBy("__range").parquet(path)
        kept = spark.read.schema(dealt.schema).parquet(path)
        counts = kept.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
        smaller = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(smaller), F.lit(0).cast("long"))
        return cls(kept, stored(counts.withColumn("before", before), "range-sizes"), order)

    def between(self, first: int, last: int) -> DataFrame:
        """The rows of all ranges that hold any of the ranks first to last (from 1), with __range and __before."""
        held = self.ranges.filter((F.col("before") < last) & (F.col("before") + F.col("n") >= first)).select("__range", F.col("before").alias("__before"))
        numbers = [r[0] for r in held.select("__range").collect()]  # a page of s rows lies in s ranges at most
        return self.rows.filter(F.col("__range").isin(numbers)).join(F.broadcast(held), "__range")

    def page(self, number: int, size: int) -> DataFrame:
        """One page; numbers below one count as one."""
        first = (max(1, number) - 1) * size + 1
        rank = F.col("__before") + F.row_number().over(Window.partitionBy("__range").orderBy(*self.order))
        found = self.between(first, first + size - 1).withColumn("__rank", rank).filter(F.col("__rank").between(first, first + size - 1))
        return found.orderBy("__rank").drop("__range", "__before", "__rank")


def neighbours_in_order(rows: DataFrame, column: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """column, previous, next: the values of column, each with those beside it."""
    table = RangedTable.of(rows.select(column).distinct(), column, range_rows=range_rows)
    ends = table.rows.groupBy("__range").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    ranges, inside = Window.orderBy("__range"), Window.partitionBy("__range").orderBy(column)
    beside = ends.select("__range", F.lag("high").over(ranges).alias("__high"), F.lead("low").over(ranges).alias("__low"))
    both = table.rows.join(beside, "__range")
    # Null stands before all values, and nothing tells it from a missing neighbour: previous is null either way.
    return both.select(column, F.coalesce(F.lag(column).over(inside), "__high").alias("previous"), F.coalesce(F.lead(column).over(inside), "__low").alias("next"))
