"""Numbers in a total order without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinfold.sources.scratch import stored


def numbered_rows(rows: DataFrame, order: str, name: str, start: int = 0) -> DataFrame:
    """rows with name: start for the first in the order of a column, and so on.

    Rows are dealt by ranges of the column and stored; the sizes of the ranges before, one row each, are added
    to the number inside the range.
    """
    fixed = stored(rows.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = fixed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("__before"))
    turn = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return fixed.join(before, "__part").withColumn(name, (F.lit(start - 1) + F.col("__before") + turn).cast("long")).drop("__part", "__before")


def by_number(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the number of their key instead of it, names: number and key), stored; rows have a key once.

    Numbers follow the order of keys, from 0, so what compares, orders or groups by keys does the same by numbers,
    in a tenth of the bytes where keys are digests.
    """
    known = stored(numbered_rows(stored(rows, "keyed"), key, "__number"), "by-number")
    numbered = known.select(*[F.col("__number").alias(key) if c == key else F.col(c) for c in rows.columns])
    return numbered, known.select(F.col("__number").alias("number"), F.col(key).alias("name"))


def named(table: DataFrame, names: DataFrame, *columns: str) -> DataFrame:
    """table with names instead of numbers in some columns."""
    for c in columns:
        mine = names.toDF("__number", "__name")
        table = table.join(mine, table[c] == mine["__number"]).withColumn(c, F.col("__name")).drop("__number", "__name")
    return table
