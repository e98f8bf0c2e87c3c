"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions alone.

Within its source each document stands in a shuffled order (by a seeded hash). Its virtual finish
time is the source's words up to and with it, divided by the source's weight; a source may be passed
through several times, so a document has one item per epoch. Serving the items of all sources in the
order of virtual time and stopping when the budget is used up gives every source a share in
proportion to its weight, and leaves what exhausted sources can't use to the others. Sources are served at
once, each at the rate of its weight, so the virtual time at which the budget ends follows from the sources'
totals, and an item is taken if its finish time lies before it. The result is range-sorted by finish time.

The running totals are sums of two levels: totals of (source, slice of the hash range), which Spark
combines before its shuffle, and a window inside one slice. A source that holds a third of all rows is
spread over all slices.

Cases: null text has size 0; null source is a source, last in order; repeated rows count each time; an
item that the budget ends within is taken in part; an empty table, or one without words, takes nothing;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.llm.shared import WORD, stored

SLICE_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: list[float], budget_ratio: float, max_epochs: int) -> DataFrame:
    """source, source_size -> also weight, target: the budget shared by weight, none above its cap.

    One row per source: sources are named by people, and this table is the only one sorted as a whole.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("rank", F.row_number().over(order)).withColumn("weight", F.element_at(cycle, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    level = (
        ranked.withColumn("budget", budget_ratio * F.sum("source_size").over(whole))
        .withColumn("used", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("used")) / F.col("open"))
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    # Setting aside a source below the level raises it, one above lowers it: the highest is the one.
    final = F.max(fits).over(whole)
    return level.withColumn("level", F.coalesce(final, F.max(F.col("cap") / F.col("weight")).over(whole))).select("source", "source_size", "weight", "level", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _placed(docs: DataFrame, weights: list[float], budget_ratio: float, max_epochs: int, seed: int, id_col: str, source_col: str, text_col: str, payload: list[Column]) -> DataFrame:
    """payload columns, id, source, size, source_size, weight, target, start, taken of each row of docs.

    An item is a row in one epoch. Its virtual finish time is the number of the source's words up to and with it,
    divided by the source's weight; level is the virtual time at which the budget ends. Items that finish by
    then are taken whole, those that start later not at all, and the one that is in service in part: the words
    that the source has been served by then, whole ones.
    """
    spread = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))), 1, 15), 16, 10).cast("long")  # 60 bits
    full = docs.select(F.struct(*payload).alias("payload"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), spread.alias("h")).withColumn("slice", F.shiftright("h", 60 - SLICE_BITS).cast("int"))
    sized = stored(full.drop("payload"), "sizes")
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    slices = slices.withColumn("before", F.coalesce(F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget_ratio, max_epochs)
    offsets = slices.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select("s.source", "slice", "before", "source_size", "weight", "level", "target")
    line = Window.partitionBy("d.source", "d.slice").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        (full if payload else sized.withColumn("payload", F.struct()))
        .alias("d")
        .join(offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.slice") == F.col("o.slice")))
        .select("payload", "id", "d.source", "size", "source_size", "weight", "level", "target", (F.col("before") + F.sum("size").over(line) - F.col("size")).alias("start"))
    )
    none = F.lit(0).cast("long")
    parts = []
    for epoch in range(max_epochs):
        begun = epoch * F.col("source_size") + F.col("start")
        in_service = F.greatest(none, F.least(F.col("size"), F.floor(F.col("level") * F.col("weight")) - begun))
        parts.append(F.when(finish_time(epoch) <= F.col("level"), F.col("size")).when(begun / F.col("weight") >= F.col("level"), none).otherwise(in_service))
    return placed.withColumn("taken", sum(parts[1:], parts[0]))


def finish_time(epoch: int) -> Column:
    """The virtual finish time of an item in the epoch."""
    return (epoch * F.col("source_size") + F.col("start") + F.col("size")) / F.col("weight")


def mix_sources(docs: DataFrame, weights: list[float], budget_ratio: float = 1.5, max_epochs: int = 2, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, source, size, source_size, target, start, finish_time, level, taken.

    start is the number of the source's shuffled words before the document; finish_time its virtual
    finish time in the first epoch; level the virtual time at which the budget ends; taken the words the mix
    takes of it over all epochs.
    """
    out = _placed(docs, weights, budget_ratio, max_epochs, seed, id_col, source_col, text_col, []).withColumn("finish_time", finish_time(0))
    return out.repartitionByRange("finish_time", "id").sortWithinPartitions("finish_time", "id").select("id", "source", "size", "source_size", "target", "start", "finish_time", "level", "taken")


def mixed_rows(docs: DataFrame, weights: list[float], budget_ratio: float = 1.5, max_epochs: int = 2, seed: int = 7, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """docs as the mix has them: whole documents, each as often as the mix takes it (to the nearest time).

    Rows travel with their places in the queue, so rows that share an identifier count each for itself.
    """
    placed = _placed(docs, weights, budget_ratio, max_epochs, seed, id_col, source_col, text_col, [F.col(c) for c in docs.columns])
    times = placed.filter("taken > 0").select("payload", F.round(F.col("taken") / F.col("size")).cast("int").alias("times")).filter("times > 0")
    return times.select("payload", F.explode(F.sequence(F.lit(1), F.col("times")))).select("payload.*")
