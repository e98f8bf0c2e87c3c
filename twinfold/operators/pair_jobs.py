"""The table of all pairs in steps that can be stopped and taken up again.

A job lives in a folder: the photos as they were at the start, dealt over blocks; the pairs, a part for each
step; and a manifest with a row for each step that is finished. A step takes a share of the block pairs. Its row is
written when its part is, so what a stopped step has left is written anew, and no finished step is repeated.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from twinfold.operators.meeting import blocks_for, counting, met_singly, needed, numbers, tile_codes, tiles
from twinfold.operators.similarity import PAIRS_PER_TASK, PAIR_INPUT, block_sides, pair_distances, spread_words

MANIFEST = "step int, pairs long"


class PairJob:
    """folder must be one that driver and executors share; photos as all_pairs takes them.

    A job by fields of the pair table keeps of each step its pairs' counts by these, instead of the pairs.
    """

    def __init__(self, spark: SparkSession, folder: str, by: list[str] | None = None):
        self.spark, self.folder, self.by = spark, folder.rstrip("/"), by

    def _has(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def start(self, photos: DataFrame, steps: int = 16, blocks: int | None = None) -> PairJob:
        """Fix the photos and the plan, unless that was done before: then photos and numbers are ignored."""
        if not self._has("plan"):
            spread_words(photos).write.mode("overwrite").parquet(f"{self.folder}/photos")
            if blocks is None and self.by:
                # As many tiles a step as a table that is made at once has for two of its cores.
                blocks = blocks_for(self.spark.read.parquet(f"{self.folder}/photos").count(), self.spark.sparkContext.defaultParallelism * max(steps // 2, 1))
            if blocks is None:
                blocks = max(math.ceil(self.spark.read.parquet(f"{self.folder}/photos").count() / math.sqrt(PAIRS_PER_TASK)), math.ceil(math.sqrt(8 * steps)))
            self.spark.createDataFrame([], MANIFEST).write.mode("overwrite").parquet(f"{self.folder}/manifest")
            self.spark.createDataFrame([(steps, blocks)], "steps int, blocks int").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/plan")
        return self

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest")

    def remaining(self) -> list[int]:
        """The steps that aren't finished; there are as many at most as the plan says."""
        steps = self.spark.read.parquet(f"{self.folder}/plan").first()["steps"]
        return [r["step"] for r in self.spark.range(steps).select(F.col("id").cast("int").alias("step")).join(self.manifest(), "step", "left_anti").orderBy("step").collect()]

    def _count(self, step: int, plan: Row) -> None:
        columns = needed(self.by)
        rows = self.spark.read.parquet(f"{self.folder}/photos").select("id", *numbers(columns)).dropna(subset=[c for c in columns if c != "group_id"])
        spread = tiles(rows.select(F.xxhash64("id").alias("__key"), *columns), "__key", plan["blocks"])
        visit, schema = counting(self.by)
        part = f"{self.folder}/counts/step={step}"
        codes = [c for c in tile_codes(plan["blocks"]) if c % plan["steps"] == step]
        found = met_singly(spread.filter(F.pmod("__tile", F.lit(plan["steps"])) == step), visit, schema, codes) if codes else self.spark.createDataFrame([], schema)
        found.write.mode("overwrite").parquet(part)
        found = self.spark.read.schema(schema).parquet(part).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))
        found.select(F.lit(step).alias("step"), "pairs").coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def step(self, step: int) -> None:
        plan = self.spark.read.parquet(f"{self.folder}/plan").first()
        if self.by:
            self._count(step, plan)
            return
        mine = F.pmod(F.xxhash64("__i", "__j"), F.lit(plan["steps"])) == step
        a, b = (x.filter(mine) for x in block_sides(self.spark.read.parquet(f"{self.folder}/photos"), "id", plan["blocks"]))
        once = (F.col("__i") < F.col("__j")) | (F.col("a_id") < F.col("b_id"))
        part = f"{self.folder}/pairs/step={step}"
        pair_distances(a.join(b, ["__i", "__j"]).filter(once)).write.mode("overwrite").parquet(part)
        found = self.spark.read.schema(PAIR_INPUT).parquet(part).agg(F.count(F.lit(1)).alias("pairs"))
        found.select(F.lit(step).alias("step"), "pairs").coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def run(self, most: int | None = None) -> PairJob:
        """Take steps until all are finished, or so many."""
        for step in self.remaining()[:most]:
            self.step(step)
        return self

    def counts(self) -> DataFrame:
        """The fields that the job goes by, and pairs: those of the finished steps."""
        steps = [r["step"] for r in self.manifest().select("step").distinct().collect()]
        schema = self.spark.createDataFrame([], counting(self.by)[1]).schema
        parts = self.spark.read.schema(schema).parquet(*[f"{self.folder}/counts/step={s}" for s in steps]) if steps else self.spark.createDataFrame([], schema)
        return parts.groupBy(*self.by).agg(F.sum("pairs").alias("pairs")).filter("pairs > 0")

    def pairs(self) -> DataFrame:
        """The pairs of the finished steps."""
        steps = [r["step"] for r in self.manifest().select("step").distinct().collect()]
        schema = self.spark.createDataFrame([], PAIR_INPUT).schema
        if not steps:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/pairs/step={s}" for s in steps])
