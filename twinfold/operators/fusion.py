"""One date per entity out of several partial dates of differing confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.functions import dates as D
from twinfold.functions import exprs as X
from twinfold.sources.scratch import stored

TIERS = ("high", "medium", "low")


def gather(photos: DataFrame, paths: DataFrame, sources: DataFrame | None = None, mode: str = "code") -> DataFrame:
    """photo_id, date_value, source_type, tier, turn (the order in which sources are gathered).

    mode "code" takes photos' own date_taken and date_source; mode "documented" takes the sources table
    (photo_id, source_type, date_value, confidence), without suspect and unusable ones.
    """
    # Dates leave an array, so that no filter on them is pushed below and computes them once more.
    parsed = lambda kind, found: paths.select("photo_id", F.explode(F.array_compact(F.array(found))).alias("date_value"), F.struct(F.lit(kind).alias("kind"), F.col("path_id").alias("n")).alias("turn"))
    names = parsed(1, D.date_from_filename(F.col("filename"))).select("photo_id", "date_value", F.lit("filename").alias("source_type"), F.lit("medium").alias("tier"), "turn")
    folders = parsed(2, D.date_from_path(F.col("source_path"))).select("photo_id", "date_value", F.lit("path_semantic").alias("source_type"), D.path_confidence(F.col("date_value")).alias("tier"), "turn")
    if mode == "documented":
        own = sources.filter(F.col("confidence").isin(*TIERS)).select("photo_id", "date_value", "source_type", F.col("confidence").alias("tier"), F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n")).alias("turn"))
        return own.unionByName(names).unionByName(folders).filter("date_value is not null")
    tier = F.when(F.col("date_source") == "mtime", "low").otherwise("medium")
    own = photos.select(F.col("id").alias("photo_id"), F.col("date_taken").alias("date_value"), F.coalesce("date_source", F.lit("exif")).alias("source_type"), tier.alias("tier"), F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n")).alias("turn"))
    return own.unionByName(names).unionByName(folders).filter("date_value is not null")


def derive(entities: DataFrame, sources: DataFrame) -> DataFrame:
    """entity, date_value, confidence, source_type, has_conflict, conflict_dates for entities (entity, photo_id).

    Of the best tier that has any, dates that are a strict prefix of another in their tier go, then the
    earliest stays; ties keep the one gathered first. Entities without a source get nulls. Prefixes are
    looked up by equality: each date offers its own possible prefixes, so no tier is joined with itself.
    """
    dated = stored(entities.join(sources, "photo_id").withColumn("rank", F.array_position(F.array(*map(F.lit, TIERS)), F.col("tier"))), "dated")
    prefixes = dated.select("entity", "rank", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("date_value") - 1, F.lit(1))), lambda n: F.left("date_value", n))).alias("date_value"), F.col("date_value").alias("longer"))
    shadowed = prefixes.filter("length(longer) > length(date_value)").select("entity", "rank", "date_value").distinct()
    specific = dated.join(shadowed, ["entity", "rank", "date_value"], "left_anti")
    key = F.struct("rank", D.date_sort_key(F.col("date_value")).alias("k"), "turn", "photo_id")
    best = specific.groupBy("entity").agg(F.min_by(F.struct("date_value", F.col("tier").alias("confidence"), "source_type"), key).alias("best"))
    year = D.year_of(F.col("date_value"))
    high = dated.filter("tier = 'high'").groupBy("entity").agg((F.max(year) - F.min(year) > 1).alias("conflict"), F.array_sort(F.collect_set("date_value")).alias("dates"))
    names = entities.select("entity").distinct()
    flag = F.coalesce("conflict", F.lit(False))
    none = F.array().cast("array<string>")
    return names.join(best, "entity", "left").join(high, "entity", "left").select("entity", "best.date_value", "best.confidence", "best.source_type", flag.alias("has_conflict"), F.when(flag, F.col("dates")).otherwise(none).alias("conflict_dates"))


def date_index(groups: DataFrame, photos: DataFrame, derived: DataFrame) -> DataFrame:
    """display_date, entity, representative, photo_count, quality: one row per entity, to be read by date, 'unknown' last.

    groups: entity, photo_id. The representative has most pixels, then the smallest id.
    """
    rows = groups.join(photos.select(F.col("id").alias("photo_id"), "width", "height"), "photo_id")
    order = F.struct(-X.resolution(F.col("width"), F.col("height")), "photo_id")
    best = rows.groupBy("entity").agg(F.min_by("photo_id", order).alias("representative"), F.count(F.lit(1)).alias("photo_count"), F.min_by(X.quality_class(F.col("width"), F.col("height")), order).alias("quality"))
    return best.join(derived, "entity", "left").select(D.display_date(F.col("date_value")).alias("display_date"), "entity", "representative", "photo_count", "quality")


def calendar(index: DataFrame, year: int) -> DataFrame:
    """day, weekday (Monday 1), photos for every day of a year."""
    days = index.sparkSession.range(1).select(F.explode(F.sequence(F.to_date(F.lit(f"{year}-01-01")), F.to_date(F.lit(f"{year}-12-31")))).alias("day"))
    counts = index.groupBy(F.expr("try_cast(display_date as date)").alias("day")).agg(F.sum("photo_count").alias("photos"))
    return days.join(counts, "day", "left").select("day", (F.weekday("day") + 1).alias("weekday"), F.coalesce("photos", F.lit(0)).alias("photos"))
