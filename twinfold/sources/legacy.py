"""What the first generation did with files: dates, scores, moves, exports, configuration, ledgers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions import dates as D
from twinfold.functions import exprs as X
from twinfold.operators.curate import upsert


#: Dates in file names, in the order in which they are tried.
DATE_PATTERNS = (r"(\d{4})(\d{2})(\d{2})[_-]?(\d{2})(\d{2})(\d{2})", r"(\d{4})(\d{2})(\d{2})", r"(\d{4})-(\d{2})-(\d{2})", r"^(\d{4})(\d{2})(\d{2})")


def legacy_filename_date(name: Column) -> Column:
    """The time in a file name, by the first pattern whose leftmost match is a real one from 1990 to 2030."""
    tries = []
    for pattern in DATE_PATTERNS:
        y, mo, d, *clock = (F.regexp_extract(name, pattern, k) for k in range(1, 1 + pattern.count("(")))
        iso = F.concat(F.concat_ws("-", y, mo, d), F.lit("T"), F.concat_ws(":", *clock) if clock else F.lit("00:00:00"))
        real = F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
        tries.append(F.when(y.between(str(D.FIRST_YEAR), str(D.LAST_YEAR)) & real, iso))
    return F.coalesce(*tries)


def legacy_date(exif: Column, name: Column, mtime: Column) -> Column:
    """struct(date_taken, date_source): of EXIF, the file name and the file's time, the first there is."""
    taken, named = D.exif_datetime(exif), legacy_filename_date(name)
    source = F.when(taken.isNotNull(), "exif").when(named.isNotNull(), "filename").when(mtime.isNotNull(), "mtime")
    return F.struct(F.coalesce(taken, named, F.date_format(mtime, "yyyy-MM-dd'T'HH:mm:ss")).alias("date_taken"), source.alias("date_source"))


#: Folders and parts of names that the first generation takes for thumbnails.
THUMB_FOLDERS = ("/thumbnails/", "/previews/", "/thumb/", "/.thumbnails/", "/cache/", "/.cache/")
THUMB_PARTS = ("_thumb", "_1024.", "_512.")


def is_thumbnail_legacy(path: Column) -> Column:
    """By folder or by name."""
    low, name = F.lower(path), F.lower(X.basename(path))
    return reduce(Column.__or__, [low.contains(x) for x in THUMB_FOLDERS] + [name.contains(x) for x in THUMB_PARTS] + [name.startswith("thumb_")])


def bucket_plan(photos: DataFrame, root: str = "images") -> DataFrame:
    """photo_id, src, bucket, dest: where each picture goes by its score; photos need id, path, score."""
    bucket = X.bucket_folder(F.col("score"))
    end = X.suffix(F.col("path"))
    return photos.select(F.col("id").alias("photo_id"), F.col("path").alias("src"), bucket.alias("bucket"), F.concat(F.lit(root + "/"), bucket, F.lit("/"), F.col("id"), F.when(end != "", end).otherwise(".jpg")).alias("dest"))


def move_plan(photos: DataFrame, root: str = "filtered") -> DataFrame:
    """photo_id, src, dest of pictures with a reason to go: filtered/reason/bucket/name. Making it true is make_links' work."""
    dest = F.concat_ws("/", F.lit(root), "reason", X.bucket_folder(F.col("score")), X.basename(F.col("path")))
    return photos.filter("reason is not null").select(F.col("id").alias("photo_id"), F.col("path").alias("src"), dest.alias("dest"))


def export_names(ranked: DataFrame) -> DataFrame:
    """photo_id, group_id, link: names that sort a group's members by rank and show which one is to be kept.

    ranked: photo_id, group_id, rank_in_group, is_suggested_keeper, width, height, quality_score, filename.
    """
    keeper = F.when(F.col("is_suggested_keeper"), "KEEPER_").otherwise("")
    return ranked.select("photo_id", "group_id", F.format_string("%04d_%s%dx%d_q%d_%s", "rank_in_group", keeper, "width", "height", "quality_score", "filename").alias("link"))


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """kind, cell of a JSON file {"complete": ["p,c", ...], "single": [...]}."""
    found = spark.read.schema("complete array<string>, single array<string>").option("multiLine", "true").json(path)
    return found.select(F.explode(F.map_from_arrays(F.array(F.lit("complete"), F.lit("single")), F.array(F.coalesce("complete", F.array().cast("array<string>")), F.coalesce("single", F.array().cast("array<string>"))))).alias("kind", "cells")).select("kind", F.explode("cells").alias("cell"))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """p, c, rating of a JSON file {"p,c": rating}."""
    found = spark.read.option("wholetext", "true").text(path).select(F.explode(F.from_json("value", "map<string,int>")).alias("cell", "rating"))
    parts = F.split("cell", ",")
    return found.select(F.get(parts, F.lit(0)).cast("int").alias("p"), F.get(parts, F.lit(1)).cast("int").alias("c"), "rating")


def record_stage(state: DataFrame, stage: str, count: int, notes: str | None = None) -> DataFrame:
    """The ledger of stages (stage, photo_count, notes) with one stage entered or replaced."""
    row = state.sparkSession.createDataFrame([(stage, count, notes)], "stage string, photo_count long, notes string")
    return upsert(state, row, "stage")


def pending_stages(state: DataFrame, order: list[str]) -> list[str]:
    """The stages from the first that isn't recorded on."""
    done = {r["stage"] for r in state.select("stage").distinct().collect()}
    first = next((k for k, s in enumerate(order) if s not in done), len(order))
    return order[first:]


def same_pixels(contents: DataFrame) -> DataFrame:
    """id_1 < id_2 of files (id, content) with the same bytes, by digest."""
    return _with_first(contents.select("id", F.sha2("content", 256).alias("digest")))


def same_pictures(hashed: DataFrame) -> DataFrame:
    """id_1 < id_2 of files (id, pixel_digest) with the same size, channels and pixels, whatever their formats."""
    return _with_first(hashed.select("id", F.col("pixel_digest").alias("digest")).filter("digest is not null"))


def _with_first(digests: DataFrame) -> DataFrame:
    """Each file with the smallest of its digest, so pairs are as many as files."""
    first = digests.groupBy("digest").agg(F.min("id").alias("id_1"))
    return digests.join(first, "digest").filter("id_1 < id").select("id_1", F.col("id").alias("id_2"))
