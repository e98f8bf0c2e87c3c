"""The first generation's rules inside duplicate groups: rejections by name clusters, and marking of derivatives.

A cluster is the members of a group whose file names share a base. Each rule asks what the rest of its
cluster holds; the answers are counts and extremes of keys inside the cluster, joined back, so no cluster is
gathered. Members: id, group_id, paths, width, height, file_size; the first path counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions import exprs as X

CLUSTER = ["group_id", "base"]


def _facts(members: DataFrame, base, *more: Column) -> DataFrame:
    path = F.coalesce(F.get("paths", F.lit(0)), F.lit(""))
    w, h = F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))
    return members.select("id", "group_id", base(path).alias("base"), path.alias("path"), F.lower(path).alias("low"), w.alias("width"), h.alias("height"), X.resolution(w, h).alias("res"), F.coalesce("file_size", F.lit(0)).alias("file_size"), *more)


def _joined(rows: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """rows with aggregates over all rows of equal keys."""
    per = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return rows.join(per, keys)


def legacy_rejections(members: DataFrame) -> DataFrame:
    """photo_id, group_id, reason: the first of ten rules that rejects a member. Members also need content_md5.

    All rules see the whole cluster. Equal contents of equal size stand in for equal pixels.
    """
    rows = _facts(members, X.derivative_base, F.col("content_md5"))
    name = F.lower(X.basename(F.col("path")))
    rows = rows.withColumns({
        "thumb": F.col("low").contains("/thumbnails/") | name.startswith("thumb_"), "name": name, "camera": X.is_camera_name(F.col("path")),
        "iphoto": F.col("low").contains(".photolibrary/"), "photos_app": F.col("low").contains(".photoslibrary/"),
    })
    rows = _joined(rows, CLUSTER, top=F.max("res"), top_master=F.max(F.when(~F.col("thumb"), F.col("res"))))
    rows = _joined(rows, [*CLUSTER, "res"], apps=F.count_if("photos_app"))
    rows = _joined(rows, [*CLUSTER, "name"], top_size=F.max("file_size"))
    rows = _joined(rows.withColumn("content_md5", F.coalesce("content_md5", F.col("id"))), [*CLUSTER, "file_size", "content_md5"], named=F.count_if(~F.col("camera")))
    square = (F.col("height") > 0) & (F.abs(F.col("width").cast("double") / F.nullif(F.col("height"), F.lit(0)) - 1.0) <= F.lit(0.1))
    number = F.regexp_replace(X.stem(F.col("path")), "_1024$", "")
    reason = (
        F.when(F.col("thumb") & (F.col("top_master") > F.col("res")), "thumbnail_with_master")
        .when(F.col("iphoto") & (F.col("apps") > F.col("photos_app").cast("int")), "iphoto_duplicate_of_photos")
        .when(F.col("low").contains("photo booth library/pictures/"), "photobooth_filtered")
        .when(F.col("low").contains("/modelresources/") & (F.greatest("width", "height") <= 500) & square, "face_thumbnail")
        .when(F.col("low").contains("/thumbnails/") & number.rlike("^[0-9]{3}$"), "stock_image")
        .when(F.col("path").contains("20121223-175144"), "flag_icon")
        .when(F.col("thumb") & F.col("top_master").isNull() & (F.col("top") > F.col("res")), "smaller_thumbnail")
        .when((F.col("res") < 500_000) & (F.col("top") > 10 * F.col("res")), "tiny_with_large")
        .when(F.col("low").contains("/previews/") & (F.col("top_size") > F.col("file_size")), "preview_with_original")
        .when(F.col("camera") & (F.col("named") > 0), "pixel_duplicate")
    )
    return rows.select(F.col("id").alias("photo_id"), "group_id", reason.alias("reason")).filter("reason is not null")


def marked_derivatives(members: DataFrame) -> DataFrame:
    """photo_id, group_id, base, keeper, mode, rejected: the plan for each member. Members also need quality_score.

    In a cluster the best is, at the resolution of its highest quality, a Photos library's picture before
    others and these before iPhoto's, then the largest file. Where some other member is clearly a derivative of
    it, the best alone is a keeper, else all are. A group resolves in full when its keepers share one resolution
    and everything else is a derivative; in part when only obvious ones can go; else by hand.
    """
    rows = _facts(members, X.marked_base, F.coalesce("quality_score", F.lit(0)).alias("quality"))
    rows = rows.withColumn("derived", F.col("low").contains("/thumbnails/") | F.col("low").contains("/thumb_"))
    rank = F.when(F.col("low").contains(".photoslibrary/"), 0).when(F.col("low").contains(".photolibrary/"), 2).otherwise(1)
    rows = _joined(rows.withColumn("rank", rank), CLUSTER, n=F.count(F.lit(1)), top=F.max_by("res", F.struct("quality", "file_size", "id")))
    at_top = F.col("res") == F.col("top")
    best = F.min_by(F.struct("id", "width", "height", "file_size"), F.when(at_top, F.struct("rank", -F.col("file_size"), "id")))
    rows = _joined(rows, CLUSTER, best=best)
    smaller = (F.col("width") < 0.9 * F.col("best.width")) | (F.col("height") < 0.9 * F.col("best.height"))
    clear = (F.col("id") != F.col("best.id")) & (F.col("derived") | smaller | (at_top & (F.col("file_size") < F.col("best.file_size"))))
    rows = _joined(rows.withColumn("clear", clear), CLUSTER, any_clear=F.bool_or("clear"))
    rows = rows.withColumn("keeper", (F.col("n") == 1) | ~F.col("any_clear") | (F.col("id") == F.col("best.id")))
    kept = lambda c: F.when(F.col("keeper"), c)
    rows = _joined(rows, ["group_id"], keep_max=F.max(kept(F.col("res"))), keep_min=F.min(kept(F.col("res"))), keep_size=F.max(kept(F.col("file_size"))), lost=F.count_if(~F.col("keeper")))
    whole = F.col("derived") | (F.col("res") < 0.5 * F.col("keep_max")) | ((F.col("res") == F.col("keep_max")) & (F.col("file_size") < F.col("keep_size")))
    obvious = F.col("derived") | (F.col("res") < 0.5 * F.col("keep_min"))
    rows = rows.withColumns({"whole": F.col("keeper") | whole, "obvious": ~F.col("keeper") & obvious})
    rows = _joined(rows, ["group_id"], all_whole=F.bool_and("whole"), some_obvious=F.bool_or("obvious"))
    even = F.col("keep_min") == F.col("keep_max")
    mode = F.when((F.col("lost") > 0) & even & F.col("all_whole"), "full").when((F.col("lost") > 0) & ~even & F.col("some_obvious"), "partial").otherwise("manual")
    rejected = F.when(F.col("mode") == "full", ~F.col("keeper")).when(F.col("mode") == "partial", F.col("obvious")).otherwise(F.lit(False))
    return rows.withColumn("mode", mode).withColumn("rejected", rejected).select(F.col("id").alias("photo_id"), "group_id", "base", "keeper", "mode", "rejected")
