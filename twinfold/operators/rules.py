"""Ordered first-match rules as one CASE expression: individual rules and the first generation's filters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.functions import exprs as X


PathTest = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    """Holds when, for one of its cases, some path passes the test (None: whatever the paths) and the condition on the photo holds."""

    name: str
    decision: str
    cases: list[tuple[PathTest | None, Column | None]]


def _holding(*needles: str) -> PathTest:
    """The path holds one of the needles, whatever the case."""
    return lambda p: reduce(Column.__or__, [F.contains(F.lower(p), F.lit(n.lower())) for n in needles])


def individual_rules() -> list[Rule]:
    """Separations first, then rejections, each in its fixed order.

    Conditions on photos read width, height and companion (a web page stands beside its _files folder).
    """
    w, h = F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))
    longest = F.greatest(w, h)
    small_square = (longest <= 500) & (w != 0) & (h != 0) & (F.abs(w.cast("double") / F.nullif(h, F.lit(0)) - 1.0) <= F.lit(0.1))
    greeting = lambda p: p.contains("20140223-155504") & F.regexp_replace(X.stem(p), "_1024", "").rlike(r"^[0-9]{3}$")
    video = lambda p: F.upper(X.basename(p)).startswith("MVI_") | F.upper(X.basename(p)).endswith(".THM")
    return [
        Rule("FATHER_IN_LAW", "separate", [(_holding("/tor/Pictures/2013/03/03/", "/Thumbnails/2013/03/03/", "/Tor's childhood/"), None)]),
        Rule("PHOTOBOOTH", "separate", [(_holding("Photo Booth Library/Originals/", "Photo Booth Library/Pictures/"), None)]),
        Rule("HUE_ANIMATION", "separate", [(_holding("HUE Animation"), None)]),
        Rule("MINECRAFT_TEXTURE", "reject", [(_holding("minecraft"), None)]),
        Rule("ICHAT_ICON", "reject", [(_holding("/iChat Icons/", "/Messages/", "/Skype/"), longest < 200)]),
        Rule("WEB_ASSET", "reject", [(None, F.coalesce("companion", F.lit(False)))]),
        Rule("FACE_CROP", "reject", [(lambda p: F.lower(X.stem(p)).contains("_face"), None), (_holding("/modelresources/"), small_square)]),
        Rule("STOCK_GREETING", "reject", [(greeting, None)]),
        Rule("FLAG_ICON", "reject", [(_holding("20121223-175144"), None)]),
        Rule("FLIP_VIDEO_THUMB", "reject", [(_holding("/FlipShare Data/Previews/", "/My Flip Video Prefs/"), None)]),
        Rule("VIDEO_THUMBNAIL", "reject", [(video, None)]),
        Rule("APP_RESOURCE", "reject", [(_holding(".app/Contents/"), None)]),
        Rule("TRASHES", "reject", [(_holding("/.Trashes/"), None)]),
        Rule("TINY_ICON", "reject", [(None, w.cast("long") * h < 5000)]),
    ]


def path_flags(path: Column, rules: list[Rule]) -> Column:
    """One bit per case, in order, that is set where the path passes its test."""
    bits, k = [], 0
    for rule in rules:
        for test, _ in rule.cases:
            if test is not None:
                bits.append(F.when(test(path), 1 << k).otherwise(0))
            k += 1
    return reduce(Column.bitwiseOR, bits).cast("long")


def first_match(rules: list[Rule], flags: Column) -> Column:
    """struct(decision, rule_name) of the first rule that holds, else null; flags are those of all paths of the photo."""
    out, k = F.lit(None).cast("struct<decision:string,rule_name:string>"), sum(len(r.cases) for r in rules)
    for rule in reversed(rules):
        hits = []
        for test, condition in reversed(rule.cases):
            k -= 1
            parts = ([flags.bitwiseAND(F.lit(1 << k)) != 0] if test is not None else []) + ([condition] if condition is not None else [])
            hits.append(F.coalesce(reduce(Column.__and__, parts), F.lit(False)))
        out = F.when(reduce(Column.__or__, hits), F.struct(F.lit(rule.decision).alias("decision"), F.lit(rule.name).alias("rule_name"))).otherwise(out)
    return out


def with_companions(photos: DataFrame, paths: DataFrame, inventory: DataFrame) -> DataFrame:
    """photos plus companion: a path inside X_files/ whose page X.htm or X.html is in the inventory of all names."""
    base = F.regexp_extract("source_path", r"(?i)(.+)_files/", 1)
    pages = inventory.filter(F.lower("path").rlike(r"[.]html?$")).select(F.regexp_replace("path", r"(?i)[.]html?$", "").alias("__base")).distinct()
    inside = paths.select("photo_id", base.alias("__base")).filter("__base <> ''")
    hit = inside.join(pages, "__base", "left_semi").select(F.col("photo_id").alias("__hit")).distinct()
    return photos.join(hit, photos["id"] == hit["__hit"], "left").withColumn("companion", F.col("__hit").isNotNull()).drop("__hit")


def with_paths(photos: DataFrame, paths: DataFrame) -> DataFrame:
    """photos plus paths: all source paths in the order of their ids."""
    listed = paths.groupBy(F.col("photo_id").alias("__photo")).agg(F.transform(F.array_sort(F.collect_list(F.struct("path_id", "source_path"))), lambda x: x["source_path"]).alias("paths"))
    return photos.join(listed, photos["id"] == listed["__photo"], "left").drop("__photo").withColumn("paths", F.coalesce("paths", F.array().cast("array<string>")))


def decide(photos: DataFrame, paths: DataFrame, inventory: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """photo_id, decision, rule_name for photos that a rule decides and that have no decision yet.

    Paths are tested one by one, and a photo gets the bits of all its paths: no list of paths is made.
    """
    rules = individual_rules()
    todo = photos if decided is None else photos.join(decided, photos["id"] == decided["photo_id"], "left_anti")
    flags = paths.groupBy(F.col("photo_id").alias("__photo")).agg(F.bit_or(path_flags(F.col("source_path"), rules)).alias("__flags"))
    ready = with_companions(todo, paths, inventory)
    ready = ready.join(flags, ready["id"] == flags["__photo"], "left").withColumn("__flags", F.coalesce("__flags", F.lit(0)))
    return ready.select(F.col("id").alias("photo_id"), first_match(rules, F.col("__flags")).alias("m")).filter("m is not null").select("photo_id", "m.decision", "m.rule_name")


#: The first generation's categories in order: a pattern of the path, whatever the case, or none, and a
#: condition on the size, or none. The one that knows web assets looks at a flag.
LEGACY_CATEGORIES = [
    ("minecraft", "minecraft", None),
    ("hue_animation", "HUE Animation", None),
    ("ichat_icons", "/iChat Icons/", None),
    ("web_page_asset", None, "companion"),
    ("flip_video_thumbs", "/My Flip Video Prefs/", None),
    ("face_detection", ".face[0-9][.]jpg$", "width * height <= 250000"),
    ("face_detection_10plus", ".face[1-9][0-9][.]jpg$", "width * height <= 250000"),
    ("flipshare_previews", "/FlipShare Data/Previews/", None),
    ("tiny_icons", None, "width * height <= 5000"),
    ("face_detection_modelresources", "/modelresources/", "abs(width - height) <= 10 AND width <= 200"),
    ("trash", "/[.]Trash", None),
]


def legacy_category(path: str = "source_path") -> Column:
    """The first category that fits; rows need path, width, height and companion (a web page's asset). Null where none does."""
    out = F.lit(None).cast("string")
    for name, pattern, condition in reversed(LEGACY_CATEGORIES):
        tests = ([F.col(path).rlike(f"(?i){pattern}")] if pattern else []) + ([F.expr(condition)] if condition else [])
        out = F.when(reduce(Column.__and__, tests), name).otherwise(out)
    return out
