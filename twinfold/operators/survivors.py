"""Which members of a duplicate group survive: five rules in order, each on what the earlier ones left.

Members of a group never meet one by one. The first four rules ask whether some other member is larger and shows
the same photo, or has the same name: of the others, each (group, hash) or (group, name) keeps its best value,
and losers look these up, hashes by way of a table of neighbouring hash values. The last rule is greedy by
definition, in the order of ids. Of members with equal hashes and resolution only those better than all before
them can decide anything; pairs of these are settled in tasks where few hang together, else in rounds.
Members: id, group_id, paths, width, height, file_size, phash, dhash.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.functions import exprs as X
from twinfold.operators.components import connected_components
from twinfold.operators.similarity import band_join
from twinfold.sources.scratch import stored

RULE_ORDER = ("THUMBNAIL", "PREVIEW", "IPHOTO_COPY", "DERIVATIVE", "SAME_RES_DUPLICATE")


def prepared(members: DataFrame) -> DataFrame:
    """Members with what the rules look at, so that self-joins carry flags, not paths."""
    p = F.col("paths")
    first = F.coalesce(F.get(p, F.lit(0)), F.lit(""))
    return members.select(
        "id",
        "group_id",
        "phash",
        "dhash",
        F.coalesce("file_size", F.lit(0)).alias("file_size"),
        X.resolution(F.col("width"), F.col("height")).alias("res"),
        F.exists(p, X.is_thumbnail).alias("thumbnail"),
        X.any_contains(p, "/thumbnails/").alias("thumb_folder"),
        F.transform(p, X.base_name).alias("bases"),
        X.any_contains(p, "/previews/").alias("preview"),
        F.lower(X.basename(first)).alias("first_name"),
        X.any_contains(p, ".photolibrary/").alias("iphoto"),
        X.any_contains(p, ".photoslibrary/").alias("photos_app"),
        F.exists(p, X.is_library_made).alias("library_made"),
    )


#: The most bits of phash between two pictures of the same photo, the most whatever dhash says, and the bands that find them.
SAME_BITS, SURE_BITS, SAME_BANDS = 6, 2, 4
#: Pairs that hang together and are settled in one task.
TASK_PAIRS = 200_000


def near_hashes(rows: DataFrame) -> DataFrame:
    """pa, pb, p: for each phash of rows, all that the same photo may have, itself included, and their distance."""
    one = stored(rows.select("phash").filter("phash is not null").distinct(), "distinct-phash")
    found = band_join(one, "phash", SAME_BITS, SAME_BANDS).select(F.col("a_phash").alias("pa"), F.col("b_phash").alias("pb"))
    every = found.unionByName(found.select(F.col("pb").alias("pa"), F.col("pa").alias("pb"))).unionByName(one.select(F.col("phash").alias("pa"), F.col("phash").alias("pb")))
    return stored(every.select("pa", "pb", X.hamming(F.col("pa"), F.col("pb")).alias("p")), "near-hashes")


def same_photos(a: DataFrame, b: DataFrame, near: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of a beside those of b (their columns prefixed b_) that agree in keys and show the same photo; both have phash and dhash, and without them no partner."""
    reach = a.filter("dhash is not null").join(near, F.col("phash") == F.col("pa")).drop("pa")
    other = b.filter("dhash is not null").select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    agree = reduce(Column.__and__, [F.col(k) == F.col(f"b_{k}") for k in keys], F.col("pb") == F.col("b_phash"))
    sure = reach.filter(F.col("p") <= SURE_BITS).join(other, agree)
    close = reach.filter(F.col("p") > SURE_BITS).join(other, agree & (F.col("dhash") == F.col("b_dhash")))
    return sure.unionByName(close).drop("pb", "p")


def _best_of_same(losers: DataFrame, others: DataFrame, near: DataFrame, *values: Column) -> DataFrame:
    """losers plus aggregates (values, over the columns b_res, b_first and b_last of classes) of the others that show the same photo.

    A class is what has a group and both hashes in common: b_res is its best resolution, b_first and b_last its outer ids.
    values are largest or smallest ones of these. Within SURE_BITS dhash says nothing, so there classes are folded
    to (group, phash) on both sides; classes that differ in dhash never meet.
    """
    keys, figures = ["group_id", "phash", "dhash"], [F.max("b_res").alias("b_res"), F.min("b_first").alias("b_first"), F.max("b_last").alias("b_last")]
    classes = stored(others.filter("dhash is not null").groupBy(*keys).agg(F.max("res").alias("b_res"), F.min("id").alias("b_first"), F.max("id").alias("b_last")), "classes")
    wanted = losers.filter("dhash is not null").select(*keys).distinct()
    folded = stored(classes.groupBy("group_id", F.col("phash").alias("pb")).agg(*figures), "folded-classes")
    reach = lambda rows, bits: rows.join(near.filter(bits), F.col("phash") == F.col("pa")).drop("pa", "p")
    sure = reach(wanted.select("group_id", "phash").distinct(), F.col("p") <= SURE_BITS).join(folded, ["group_id", "pb"]).groupBy("group_id", "phash").agg(*figures)
    close = reach(wanted, F.col("p") > SURE_BITS).join(classes.withColumnRenamed("phash", "pb"), ["group_id", "pb", "dhash"])
    met = wanted.join(sure, ["group_id", "phash"]).unionByName(close.drop("pb"))
    best = stored(met.groupBy(*keys).agg(*values), "best-of-same")
    return losers.join(best, keys)


def _thumbnails(left: DataFrame, near: DataFrame) -> DataFrame:
    losers, others = left.filter("thumbnail"), left.filter("NOT thumbnail")
    seen = _best_of_same(losers, others, near, F.max("b_res").alias("best")).filter("res < best")
    bases = lambda rows: rows.select("id", "group_id", "res", F.explode(F.array_distinct("bases")).alias("base"))
    largest = stored(bases(others).groupBy("group_id", "base").agg(F.max("res").alias("best")), "largest-names")
    named = bases(losers.filter("thumb_folder")).join(largest, ["group_id", "base"]).filter("res < best")
    return seen.select("id", "group_id").unionByName(named.select("id", "group_id")).distinct()


def _previews(left: DataFrame, near: DataFrame) -> DataFrame:
    largest = stored(left.filter("NOT preview").groupBy("group_id", "first_name").agg(F.max("file_size").alias("best")), "largest-files")
    return left.filter("preview").join(largest, ["group_id", "first_name"]).filter("file_size < best").select("id", "group_id")


def _iphoto_copies(left: DataFrame, near: DataFrame, exclude_self: bool) -> DataFrame:
    met = _best_of_same(left.filter("photos_app"), left.filter("iphoto"), near, F.min("b_first").alias("first"), F.max("b_last").alias("last"))
    return (met.filter("first <> id OR last <> id") if exclude_self else met).select("id", "group_id")


def _derivatives(left: DataFrame, near: DataFrame) -> DataFrame:
    met = _best_of_same(left, left, near, F.max("b_res").alias("best"))
    return met.filter((F.col("res") < F.col("best")) & (F.col("res") < F.lit(0.9) * F.col("best"))).select("id", "group_id")


def leading(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows (id, worth and others) with leads: whether, in the order of ids, worth is smaller than all before it with the same keys.

    Rows are dealt by ranges of keys and id, so that one key's rows may lie in many tasks; the smallest worth
    of each task's part is handed on to the next ones.
    """
    fixed = stored(rows.repartitionByRange(*keys, "id").withColumn("__part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys, "__part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    parts = fixed.groupBy(*keys, "__part").agg(F.min("worth").alias("__least"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bounds = stored(parts.withColumn("__bound", F.min("__least").over(earlier)).filter("__bound is not null").drop("__least"), "bounds")
    first = fixed.withColumn("__seen", F.min("worth").over(before)).join(bounds, [*keys, "__part"], "left")
    leads = (F.col("__seen").isNull() | (F.col("worth") < F.col("__seen"))) & (F.col("__bound").isNull() | (F.col("worth") < F.col("__bound")))
    return first.withColumn("leads", leads).drop("__part", "__seen", "__bound")


def _same_resolution(left: DataFrame, near: DataFrame, task_pairs: int) -> DataFrame:
    """Greedy: in the order of ids, each pair of one resolution and picture loses its worse member at once.

    A member with an earlier and better one of the same hashes always loses: to that one, or to what that one lost to.
    Nothing that such a member beats would survive without it. So the others' pairs decide.
    """
    keys = ["group_id", "res", "phash", "dhash"]
    rows = left.filter("phash is not null and dhash is not null").select("id", *keys, F.struct("library_made", -F.col("file_size"), "id").alias("worth"))
    led = stored(leading(rows, keys), "same-resolution")
    some = led.filter("leads").drop("leads")
    met = same_photos(some, some, near, ("group_id", "res")).filter("id < b_id")
    pairs = stored(met.select(F.col("id").alias("one"), F.col("b_id").alias("two"), (F.col("worth") > F.col("b_worth")).alias("one_is_worse"), "group_id"), "same-resolution-pairs")
    lost = settled(pairs, task_pairs).join(some.select("id", "group_id"), "id")
    return led.filter("NOT leads").select("id", "group_id").unionByName(lost)


def settled(pairs: DataFrame, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """id of those who lose among stored pairs (one, two, one_is_worse) in order, as greedy_losers has it.

    Only pairs that hang together depend on each other: up to task_pairs of them are one task's, more take rounds.
    """
    labels = connected_components(pairs, "one", "two")
    placed = stored(pairs.join(labels.select(F.col("node").alias("one"), "label"), "one"), "settled-components")
    big = stored(placed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > task_pairs).select("label"), "large-components")
    kind = pairs.schema["one"].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": greedy_losers(sorted(group[["one", "two", "one_is_worse"]].itertuples(index=False, name=None)))})

    if big.isEmpty():
        return placed.groupBy("label").applyInPandas(run, f"id {kind}")
    small = placed.join(big, "label", "left_anti").groupBy("label").applyInPandas(run, f"id {kind}")
    return small.unionByName(settled_in_rounds(placed.join(big, "label", "left_semi").drop("label")))


def settled_in_rounds(pairs: DataFrame) -> DataFrame:
    """settled, by rounds of joins.

    Who loses in its own turn no longer matters to others, so what counts is who falls before it: a member
    falls if a smaller one, standing at its own turn, is better. Those that nobody undecided could fell stand; whom
    they beat falls; both leave the pairs, until none is left.
    """
    fell = stored(pairs.filter("NOT one_is_worse").select("one", "two").distinct(), "felling")
    left, fallen = fell, None
    while not left.isEmpty():
        standing = left.select("one").distinct().join(left.select(F.col("two").alias("one")).distinct(), "one", "left_anti")
        struck = stored(left.join(standing, "one", "left_semi").select("two").distinct(), "struck")
        fallen = struck if fallen is None else fallen.unionByName(struck)
        left = stored(left.join(struck, "two", "left_anti").join(struck.select(F.col("two").alias("one")), "one", "left_anti"), "felling")
    if fallen is None:
        return pairs.select(F.col("one").alias("id")).filter("false") if pairs.isEmpty() else pairs.filter("one_is_worse").select(F.col("one").alias("id")).distinct()
    fallen = stored(fallen, "fallen")
    by = stored(fell.join(fallen.select(F.col("two").alias("one")), "one", "left_anti").groupBy("two").agg(F.min("one").alias("by")), "felled-by")
    turns = pairs.filter("one_is_worse").select("one", "two").join(fallen.select(F.col("two").alias("one")), "one", "left_anti").join(by, "two", "left")
    return by.select(F.col("two").alias("id")).unionByName(turns.filter("by is null or by > one").select(F.col("one").alias("id")).distinct())


def greedy_losers(pairs: list[tuple[str, str, bool]]) -> list[str]:
    """Who loses among pairs (one, two, one is worse) in order. A pair counts unless one had lost before its turn came, or two has lost by now."""
    lost: dict[str, None] = {}
    turn, out_before = None, False
    for one, two, one_is_worse in pairs:
        if one != turn:
            turn, out_before = one, one in lost
        if not out_before and two not in lost:
            lost[one if one_is_worse else two] = None
    return list(lost)


def reject_in_groups(members: DataFrame, iphoto_exclude_self: bool = False, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """photo_id, group_id, rule_name of the members that lose; rules stop in a group with fewer than two left.

    As published, IPHOTO_COPY may reject a photo against itself; iphoto_exclude_self mends that. Members without
    both hashes are nobody's same photo.
    """
    left = stored(prepared(members), "members")
    near = near_hashes(left.filter("dhash is not null"))
    rules = {
        "THUMBNAIL": _thumbnails,
        "PREVIEW": _previews,
        "IPHOTO_COPY": lambda rows, near: _iphoto_copies(rows, near, iphoto_exclude_self),
        "DERIVATIVE": _derivatives,
        "SAME_RES_DUPLICATE": lambda rows, near: _same_resolution(rows, near, task_pairs),
    }
    out = None
    for name in RULE_ORDER:
        several = stored(left.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").select("group_id"), "groups")
        hit = stored(rules[name](left.join(several, "group_id", "left_semi"), near), "hit")
        rejected = hit.select(F.col("id").alias("photo_id"), "group_id", F.lit(name).alias("rule_name"))
        out = rejected if out is None else out.unionByName(rejected)
        left = stored(left.join(hit.select("id"), "id", "left_anti"), "members")
    return out


def originals(members: DataFrame, rejections: DataFrame) -> DataFrame:
    """photo_id, group_id, rule_name, status of every member of groups with a rejection under each rule.

    Per rule, members that earlier rules rejected are hidden; status is rejected, original (by what the rule
    looks at, the members that beat a rejected one) or other.
    """
    flags = prepared(members).select(F.col("id").alias("photo_id"), "group_id", "res", "thumbnail", "preview", "iphoto")
    rank = F.array_position(F.array(*map(F.lit, RULE_ORDER)), F.col("rule_name"))
    ranked = rejections.withColumn("rule_rank", rank)
    seen = ranked.select("group_id", "rule_name", "rule_rank").distinct()
    all_rows = flags.join(seen, "group_id").join(ranked.select("photo_id", F.col("rule_rank").alias("own_rank")), "photo_id", "left").filter("own_rank is null or own_rank >= rule_rank")
    most = Window.partitionBy("group_id", "rule_name")
    top = F.max(F.when(F.col("own_rank") == F.col("rule_rank"), F.col("res"))).over(most)
    rejected = F.coalesce(F.col("own_rank") == F.col("rule_rank"), F.lit(False))
    original = (
        F.when(F.col("rule_name") == "THUMBNAIL", ~F.col("thumbnail") & (F.col("res") > top))
        .when(F.col("rule_name") == "PREVIEW", ~F.col("preview"))
        .when(F.col("rule_name") == "IPHOTO_COPY", F.col("iphoto"))
        .when(F.col("rule_name") == "DERIVATIVE", F.col("res") > top)
        .otherwise(F.col("res") == top)
    )
    status = F.when(rejected, "rejected").when(original, "original").otherwise("other")
    return all_rows.withColumn("status", status).select("photo_id", "group_id", "rule_name", "status")


def legacy_rank(members: DataFrame) -> DataFrame:
    """photo_id, group_id, group_size, rank_in_group, quality_score, is_suggested_keeper; needs score (0-100)."""
    quality = (X.resolution(F.col("width"), F.col("height")) * (F.col("score") / F.lit(100.0))).cast("long")
    rows = members.select(F.col("id").alias("photo_id"), "group_id", quality.alias("quality_score"))
    order = Window.partitionBy("group_id").orderBy(F.desc("quality_score"), "photo_id")
    size = F.count(F.lit(1)).over(Window.partitionBy("group_id"))
    return rows.withColumn("rank_in_group", F.row_number().over(order)).withColumn("group_size", size).withColumn("is_suggested_keeper", F.col("rank_in_group") == 1)


def planned_rank(members: DataFrame) -> DataFrame:
    """The first generation's planned order: pixels, then size, then no thumbnail, then EXIF."""
    rows = members.select(F.col("id").alias("photo_id"), "group_id", X.resolution(F.col("width"), F.col("height")).alias("res"), "file_size", F.exists("paths", X.is_thumbnail).alias("thumb"), F.col("exif_make").isNotNull().alias("exif"))
    order = Window.partitionBy("group_id").orderBy(F.desc("res"), F.desc_nulls_last("file_size"), "thumb", F.desc("exif"), "photo_id")
    return rows.withColumn("rank", F.row_number().over(order)).select("photo_id", "group_id", "rank")
