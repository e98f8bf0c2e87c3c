"""From similar pairs to groups: clustering, unlinked pairs, bridges, merging, composite groups, boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.operators.cluster import complete_linkage, single_linkage_extend
from twinfold.operators.components import connected_components
from twinfold.operators.meeting import group_links, pairs_in_limits
from twinfold.operators.ordering import numbered_rows
from twinfold.operators.similarity import banded_pairs
from twinfold.sources.scratch import stored


def numbered(clusters: DataFrame, min_size: int = 2) -> DataFrame:
    """photo_id, group_id from clusters (photo_id, cluster_id): sizes from min_size, numbers by smallest member."""
    groups = clusters.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"), F.min("photo_id").alias("first")).filter(F.col("size") >= min_size)
    ids = numbered_rows(groups.select("cluster_id", "first"), "first", "group_id").select("cluster_id", "group_id")
    return clusters.join(ids, "cluster_id").select("photo_id", "group_id")


def primary_groups(pairs: DataFrame) -> DataFrame:
    """photo_id, group_id by complete linkage over similar pairs (id_1, id_2, phash_dist, dhash_dist)."""
    return numbered(complete_linkage(pairs))


#: Fixed value: the most bits between two linked photos of the first generation.
LEGACY_THRESHOLD = 8


def legacy_groups(photos: DataFrame, threshold: int = LEGACY_THRESHOLD) -> DataFrame:
    """photo_id, group_id: the first generation's single linkage, on one hash alone; photos need id, phash."""
    return component_groups(banded_pairs(photos, threshold))


def component_groups(pairs: DataFrame) -> DataFrame:
    """photo_id, group_id by plain connectivity."""
    return numbered(connected_components(pairs, "id_1", "id_2").select(F.col("node").alias("photo_id"), F.col("label").alias("cluster_id")))


def _with_groups(pairs: DataFrame, groups: DataFrame, how: str = "left") -> DataFrame:
    one, two = groups.select(F.col("photo_id").alias("id_1"), F.col("group_id").alias("g1")), groups.select(F.col("photo_id").alias("id_2"), F.col("group_id").alias("g2"))
    return pairs.join(one, "id_1", how).join(two, "id_2", how)


def unlinked_pairs(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The similar pairs that ended in different groups, with the reason; two singles never count."""
    reason = F.when(F.col("g1").isNull() & F.col("g2").isNull(), "both_singleton").when(F.col("g1").isNull() | F.col("g2").isNull(), "one_singleton").otherwise("different_groups")
    return _with_groups(pairs, groups).filter(~F.col("g1").eqNullSafe(F.col("g2"))).withColumn("reason", reason).drop("g1", "g2")


def bridges(unlinked: DataFrame, groups: DataFrame, min_bridges: int = 50) -> DataFrame:
    """g1 < g2, bridges: group pairs joined by enough unlinked pairs."""
    both = _with_groups(unlinked.filter("reason = 'different_groups'"), groups, "inner")
    return both.groupBy(F.least("g1", "g2").alias("lo"), F.greatest("g1", "g2").alias("hi")).agg(F.count(F.lit(1)).alias("bridges")).filter(F.col("bridges") >= min_bridges).select(F.col("lo").alias("g1"), F.col("hi").alias("g2"), "bridges")


def bridges_at(members: DataFrame, most: int, min_bridges: int = 50, column: str = "phash", blocks: int | None = None) -> DataFrame:
    """g1 < g2, bridges: group pairs joined by enough pairs at most so far apart by one hash; these are counted, not written.

    members: id, group_id and the hash; a photo is in one group.
    """
    return group_links(members, column, most, blocks).filter(F.col("bridges") >= min_bridges)


def merge_map(group_pairs: DataFrame) -> DataFrame:
    """old -> new (the smallest id reachable) for groups that change."""
    return connected_components(group_pairs, "g1", "g2").filter("node <> label").select(F.col("node").alias("old"), F.col("label").alias("new"))


def merge_groups(groups: DataFrame, mapping: DataFrame) -> DataFrame:
    return groups.join(mapping, F.col("group_id") == F.col("old"), "left").select("photo_id", F.coalesce("new", "group_id").alias("group_id"))


def still_unlinked(unlinked: DataFrame, groups: DataFrame) -> DataFrame:
    """Without the pairs that a merger has brought into one group."""
    same = _with_groups(unlinked.select("id_1", "id_2"), groups, "inner").filter("g1 = g2").select("id_1", "id_2")
    return unlinked.join(same, ["id_1", "id_2"], "left_anti")


def merge_by_bridges(unlinked: DataFrame, groups: DataFrame, min_bridges: int = 50) -> tuple[DataFrame, DataFrame]:
    """(groups, unlinked pairs) after one pass; counts are not taken again."""
    merged = merge_groups(groups, merge_map(bridges(unlinked, groups, min_bridges)))
    return merged, still_unlinked(unlinked, merged)


def merge_stats(pairs: DataFrame, unlinked: DataFrame, groups: DataFrame) -> DataFrame:
    """pairs, merged, targets, removed_pairs, groups, photos: what a merger of group pairs (g1, g2) did, in one row."""
    mapping = stored(merge_map(pairs), "merges")
    merged = merge_groups(groups, mapping)
    gone = _with_groups(unlinked.select("id_1", "id_2"), merged, "inner").filter("g1 = g2")
    parts = [
        pairs.agg(F.count(F.lit(1)).alias("pairs")),
        mapping.agg(F.count(F.lit(1)).alias("merged"), F.countDistinct("new").alias("targets")),
        gone.agg(F.count(F.lit(1)).alias("removed_pairs")),
        merged.agg(F.countDistinct("group_id").alias("groups"), F.count(F.lit(1)).alias("photos")),
    ]
    return beside(*parts)


def beside(*rows: DataFrame) -> DataFrame:
    """Tables of one row each as one row."""
    keyed = [r.withColumn("__one", F.lit(1)) for r in rows]
    out = keyed[0]
    for r in keyed[1:]:
        out = out.join(r, "__one")
    return out.drop("__one")


def boundary(cells: DataFrame) -> DataFrame:
    """kind, colorhash_dist, max_phash16 from cells (kind, cell "p,c")."""
    parts = F.split("cell", ",")
    return cells.groupBy("kind", F.get(parts, F.lit(1)).cast("int").alias("colorhash_dist")).agg(F.max(F.get(parts, F.lit(0)).cast("int")).alias("max_phash16"))


def within(pairs: DataFrame, limits: DataFrame) -> DataFrame:
    """Pairs at or below the limit of their colorhash distance; no limit, no pair."""
    return pairs.join(F.broadcast(limits.select("colorhash_dist", "max_phash16")), "colorhash_dist").filter("phash16_dist <= max_phash16").drop("max_phash16")


def review_zone(relaxed: DataFrame, strict: DataFrame) -> DataFrame:
    """colorhash_dist, lo, hi where the relaxed limit goes beyond the strict one."""
    joined = relaxed.select("colorhash_dist", F.col("max_phash16").alias("hi")).join(strict.select("colorhash_dist", F.col("max_phash16").alias("strict_max")), "colorhash_dist", "left")
    return joined.withColumn("lo", F.coalesce(F.col("strict_max") + 1, F.lit(0))).filter("hi >= lo").select("colorhash_dist", "lo", "hi")


def pairs_in_zone(pairs: DataFrame, zone: DataFrame) -> DataFrame:
    """Pairs whose distances lie in the zone. The zone has one row per colorhash distance, 15 at most."""
    return pairs.join(F.broadcast(zone), "colorhash_dist").filter(F.col("phash16_dist").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")


def _limits_by_distance(zone: DataFrame) -> tuple[list[int], list[int]]:
    """(lo, hi) by colorhash_dist, 0 to 64, from a zone with one row per distance at most; 1 and 0 where it has none."""
    rows = zone.filter(F.col("colorhash_dist").between(0, 64)).groupBy("colorhash_dist").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    low, high = [1] * 65, [0] * 65
    for r in rows:
        low[r["colorhash_dist"]], high[r["colorhash_dist"]] = r["lo"], r["hi"]
    return low, high


def pairs_met_in_zone(photos: DataFrame, zone: DataFrame, blocks: int | None = None) -> DataFrame:
    """pairs_in_zone of all pairs of photos (words spread), without a row for any other pair."""
    return pairs_in_limits(photos, *_limits_by_distance(zone), blocks)


def pairs_within(photos: DataFrame, limits: DataFrame, blocks: int | None = None) -> DataFrame:
    """within of all pairs of photos (words spread), without a row for any other pair."""
    return pairs_met_in_zone(photos, limits.select("colorhash_dist", F.lit(0).alias("lo"), F.col("max_phash16").alias("hi")), blocks)


def second_groups(pairs: DataFrame, relaxed: DataFrame, strict: DataFrame, include_isolated: bool = False) -> DataFrame:
    """photo_id, group_id: complete linkage within relaxed limits, then extension by pairs within strict ones.

    As published, photos without a relaxed edge are not offered to the extension; include_isolated does.
    """
    near = within(pairs, relaxed).select(F.col("photo_id_1").alias("id_1"), F.col("photo_id_2").alias("id_2"), "phash16_dist", "colorhash_dist")
    kernels = complete_linkage(near, keys=("phash16_dist", "colorhash_dist"))
    sizes = kernels.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    members = kernels.join(sizes, "cluster_id").select("photo_id", F.when(F.col("n") > 1, F.col("cluster_id")).alias("cluster_id"))
    kind = members.schema["cluster_id"].dataType
    tight = within(pairs, strict).select(F.col("photo_id_1").alias("id_1"), F.col("photo_id_2").alias("id_2"))
    if include_isolated:
        ends = tight.select(F.col("id_1").alias("photo_id")).unionByName(tight.select(F.col("id_2").alias("photo_id"))).distinct()
        members = members.unionByName(ends.join(members, "photo_id", "left_anti").withColumn("cluster_id", F.lit(None).cast(kind)))
    else:
        known = members.select("photo_id")
        tight = tight.join(known.withColumnRenamed("photo_id", "id_1"), "id_1", "left_semi").join(known.withColumnRenamed("photo_id", "id_2"), "id_2", "left_semi")
    return numbered(single_linkage_extend(members, tight))


def composite_groups(primary: DataFrame, second: DataFrame, kept: DataFrame) -> DataFrame:
    """photo_id, group_id: kept photos that either grouping holds together, directly or in turn."""
    live = primary.join(kept.select(F.col("id").alias("photo_id")), "photo_id", "left_semi")

    def star(groups: DataFrame) -> DataFrame:
        hubs = groups.groupBy("group_id").agg(F.min("photo_id").alias("dst"))
        return groups.join(hubs, "group_id").select(F.col("photo_id").alias("src"), "dst")

    labels = connected_components(star(live).unionByName(star(second)))
    return numbered(labels.select(F.col("node").alias("photo_id"), F.col("label").alias("cluster_id")))


def expand_to_groups(photos: DataFrame, groups: DataFrame) -> DataFrame:
    """entity, photo_id: each entity's photos and all members of their groups.

    What is expanded isn't made distinct, but what it is expanded from, unless some photo is in several groups.
    """
    held = stored(groups.filter("group_id is not null and photo_id is not null").select("photo_id", "group_id").distinct(), "groups")
    touched = photos.join(held, "photo_id").select("entity", "group_id").distinct()
    mates = touched.join(held, "group_id").select("entity", "photo_id")
    alone = photos.select("entity", "photo_id").join(held, "photo_id", "left_anti").select("entity", "photo_id").distinct()
    found = alone.unionByName(mates)
    several = held.groupBy("photo_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return found if several.isEmpty() else found.distinct()
