"""Named queries of the catalog: selections, counts, statistics, representatives, pages, review order.

Tables: photos (id, ...), paths (path_id, photo_id, source_path, filename), decisions (photo_id, decision,
rule_name), groups (photo_id, group_id), rejections (photo_id, group_id, rule_name), junk (photo_id, group_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinfold.functions import exprs as X
from twinfold.operators.ranges import RangedTable, neighbours_in_order
from twinfold.operators.rules import with_paths

# ---- selections -------------------------------------------------------------


def without(photos: DataFrame, *tables: DataFrame) -> DataFrame:
    """Photos that none of the tables (photo_id) names."""
    for t in tables:
        photos = photos.join(t.select(F.col("photo_id").alias("__x")), photos["id"] == F.col("__x"), "left_anti")
    return photos


def undecided(photos: DataFrame, paths: DataFrame, decisions: DataFrame) -> DataFrame:
    return with_paths(without(photos, decisions), paths)


def needing_hash(photos: DataFrame, paths: DataFrame, decisions: DataFrame) -> DataFrame:
    """id, source_path (the first) of undecided photos that lack a hash."""
    todo = without(photos.filter("phash is null or dhash is null"), decisions).select("id")
    first = paths.groupBy(F.col("photo_id").alias("id")).agg(F.min_by("source_path", "path_id").alias("source_path"))
    return todo.join(first, "id")


def for_grouping(photos: DataFrame, decisions: DataFrame) -> DataFrame:
    return without(photos.filter("phash is not null and dhash is not null"), decisions)


def members_with_paths(groups: DataFrame, photos: DataFrame, paths: DataFrame) -> DataFrame:
    """All members of all groups, with their paths."""
    return with_paths(groups.join(photos, groups["photo_id"] == photos["id"]).drop("photo_id"), paths)


def group_ids(groups: DataFrame) -> DataFrame:
    return groups.select("group_id").distinct().orderBy("group_id")


def accepted(photos: DataFrame, paths: DataFrame, decisions: DataFrame, rejections: DataFrame) -> DataFrame:
    return with_paths(without(photos, decisions, rejections), paths)


def kept(photos: DataFrame, decisions: DataFrame, rejections: DataFrame, junk: DataFrame) -> DataFrame:
    return without(photos, decisions, rejections, junk)


def needing_wide_hash(kept_photos: DataFrame, extended: DataFrame) -> DataFrame:
    return without(kept_photos, extended)


def with_primary_group(kept_photos: DataFrame, groups: DataFrame) -> DataFrame:
    return kept_photos.join(groups, kept_photos["id"] == groups["photo_id"], "left").drop("photo_id")


def clear_stage(table: DataFrame, *columns: str) -> DataFrame:
    """An empty table, or with columns given, the table with these set to null."""
    return table.withColumns({c: F.lit(None).cast(table.schema[c].dataType) for c in columns}) if columns else table.filter(F.lit(False))


def missing_tables(spark: SparkSession, names: list[str]) -> list[str]:
    return [n for n in names if not spark.catalog.tableExists(n)]


def page_by_rule(decisions: DataFrame, rule: str, page: int, size: int = 50) -> DataFrame:
    return RangedTable.of(decisions.filter(F.col("rule_name") == rule), "photo_id").page(page, size)


def search_paths(paths: DataFrame, text: str, score: Column, top: int = 50) -> DataFrame:
    """The best scored paths that hold text, whatever the case."""
    return paths.filter(F.contains(F.lower("source_path"), F.lit(text.lower()))).withColumn("score", score).orderBy(F.desc("score"), "path_id").limit(top)


def unreviewed(groups: DataFrame, reviewed: DataFrame) -> DataFrame:
    return groups.select("group_id").distinct().join(reviewed.select("group_id"), "group_id", "left_anti")


def in_list_order(photos: DataFrame, ids: list[str]) -> DataFrame:
    wanted = photos.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, ids))).alias("pos", "__id"))
    return wanted.join(photos, photos["id"] == wanted["__id"]).drop("__id").orderBy("pos")


# ---- aggregations -----------------------------------------------------------


def status(photos: DataFrame, decisions: DataFrame, groups: DataFrame, rejections: DataFrame) -> DataFrame:
    """item, n: the totals of a status page, one scan per table."""
    rows = [("photos", photos.agg(F.count(F.lit(1)))), ("decided", decisions.agg(F.count(F.lit(1)))), ("grouped", groups.agg(F.count(F.lit(1)))), ("groups", groups.agg(F.countDistinct("group_id"))), ("rejected", rejections.agg(F.count(F.lit(1))))]
    out = None
    for name, df in rows:
        row = df.toDF("n").select(F.lit(name).alias("item"), F.col("n").cast("long").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def rule_tallies(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision", "rule_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "rule_name")


def size_distribution(groups: DataFrame) -> DataFrame:
    return groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("groups"))


def groups_sized(groups: DataFrame, least: int = 2, exactly: int | None = None) -> DataFrame:
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.filter(F.col("size") == exactly if exactly is not None else F.col("size") >= least)


def group_stats(groups: DataFrame) -> DataFrame:
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("size"), F.lit(0)).alias("photos"), F.min("group_id").alias("min_id"), F.max("group_id").alias("max_id"), F.max("size").alias("largest"))


def first_distances(pairs: DataFrame, column: str, top: int = 10) -> DataFrame:
    """dist, n of pairs across groups, the smallest distances."""
    return pairs.filter("same_primary_group = 0").groupBy(F.col(column).alias("dist")).agg(F.count(F.lit(1)).alias("n")).orderBy("dist").limit(top)


def first_counted(counts: DataFrame, column: str, top: int = 10) -> DataFrame:
    """The same from pairs that are counted (column, same_primary_group, pairs)."""
    return counts.filter("same_primary_group = 0").groupBy(F.col(column).alias("dist")).agg(F.sum("pairs").alias("n")).orderBy("dist").limit(top)


def heatmap(summary: DataFrame, across: str = "phash16_dist", down: str = "colorhash_dist") -> DataFrame:
    """across, down, cross, same: a pair summary rolled up to two dimensions."""
    same = F.col("same_primary_group") == 1
    return summary.groupBy(across, down).agg(F.sum(F.when(~same, F.col("count")).otherwise(0)).alias("cross"), F.sum(F.when(same, F.col("count")).otherwise(0)).alias("same"))


def bridge_report(unlinked: DataFrame, groups: DataFrame, photos: DataFrame) -> DataFrame:
    """g1, g2, bridges, min_phash, max_phash, avg_phash, size_1, size_2, rep_1, rep_2."""
    one, two = groups.select(F.col("photo_id").alias("id_1"), F.col("group_id").alias("a")), groups.select(F.col("photo_id").alias("id_2"), F.col("group_id").alias("b"))
    both = unlinked.filter("reason = 'different_groups'").join(one, "id_1").join(two, "id_2")
    pairs = both.groupBy(F.least("a", "b").alias("g1"), F.greatest("a", "b").alias("g2")).agg(F.count(F.lit(1)).alias("bridges"), F.min("phash_dist").alias("min_phash"), F.max("phash_dist").alias("max_phash"), F.round(F.avg("phash_dist"), 1).alias("avg_phash"))
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"))
    about = sizes.join(representatives(groups, photos).select("group_id", F.col("photo_id").alias("rep")), "group_id")
    left, right = about.toDF("g1", "size_1", "rep_1"), about.toDF("g2", "size_2", "rep_2")
    return pairs.join(left, "g1").join(right, "g2")


def score_buckets(photos: DataFrame) -> DataFrame:
    """bucket, n, avg_score, min_score, max_score, percent."""
    per = photos.groupBy(X.confidence_bucket(F.col("score")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 1).alias("avg_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))
    return per.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))


def top_cameras(photos: DataFrame, top: int = 10) -> DataFrame:
    return photos.groupBy(F.concat("exif_make", F.lit(" "), "exif_model").alias("camera")).agg(F.count(F.lit(1)).alias("n")).filter("camera is not null").orderBy(F.desc("n"), "camera").limit(top)


def hash_copies(photos: DataFrame) -> DataFrame:
    return photos.agg(F.count("phash").alias("hashed"), F.countDistinct("phash").alias("distinct_hashes")).withColumn("repeats", F.col("hashed") - F.col("distinct_hashes"))


def uneven_groups(groups: DataFrame, photos: DataFrame, ratio: float = 2.0, least: int = 3, top: int = 50) -> DataFrame:
    """Groups whose largest member has more than ratio times the pixels of the smallest, the most uneven first."""
    sized = groups.join(photos.select(F.col("id").alias("photo_id"), X.resolution(F.col("width"), F.col("height")).alias("res")), "photo_id")
    per = sized.groupBy("group_id").agg(F.count(F.lit(1)).alias("size"), F.max("res").alias("largest"), F.min("res").alias("smallest"))
    return per.filter((F.col("size") >= least) & (F.col("smallest") > 0)).withColumn("ratio", F.col("largest") / F.col("smallest")).filter(F.col("ratio") > ratio).orderBy(F.desc("ratio"), "group_id").limit(top)


def marker_counts(groups: DataFrame, photos: DataFrame, paths: DataFrame, first: int = 20, top: int = 10) -> DataFrame:
    """kind (keyword, prefix, suffix), marker, n: what the first paths of the members of the most uneven groups are marked by.

    Of each kind the top most frequent.
    """
    worst = uneven_groups(groups, photos).orderBy(F.desc("ratio"), "group_id").limit(first).select("group_id")
    path = paths.groupBy("photo_id").agg(F.min_by("source_path", "path_id").alias("path"))
    found = groups.join(worst, "group_id", "left_semi").join(path, "photo_id")
    kinds = {"keyword": X.path_keywords, "prefix": X.name_prefixes, "suffix": X.name_suffixes}
    marks = F.concat(*[_marked(kind, make(F.col("path"))) for kind, make in kinds.items()])
    counted = found.select(F.explode(marks).alias("m")).groupBy("m.kind", "m.marker").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("kind").orderBy(F.desc("n"), "marker")
    return counted.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= top).drop("turn")


def _marked(kind: str, marks: Column) -> Column:
    return F.transform(marks, lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("marker")))


def name_collisions(groups: DataFrame, paths: DataFrame) -> DataFrame:
    """group_id, base, n: file names that several members of a group share."""
    named = groups.join(paths, "photo_id").select("group_id", X.collision_base(F.col("source_path")).alias("base"))
    return named.groupBy("group_id", "base").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def distance_context(pairs: DataFrame, photos: DataFrame, most: int = 20) -> DataFrame:
    """phash_dist, n, both_thumb, either_thumb, ratio_2, ratio_4, same_stem, same_dir for pairs up to most.

    Photos need id, path and file_size.
    """
    facts = photos.select("id", X.is_thumbnail(F.col("path")).alias("thumb"), F.greatest("file_size", F.lit(1)).cast("double").alias("size"), X.stem(F.col("path")).alias("stem"), F.regexp_replace("path", "/[^/]*$", "").alias("dir"))
    one, two = facts.toDF(*[f"{c}_1" for c in facts.columns]), facts.toDF(*[f"{c}_2" for c in facts.columns])
    full = pairs.filter(F.col("phash_dist") <= most).join(one, "id_1").join(two, "id_2")
    ratio = F.greatest("size_1", "size_2") / F.least("size_1", "size_2")
    flags = {"both_thumb": F.col("thumb_1") & F.col("thumb_2"), "either_thumb": F.col("thumb_1") | F.col("thumb_2"), "ratio_2": ratio > 2, "ratio_4": ratio > 4, "same_stem": F.col("stem_1") == F.col("stem_2"), "same_dir": F.col("dir_1") == F.col("dir_2")}
    return full.groupBy("phash_dist").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in flags.items()])


def natural_gap(histogram: DataFrame, low: int = 5, high: int = 20) -> DataFrame:
    """threshold, ratio: one below the distance where the histogram (dist, pairs) grows least from the one before."""
    before = histogram.select((F.col("dist") + 1).alias("dist"), F.col("pairs").alias("before"))
    ratios = histogram.join(before, "dist").filter((F.col("dist") > low) & (F.col("dist") < high)).withColumn("ratio", F.col("pairs") / F.col("before"))
    return ratios.orderBy("ratio", "dist").limit(1).select((F.col("dist") - 1).alias("threshold"), "ratio")


def review_stats(groups: DataFrame, reviewed: DataFrame, junk: DataFrame) -> DataFrame:
    total = groups.agg(F.countDistinct("group_id").alias("total"))
    done = groups.select("group_id").distinct().join(reviewed.select("group_id").distinct(), "group_id", "left_semi").agg(F.count(F.lit(1)).alias("reviewed"))
    gone = junk.agg(F.count(F.lit(1)).alias("junk"))
    rows = [df.select(F.lit(df.columns[0]).alias("item"), F.col(df.columns[0]).cast("long").alias("n")) for df in (total, done, gone)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# ---- order, representatives, pages -----------------------------------------


def representatives(groups: DataFrame, photos: DataFrame) -> DataFrame:
    """group_id, photo_id: the member with most pixels, then most bytes, then the smallest id."""
    rows = groups.join(photos.select(F.col("id").alias("photo_id"), X.resolution(F.col("width"), F.col("height")).alias("res"), "file_size"), "photo_id")
    order = Window.partitionBy("group_id").orderBy(F.desc("res"), F.desc_nulls_last("file_size"), "photo_id")
    return rows.withColumn("__n", F.row_number().over(order)).filter("__n = 1").select("group_id", "photo_id", "res")


def review_order(groups: DataFrame, photos: DataFrame) -> DataFrame:
    """kind, group_id, photo_id, res: groups by their representative's pixels, then single photos, to be read in order."""
    first = representatives(groups, photos).select(F.lit(0).alias("kind"), "group_id", "photo_id", "res")
    single = without(photos, groups).select(F.lit(1).alias("kind"), F.lit(None).cast(groups.schema["group_id"].dataType).alias("group_id"), F.col("id").alias("photo_id"), X.resolution(F.col("width"), F.col("height")).alias("res"))
    return first.unionByName(single).orderBy("kind", F.desc("res"), "photo_id")


def neighbours(groups: DataFrame) -> DataFrame:
    """group_id, previous, next among the groups."""
    return neighbours_in_order(groups, "group_id")


def page(rows: DataFrame, number: int, size: int, *order: str) -> DataFrame:
    """One page of rows; whoever turns several keeps the RangedTable."""
    return RangedTable.of(rows, *order).page(number, size)


def nearest_cells(pairs: DataFrame, p: int, c: int, reach: int = 0, limit: int = 24) -> DataFrame:
    off = F.abs(F.col("phash16_dist") - p) + F.abs(F.col("colorhash_dist") - c)
    return pairs.withColumn("off", off).filter(F.col("off") <= reach).orderBy("off", "photo_id_1", "photo_id_2").limit(limit)


def first_pair_per_groups(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """g1, g2, photo_id_1, photo_id_2: for each two groups that any pair joins, its first pair."""
    one, two = groups.select(F.col("photo_id").alias("photo_id_1"), F.col("group_id").alias("a")), groups.select(F.col("photo_id").alias("photo_id_2"), F.col("group_id").alias("b"))
    both = pairs.join(one, "photo_id_1").join(two, "photo_id_2").filter("a <> b")
    first = F.min(F.struct("photo_id_1", "photo_id_2"))
    return both.groupBy(F.least("a", "b").alias("g1"), F.greatest("a", "b").alias("g2")).agg(first.alias("x")).select("g1", "g2", "x.photo_id_1", "x.photo_id_2")


def next_unrated(counts: DataFrame, ratings: DataFrame, p: int, c: int, max_c: int = 14, max_p: int = 150, full: int = 5) -> DataFrame:
    """p, c: the first cell with pairs and without rating after (p, c), in row order.

    A row of cells (one p) is done with once two neighbouring cells in it are rated full.
    """
    order = Window.partitionBy("p").orderBy("c")
    top = ratings.filter(F.col("rating") == full)
    done = top.withColumn("gap", F.col("c") - F.lag("c").over(order)).filter("gap = 1").select("p").distinct()
    open_cells = counts.filter((F.col("p") <= max_p) & (F.col("c") <= max_c)).join(ratings.select("p", "c"), ["p", "c"], "left_anti").join(done, "p", "left_anti")
    return open_cells.filter((F.col("p") > p) | ((F.col("p") == p) & (F.col("c") > c))).agg(F.min(F.struct("p", "c")).alias("x")).filter("x is not null").select("x.p", "x.c")


def boundary_edges(cells: DataFrame) -> DataFrame:
    """p, c, right, bottom: marked cells at whose right or lower side the marked area ends."""
    right = cells.select((F.col("c") - 1).alias("c"), "p", F.lit(1).alias("r"))
    below = cells.select("c", (F.col("p") - 1).alias("p"), F.lit(1).alias("b"))
    return cells.select("p", "c").join(right, ["p", "c"], "left").join(below, ["p", "c"], "left").select("p", "c", F.col("r").isNull().alias("right"), F.col("b").isNull().alias("bottom"))


def pair_details(unlinked: DataFrame, photos: DataFrame, groups: DataFrame) -> DataFrame:
    """Unlinked pairs with both photos' pixels and groups."""
    about = photos.select("id", X.resolution(F.col("width"), F.col("height")).alias("res"))
    one, two = about.toDF("id_1", "res_1"), about.toDF("id_2", "res_2")
    g1, g2 = groups.toDF("id_1", "group_1"), groups.toDF("id_2", "group_2")
    return unlinked.join(one, "id_1").join(two, "id_2").join(g1, "id_1", "left").join(g2, "id_2", "left")


def pair_lookup(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pairs asked for in either order (x, y)."""
    normal = wanted.select(F.least("x", "y").alias("photo_id_1"), F.greatest("x", "y").alias("photo_id_2"))
    return pairs.join(normal.distinct(), ["photo_id_1", "photo_id_2"])


def doubtful_doubles(second: DataFrame, primary: DataFrame) -> DataFrame:
    """group_id, photo_1, photo_2: second groups of two whose members the primary grouping doesn't hold together."""
    pair = second.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.min("photo_id").alias("photo_1"), F.max("photo_id").alias("photo_2")).filter("n = 2").drop("n")
    a, b = primary.toDF("photo_1", "p1"), primary.toDF("photo_2", "p2")
    return pair.join(a, "photo_1", "left").join(b, "photo_2", "left").filter(~F.coalesce(F.col("p1") == F.col("p2"), F.lit(False))).select("group_id", "photo_1", "photo_2")
