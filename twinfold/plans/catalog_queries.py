"""Queries F, A and W: selections, aggregations, windows and pages over the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinfold.functions import exprs as X
from twinfold.operators import catalog as C
from twinfold.operators.grouping import expand_to_groups
from twinfold.plans.register import Registry
from twinfold.sources.legacy import is_thumbnail_legacy

R = Registry()
_P = ["id", "array_join(paths, '|') AS paths"]
_PSQL = "photos.id, coalesce(array_to_string(listed.paths, '|'), '') AS paths"

R.add("f1_undecided", lambda c: C.undecided(c.bare, c.paths, c.small("decisions")).selectExpr(*_P), f"SELECT {_PSQL} FROM photos LEFT JOIN listed ON listed.photo_id = photos.id WHERE photos.id NOT IN (SELECT photo_id FROM decisions)", "photos", "listed", "decisions")
R.add(
    "f2_needing_hash",
    lambda c: C.needing_hash(c.bare.withColumn("phash", F.when(F.col("L") % 2 == 0, 1)).withColumn("dhash", F.lit(1)), c.paths, c.small("decisions")),
    "SELECT photos.id, first.source_path FROM photos JOIN (SELECT photo_id, arg_min(source_path, path_id) AS source_path FROM paths GROUP BY 1) first ON first.photo_id = photos.id WHERE L % 2 <> 0 AND NOT EXISTS (SELECT 1 FROM decisions d WHERE d.photo_id = photos.id)",
    "photos", "paths", "decisions",
)
R.add("f3_for_grouping", lambda c: C.for_grouping(c.photos, c.small("decisions")).select("id"), "SELECT id FROM hashes WHERE id NOT IN (SELECT photo_id FROM decisions)", "hashes", "decisions")
R.add("f4_members_with_paths", lambda c: C.members_with_paths(c.small("members"), c.bare, c.paths).selectExpr("group_id", *_P), f"SELECT group_id, {_PSQL} FROM members JOIN photos ON photos.id = members.photo_id LEFT JOIN listed ON listed.photo_id = photos.id", "members", "listed")
R.add("f5_group_ids", lambda c: C.group_ids(c.small("members")), "SELECT DISTINCT group_id FROM members ORDER BY 1", "members")
R.add(
    "f6_status",
    lambda c: C.status(c.bare, c.small("decisions"), c.small("members"), c.small("rejections")),
    "SELECT 'photos' AS item, count(*) AS n FROM photos UNION ALL SELECT 'decided', count(*) FROM decisions UNION ALL SELECT 'grouped', count(*) FROM members UNION ALL SELECT 'groups', count(DISTINCT group_id) FROM members UNION ALL SELECT 'rejected', count(*) FROM rejections",
    "photos", "decisions", "members", "rejections",
)
R.add("f8_clear_stage", lambda c: C.clear_stage(c.bare.select("id", "width"), "width").agg(F.count(F.lit(1)).alias("photos"), F.count("width").alias("filled")), "SELECT count(*) AS photos, CAST(0 AS BIGINT) AS filled FROM photos", "photos")
R.add(
    "f9_accepted",
    lambda c: C.accepted(c.bare, c.paths, c.small("decisions"), c.small("rejections")).selectExpr(*_P),
    f"SELECT {_PSQL} FROM photos LEFT JOIN listed ON listed.photo_id = photos.id WHERE NOT EXISTS (SELECT 1 FROM decisions d WHERE d.photo_id = photos.id) AND NOT EXISTS (SELECT 1 FROM rejections r WHERE r.photo_id = photos.id)",
    "photos", "listed", "decisions", "rejections",
)
_KEPT = "SELECT id FROM photos EXCEPT SELECT photo_id FROM decisions EXCEPT SELECT photo_id FROM rejections EXCEPT SELECT photo_id FROM junk"
_KEPT_TABLES = ("photos", "decisions", "rejections", "junk")


def _kept(c):
    return C.kept(c.bare, c.small("decisions"), c.small("rejections"), c.small("junk"))


R.add("f10_kept", lambda c: _kept(c).select("id"), _KEPT, *_KEPT_TABLES)
R.add("f11_needing_wide_hash", lambda c: C.needing_wide_hash(_kept(c), c.small("second")).select("id"), f"SELECT id FROM ({_KEPT}) EXCEPT SELECT photo_id FROM second", *_KEPT_TABLES, "second")
R.add("f12_with_primary_group", lambda c: C.with_primary_group(_kept(c), c.small("members")).select("id", "group_id"), f"SELECT k.id, m.group_id FROM ({_KEPT}) k LEFT JOIN members m ON m.photo_id = k.id", *_KEPT_TABLES, "members")
R.add("f14_page_by_rule", lambda c: C.page_by_rule(c.small("decisions"), "PHOTOBOOTH", 2, 20), "SELECT * FROM decisions WHERE rule_name = 'PHOTOBOOTH' ORDER BY photo_id LIMIT 20 OFFSET 20", "decisions")
R.add("f15_search_paths", lambda c: C.search_paths(c.paths, "img_", F.length("source_path")).select("path_id", "source_path", "score"), "SELECT path_id, source_path, CAST(length(source_path) AS INT) AS score FROM paths WHERE source_path ILIKE '%img\\_%' ESCAPE '\\' ORDER BY score DESC, path_id LIMIT 50", "paths")
R.add("f16_unreviewed", lambda c: C.unreviewed(c.small("members"), c.small("reviewed")), "SELECT DISTINCT group_id FROM members WHERE group_id NOT IN (SELECT group_id FROM reviewed)", "members", "reviewed")
R.add("f17_not_rejected", lambda c: C.without(c.bare, c.small("rejections")).select("id", "exif_datetime").orderBy(F.col("exif_datetime").asc_nulls_first(), "id"), "SELECT id, exif_datetime FROM photos WHERE NOT EXISTS (SELECT 1 FROM rejections r WHERE r.photo_id = photos.id) ORDER BY exif_datetime NULLS FIRST, id", "photos", "rejections")
R.add("f18_in_list_order", lambda c: C.in_list_order(c.table("nation").selectExpr("n_name AS id", "n_regionkey"), ["NATION_7", "NATION_2", "NATION_11"]), "SELECT CAST(x.pos AS INT) AS pos, n_name AS id, n_regionkey FROM nation JOIN (VALUES (0, 'NATION_7'), (1, 'NATION_2'), (2, 'NATION_11')) x(pos, name) ON name = n_name ORDER BY pos")

R.add("a1_path_lists", lambda c: c.paths.groupBy("photo_id").agg(F.expr("listagg(source_path, '|') WITHIN GROUP (ORDER BY path_id)").alias("paths")), "SELECT photo_id, string_agg(source_path, '|' ORDER BY path_id) AS paths FROM paths GROUP BY photo_id", "paths")
R.add("a2_counts", lambda c: c.small("rejections").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("group_id").alias("groups")), "SELECT count(*) AS n, count(DISTINCT group_id) AS groups FROM rejections", "rejections")
R.add("a3_rule_tallies", lambda c: C.rule_tallies(c.small("decisions")), "SELECT decision, rule_name, count(*) AS n FROM decisions GROUP BY 1, 2 ORDER BY n DESC, rule_name", "decisions")
R.add("a4_size_distribution", lambda c: C.size_distribution(c.small("members")), "SELECT size, count(*) AS groups FROM (SELECT count(*) AS size FROM members GROUP BY group_id) GROUP BY size", "members")
R.add("a10_groups_sized", lambda c: C.groups_sized(c.small("second"), exactly=2), "SELECT group_id, count(*) AS size FROM second GROUP BY 1 HAVING count(*) = 2", "second")
R.add("a11_next_group_id", lambda c: c.small("members").agg((F.coalesce(F.max("group_id"), F.lit(0)) + 1).alias("next_id")), "SELECT coalesce(max(group_id), 0) + 1 AS next_id FROM members", "members")
R.add("a12_group_stats", lambda c: C.group_stats(c.small("members")), "SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS photos, min(group_id) AS min_id, max(group_id) AS max_id, max(n) AS largest FROM (SELECT group_id, count(*) AS n FROM members GROUP BY 1)", "members")
R.add(
    "a13_conditional_sums",
    lambda c: c.bare.agg(F.count_if(F.col("exif_make").isNotNull()).alias("with_make"), F.sum(F.when(F.col("L") > 2000, 1).otherwise(0)).alias("long_texts")),
    "SELECT count(exif_make) AS with_make, CAST(count(*) FILTER (L > 2000) AS BIGINT) AS long_texts FROM photos", "photos",
)
_SCORED = "SELECT id, L % 101 AS score FROM photos"
R.add(
    "a14_score_buckets",
    lambda c: C.score_buckets(c.bare.selectExpr("id", "L % 101 AS score")),
    f"SELECT bucket, n, avg_score, min_score, max_score, round(100.0 * n / sum(n) OVER (), 1) AS percent FROM (SELECT CASE WHEN score >= 70 THEN 'high' WHEN score >= 40 THEN 'medium' ELSE 'low' END AS bucket, count(*) AS n, round(avg(score), 1) AS avg_score, min(score) AS min_score, max(score) AS max_score FROM ({_SCORED}) GROUP BY 1)", "photos",
)
R.add("a15_top_cameras", lambda c: C.top_cameras(c.bare), "SELECT exif_make || ' ' || exif_model AS camera, count(*) AS n FROM photos WHERE exif_make IS NOT NULL AND exif_model IS NOT NULL GROUP BY 1 ORDER BY n DESC, camera LIMIT 10", "photos")
R.add("a16_hash_copies", lambda c: C.hash_copies(c.hashes), "SELECT count(*) AS hashed, count(DISTINCT (p_hi, p_lo)) AS distinct_hashes, count(*) - count(DISTINCT (p_hi, p_lo)) AS repeats FROM hashes", "hashes")
_UNEVEN = "SELECT group_id, count(*) AS size, max(width * height) AS largest, min(width * height) AS smallest, max(width * height) / min(width * height) AS ratio FROM members JOIN photos ON id = photo_id GROUP BY 1 HAVING count(*) >= 3 AND min(width * height) > 0 AND max(width * height) / min(width * height) > 2 ORDER BY ratio DESC, group_id LIMIT 50"
R.add(
    "a17_uneven_groups",
    lambda c: C.uneven_groups(c.small("members"), c.bare),
    _UNEVEN, "members",
)
_STEM = r"regexp_replace(split_part(path, '/', -1), '(.)\.[^.]+$', '\1')"
R.add(
    "a18_marker_counts",
    lambda c: C.marker_counts(c.small("members"), c.bare, c.paths),
    rf"""SELECT kind, marker, n FROM (SELECT kind, marker, count(*) AS n, row_number() OVER (PARTITION BY kind ORDER BY count(*) DESC, marker) AS turn FROM (
    SELECT 'keyword' AS kind, marker FROM (SELECT unnest(string_split(path, '/')) AS marker FROM worst) WHERE regexp_matches(lower(marker), 'thumb|cache|preview|resized')
    UNION ALL SELECT 'prefix', CASE WHEN starts_with(lower({_STEM}), 'img_') THEN 'img_' ELSE 'thumb_' END FROM worst WHERE regexp_matches({_STEM}, '(?i)^(img|thumb)_')
    UNION ALL SELECT 'suffix', regexp_extract({_STEM}, '_\d\d\d\d?$') FROM worst WHERE regexp_matches({_STEM}, '_\d\d\d\d?$')
    UNION ALL SELECT 'suffix', lower(regexp_extract({_STEM}, '(?i)_(thumb|small)$')) FROM worst WHERE regexp_matches({_STEM}, '(?i)_(thumb|small)$')) GROUP BY 1, 2) WHERE turn <= 10""".replace("FROM worst", f"FROM (SELECT arg_min(source_path, path_id) AS path FROM paths JOIN members USING (photo_id) WHERE group_id IN (SELECT group_id FROM ({_UNEVEN}) ORDER BY ratio DESC, group_id LIMIT 20) GROUP BY photo_id)"),
    "paths", "members",
)
R.add(
    "a19_name_collisions",
    lambda c: C.name_collisions(c.small("members"), c.paths.withColumn("source_path", F.regexp_replace("source_path", r"\d{2,}", "9"))),
    r"""SELECT group_id, upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(filename, '\d{2,}', '9', 'g'), '(.)\.[^.]+$', '\1'), '^thumb_', '', 'i'), '_\d{3,4}$', ''), '_thumb$', '', 'i')) AS base, count(*) AS n
    FROM members JOIN paths USING (photo_id) GROUP BY 1, 2 HAVING count(*) > 1""", "members", "paths",
)
R.add("a22_review_stats", lambda c: C.review_stats(c.small("members"), c.small("reviewed"), c.small("junk")), "SELECT 'total' AS item, count(DISTINCT group_id) AS n FROM members UNION ALL SELECT 'reviewed', count(DISTINCT group_id) FROM members WHERE group_id IN (SELECT group_id FROM reviewed) UNION ALL SELECT 'junk', count(*) FROM junk", "members", "reviewed", "junk")
_REP = "SELECT group_id, photo_id, res FROM (SELECT group_id, photo_id, width * height AS res, row_number() OVER (PARTITION BY group_id ORDER BY width * height DESC, file_size DESC, photo_id) AS n FROM members JOIN photos ON id = photo_id) WHERE n = 1"
R.add("w1_representatives", lambda c: C.representatives(c.small("members"), c.bare), _REP, "members")
R.add(
    "w5_review_order",
    lambda c: C.review_order(c.small("members"), c.bare),
    f"SELECT 0 AS kind, group_id, photo_id, res FROM ({_REP}) UNION ALL SELECT 1, NULL, id, width * height FROM photos WHERE id NOT IN (SELECT photo_id FROM members)", "members",
)
R.add("w6_neighbours", lambda c: C.neighbours(c.small("members")), "SELECT group_id, lag(group_id) OVER (ORDER BY group_id) AS previous, lead(group_id) OVER (ORDER BY group_id) AS next FROM (SELECT DISTINCT group_id FROM members)", "members")
R.add("w7_page", lambda c: C.page(c.small("members"), 3, 28, "group_id", "photo_id"), "SELECT photo_id, group_id FROM members ORDER BY group_id, photo_id LIMIT 28 OFFSET 56", "members")
R.add("w9_sample", lambda c: c.small("members").orderBy(F.sha2(F.concat(F.lit("7"), "photo_id"), 256)).limit(30), "SELECT photo_id, group_id FROM members ORDER BY sha256('7' || photo_id) LIMIT 30", "members")
R.add("w4_first_paths", lambda c: c.paths.groupBy("photo_id").agg(F.min_by("source_path", "path_id").alias("source_path")), "SELECT photo_id, source_path FROM (SELECT *, row_number() OVER (PARTITION BY photo_id ORDER BY path_id) AS n FROM paths) WHERE n = 1", "paths")
_CELLS = "SELECT CAST(L % 40 AS INT) AS p, CAST(L % 15 AS INT) AS c, CAST(1 + L % 7 AS INT) AS r FROM photos"


def _cells(c):
    return c.bare.selectExpr("CAST(L % 40 AS INT) AS p", "CAST(L % 15 AS INT) AS c", "CAST(1 + L % 7 AS INT) AS r")


R.add(
    "w11_next_unrated",
    lambda c: C.next_unrated(_cells(c).select("p", "c").distinct(), _cells(c).groupBy("p", "c").agg(F.max("r").alias("rating")).filter("rating <= 5"), 3, 2),
    f"""SELECT p, c FROM (SELECT DISTINCT p, c FROM ({_CELLS})) x
    WHERE (p, c) NOT IN (SELECT (p, c) FROM (SELECT p, c, max(r) AS r FROM ({_CELLS}) GROUP BY 1, 2) WHERE r <= 5)
    AND p NOT IN (SELECT a.p FROM (SELECT p, c FROM ({_CELLS}) GROUP BY 1, 2 HAVING max(r) = 5) a JOIN (SELECT p, c FROM ({_CELLS}) GROUP BY 1, 2 HAVING max(r) = 5) b ON a.p = b.p AND a.c = b.c + 1)
    AND (p > 3 OR (p = 3 AND c > 2)) ORDER BY p, c LIMIT 1""", "photos",
)
R.add(
    "w12_boundary_edges",
    lambda c: C.boundary_edges(_cells(c).filter("r < 4").select("p", "c").distinct()),
    f"SELECT p, c, (p, c + 1) NOT IN (SELECT (p, c) FROM ({_CELLS}) WHERE r < 4) AS \"right\", (p + 1, c) NOT IN (SELECT (p, c) FROM ({_CELLS}) WHERE r < 4) AS bottom FROM (SELECT DISTINCT p, c FROM ({_CELLS}) WHERE r < 4)", "photos",
)
R.add(
    "j10_expand_groups",
    lambda c: expand_to_groups(c.bare.selectExpr("id AS entity", "id AS photo_id"), c.small("members")),
    "SELECT DISTINCT entity, photo_id FROM (SELECT id AS entity, id AS photo_id FROM photos UNION ALL SELECT p.id, m2.photo_id FROM photos p JOIN members m ON m.photo_id = p.id JOIN members m2 ON m2.group_id = m.group_id)", "photos", "members",
)
R.add(
    "j13_doubtful_doubles",
    lambda c: C.doubtful_doubles(c.small("second"), c.small("members")),
    "SELECT s.group_id, s.a AS photo_1, s.b AS photo_2 FROM (SELECT group_id, min(photo_id) AS a, max(photo_id) AS b FROM second GROUP BY 1 HAVING count(*) = 2) s LEFT JOIN members x ON x.photo_id = s.a LEFT JOIN members y ON y.photo_id = s.b WHERE x.group_id IS NULL OR y.group_id IS NULL OR x.group_id <> y.group_id", "second", "members",
)
_FILE = "split_part(source_path, '/', -1)"
_SCORE = rf"""least(100, greatest(0, 50 + CASE WHEN exif_make IS NOT NULL OR exif_model IS NOT NULL THEN 40 ELSE 0 END + CASE WHEN regexp_matches(lower({_FILE}), '^(img_|dsc|p000|p100)') THEN 20 ELSE 0 END
    + CASE WHEN regexp_matches(lower(source_path), '/(pictures|photos|dcim|camera|my pictures)/') THEN 20 ELSE 0 END + CASE WHEN width >= 800 AND height >= 800 THEN 10 ELSE 0 END
    - CASE WHEN regexp_matches(lower(source_path), '/(thumbnails|previews|thumb|[.]thumbnails|cache|[.]cache)/') OR regexp_matches(lower({_FILE}), '^thumb_|_thumb|_1024[.]|_512[.]') THEN 15 ELSE 0 END
    - CASE WHEN regexp_matches(lower(source_path), '/cache/|/temp/|/[.]trash') THEN 20 ELSE 0 END - CASE WHEN regexp_matches(lower(source_path), 'stock|wallpaper|icon|template|sample') THEN 20 ELSE 0 END - CASE WHEN width < 200 OR height < 200 THEN 20 ELSE 0 END))"""
R.add(
    "s18_score_bucket_sizes",
    lambda c: c.paths.join(c.bare, c.paths["photo_id"] == c.bare["id"]).select(X.bucket_folder(X.legacy_confidence(F.col("source_path"), F.col("width"), F.col("height"), F.col("exif_make"), F.col("exif_model"), is_thumbnail_legacy(F.col("source_path")))).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")),
    f"SELECT CASE WHEN score >= 70 THEN 'high_confidence' WHEN score >= 40 THEN 'medium_confidence' ELSE 'low_confidence' END AS bucket, count(*) AS n FROM (SELECT {_SCORE} AS score FROM paths JOIN photos ON id = photo_id) GROUP BY 1", "photos", "paths",
)

QUERIES, ORACLES = R.queries, R.oracles
