"""Queries of the individual rules, the survivor rules and the first generation's filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinfold.operators import catalog as C
from twinfold.operators import first_generation as V1
from twinfold.operators import rules as L
from twinfold.operators import survivors as V
from twinfold.operators.grouping import component_groups
from twinfold.operators.similarity import similar_pairs
from twinfold.plans.register import Registry
from twinfold.sources.scratch import stored

R = Registry()


def _like(*parts: str) -> str:
    """Some path holds a part, whatever the case, as DuckDB SQL over paths."""
    return "(" + " OR ".join(f"len(list_filter(paths, lambda p: contains(lower(p), '{x.lower()}'))) > 0".replace("'s child", "''s child") for x in parts) + ")"


_STEM = r"regexp_replace(split_part(p, '/', -1), '(.)\.[^.]+$', '\1')"
_FIRST_MATCH = [
    ("FATHER_IN_LAW", "separate", _like("/tor/Pictures/2013/03/03/", "/Thumbnails/2013/03/03/", "/Tor's childhood/")),
    ("PHOTOBOOTH", "separate", _like("Photo Booth Library/Originals/", "Photo Booth Library/Pictures/")),
    ("HUE_ANIMATION", "separate", _like("HUE Animation")),
    ("MINECRAFT_TEXTURE", "reject", _like("minecraft")),
    ("ICHAT_ICON", "reject", _like("/iChat Icons/", "/Messages/", "/Skype/") + " AND greatest(width, height) < 200"),
    ("WEB_ASSET", "reject", "companion"),
    ("FACE_CROP", "reject", f"len(list_filter(paths, lambda p: contains(lower({_STEM}), '_face'))) > 0 OR ({_like('/modelresources/')} AND greatest(width, height) <= 500 AND abs(width / height - 1) <= CAST(0.1 AS DOUBLE))"),
    ("STOCK_GREETING", "reject", f"len(list_filter(paths, lambda p: contains(p, '20140223-155504') AND regexp_full_match(replace({_STEM}, '_1024', ''), '[0-9]{{3}}'))) > 0"),
    ("FLAG_ICON", "reject", _like("20121223-175144")),
    ("FLIP_VIDEO_THUMB", "reject", _like("/FlipShare Data/Previews/", "/My Flip Video Prefs/")),
    ("VIDEO_THUMBNAIL", "reject", "len(list_filter(paths, lambda p: starts_with(upper(split_part(p, '/', -1)), 'MVI_') OR ends_with(upper(p), '.THM'))) > 0"),
    ("APP_RESOURCE", "reject", _like(".app/Contents/")),
    ("TRASHES", "reject", _like("/.Trashes/")),
    ("TINY_ICON", "reject", "width * height < 5000"),
]
_WHEN = " ".join(f"WHEN {w} THEN '{d}:{n}'" for n, d, w in _FIRST_MATCH)
_COMPANION = r"photos.id IN (SELECT photo_id FROM paths JOIN (SELECT DISTINCT regexp_replace(path, '\.html?$', '') AS base FROM inventory WHERE regexp_matches(path, '\.html?$')) i ON i.base = regexp_extract(source_path, '(.+)_files/', 1))"
R.add(
    "individual_rules",
    lambda c: L.decide(c.bare, c.paths, c.inventory),
    f"SELECT photo_id, split_part(hit, ':', 1) AS decision, split_part(hit, ':', 2) AS rule_name FROM (SELECT id AS photo_id, CASE {_WHEN} END AS hit FROM (SELECT photos.*, listed.paths, {_COMPANION} AS companion FROM photos JOIN listed ON listed.photo_id = photos.id)) WHERE hit IS NOT NULL", "photos", "listed", "inventory",
)
R.add("f19_companions", lambda c: L.with_companions(c.bare, c.paths, c.inventory).filter("companion").select("id"), f"SELECT id FROM photos WHERE {_COMPANION}", "photos", "paths", "inventory")
#: Paths that tell the first generation's categories apart, beside the catalog's own; {} is the row's number.
_ODD_PATHS = ["/a/x_face7.jpg", "/a/x_face42.JPG", "/a/face42.jpg", "/a/x_face042.jpg", "/a/x_face7.png", "/b/My Flip Video Prefs/{}.jpg", "/c/modelresources/{}.jpg", "/d/.Trash-1/{}.jpg", "/e/ichat icons/{}.gif", "/f/hue animation/minecraft{}.png", "/g/{}.jpg"]


def _odd_sql() -> str:
    whens = " ".join(f"WHEN {k} THEN concat('{x}', CAST(o_orderkey AS STRING), '{y}')" if mark else f"WHEN {k} THEN '{x}'" for k, (x, mark, y) in enumerate(p.partition("{}") for p in _ODD_PATHS))
    size = "CAST(o_orderkey % 9 * 80 AS BIGINT) AS width, CAST(o_orderkey % 9 * 80 + o_orderkey % 4 * 4 AS BIGINT) AS height"
    return f"SELECT o_orderkey AS row, CASE CAST(o_orderkey % {len(_ODD_PATHS)} AS INT) {whens} END AS source_path, {size}, o_orderkey % 13 = 0 AS companion FROM orders"


_LOW = "lower(source_path)"
R.add(
    "r11_legacy_categories",
    lambda c: c.spark.sql(_odd_sql().replace("FROM orders", "FROM {orders}"), orders=c.table("orders")).select("row", L.legacy_category().alias("category")),
    f"""SELECT row, CASE WHEN {_LOW} LIKE '%minecraft%' THEN 'minecraft' WHEN {_LOW} LIKE '%hue animation%' THEN 'hue_animation' WHEN {_LOW} LIKE '%/ichat icons/%' THEN 'ichat_icons' WHEN companion THEN 'web_page_asset'
    WHEN {_LOW} LIKE '%/my flip video prefs/%' THEN 'flip_video_thumbs' WHEN width * height <= 250000 AND regexp_full_match({_LOW}, '.+face[0-9][.]jpg') THEN 'face_detection'
    WHEN width * height <= 250000 AND regexp_full_match({_LOW}, '.+face[1-9][0-9][.]jpg') THEN 'face_detection_10plus' WHEN {_LOW} LIKE '%/flipshare data/previews/%' THEN 'flipshare_previews' WHEN width * height <= 5000 THEN 'tiny_icons'
    WHEN {_LOW} LIKE '%/modelresources/%' AND abs(width - height) <= 10 AND width <= 200 THEN 'face_detection_modelresources' WHEN {_LOW} LIKE '%/.trash%' THEN 'trash' END AS category FROM ({_odd_sql()})""",
)
R.add(
    "r11_catalog_categories",
    lambda c: c.paths.join(L.with_companions(c.bare, c.paths, c.inventory), F.col("photo_id") == F.col("id")).select("path_id", L.legacy_category().alias("category")).filter("category is not null"),
    f"""SELECT path_id, category FROM (SELECT path_id, CASE WHEN {_LOW} LIKE '%minecraft%' THEN 'minecraft' WHEN {_LOW} LIKE '%hue animation%' THEN 'hue_animation' WHEN {_LOW} LIKE '%/ichat icons/%' THEN 'ichat_icons' WHEN {_COMPANION} THEN 'web_page_asset'
    WHEN width * height <= 250000 AND ({_LOW} SIMILAR TO '.+face[0-9][.]jpg') THEN 'face_detection' WHEN {_LOW} LIKE '%/flipshare data/previews/%' THEN 'flipshare_previews' WHEN width * height <= 5000 THEN 'tiny_icons'
    WHEN {_LOW} LIKE '%/modelresources/%' AND abs(width - height) <= 10 AND width <= 200 THEN 'face_detection_modelresources' WHEN {_LOW} LIKE '%/.trash%' THEN 'trash' END AS category FROM paths JOIN photos ON photos.id = photo_id) WHERE category IS NOT NULL""", "photos", "paths", "inventory",
)


def _members(c):
    """Members of the groups that similar hashes make, with all that the planned order looks at; the hashes, made once for the pairs, aren't."""
    groups = component_groups(stored(similar_pairs(c.hashes), "near"))
    return stored(C.members_with_paths(groups, c.bare.select("id", "width", "height", "file_size", "exif_make"), c.paths), "members")


def _coarse(c):
    """Members by plain arithmetic, with eight-bit hashes and names without numbers, so that every rule has work."""
    photos = c.photos.select("id", "width", "height", "file_size", F.col("phash").bitwiseAND(F.lit(255)).alias("phash"), F.col("dhash").bitwiseAND(F.lit(255)).alias("dhash"))
    return stored(C.members_with_paths(c.small("members"), photos, c.paths.withColumn("source_path", F.regexp_replace("source_path", "[0-9]{2,}", "x"))), "members")


_FACTS = r"""SELECT g.group_id, p.id, p.width * p.height AS res, p.file_size, h.*, len(list_filter(l.paths, lambda x: contains(lower(x), '/thumbnails/') OR starts_with(lower(split_part(x, '/', -1)), 'thumb_'))) > 0 AS thumb, len(list_filter(l.paths, lambda x: contains(lower(x), '/thumbnails/'))) > 0 AS folder,
    list_transform(l.paths, lambda x: regexp_replace(regexp_replace(lower(regexp_replace(split_part(x, '/', -1), '(.)\.[^.]+$', '\1')), '_\d+$', ''), '^thumb_', '')) AS bases, len(list_filter(l.paths, lambda x: contains(lower(x), '/previews/'))) > 0 AS preview, lower(split_part(l.paths[1], '/', -1)) AS first_name,
    len(list_filter(l.paths, lambda x: contains(lower(x), '.photolibrary/'))) > 0 AS iphoto, len(list_filter(l.paths, lambda x: contains(lower(x), '.photoslibrary/'))) > 0 AS photos_app FROM comp_groups g JOIN photos p ON p.id = g.photo_id JOIN (SELECT id AS hid, p_hi, p_lo, d_hi, d_lo FROM hashes) h ON h.hid = p.id JOIN listed l ON l.photo_id = p.id"""
_DP, _DD = "(bit_count(xor(a.p_hi, b.p_hi)) + bit_count(xor(a.p_lo, b.p_lo)))", "(bit_count(xor(a.d_hi, b.d_hi)) + bit_count(xor(a.d_lo, b.d_lo)))"
_SAME = f"({_DP} <= 2 OR ({_DP} <= 6 AND {_DD} = 0))"
_HITS = {
    "THUMBNAIL": f"a.thumb AND NOT b.thumb AND b.res > a.res AND ({_SAME} OR (a.folder AND list_has_any(a.bases, b.bases)))",
    "PREVIEW": "a.preview AND NOT b.preview AND a.first_name = b.first_name AND b.file_size > a.file_size",
    "IPHOTO_COPY": f"a.photos_app AND b.iphoto AND {_SAME}",
    "DERIVATIVE": f"a.id <> b.id AND b.res > a.res AND a.res < CAST(0.9 AS DOUBLE) * b.res AND {_SAME}",
}
#: Each step: the rejected of one rule among those left, in groups with two left at least.
_CHAIN = "left0 AS (SELECT * FROM facts)" + "".join(
    f", alive{k} AS (SELECT * FROM left{k} QUALIFY count(*) OVER (PARTITION BY group_id) >= 2), hit{k} AS (SELECT DISTINCT a.id, a.group_id FROM alive{k} a JOIN alive{k} b ON a.group_id = b.group_id AND {cond}), left{k + 1} AS (SELECT * FROM left{k} WHERE id NOT IN (SELECT id FROM hit{k}))" for k, cond in enumerate(_HITS.values())
)
_COARSE = (
    _FACTS.replace("FROM comp_groups g", "FROM members g")
    .replace("SELECT id AS hid, p_hi, p_lo, d_hi, d_lo FROM hashes", "SELECT id AS hid, 0 AS p_hi, p_lo & 255 AS p_lo, 0 AS d_hi, d_lo & 255 AS d_lo FROM hashes")
    .replace("JOIN listed l ON", "JOIN (SELECT photo_id, list(regexp_replace(source_path, '[0-9]{2,}', 'x', 'g') ORDER BY path_id) AS paths FROM paths GROUP BY 1) l ON")
)
_SETS = " UNION ALL ".join(f"SELECT id AS photo_id, group_id, '{name}' AS rule_name FROM hit{k}" for k, name in enumerate(_HITS))
R.add("r1_r4_survivor_rules", lambda c: V.reject_in_groups(_coarse(c)).filter("rule_name <> 'SAME_RES_DUPLICATE'"), f"SELECT * FROM (WITH facts AS ({_COARSE}), {_CHAIN} {_SETS})", "members", "hashes", "paths")
R.add("r5_all_survivor_rules", lambda c: V.reject_in_groups(_coarse(c)))
_RANKS = "['THUMBNAIL', 'PREVIEW', 'IPHOTO_COPY', 'DERIVATIVE', 'SAME_RES_DUPLICATE']"
R.add(
    "r6_r7_originals",
    lambda c: _originals(c),
    f"""WITH facts AS ({_COARSE}), {_CHAIN}, rej AS (SELECT *, list_position({_RANKS}, rule_name) AS rank FROM ({_SETS})),
    seen AS (SELECT DISTINCT group_id, rule_name, rank FROM rej),
    shown AS (SELECT f.id, f.group_id, f.res, f.thumb, f.preview, f.iphoto, s.rule_name, coalesce(r.rank = s.rank, false) AS rejected, max(CASE WHEN r.rank = s.rank THEN f.res END) OVER (PARTITION BY f.group_id, s.rule_name) AS top
        FROM facts f JOIN seen s USING (group_id) LEFT JOIN rej r ON r.photo_id = f.id WHERE r.rank IS NULL OR r.rank >= s.rank)
    SELECT id AS photo_id, group_id, rule_name, CASE WHEN rejected THEN 'rejected' WHEN CASE rule_name WHEN 'THUMBNAIL' THEN NOT thumb AND res > top WHEN 'PREVIEW' THEN NOT preview WHEN 'IPHOTO_COPY' THEN iphoto WHEN 'DERIVATIVE' THEN res > top ELSE res = top END THEN 'original' ELSE 'other' END AS status FROM shown""".replace("WITH facts", "SELECT * FROM (WITH facts", 1) + ")",
    "members", "hashes", "paths",
)


def _originals(c):
    """Under the rules that SQL has as well: the greedy one is left out."""
    members = _coarse(c)
    return V.originals(members, stored(V.reject_in_groups(members).filter("rule_name <> 'SAME_RES_DUPLICATE'"), "rejections"))


R.add("r8_groups_with_rejections", lambda c: c.small("rejections").filter("rule_name = 'THUMBNAIL'").select("group_id").distinct().orderBy("group_id").offset(5).limit(10), "SELECT DISTINCT group_id FROM rejections WHERE rule_name = 'THUMBNAIL' ORDER BY 1 LIMIT 10 OFFSET 5", "rejections")


def _clustered(c):
    """Members by plain arithmetic whose first paths make clusters in which every rule has work."""
    rows = c.spark.sql(f"SELECT id, L % 97 AS group_id, {_CLUSTER_PATH} AS path, CAST(100 + L % 4 * 250 AS BIGINT) AS width, CAST(100 + L % 4 * 250 + L % 2 * 90 AS BIGINT) AS height, CAST(L % 5 AS BIGINT) AS file_size, CAST(L % 101 AS BIGINT) AS score, CAST(L % 3 AS STRING) AS content_md5 FROM {{photos}}", photos=c.bare.select("id", "L"))
    return stored(rows.withColumn("paths", F.array("path")).drop("path"), "clustered")


#: Folders and names of such paths.
_CLUSTER_FOLDERS = ["/Lib/Thumbnails/x/", "/Old/iPhoto.photolibrary/", "/New/Mac.photoslibrary/", "/a/Photo Booth Library/Pictures/", "/b/modelresources/", "/c/20121223-175144/", "/d/Previews/", "/e/", "/f/g/"]
_CLUSTER_NAMES = ["IMG_1.jpg", "thumb_IMG_1.jpg", "IMG_E1_1024.jpg", "123_1024.jpg", "123.jpg", "Rose cat.jpg", "thumb_rose-cat.jpg", "IMG_1.png"]
_CLUSTER_PATH = "CASE CAST(L % 9 AS INT) " + " ".join(f"WHEN {k} THEN '{f}'" for k, f in enumerate(_CLUSTER_FOLDERS)) + " END || CASE CAST(floor(L / 9) % 8 AS INT) " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(_CLUSTER_NAMES)) + " END"
_MEMBERS = f"SELECT id, L % 97 AS group_id, {_CLUSTER_PATH} AS path, 100 + L % 4 * 250 AS w, 100 + L % 4 * 250 + L % 2 * 90 AS h, w * h AS res, L % 5 AS size, L % 101 AS score, L % 3 AS md5 FROM photos"
_BASES = r"CASE WHEN ends_with(path, 'IMG_1.jpg') OR ends_with(path, 'IMG_E1_1024.jpg') OR ends_with(path, 'IMG_1.png') THEN 'IMG 1' WHEN contains(path, '123') AND NOT ends_with(path, 'cat.jpg') AND NOT contains(path, 'IMG') THEN '123' ELSE 'ROSE CAT' END"
_OTHER = "EXISTS (SELECT 1 FROM m o WHERE o.group_id = m.group_id AND o.base = m.base AND o.id <> m.id AND {})"
R.add(
    "r9_legacy_rejections",
    lambda c: V1.legacy_rejections(_clustered(c)),
    f"""SELECT * FROM (WITH m AS (SELECT *, {_BASES} AS base, contains(path, '/Thumbnails/') OR contains(path, '/thumb_') AS thumb, regexp_matches(path, '/IMG_1[.]') AS camera, split_part(path, '/', -1) AS name FROM ({_MEMBERS}))
    SELECT id AS photo_id, group_id, reason FROM (SELECT *, CASE WHEN thumb AND {_OTHER.format('NOT o.thumb AND o.res > m.res')} THEN 'thumbnail_with_master' WHEN contains(path, '.photolibrary/') AND {_OTHER.format("contains(o.path, '.photoslibrary/') AND o.res = m.res")} THEN 'iphoto_duplicate_of_photos'
    WHEN contains(path, '/Photo Booth Library/Pictures/') THEN 'photobooth_filtered' WHEN contains(path, '/modelresources/') AND greatest(w, h) <= 500 AND abs(w / h - 1) <= CAST(0.1 AS DOUBLE) THEN 'face_thumbnail' WHEN contains(path, '/Thumbnails/') AND regexp_matches(path, '/123(_1024)?[.]') THEN 'stock_image'
    WHEN contains(path, '20121223-175144') THEN 'flag_icon' WHEN thumb AND NOT {_OTHER.format('NOT o.thumb')} AND {_OTHER.format('o.res > m.res')} THEN 'smaller_thumbnail' WHEN res < 500000 AND {_OTHER.format('o.res > 10 * m.res')} THEN 'tiny_with_large'
    WHEN contains(path, '/Previews/') AND {_OTHER.format('lower(o.name) = lower(m.name) AND o.size > m.size')} THEN 'preview_with_original' WHEN camera AND {_OTHER.format('o.size = m.size AND NOT o.camera AND o.md5 = m.md5')} THEN 'pixel_duplicate' END AS reason FROM m) WHERE reason IS NOT NULL)""", "photos",
)
R.add(
    "r10_marked_derivatives",
    lambda c: V1.marked_derivatives(_clustered(c).withColumn("quality_score", (F.col("width") * F.col("height") * F.col("score") / 100.0).cast("long"))),
    r"""SELECT * FROM (WITH m AS (SELECT *, upper(regexp_replace(regexp_replace(regexp_replace(split_part(path, '/', -1), '[.][a-z]+$', ''), '^thumb_', ''), '_1024$', '')) AS base, CAST(floor(w * h * score / 100.0::DOUBLE) AS BIGINT) AS q, contains(path, '/Thumbnails/') OR contains(path, '/thumb_') AS der,
        CASE WHEN contains(path, '.photoslibrary/') THEN 0 WHEN contains(path, '.photolibrary/') THEN 2 ELSE 1 END AS lib FROM (""" + _MEMBERS + r""")),
    t AS (SELECT *, first_value(res) OVER (PARTITION BY group_id, base ORDER BY q DESC, size DESC, id DESC) AS top, count(*) OVER (PARTITION BY group_id, base) AS n FROM m),
    b AS (SELECT group_id, base, id AS bid, w AS bw, h AS bh, size AS bs FROM t WHERE res = top QUALIFY row_number() OVER (PARTITION BY group_id, base ORDER BY lib, size DESC, id) = 1),
    c AS (SELECT t.*, bid, id <> bid AND (der OR w < CAST(0.9 AS DOUBLE) * bw OR h < CAST(0.9 AS DOUBLE) * bh OR (res = top AND size < bs)) AS clear FROM t JOIN b USING (group_id, base)),
    k AS (SELECT *, n = 1 OR id = bid OR NOT bool_or(clear) OVER (PARTITION BY group_id, base) AS keeper FROM c),
    g AS (SELECT *, max(CASE WHEN keeper THEN res END) OVER p AS kmax, min(CASE WHEN keeper THEN res END) OVER p AS kmin, max(CASE WHEN keeper THEN size END) OVER p AS ksize, count(*) FILTER (NOT keeper) OVER p AS lost FROM k WINDOW p AS (PARTITION BY group_id)),
    o AS (SELECT *, bool_and(keeper OR der OR res < CAST(0.5 AS DOUBLE) * kmax OR (res = kmax AND size < ksize)) OVER p AS whole, bool_or(NOT keeper AND (der OR res < CAST(0.5 AS DOUBLE) * kmin)) OVER p AS obvious FROM g WINDOW p AS (PARTITION BY group_id)),
    d AS (SELECT *, CASE WHEN lost > 0 AND kmin = kmax AND whole THEN 'full' WHEN lost > 0 AND kmin <> kmax AND obvious THEN 'partial' ELSE 'manual' END AS mode FROM o)
    SELECT id AS photo_id, group_id, base, keeper, mode, CASE mode WHEN 'full' THEN NOT keeper WHEN 'partial' THEN NOT keeper AND (der OR res < CAST(0.5 AS DOUBLE) * kmin) ELSE false END AS rejected FROM d)""", "photos",
)
_RANK = "SELECT photo_id, group_id, q AS quality_score, CAST(row_number() OVER (PARTITION BY group_id ORDER BY q DESC, photo_id) AS INT) AS rank_in_group, count(*) OVER (PARTITION BY group_id) AS group_size FROM (SELECT photo_id, group_id, CAST(floor(width * height * ((L % 101) / 100.0::DOUBLE)) AS BIGINT) AS q FROM members JOIN photos ON id = photo_id)"
R.add(
    "w3_legacy_rank",
    lambda c: V.legacy_rank(c.small("members").join(c.bare.withColumn("score", F.col("L") % 101), F.col("photo_id") == F.col("id")).drop("photo_id")),
    f"SELECT *, rank_in_group = 1 AS is_suggested_keeper FROM ({_RANK})", "members", "photos",
)
R.add("r12_planned_rank", lambda c: V.planned_rank(_members(c)).select("photo_id", "group_id", "rank"), "SELECT id AS photo_id, group_id, CAST(row_number() OVER (PARTITION BY group_id ORDER BY f.res DESC, file_size DESC, thumb, has DESC, id) AS INT) AS rank FROM (SELECT f.*, p.exif_make IS NOT NULL AS has FROM (" + _FACTS + ") f JOIN photos p ON p.id = f.id) f", "comp_groups", "listed")

QUERIES, ORACLES = R.queries, R.oracles
