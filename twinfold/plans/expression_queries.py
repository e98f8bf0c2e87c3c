"""Queries X, D and S: scalar functions, date parsing and fusion, and what is derived from files."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinfold.functions import dates as D
from twinfold.functions import exprs as X
from twinfold.operators import fusion
from twinfold.operators.survivors import legacy_rank
from twinfold.plans.register import Registry
from twinfold.sources import ingest, legacy
from twinfold.sources.scratch import new_path

R = Registry()
_HEX = "printf('%08x%08x', p_hi, p_lo)"
R.add(
    "x1_hamming",
    lambda c: c.hashes.select("id", X.hamming_hex(X.long_to_hex(F.col("phash")), X.long_to_hex(F.col("dhash"))).alias("dist"), X.hamming_hex(F.concat(X.long_to_hex(F.col("phash")), X.long_to_hex(F.col("dhash"))), F.concat(X.long_to_hex(F.col("dhash")), X.long_to_hex(F.col("dhash"))), 256).alias("wide")),
    "SELECT id, CAST(bit_count(xor(p_hi, d_hi)) + bit_count(xor(p_lo, d_lo)) AS INT) AS dist, CAST(bit_count(xor(p_hi, d_hi)) + bit_count(xor(p_lo, d_lo)) AS INT) AS wide FROM hashes", "hashes",
)
R.add(
    "x2_hamming_or",
    lambda c: c.hashes.join(c.bare.select("id", "L"), "id").select("id", X.hamming_hex_or(F.when(F.col("L") % 2 == 0, X.long_to_hex(F.col("phash"))).when(F.col("L") % 3 == 0, "not hex"), X.long_to_hex(F.col("dhash"))).alias("dist")),
    "SELECT id, CASE WHEN L % 2 = 0 THEN CAST(bit_count(xor(p_hi, d_hi)) + bit_count(xor(p_lo, d_lo)) AS INT) ELSE 256 END AS dist FROM hashes JOIN photos USING (id)", "hashes",
)
R.add(
    "x3_x4_thresholds",
    lambda c: c.bare.selectExpr("CAST(L % 18 AS INT) AS p", "CAST(L % 26 AS INT) AS d").distinct().select("p", "d", X.is_same_photo(F.col("p"), F.col("d")).alias("photo"), X.is_same_scene(F.col("p"), F.col("d")).alias("scene")),
    "SELECT DISTINCT p, d, p <= 2 OR (p <= 6 AND d = 0) AS photo, CASE WHEN p <= 10 THEN true WHEN p <= 12 THEN d < 22 WHEN p <= 14 THEN d <= 17 ELSE false END AS scene FROM (SELECT CAST(L % 18 AS INT) AS p, CAST(L % 26 AS INT) AS d FROM photos)", "photos",
)
R.add(
    "x7_x18_sizes",
    lambda c: c.bare.select("id", X.resolution(F.col("width"), F.col("height")).alias("res"), X.quality_class(F.col("width"), F.col("height")).alias("quality"), X.megapixels(F.col("width"), F.col("height")).alias("mp"), F.concat("width", F.lit("x"), "height").alias("size"), X.file_size_text(F.col("file_size")).alias("bytes")),
    "SELECT id, width * height AS res, CASE WHEN width * height >= 2000000 THEN 'high' WHEN width * height >= 500000 THEN 'medium' ELSE 'low' END AS quality, round(width * height / 1e6, 1) AS mp, concat(width, 'x', height) AS size, CASE WHEN file_size < 1024 THEN printf('%.1f B', file_size::DOUBLE) WHEN file_size < 1048576 THEN printf('%.1f KB', file_size / 1024) ELSE printf('%.1f MB', file_size / 1048576) END AS bytes FROM photos", "photos",
)


_N = 10_000  # enough rows for any order key as the number of a pair


def _index(c):
    i, j = X.pair_from_index(F.col("k"), _N)
    return c.table("orders").selectExpr("o_orderkey AS k").select("k", i.alias("i"), j.alias("j"))


R.add("x8_pair_index", _index, f"SELECT o.k, r.i, o.k - r.before + r.i + 1 AS j FROM (SELECT o_orderkey AS k FROM orders) o ASOF JOIN (SELECT i, i * {_N} - i * (i + 1) // 2 AS before FROM range({_N - 1}) t(i)) r ON o.k >= r.before")
_VALID = "try_strptime({v}, '{f}') IS NOT NULL AND substr({v}, 1, 4) BETWEEN '1990' AND '2030'"


def _name_sql(column: str) -> str:
    out = []
    for pattern in (r"(\d{4})(\d{2})(\d{2})[_-](\d{2})(\d{2})(\d{2})", r"(\d{4})-(\d{2})-(\d{2})[_ ](?:at )?(\d{2})\.(\d{2})\.(\d{2})", r"(\d{4})-(\d{2})-(\d{2})[_-](\d{2})(\d{2})(\d{2})"):
        value = f"regexp_replace(regexp_extract({column}, '{pattern}'), '{pattern}', '\\1-\\2-\\3T\\4:\\5:\\6')"
        out.append(f"CASE WHEN {_VALID.format(v=value, f='%Y-%m-%dT%H:%M:%S')} THEN {value} END")
    for pattern in (r"(\d{4})(\d{2})(\d{2})(?:\D|$)", r"(\d{4})-(\d{2})-(\d{2})(?:\D|$)"):
        value = f"regexp_replace(regexp_extract({column}, '{pattern}'), '{pattern}', '\\1-\\2-\\3')"
        out.append(f"CASE WHEN {_VALID.format(v=value, f='%Y-%m-%d')} THEN {value} END")
    return "coalesce(" + ", ".join(out) + ")"


R.add("x9_filename_dates", lambda c: c.paths.select("path_id", D.date_from_filename(F.col("filename")).alias("date_value")), f"SELECT path_id, {_name_sql('filename')} AS date_value FROM paths", "paths")
_PATH_SQL = "CASE WHEN contains(source_path, '.photolibrary') OR contains(source_path, '.photoslibrary') THEN NULL WHEN contains(source_path, '101122 ') THEN '{a}' WHEN contains(source_path, 'April 2010') THEN '{b}' WHEN contains(source_path, '2012 May') THEN '{c}' WHEN contains(source_path, 'Xmas 2004') THEN '{d}' WHEN contains(source_path, '/2013/') THEN '{e}' WHEN contains(source_path, '/2004/') THEN '{f}' END"
R.add(
    "x10_path_dates",
    lambda c: c.paths.select("path_id", D.date_from_path(F.col("source_path")).alias("date_value")).withColumn("confidence", D.path_confidence(F.col("date_value"))),
    f"SELECT path_id, {_PATH_SQL.format(a='2010-11-22', b='2010-04', c='2012-05', d='2004-12', e='2013', f='2004')} AS date_value, {_PATH_SQL.format(a='medium', b='medium', c='medium', d='medium', e='low', f='low')} AS confidence FROM paths", "paths",
)
_ISO = "CASE WHEN try_strptime(exif_datetime, '%Y:%m:%d %H:%M:%S') IS NOT NULL THEN strftime(try_strptime(exif_datetime, '%Y:%m:%d %H:%M:%S'), '%Y-%m-%dT%H:%M:%S') END"
_RATE = f"CASE WHEN coalesce({_ISO}, '') = '' THEN 'unusable' WHEN NOT substr({_ISO}, 1, 4) BETWEEN '1990' AND '2030' THEN 'suspect' WHEN coalesce(exif_make, '') <> '' OR coalesce(exif_model, '') <> '' THEN 'high' WHEN coalesce(exif_software, '') <> '' THEN 'low' ELSE 'medium' END"
R.add(
    "x11_exif_confidence",
    lambda c: c.bare.select("id", D.exif_datetime(F.col("exif_datetime")).alias("iso"), D.exif_confidence(D.exif_datetime(F.col("exif_datetime")), F.col("exif_make"), F.col("exif_model"), F.col("exif_software")).alias("confidence")),
    f"SELECT id, {_ISO} AS iso, {_RATE} AS confidence FROM photos", "photos",
)
R.add(
    "x12_x13_x17_date_parts",
    lambda c: c.table("orders").selectExpr("o_orderkey", "substring(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\"), 1, CAST(element_at(array(0, 4, 7, 10, 19), CAST(o_orderkey % 5 AS INT) + 1) AS INT)) AS v").select("o_orderkey", D.year_of(F.col("v")).alias("year"), D.date_sort_key(F.col("v")).alias("sort_key"), D.display_date(F.nullif(F.col("v"), F.lit(""))).alias("display")),
    "SELECT o_orderkey, CASE WHEN n > 0 THEN CAST(substr(v, 1, 4) AS INT) END AS year, CASE n WHEN 0 THEN '9999-99-99T99:99:99' WHEN 4 THEN v || '-00-00T00:00:00' WHEN 7 THEN v || '-00T00:00:00' WHEN 10 THEN v || 'T00:00:00' ELSE v END AS sort_key, CASE WHEN n = 0 THEN 'unknown' ELSE substr(v, 1, 10) END AS display FROM (SELECT o_orderkey, [0, 4, 7, 10, 19][1 + o_orderkey % 5] AS n, substr(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 1, [0, 4, 7, 10, 19][1 + o_orderkey % 5]) AS v FROM orders)",
)
_NAME = "split_part(source_path, '/', -1)"
_STEM = rf"regexp_replace({_NAME}, '(.)\.[^.]+$', '\1')"
R.add(
    "x14_x16_paths",
    lambda c: c.paths.select("path_id", X.stem(F.col("source_path")).alias("stem"), X.suffix(F.col("source_path")).alias("suffix"), X.base_name(F.col("source_path")).alias("base"), X.is_thumbnail(F.col("source_path")).alias("thumb"), X.is_library_made(F.col("source_path")).alias("made"), X.derivative_base(F.col("source_path")).alias("derivative")),
    rf"SELECT path_id, {_STEM} AS stem, regexp_extract({_NAME}, '.(\.[^.]+)$', 1) AS suffix, regexp_replace(regexp_replace(lower({_STEM}), '_\d+$', ''), '^thumb_', '') AS base, contains(lower(source_path), '/thumbnails/') OR starts_with(lower({_NAME}), 'thumb_') AS thumb, contains(lower(source_path), '/previews/') OR contains(lower(source_path), '/thumbnails/') OR contains(lower(source_path), '/modelresources/') AS made, upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_STEM}, '^thumb_', '', 'i'), '^!cid_', '', 'i'), '_1024$', ''), '^(IMG_)E(\d+)$', '\1\2', 'i'), '[-_\s]+', ' ', 'g')) AS derivative FROM paths", "paths",
)
R.add(
    "x19_shortest_path",
    lambda c: c.paths.groupBy("photo_id").agg(F.min_by("source_path", F.struct(F.length("source_path"), "path_id")).alias("path")),
    "SELECT photo_id, source_path AS path FROM paths QUALIFY row_number() OVER (PARTITION BY photo_id ORDER BY length(source_path), path_id) = 1", "paths",
)
R.add(
    "x21_unique_in_order",
    lambda c: c.bare.select("id", F.array_join(F.array_distinct(F.split("text", " ")), " ").alias("words")),
    "SELECT id, string_agg(w, ' ' ORDER BY pos) AS words FROM (SELECT id, w, min(pos) AS pos FROM (SELECT id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS pos FROM photos) GROUP BY id, w) GROUP BY id", "photos",
)
#: Names of pictures in the forms that the tests on names tell apart; {} is the row's number.
NAMES = [
    "IMG_{}.jpg", "IMG_E{}.JPG", "img_e{}x.jpg", "DSC_{}.jpg", "DSCN{}.jpg", "DSCF{}.jpg", "P1020304.jpg", "P102030{}.jpg", "20040615_{}.jpg", "20040615-{}.jpg", "photo-2004-06-15-{}.jpg", "thumb_cat.jpg", "cat_{}.jpg",
    "cat {}.jpg", "!cid_cat-{}.jpg", "cat_1024.jpg", "cat_512.jpg", "cat_small.jpg", "cat_thumb.jpg", "IMG_{}_1024.jpg", "20231225_123456.jpg", "20231225123456_{}.jpg", "20231325.jpg", "20230230_x.jpg", "2023-12-25_{}.jpg", "x19891225_20011225.jpg", "20231225_253456.jpg",
]
FOLDERS = ["/Pictures/2004/", "/A/Thumbnails/", "/A/previews/x/", "/dcim/100/", "/stock/", "/x/Temp/", "/home/.Trash-1/", "/a/thumb/", "/b/.cache/", "/My Pictures/icons/", "/Resized files/", "/c/"]


def _sample_path() -> str:
    """A path for each order, by plain arithmetic that both engines read alike."""
    names = " ".join(f"WHEN {k} THEN " + " || CAST(o_orderkey AS STRING) || ".join(f"'{part}'" for part in n.split("{}")) for k, n in enumerate(NAMES))
    folders = " ".join(f"WHEN {k} THEN '{f}'" for k, f in enumerate(FOLDERS))
    return f"CASE CAST(o_orderkey % {len(FOLDERS)} AS INT) {folders} END || CASE CAST(o_orderkey % {len(NAMES)} AS INT) {names} END"


_FIELDS = {"w": "CAST(o_orderkey % 7 * 150 AS BIGINT)", "h": "CAST(o_orderkey % 5 * 250 AS BIGINT)", "make": "CASE WHEN o_orderkey % 3 = 0 THEN 'Canon' WHEN o_orderkey % 3 = 1 THEN '' END", "model": "CASE WHEN o_orderkey % 4 = 0 THEN 'M' END"}
_SAMPLES = f"(SELECT o_orderkey, {_sample_path()} AS path, " + ", ".join(f"{e} AS {c}" for c, e in _FIELDS.items()) + " FROM orders)"
_PNAME, _PSTEM = "split_part(path, '/', -1)", r"regexp_replace(split_part(path, '/', -1), '(.)\.[^.]+$', '\1')"


def _samples(c):
    return c.table("orders").selectExpr("o_orderkey", f"{_sample_path()} AS path", *[f"{e} AS {n}" for n, e in _FIELDS.items()])


R.add(
    "x22_generated_names",
    lambda c: _samples(c).select("o_orderkey", X.is_generated_name(F.col("path")).alias("generated")),
    rf"SELECT o_orderkey, regexp_matches(upper({_PSTEM}), '^IMG_E?\d+$|^DSC[_N]?\d+$|^P\d\d\d\d\d\d\d$|^\d{{8}}[_-]\d+$|^PHOTO-\d{{4}}-\d\d-\d\d|^THUMB_|_\d+$') AS generated FROM {_SAMPLES}",
)
R.add(
    "x23_camera_names",
    lambda c: _samples(c).select("o_orderkey", X.is_camera_name(F.col("path")).alias("camera")),
    rf"SELECT o_orderkey, regexp_full_match(upper({_PSTEM}), '(IMG_|DSC_|DSCN|DSC)\d+|P\d{{7}}|\d{{8}}_\d+') AS camera FROM {_SAMPLES}",
)
R.add(
    "x24_bases",
    lambda c: _samples(c).select("o_orderkey", X.derivative_base(F.col("path")).alias("derivative"), X.marked_base(F.col("path")).alias("marked"), X.collision_base(F.col("path")).alias("collision")),
    rf"""SELECT o_orderkey, trim(regexp_replace(upper(CASE WHEN regexp_matches(s, '(?i)^IMG_E\d+$') THEN s[1:4] || s[6:] ELSE s END), '[-_ ]+', ' ', 'g'), '') AS derivative,
    upper(regexp_replace(regexp_replace(st, '^thumb_', '', 'i'), '_1024$', '')) AS marked, upper(regexp_replace(regexp_replace(regexp_replace(st, '^thumb_', '', 'i'), '_\d\d\d\d?$', ''), '_thumb$', '', 'i')) AS collision
    FROM (SELECT o_orderkey, {_PSTEM} AS st, regexp_replace(regexp_replace({_PSTEM}, '^(thumb_)?(!cid_)?', '', 'i'), '_1024$', '') AS s FROM {_SAMPLES})""",
)
_LOW, _LNAME = "lower(path)", "lower(split_part(path, '/', -1))"
_THUMB = rf"(regexp_matches({_LOW}, '/(thumbnails|previews|thumb|\.thumbnails|cache|\.cache)/') OR starts_with({_LNAME}, 'thumb_') OR regexp_matches({_LNAME}, '_thumb|_1024\.|_512\.'))"
_SCORE = rf"""least(100, greatest(0, 50 + CASE WHEN coalesce(make, '') <> '' OR coalesce(model, '') <> '' THEN 40 ELSE 0 END + CASE WHEN regexp_matches({_LNAME}, '^(img_|dsc|p000|p100)') THEN 20 ELSE 0 END
    + CASE WHEN regexp_matches({_LOW}, '/((my )?pictures|photos|dcim|camera)/') THEN 20 ELSE 0 END + CASE WHEN w >= 800 AND h >= 800 THEN 10 ELSE 0 END - CASE WHEN {_THUMB} THEN 15 ELSE 0 END
    - CASE WHEN regexp_matches({_LOW}, '/cache/|/temp/|/\.trash') THEN 20 ELSE 0 END - CASE WHEN regexp_matches({_LOW}, 'stock|wallpaper|icon|template|sample') THEN 20 ELSE 0 END - CASE WHEN w < 200 OR h < 200 THEN 20 ELSE 0 END))"""
R.add(
    "x25_confidence",
    lambda c: _samples(c).select("o_orderkey", X.legacy_confidence(F.col("path"), F.col("w"), F.col("h"), F.col("make"), F.col("model"), legacy.is_thumbnail_legacy(F.col("path"))).alias("score")),
    f"SELECT o_orderkey, {_SCORE} AS score FROM {_SAMPLES}",
)
R.add("x26_legacy_thumbnails", lambda c: _samples(c).select("o_orderkey", legacy.is_thumbnail_legacy(F.col("path")).alias("thumb")), f"SELECT o_orderkey, {_THUMB} AS thumb FROM {_SAMPLES}")


def _legacy_sql(name: str) -> str:
    tries = []
    for pattern in (r"(\d{4})(\d{2})(\d{2})[_-]?(\d{2})(\d{2})(\d{2})", r"(\d{4})(\d{2})(\d{2})", r"(\d{4})-(\d{2})-(\d{2})"):
        form = r"\1-\2-\3T\4:\5:\6" if pattern.count("(") > 3 else r"\1-\2-\3T00:00:00"
        value = f"regexp_replace(regexp_extract({name}, '{pattern}'), '{pattern}', '{form}')"
        tries.append(f"CASE WHEN try_strptime({value}, '%Y-%m-%dT%H:%M:%S') BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2030-12-31 23:59:59' THEN {value} END")
    # The fourth pattern asks for the start of the name; what it finds there the second has found or refused.
    fourth = r"^(\d{4})(\d{2})(\d{2})"
    value = rf"regexp_replace(regexp_extract({name}, '{fourth}'), '{fourth}', '\1-\2-\3T00:00:00')"
    tries.append(f"CASE WHEN try_strptime({value}, '%Y-%m-%dT%H:%M:%S') BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2030-12-31 23:59:59' THEN {value} END")
    return "coalesce(" + ", ".join(tries) + ")"


R.add("x27_legacy_dates", lambda c: _samples(c).select("o_orderkey", legacy.legacy_filename_date(X.basename(F.col("path"))).alias("date_value")), f"SELECT o_orderkey, {_legacy_sql(_PNAME)} AS date_value FROM {_SAMPLES}")
R.add(
    "x28_path_markers",
    lambda c: _samples(c).select("o_orderkey", F.array_join(X.path_keywords(F.col("path")), ",").alias("keywords"), F.array_join(X.name_prefixes(F.col("path")), ",").alias("prefixes"), F.array_join(X.name_suffixes(F.col("path")), ",").alias("suffixes")),
    rf"""SELECT o_orderkey, array_to_string(list_filter(string_split(path, '/'), lambda p: contains(lower(p), 'thumb') OR contains(lower(p), 'cache') OR contains(lower(p), 'preview') OR contains(lower(p), 'resized')), ',') AS keywords,
    CASE WHEN {_LNAME} LIKE 'thumb\_%' ESCAPE '\' THEN 'thumb_' WHEN {_LNAME} LIKE 'img\_%' ESCAPE '\' THEN 'img_' ELSE '' END AS prefixes,
    CASE WHEN regexp_matches({_PSTEM}, '_\d\d\d\d?$') THEN '_' || string_split({_PSTEM}, '_')[-1] WHEN regexp_matches({_PSTEM}, '(?i)_thumb$') THEN '_thumb' WHEN regexp_matches({_PSTEM}, '(?i)_small$') THEN '_small' ELSE '' END AS suffixes FROM {_SAMPLES}""",
)


# ---- dates of entities ------------------------------------------------------


def _dated(c):
    return c.bare.select("id", F.when(F.col("L") % 3 == 0, D.exif_datetime(F.col("exif_datetime"))).alias("date_taken"), F.when(F.col("L") % 2 == 0, "mtime").alias("date_source"))


def _entities(c):
    return c.small("members").selectExpr("concat('G_', CAST(group_id AS STRING)) AS entity", "photo_id")


_GATHER = f"""SELECT id AS photo_id, {_ISO} AS date_value, CASE WHEN L % 2 = 0 THEN 'mtime' ELSE 'exif' END AS source_type, CASE WHEN L % 2 = 0 THEN 'low' ELSE 'medium' END AS tier, 0 AS kind, 0 AS n FROM photos WHERE L % 3 = 0 AND {_ISO} IS NOT NULL
    UNION ALL SELECT photo_id, {_name_sql('filename')}, 'filename', 'medium', 1, path_id FROM paths WHERE {_name_sql('filename')} IS NOT NULL
    UNION ALL SELECT photo_id, dv, 'path_semantic', CASE WHEN length(dv) = 4 THEN 'low' ELSE 'medium' END, 2, path_id FROM (SELECT *, {_PATH_SQL.format(a='2010-11-22', b='2010-04', c='2012-05', d='2004-12', e='2013', f='2004')} AS dv FROM paths) WHERE dv IS NOT NULL"""
R.add("d1_gathered_dates", lambda c: fusion.gather(_dated(c), c.paths).select("photo_id", "date_value", "source_type", "tier"), f"SELECT photo_id, date_value, source_type, tier FROM ({_GATHER})", "photos", "paths")
_PAD = "CASE length(date_value) WHEN 4 THEN date_value || '-00-00T00:00:00' WHEN 7 THEN date_value || '-00T00:00:00' WHEN 10 THEN date_value || 'T00:00:00' ELSE date_value END"
_DERIVED = f"""SELECT e.entity, b.date_value, b.tier AS confidence, b.source_type FROM (SELECT DISTINCT group_id, concat('G_', CAST(group_id AS STRING)) AS entity FROM members) e LEFT JOIN (
    SELECT m.group_id, g.* FROM members m JOIN ({_GATHER}) g USING (photo_id) WHERE NOT EXISTS (SELECT 1 FROM members m2 JOIN ({_GATHER}) h ON h.photo_id = m2.photo_id WHERE m2.group_id = m.group_id AND h.tier = g.tier AND length(h.date_value) > length(g.date_value) AND starts_with(h.date_value, g.date_value))
    QUALIFY row_number() OVER (PARTITION BY m.group_id ORDER BY CASE g.tier WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, {_PAD.replace('date_value', 'g.date_value')}, g.kind, g.n, g.photo_id) = 1) b USING (group_id)"""


def _derived(c):
    return fusion.derive(_entities(c), fusion.gather(_dated(c), c.paths))


R.add("d2_d5_derived_dates", lambda c: _derived(c).select("entity", "date_value", "confidence", "source_type"), _DERIVED, "members", "paths")


def _conflicts(c):
    rows = c.bare.select(F.col("id").alias("photo_id"), D.exif_datetime(F.col("exif_datetime")).alias("date_value"), F.lit("exif_original").alias("source_type"), D.exif_confidence(D.exif_datetime(F.col("exif_datetime")), F.col("exif_make"), F.col("exif_model"), F.col("exif_software")).alias("confidence"))
    sources = fusion.gather(_dated(c), c.paths, rows, mode="documented")
    return fusion.derive(_entities(c), sources).filter("has_conflict").select("entity", F.array_join("conflict_dates", "|").alias("dates"))


R.add(
    "d4_conflicts", _conflicts,
    f"SELECT concat('G_', CAST(group_id AS STRING)) AS entity, string_agg(DISTINCT iso, '|' ORDER BY iso) AS dates FROM (SELECT group_id, {_ISO} AS iso FROM members JOIN photos ON id = photo_id WHERE {_RATE} = 'high') GROUP BY group_id HAVING max(CAST(substr(iso, 1, 4) AS INT)) - min(CAST(substr(iso, 1, 4) AS INT)) > 1", "members",
)
R.add(
    "d6_date_index",
    lambda c: fusion.date_index(_entities(c), c.bare, _derived(c)),
    f"""SELECT coalesce(substr(d.date_value, 1, 10), 'unknown') AS display_date, d.entity, r.photo_id AS representative, n.n AS photo_count, CASE WHEN res >= 2000000 THEN 'high' WHEN res >= 500000 THEN 'medium' ELSE 'low' END AS quality FROM ({_DERIVED}) d
    JOIN (SELECT concat('G_', CAST(group_id AS STRING)) AS entity, photo_id, width * height AS res FROM members JOIN photos ON id = photo_id QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY width * height DESC, photo_id) = 1) r USING (entity)
    JOIN (SELECT concat('G_', CAST(group_id AS STRING)) AS entity, count(*) AS n FROM members GROUP BY group_id) n USING (entity)""", "members", "paths",
)
R.add(
    "d7_calendar",
    lambda c: fusion.calendar(c.table("orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("display_date"), F.lit(1).alias("photo_count")), 1996).withColumn("day", F.col("day").cast("string")),
    "SELECT CAST(d AS VARCHAR) AS day, CAST(isodow(d) AS INT) AS weekday, CAST(count(o_orderkey) AS BIGINT) AS photos FROM (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d",
)

# ---- files ------------------------------------------------------------------
_MAGIC = ["ffd8ffe0", "89504e470d0a1a0a", "474946383961", "424d9999", "49492a00", "52494646aaaaaaaa57454250", "00000018667479706865696300", "25504446"]


def _contents(c):
    kinds = F.array(*[F.unhex(F.lit(x)) for x in _MAGIC])
    return c.table("documents").select("doc_id", F.concat(F.element_at(kinds, (F.col("doc_id") % len(_MAGIC) + 1).cast("int")), F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("content"))


R.add(
    "s2_s3_sniff_and_hash",
    lambda c: _contents(c).select("doc_id", X.sniff_mime(F.col("content")).alias("mime_type"), F.sha2("content", 256).alias("id")),
    f"SELECT doc_id, [{', '.join(repr(x) for x in ('image/jpeg', 'image/png', 'image/gif', 'image/bmp', 'image/tiff', 'image/webp', 'image/heic'))}, NULL][1 + doc_id % 8] AS mime_type, sha256(unhex([{', '.join(repr(x) for x in _MAGIC)}][1 + doc_id % 8]) || encode(coalesce(text, ''))) AS id FROM documents",
)
R.add(
    "s9_date_sources",
    lambda c: ingest.date_sources(c.bare.join(c.paths, F.col("id") == F.col("photo_id")).select("id", "source_path", "filename", F.lit(None).cast("timestamp").alias("mtime"), "exif_make", "exif_model", "exif_software", F.lit(None).cast("string").alias("exif_datetime_original"), F.lit(None).cast("string").alias("exif_datetime_digitized"), "exif_datetime")).select("photo_id", "source_type", "date_value", "confidence", "source_path"),
    f"SELECT id AS photo_id, 'exif_datetime' AS source_type, {_ISO} AS date_value, CASE WHEN {_RATE} = 'high' THEN 'medium' ELSE {_RATE} END AS confidence, source_path FROM photos JOIN paths ON photo_id = id WHERE {_ISO} IS NOT NULL UNION ALL SELECT photo_id, source_type, date_value, tier, source_path FROM ({_GATHER}) g JOIN paths USING (photo_id) WHERE kind > 0 AND g.n = path_id", "photos", "paths",
)
R.add(
    "s10_first_of_each_photo",
    lambda c: ingest.photos_of(ingest.new_paths(c.paths.select(F.col("photo_id").alias("id"), "source_path", "filename", F.lit(0).alias("mtime"), "path_id"), c.paths.filter("source_path LIKE '/Camera/%'"))).select("id", "path_id"),
    "SELECT photo_id AS id, arg_min(path_id, source_path) AS path_id FROM paths WHERE source_path NOT LIKE '/Camera/%' GROUP BY 1", "paths",
)
R.add(
    "s11_numbered_paths",
    lambda c: ingest.numbered_paths(c.paths.select(F.col("photo_id").alias("id"), "source_path", "filename", F.lit(None).cast("timestamp").alias("mtime"))).select("path_id", "photo_id", "source_path"),
    "SELECT row_number() OVER (ORDER BY source_path) AS path_id, photo_id, source_path FROM paths", "paths",
)
R.add(
    "s13_link_plan",
    lambda c: ingest.link_plan(c.bare, c.paths),
    "SELECT photo_id, src, concat('files/', substr(photo_id, 1, 2), '/', photo_id, CASE mime_type WHEN 'image/png' THEN '.png' WHEN 'image/gif' THEN '.gif' WHEN 'image/tiff' THEN '.tiff' ELSE '.jpg' END) AS dest FROM (SELECT photo_id, arg_min(source_path, path_id) AS src FROM paths GROUP BY 1) JOIN photos ON id = photo_id", "photos", "paths",
)
R.add(
    "s15_import_hashes",
    lambda c: ingest.import_hashes(c.bare.select("id", F.when(F.col("L") % 2 == 0, F.lit("own")).alias("perceptual_hash")), c.bare.filter("exif_make IS NOT NULL").select("id", F.lit("theirs").alias("perceptual_hash"))),
    "SELECT id, CASE WHEN L % 2 = 0 THEN 'own' WHEN exif_make IS NOT NULL THEN 'theirs' END AS perceptual_hash FROM photos", "photos",
)
R.add("x29_text_hashes", lambda c: c.hashes.select("id", X.long_to_hex(F.col("phash")).alias("phash"), X.long_to_hex(F.col("dhash")).alias("dhash")), "SELECT id, printf('%08x%08x', p_hi, p_lo) AS phash, printf('%08x%08x', d_hi, d_lo) AS dhash FROM hashes", "hashes")

def _scored(c):
    first = c.paths.groupBy(F.col("photo_id").alias("id")).agg(F.min_by("source_path", "path_id").alias("path"))
    return c.bare.join(first, "id").select("id", "path", (F.col("L") % 101).alias("score"), F.when(F.col("L") % 4 == 0, "tiny").alias("reason"))


_FIRST = "(SELECT photo_id, arg_min(source_path, path_id) AS path FROM paths GROUP BY 1) f JOIN photos ON id = photo_id"
_BUCKET = "CASE WHEN L % 101 >= 70 THEN 'high_confidence' WHEN L % 101 >= 40 THEN 'medium_confidence' ELSE 'low_confidence' END"
R.add("s18_bucket_plan", lambda c: legacy.bucket_plan(_scored(c)), rf"SELECT photo_id, path AS src, {_BUCKET} AS bucket, concat('images/', {_BUCKET}, '/', photo_id, regexp_extract(path, '\.[^.]+$')) AS dest FROM {_FIRST}", "paths", "photos")
R.add("s19_move_plan", lambda c: legacy.move_plan(_scored(c)), f"SELECT photo_id, path AS src, concat('filtered/tiny/', {_BUCKET}, '/', split_part(path, '/', -1)) AS dest FROM {_FIRST} WHERE L % 4 = 0", "paths", "photos")
R.add(
    "s20_export_names",
    lambda c: legacy.export_names(legacy_rank(c.small("members").join(c.bare.withColumn("score", F.col("L") % 101), F.col("photo_id") == F.col("id")).drop("photo_id")).join(c.bare.selectExpr("id AS photo_id", "width", "height"), "photo_id").withColumn("filename", F.substring("photo_id", 1, 8))),
    "SELECT photo_id, group_id, printf('%04d_%s%dx%d_q%d_%s', n, CASE WHEN n = 1 THEN 'KEEPER_' ELSE '' END, width, height, q, substr(photo_id, 1, 8)) AS link FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY q DESC, photo_id) AS n FROM (SELECT photo_id, group_id, width, height, CAST(floor(width * height * ((L % 101) / 100.0::DOUBLE)) AS BIGINT) AS q FROM members JOIN photos ON id = photo_id))", "members", "photos",
)
R.add("x30_same_bytes", lambda c: legacy.same_pixels(c.table("documents").selectExpr("doc_id AS id", "encode(coalesce(text, ''), 'UTF-8') AS content")), "SELECT m.id_1, d.doc_id AS id_2 FROM documents d JOIN (SELECT coalesce(text, '') AS t, min(doc_id) AS id_1 FROM documents GROUP BY 1) m ON m.t = coalesce(d.text, '') WHERE m.id_1 < d.doc_id")



def _pictures(c):
    """Contents in the shape of binaryFile: PNG headers with sizes, TIFF directories with a camera's name, and other bytes."""
    number = lambda n, digits: F.unhex(F.lpad(F.hex(n), digits, "0"))
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), number(F.col("page_id") % 4096, 8), number(F.length("url"), 8))
    make = F.concat(F.lit(" Maker "), F.col("page_id").cast("string"), F.lit("  "))
    tiff = F.concat(F.unhex(F.lit("49492A0008000000" + "0100" + "0F010200")), number(F.length(make) + 1, 2), F.unhex(F.lit("000000" + "1A000000" + "00000000")), F.encode(make, "UTF-8"), F.unhex(F.lit("00")))
    content = F.when(F.col("page_id") % 3 == 0, png).when(F.col("page_id") % 3 == 1, tiff).otherwise(F.encode("html", "UTF-8"))
    pages = c.table("pages")
    return pages.select(F.concat(F.lit("/in/"), F.col("page_id").cast("string")).alias("source_path"), F.col("page_id").cast("string").alias("filename"), F.lit(None).cast("timestamp").alias("mtime"), F.lit(0).cast("long").alias("file_size"), content.alias("content"))


R.add(
    "s4_s7_described_files",
    lambda c: ingest.describe_files(_pictures(c)).select("source_path", "mime_type", "width", "height", "exif_make", "exif_model"),
    "SELECT '/in/' || page_id AS source_path, CASE page_id % 3 WHEN 0 THEN 'image/png' ELSE 'image/tiff' END AS mime_type, CASE page_id % 3 WHEN 0 THEN page_id % 4096 END AS width, CASE page_id % 3 WHEN 0 THEN CAST(length(url) AS BIGINT) END AS height, CASE page_id % 3 WHEN 1 THEN 'Maker ' || page_id END AS exif_make, CAST(NULL AS VARCHAR) AS exif_model FROM pages WHERE page_id % 3 < 2",
)
R.add("s1_s8_scanned_files", lambda c: ingest.scan_files(c.spark, c.dir, contents=False).select("filename", "file_size", F.col("mtime").isNotNull().alias("timed")))


def _config(c):
    """Cells as a threshold file holds them, written and read back."""
    cells = c.bare.selectExpr("L % 2 = 0 AS even", "concat(CAST(20 + L % 50 AS STRING), ',', CAST(L % 15 AS STRING)) AS cell").distinct()
    lists = cells.agg(F.collect_list(F.when(F.col("even"), F.col("cell"))).alias("complete"), F.collect_list(F.when(~F.col("even"), F.col("cell"))).alias("single"))
    path = new_path(c.spark, "thresholds")
    lists.write.json(path)
    return legacy.read_boundaries(c.spark, path)


R.add("s16_thresholds", _config, "SELECT DISTINCT CASE WHEN L % 2 = 0 THEN 'complete' ELSE 'single' END AS kind, concat(CAST(20 + L % 50 AS STRING), ',', CAST(L % 15 AS STRING)) AS cell FROM photos", "photos")


def _table_file(c):
    path = new_path(c.spark, "rows")
    ingest.write_tsv(c.bare.select("id", "exif_make", "L"), path)
    return c.spark.read.text(path).filter("value <> 'id\texif_make\tL'").select(F.col("value").alias("line"))


R.add("s21_table_file", _table_file, r"SELECT id || chr(9) || coalesce(exif_make, '') || chr(9) || L AS line FROM photos", "photos")


def _ledger(c):
    counted = c.small("decisions").groupBy(F.col("rule_name").alias("stage")).agg(F.count(F.lit(1)).alias("photo_count")).withColumn("notes", F.lit(None).cast("string"))
    return legacy.record_stage(legacy.record_stage(counted, "TINY_ICON", 7, "again"), "export", 1)


R.add("f7_stage_ledger", _ledger, "SELECT rule_name AS stage, count(*) AS photo_count, CAST(NULL AS VARCHAR) AS notes FROM decisions WHERE rule_name <> 'TINY_ICON' GROUP BY 1 UNION ALL VALUES ('TINY_ICON', 7, 'again'), ('export', 1, NULL)", "decisions")

QUERIES, ORACLES = R.queries, R.oracles
