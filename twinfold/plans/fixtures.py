"""The catalog that queries run on, derived from the driver's tables, in Spark and as SQL for DuckDB.

A distinct text plays a picture, a document row one of its paths; pixels, bytes and camera fields follow from
the text's length, and 64-bit majority hashes of its words play perceptual hashes.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession

from twinfold.sources.ingest import text_hashes

#: Expressions that both engines read alike; L is the text's length, k its class of 256 characters.
_PHOTO = {
    "width": "CAST(40 * (1 + k) AS BIGINT)",
    "height": "CAST(30 * (1 + k) AS BIGINT)",
    "mime_type": "CASE WHEN L % 5 = 0 THEN 'image/png' WHEN L % 5 = 1 THEN 'image/gif' WHEN L % 7 = 0 THEN 'image/tiff' ELSE 'image/jpeg' END",
    "exif_make": "CASE WHEN L % 3 = 0 THEN 'Canon' WHEN L % 3 = 1 AND L % 2 = 0 THEN 'Nikon' END",
    "exif_model": "CASE WHEN L % 6 < 4 THEN concat('M', CAST(L % 4 AS STRING)) END",
    "exif_software": "CASE WHEN L % 4 = 1 THEN 'Editor' END",
    "exif_datetime": "concat(CAST(1985 + L % 50 AS STRING), ':', lpad(CAST(1 + L % 13 AS STRING), 2, '0'), ':', lpad(CAST(1 + L % 31 AS STRING), 2, '0'), ' ', lpad(CAST(L % 25 AS STRING), 2, '0'), ':', lpad(CAST(L % 60 AS STRING), 2, '0'), ':00')",
}
#: Each row's path by its number; {} is the number.
PATHS = [
    "/Backup/tor/Pictures/2013/03/03/IMG_{}.jpg", "/Home/Photo Booth Library/Pictures/Photo on {}.jpg", "/Films/HUE Animation/frame_{}.png", "/Games/minecraft/texture{}.png", "/Library/iChat Icons/Flags/{}.gif",
    "/Web/page{}_files/logo.png", "/Lib/modelresources/x/IMG_{}_face0.jpg", "/Import/20140223-155504/{}_1024.jpg", "/Import/20121223-175144/{}.jpg", "/FlipShare Data/Previews/{}.jpg", "/Camera/MVI_{}.jpg",
    "/Applications/Photo.app/Contents/{}.png", "/Disk/.Trashes/{}.jpg", "/Lib/Thumbnails/thumb_{}.jpg", "/Lib/Previews/IMG_{}.jpg", "/Old/iPhoto.photolibrary/IMG_{}.jpg", "/New/Mac.photoslibrary/IMG_{}.jpg",
    "/Camera/101122 Rose ballet/IMG_{}.jpg", "/Camera/April 2010/DSC_{}.jpg", "/Camera/Xmas 2004/thumb_{}_2.jpg", "/Camera/2004/20040615_101112_{}.jpg", "/Camera/misc/2003-07-{}_x.jpg", "/Camera/2012 May/P1020304_{}.jpg", "/Screens/Screen Shot 2023-05-14 at 09.48.46 {}.png",
]


def _path_case() -> str:
    whens = " ".join(f"WHEN {k} THEN concat('{a}', CAST(doc_id AS STRING), '{b}')" for k, (a, b) in enumerate(p.split("{}") for p in PATHS))
    return f"CASE CAST(doc_id % {len(PATHS)} AS INT) {whens} END"


#: Small tables over photos (id, L) with plain rules, for queries that only need some content.
_TABLES = {
    "decisions": "SELECT id AS photo_id, CASE WHEN L % 11 = 0 THEN 'reject' ELSE 'separate' END AS decision, CASE WHEN L % 22 = 0 THEN 'TINY_ICON' WHEN L % 11 = 0 THEN 'WEB_ASSET' ELSE 'PHOTOBOOTH' END AS rule_name FROM photos WHERE L % 11 = 0 OR L % 13 = 0",
    "members": "SELECT id AS photo_id, CAST(L % 61 AS BIGINT) AS group_id FROM photos WHERE L % 3 <> 0",
    "second": "SELECT id AS photo_id, CAST(L % 401 AS BIGINT) AS group_id FROM photos WHERE L % 4 <> 0",
    "rejections": "SELECT id AS photo_id, CAST(L % 61 AS BIGINT) AS group_id, CASE WHEN L % 2 = 0 THEN 'THUMBNAIL' ELSE 'DERIVATIVE' END AS rule_name FROM photos WHERE L % 3 <> 0 AND L % 7 = 0",
    "junk": "SELECT id AS photo_id, CAST(L % 61 AS BIGINT) AS group_id FROM photos WHERE L % 17 = 0",
    "reviewed": "SELECT DISTINCT CAST(L % 61 AS BIGINT) AS group_id FROM photos WHERE L % 5 = 0",
}


def _spark_photos(docs: DataFrame) -> DataFrame:
    rows = docs.selectExpr("coalesce(text, '') AS text").distinct().selectExpr("sha2(text, 256) AS id", "text", "CAST(length(text) AS BIGINT) AS L", "CAST(floor(length(text) / 256) AS BIGINT) AS k", "CAST(octet_length(text) AS BIGINT) AS file_size")
    return rows.selectExpr("*", *[f"{e} AS {c}" for c, e in _PHOTO.items()])


class Catalog:
    """The derived tables of one folder of the driver's tables, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def bare(self) -> DataFrame:
        """Photos without hashes; text and helpers L and k stay, and pruning drops what isn't used."""
        return _spark_photos(self.table("documents"))

    @cached_property
    def hashes(self) -> DataFrame:
        return text_hashes(self.bare.select("id", "text"))

    @cached_property
    def photos(self) -> DataFrame:
        return self.bare.drop("text", "k").join(self.hashes, "id")

    @cached_property
    def paths(self) -> DataFrame:
        rows = self.table("documents").selectExpr("doc_id AS path_id", "sha2(coalesce(text, ''), 256) AS photo_id", f"{_path_case()} AS source_path")
        return rows.selectExpr("*", "element_at(split(source_path, '/'), -1) AS filename")

    @cached_property
    def inventory(self) -> DataFrame:
        pages = self.table("documents").filter(f"doc_id % {len(PATHS)} = 5 AND doc_id % 2 = 1").selectExpr("concat('/Web/page', CAST(doc_id AS STRING), '.html') AS path")
        return self.paths.selectExpr("source_path AS path").unionByName(pages)

    def small(self, name: str) -> DataFrame:
        return self.spark.sql(_TABLES[name].replace("FROM photos", "FROM {photos}"), photos=self.bare.select("id", "L"))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, sf_dir)


# ---- the same in SQL --------------------------------------------------------


def _half(salt: str, at: int, name: str) -> str:
    bits = " + ".join(f"(CASE WHEN 2 * sum((h{name} >> {b}) & 1) > count(*) THEN {1 << b} ELSE 0 END)" for b in range(32))
    return f"CAST({bits} AS BIGINT) AS {name}"


@cache
def ctes() -> dict[str, str]:
    """name -> body of each CTE; later ones may use earlier ones."""
    photo = ", ".join(f"{e} AS {c}" for c, e in _PHOTO.items())
    word = "('0x' || substr(md5('{s}' || word), {a}, 8))::BIGINT AS h{n}"
    halves = [("", 1, "p_hi"), ("", 9, "p_lo"), ("d:", 1, "d_hi"), ("d:", 9, "d_lo")]
    dist = "CAST(bit_count(xor(a.{x}_hi, b.{x}_hi)) + bit_count(xor(a.{x}_lo, b.{x}_lo)) AS INT)"
    p, d = dist.format(x="p"), dist.format(x="d")
    out = {
        "photos": f"SELECT *, {photo} FROM (SELECT sha256(text) AS id, text, CAST(length(text) AS BIGINT) AS L, CAST(floor(length(text) / 256) AS BIGINT) AS k, CAST(strlen(text) AS BIGINT) AS file_size FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents))",
        "paths": f"SELECT *, split_part(source_path, '/', -1) AS filename FROM (SELECT doc_id AS path_id, sha256(coalesce(text, '')) AS photo_id, {_path_case()} AS source_path FROM documents)",
        "listed": "SELECT photo_id, list(source_path ORDER BY path_id, source_path) AS paths FROM paths GROUP BY photo_id",
        "inventory": f"SELECT source_path AS path FROM paths UNION ALL SELECT concat('/Web/page', CAST(doc_id AS STRING), '.html') FROM documents WHERE doc_id % {len(PATHS)} = 5 AND doc_id % 2 = 1",
        "words": "SELECT DISTINCT id, word FROM (SELECT id, unnest(regexp_split_to_array(lower(trim(text)), '[ \\t\\n\\r\\f\\v]+')) AS word FROM photos) WHERE word <> ''",
        "hashed": "SELECT id, " + ", ".join(word.format(s=s, a=a, n=n) for s, a, n in halves) + " FROM words",
        "hashes": "SELECT id, " + ", ".join(_half(s, a, n) for s, a, n in halves) + " FROM hashed GROUP BY id",
        "near": f"SELECT id_1, id_2, phash_dist, dhash_dist FROM (SELECT a.id AS id_1, b.id AS id_2, {p} AS phash_dist, {d} AS dhash_dist FROM hashes a JOIN hashes b ON a.id < b.id) WHERE phash_dist <= 10 OR (phash_dist <= 12 AND dhash_dist < 22) OR (phash_dist <= 14 AND dhash_dist <= 17)",
        "reach": "SELECT id_1 AS node, id_2 AS other FROM near UNION SELECT id_2, id_1 FROM near UNION SELECT r.node, CASE WHEN n.id_1 = r.other THEN n.id_2 ELSE n.id_1 END FROM reach r JOIN near n ON n.id_1 = r.other OR n.id_2 = r.other",
        "components": "SELECT node, least(node, min(other)) AS label FROM reach GROUP BY node",
        "near8": f"SELECT a.id AS id_1, b.id AS id_2 FROM hashes a JOIN hashes b ON a.id < b.id WHERE {p} <= 8",
        "reach8": "SELECT id_1 AS node, id_2 AS other FROM near8 UNION SELECT id_2, id_1 FROM near8 UNION SELECT r.node, CASE WHEN n.id_1 = r.other THEN n.id_2 ELSE n.id_1 END FROM reach8 r JOIN near8 n ON n.id_1 = r.other OR n.id_2 = r.other",
        "legacy_groups": "SELECT node AS photo_id, CAST(dense_rank() OVER (ORDER BY label) - 1 AS BIGINT) AS group_id FROM (SELECT node, least(node, min(other)) AS label FROM reach8 GROUP BY node)",
        "unlinked": "SELECT n.*, CASE WHEN a.group_id IS NULL AND b.group_id IS NULL THEN 'both_singleton' WHEN a.group_id IS NULL OR b.group_id IS NULL THEN 'one_singleton' ELSE 'different_groups' END AS reason FROM near n LEFT JOIN members a ON a.photo_id = n.id_1 LEFT JOIN members b ON b.photo_id = n.id_2 WHERE a.group_id IS DISTINCT FROM b.group_id",
        "bridge": "SELECT DISTINCT least(x.group_id, y.group_id) AS g1, greatest(x.group_id, y.group_id) AS g2 FROM unlinked u JOIN members x ON x.photo_id = u.id_1 JOIN members y ON y.photo_id = u.id_2 WHERE reason = 'different_groups'",
        "group_reach": "SELECT g1 AS node, g2 AS other FROM bridge UNION SELECT g2, g1 FROM bridge UNION SELECT r.node, CASE WHEN b.g1 = r.other THEN b.g2 ELSE b.g1 END FROM group_reach r JOIN bridge b ON b.g1 = r.other OR b.g2 = r.other",
        "merges": "SELECT node AS old, min(other) AS new FROM group_reach GROUP BY node HAVING min(other) < node",
        "merged": "SELECT photo_id, coalesce(new, group_id) AS group_id FROM members LEFT JOIN merges ON old = group_id",
        "firsts": "SELECT label, row_number() OVER (ORDER BY label) - 1 AS group_id FROM (SELECT DISTINCT label FROM components)",
        "comp_groups": "SELECT node AS photo_id, CAST(group_id AS BIGINT) AS group_id FROM components JOIN firsts USING (label)",
        "held": "SELECT id AS photo_id, concat('a', CAST(floor(L / 5) AS BIGINT)) AS tier FROM photos WHERE L % 3 <> 0 AND id NOT IN (SELECT photo_id FROM decisions) UNION ALL SELECT id, concat('b', CAST(floor((L + 2) / 5) AS BIGINT)) FROM photos WHERE L % 3 <> 2",
        "touching": "SELECT DISTINCT x.tier AS a, y.tier AS b FROM held x JOIN held y USING (photo_id)",
        "tier_reach": "SELECT a AS node, b AS other FROM touching UNION SELECT r.node, t.b FROM tier_reach r JOIN touching t ON t.a = r.other",
    }
    return out | _TABLES


NEEDS = {"listed": ["paths"], "inventory": ["paths"], "words": ["photos"], "hashed": ["words"], "hashes": ["hashed"], "near": ["hashes"], "reach": ["near"], "components": ["reach"], "firsts": ["components"], "comp_groups": ["components", "firsts"], "near8": ["hashes"], "reach8": ["near8"], "legacy_groups": ["reach8"], "unlinked": ["near", "members"], "bridge": ["unlinked"], "group_reach": ["bridge"], "merges": ["group_reach"], "merged": ["merges", "members"], "held": ["photos", "decisions"], "touching": ["held"], "tier_reach": ["touching"]} | {t: ["photos"] for t in _TABLES}


def sql(body: str, *tables: str) -> str:
    """body with the CTEs that tables name, and those that they need, before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for t in tables:
        add(t)
    recursive = "RECURSIVE " if {"reach", "reach8", "group_reach", "tier_reach"} & set(order) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({ctes()[n]})" for n in order) + "\n" + body if order else body
