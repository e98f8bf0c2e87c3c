"""Queries over files and pictures that Spark makes from the given tables: trees, headers of all types, rasters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinfold.plans.register import Registry
from twinfold.sources import ingest, legacy
from twinfold.sources.file_tree import write_files
from twinfold.sources.scratch import new_path, stored

R = Registry()


def _big(n: Column, size: int) -> Column:
    """A number as hex digits of size bytes, high ones first."""
    return F.lpad(F.hex(n), 2 * size, "0")


def _little(n: Column, size: int) -> Column:
    return F.concat(*[F.lpad(F.hex(F.shiftright(n, 8 * k).bitwiseAND(255)), 2, "0") for k in range(size)])


def _hex(text: str) -> str:
    return text.encode().hex()


def _box(kind: str, size: int, *body: Column) -> Column:
    """An ISO box around hex digits of size bytes."""
    return F.concat(F.lit(f"{8 + size:08x}{_hex(kind)}"), *body)


# ---- headers of all types, with sizes and EXIF ------------------------------
#: Expressions that both engines read alike.
_W, _H = "1 + page_id * 7 % 4000", "1 + length(coalesce(url, '')) * 13 % 3000"
_KINDS = ["jpeg", "png", "gif", "bmp", "tiff", "webp", "webp", "heic", "heif"]


def _pictures(c):
    """Contents whose headers say a size, and but for GIF and BMP a camera; every 11th is cut off after 14 bytes."""
    w, h, lit = F.col("w"), F.col("h"), F.lit
    make, model = (F.concat(lit(_hex(x)), F.hex(F.encode(F.col("page_id").cast("string"), "UTF-8")), lit("00")) for x in ("Maker ", "Model "))
    pages = c.table("pages").selectExpr("page_id", f"{_W} AS w", f"{_H} AS h", f"CAST(page_id % {len(_KINDS)} AS INT) AS kind", "7 + length(CAST(page_id AS STRING)) AS n")
    entry = lambda tag, kind, count, value: F.concat(_little(lit(tag), 2), _little(lit(kind), 2), _little(count.cast("long"), 4), _little(value.cast("long"), 4))
    tiff = F.concat(lit("49492A00080000000400"), entry(0x100, 4, lit(1), w), entry(0x101, 3, lit(1), h), entry(0x10F, 2, F.col("n"), lit(62)), entry(0x110, 2, F.col("n"), F.col("n") + 62), lit("00000000"), make, model)
    pages = stored(pages.select("page_id", "w", "h", "kind", (62 + 2 * F.col("n")).cast("long").alias("t"), tiff.alias("tiff")), "exif-blocks")
    tiff, t = F.col("tiff"), F.col("t")
    jpeg = F.concat(lit("FFD8FFE00010" + _hex("JFIF") + "00" * 10 + "FFE1"), _big(t + 8, 2), lit(_hex("Exif") + "0000"), tiff, lit("FFC0000B08"), _big(h, 2), _big(w, 2), lit("01011100FFDA0002"))
    png = F.concat(lit("89504E470D0A1A0A0000000D" + _hex("IHDR")), _big(w, 4), _big(h, 4), lit("080200000000000000"), _big(t, 4), lit(_hex("eXIf")), tiff, lit("00000000"))
    gif = F.concat(lit(_hex("GIF89a")), _little(w, 2), _little(h, 2), lit("000000"))
    bmp = F.concat(lit(_hex("BM") + "00" * 12 + "28000000"), _little(w, 4), _little(h, 4), lit("01001800"))
    webp = lambda head: F.concat(lit(_hex("RIFF") + "00000000" + _hex("WEBP")), head, lit(_hex("EXIF")), _little(t, 4), tiff)  # noqa: E731  t is even
    extended = webp(F.concat(lit(_hex("VP8X") + "0a000000" + "08000000"), _little(w - 1, 3), _little(h - 1, 3)))
    lossless = webp(F.concat(lit(_hex("VP8L") + "05000000" + "2F"), _little((w - 1).bitwiseOR(F.shiftleft((h - 1).cast("long"), 14)), 4), lit("00")))
    properties = _box("iprp", 48, _box("ipco", 20, _box("ispe", 12, lit("00000000"), _big(w, 4), _big(h, 4))), _box("ipma", 12, lit("00000000" + "00000001" + "0001" + "01" + "81")))
    items = _box("iinf", 27, lit("00000000" + "0001"), _box("infe", 13, lit("02000000" + "0002" + "0000" + _hex("Exif") + "00")))
    places = _box("iloc", 22, lit("00000000" + "4400" + "0001" + "0002" + "0000" + "0001" + f"{171:08x}"), _big(t + 10, 4))
    meta = _box("meta", 139, lit("00000000"), _box("pitm", 6, lit("00000000" + "0001")), items, places, properties)
    boxed = lambda brand: F.concat(_box("ftyp", 8, lit(_hex(brand) + "00000000")), meta, _big(t + 18, 4), lit(_hex("mdat") + "00000006" + _hex("Exif") + "0000"), tiff)
    kinds = [jpeg, png, gif, bmp, tiff, extended, lossless, boxed("heic"), boxed("mif1")]
    content = F.lit(None).cast("string")
    for k, x in enumerate(kinds):
        content = F.when(F.col("kind") == k, x).otherwise(content)
    whole = F.unhex(content)
    cut = F.when(F.col("page_id") % 11 == 0, F.substring(whole, 1, 14)).otherwise(whole)
    return pages.select(F.concat(F.lit("/in/"), F.col("page_id").cast("string")).alias("source_path"), F.col("page_id").cast("string").alias("filename"), F.lit(None).cast("timestamp").alias("mtime"), F.lit(0).cast("long").alias("file_size"), cut.alias("content"))


def _shown(name: str, value: str) -> str:
    return f"CASE WHEN page_id % 11 <> 0 AND page_id % 9 NOT IN (2, 3) THEN {value} END AS {name}"


R.add(
    "s4_s7_all_types",
    lambda c: ingest.describe_files(stored(_pictures(c), "pictures")).select("source_path", "mime_type", "width", "height", "exif_make", "exif_model"),
    f"SELECT '/in/' || page_id AS source_path, 'image/' || {_KINDS}[1 + page_id % 9] AS mime_type, CASE WHEN page_id % 11 <> 0 THEN CAST({_W} AS BIGINT) WHEN page_id % 9 = 2 THEN CAST({_W} AS BIGINT) END AS width, CASE WHEN page_id % 11 <> 0 OR page_id % 9 = 2 THEN CAST({_H} AS BIGINT) END AS height, {_shown('exif_make', chr(39) + 'Maker ' + chr(39) + ' || page_id')}, {_shown('exif_model', chr(39) + 'Model ' + chr(39) + ' || page_id')} FROM pages",
)

# ---- trees ------------------------------------------------------------------
#: Folders and names of a tree; {} is a document's number.
_FOLDERS = ["Camera/2004", ".Trashes/501", "Lib/.hidden/deep/er", "_private", "Camera"]
_NAMES = ["IMG_{}.jpg", "._IMG_{}.jpg", ".DS_Store", "_{}.png", ".{}.gif", "Thumbs.db", "{}"]
_TREE_PATH = f"concat(element_at(array({', '.join(map(repr, _FOLDERS))}), CAST(doc_id % {len(_FOLDERS)} AS INT) + 1), '/', CAST(doc_id % 23 AS STRING), '/', replace(element_at(array({', '.join(map(repr, _NAMES))}), CAST(doc_id % {len(_NAMES)} AS INT) + 1), '{{}}', CAST(doc_id AS STRING)))"
_SQL_PATH = _TREE_PATH.replace("element_at(array(", "list_extract(list_value(")


def _scanned(c):
    """The files of a tree that is written from documents, a file for each path, and scanned."""
    root = new_path(c.spark, "tree")
    rows = c.table("documents").selectExpr(f"{_TREE_PATH} AS path", "coalesce(text, '') AS text").groupBy("path").agg(F.max("text").alias("text"))
    stored(write_files(rows.select("path", F.encode("text", "UTF-8").alias("content")), root), "written")
    found = ingest.scan_files(c.spark, root)
    return found.select(F.regexp_replace("source_path", "^.*/tree-[0-9a-f]+/", "").alias("path"), "filename", "file_size", F.sha2("content", 256).alias("digest"), F.col("mtime").isNotNull().alias("timed"))


R.add(
    "s1_s3_walked_tree",
    _scanned,
    f"SELECT path, split_part(path, '/', -1) AS filename, CAST(strlen(text) AS BIGINT) AS file_size, sha256(text) AS digest, true AS timed FROM (SELECT {_SQL_PATH} AS path, max(coalesce(text, '')) AS text FROM documents GROUP BY 1) WHERE NOT starts_with(split_part(path, '/', -1), '._') AND split_part(path, '/', -1) NOT IN ('.DS_Store', 'Thumbs.db')",
)

# ---- rasters ----------------------------------------------------------------
_LINE = 24


def _bitmaps(c):
    """Documents as pictures of 8 pixels a row, of three bytes of text each: odd ones from the bottom up, even ones from the top down."""
    docs = c.table("documents").selectExpr("doc_id AS id", "encode(coalesce(text, ''), 'UTF-8') AS b").filter("octet_length(b) > 0").withColumn("h", F.ceil(F.octet_length("b") / _LINE).cast("int"))
    digits = F.rpad(F.hex("b"), 2 * _LINE * F.col("h"), "0")
    up = F.array_join(F.reverse(F.regexp_extract_all(digits, F.lit(f".{{{2 * _LINE}}}"), F.lit(0))), "")
    signed = F.when(F.col("id") % 2 == 0, F.lit(2**32) - F.col("h")).otherwise(F.col("h").cast("long"))
    head = F.concat(F.lit(_hex("BM") + "00000000" + "00000000" + "36000000" + "28000000" + "08000000"), _little(signed, 4), F.lit("01001800" + "00" * 24))
    return docs.select("id", F.unhex(F.concat(head, F.when(F.col("id") % 2 == 0, digits).otherwise(up))).alias("content"))


R.add(
    "x30_same_pictures",
    lambda c: legacy.same_pictures(ingest.picture_hashes(_bitmaps(c), ("pixel_digest",))),
    f"WITH p AS (SELECT doc_id, rpad(hex(encode(text)), CAST({2 * _LINE} * ceil(strlen(text) / {_LINE}.0) AS INT), '0') AS pixels FROM documents WHERE strlen(text) > 0) SELECT m.id_1, p.doc_id AS id_2 FROM p JOIN (SELECT pixels, min(doc_id) AS id_1 FROM p GROUP BY 1) m USING (pixels) WHERE m.id_1 < p.doc_id",
)


def _tiles(c):
    """Each document cut into gray pictures of 9 x 8 pixels, a byte of text each; what is missing at the end is black."""
    docs = c.table("documents").selectExpr("doc_id", "encode(coalesce(text, ''), 'UTF-8') AS b").filter("octet_length(b) > 0")
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.octet_length("b") - 1) / 72)), lambda k: F.substring(F.col("b"), (72 * k + 1).cast("int"), F.lit(72)))
    tiles = docs.select("doc_id", F.posexplode(cut).alias("tile", "part")).select("doc_id", F.col("tile").cast("long"), F.expr("rpad(part, 72, X'00')").alias("part"))
    rows = [x for k in range(8) for x in (F.substring("part", 9 * k + 1, 9), F.expr("X'000000'"))]
    grays = "".join(f"{k:02x}" * 3 + "00" for k in range(256))
    head = _hex("BM") + "00" * 8 + "36040000" + "28000000" + "09000000" + "f8ffffff" + "01000800" + "00" * 24 + grays
    return tiles.select("doc_id", "tile", F.concat(F.lit(bytes.fromhex(head)), *rows).alias("content"))


def _dhash_sql(half: int) -> str:
    at = lambda y, x: f"substr(d, {2 * (9 * y + x) + 1}, 2)"
    bits = [f"(CASE WHEN {at(y, x + 1)} > {at(y, x)} THEN {1 << (31 - (8 * y + x) % 32)} ELSE 0 END)" for y in range(8) for x in range(8) if (8 * y + x) // 32 == half]
    return " + ".join(bits)


R.add(
    "x29_picture_dhash",
    lambda c: ingest.picture_hashes(_tiles(c), ("dhash",)),
    f"WITH t AS (SELECT doc_id, tile, rpad(substr(hex(encode(text)), CAST(144 * tile + 1 AS BIGINT), 144), 144, '0') AS d FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(strlen(text) / 72.0) AS BIGINT))) AS tile FROM documents WHERE strlen(text) > 0)) SELECT doc_id, tile, printf('%08x%08x', {_dhash_sql(0)}, {_dhash_sql(1)}) AS dhash FROM t",
)
R.add("x29_picture_hashes", lambda c: ingest.picture_hashes(_bitmaps(c)))

QUERIES, ORACLES = R.queries, R.oracles
