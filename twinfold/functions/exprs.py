"""Column builders: bit distances, thresholds, paths, names, sizes, scores.

All are plain expressions that Catalyst compiles; none leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- hashes -----------------------------------------------------------------


def hex_to_long(value: Column) -> Column:
    """16 hex digits as a signed 64-bit number; null where it isn't one."""
    ok = value.rlike("^[0-9a-fA-F]{1,16}$")
    return F.when(ok, F.conv(value, 16, -10).cast("long"))


def long_to_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def hamming(a: Column, b: Column) -> Column:
    """Distance of two 64-bit numbers."""
    return F.bit_count(a.bitwiseXOR(b))


def hex_words(value: Column, bits: int) -> Column:
    """A hex hash of any width as an array of 64-bit words."""
    digits = -(-bits // 64) * 16
    padded = F.lpad(value, digits, "0")
    return F.array(*[hex_to_long(F.substring(padded, 1 + 16 * k, 16)) for k in range(digits // 16)])


def hamming_hex(a: Column, b: Column, bits: int = 64) -> Column:
    """Distance of two hex hashes, null where either is missing or malformed."""
    parts = F.zip_with(hex_words(a, bits), hex_words(b, bits), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(parts, F.lit(0), lambda acc, x: acc + x)


def hamming_hex_or(a: Column, b: Column, missing: int = 256, bits: int = 64) -> Column:
    return F.coalesce(hamming_hex(a, b, bits), F.lit(missing))


def is_same_photo(p: Column, d: Column) -> Column:
    return (p <= 2) | ((p <= 6) & (d == 0))


def is_same_scene(p: Column, d: Column) -> Column:
    """The grouping threshold: lenient on d for small p, strict for larger p."""
    return F.when(p <= 10, F.lit(True)).when(p <= 12, d < 22).when(p <= 14, d <= 17).otherwise(F.lit(False))


def pair_from_index(k: Column, n: int) -> tuple[Column, Column]:
    """(i, j), i < j < n, of the k-th pair in row order.

    The root is taken in doubles and then set right by one step either way, so that it is exact.
    """
    guess = F.floor((F.lit(2 * n - 1) - F.sqrt(F.lit(float((2 * n - 1) ** 2)) - 8 * k.cast("double"))) / 2).cast("long")
    before = lambda i: i * F.lit(n) - F.floor(i * (i + 1) / 2)  # noqa: E731  pairs in rows above i
    i = F.when(before(guess) > k, guess - 1).when(before(guess + 1) <= k, guess + 1).otherwise(guess)
    return i.cast("long"), (k - before(i) + i + 1).cast("long")


# ---- paths ------------------------------------------------------------------


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    return F.regexp_extract(basename(path), r".(\.[^.]+)$", 1)


def any_contains(paths: Column, *needles: str) -> Column:
    """Some path holds one of the needles, whatever the case."""
    return F.exists(paths, lambda p: reduce(Column.__or__, [F.contains(F.lower(p), F.lit(n.lower())) for n in needles]))


def is_thumbnail(path: Column) -> Column:
    low = F.lower(path)
    return low.contains("/thumbnails/") | low.startswith("thumb_") | basename(low).startswith("thumb_")


def is_library_made(path: Column) -> Column:
    low = F.lower(path)
    return low.contains("/previews/") | low.contains("/thumbnails/") | low.contains("/modelresources/")


def base_name(path: Column) -> Column:
    """The lower-case stem without a trailing number and a leading thumb_."""
    return F.regexp_replace(F.regexp_replace(F.lower(stem(path)), r"_\d+$", ""), "^thumb_", "")


def shortest(paths: Column) -> Column:
    """The first of the shortest paths."""
    return F.array_min(F.transform(paths, lambda p, k: F.struct(F.length(p).alias("n"), k.alias("k"), p.alias("path"))))["path"]


#: Upper-case stems that cameras give, in the first generation and now, and those that software gives.
LEGACY_CAMERA_NAMES = (r"^IMG_\d+$", r"^DSC_?\d+$", r"^DSCN?\d+$", r"^P\d{7}$", r"^\d{8}_\d+$")
CAMERA_NAMES = (r"^IMG_\d+$", r"^IMG_E\d+$", r"^DSC_?\d+$", r"^DSCN?\d+$", r"^P\d{7}$", r"^\d{8}_\d+$", r"^\d{8}-\d+$", r"^PHOTO-\d{4}-\d{2}-\d{2}")
SOFTWARE_NAMES = (r"^THUMB_", r"_\d+$")


def _stem_matches(path: Column, patterns: tuple[str, ...]) -> Column:
    return F.upper(stem(path)).rlike("|".join(f"(?:{p})" for p in patterns))


def is_generated_name(path: Column) -> Column:
    """A name that a camera or some software gave, not a person."""
    return _stem_matches(path, CAMERA_NAMES + SOFTWARE_NAMES)


def is_camera_name(path: Column) -> Column:
    """The first generation's test for a camera's name."""
    return _stem_matches(path, LEGACY_CAMERA_NAMES)


def _rewritten(name: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        name = F.regexp_replace(name, pattern, by)
    return F.upper(name)


def derivative_base(path: Column) -> Column:
    """The name that derivatives of one picture share, in upper case."""
    return _rewritten(stem(path), ("(?i)^thumb_", ""), ("(?i)^!cid_", ""), ("_1024$", ""), (r"(?i)^(IMG_)E(\d+)$", "$1$2"), (r"[-_\s]+", " "))


def marked_base(path: Column) -> Column:
    """The simpler base that marking of derivatives uses."""
    return _rewritten(stem(path), ("(?i)^thumb_", ""), ("_1024$", ""))


def collision_base(path: Column) -> Column:
    """The base that the search for equal names inside a group uses."""
    return _rewritten(stem(path), ("(?i)^thumb_", ""), (r"_\d{3,4}$", ""), ("(?i)_thumb$", ""))


#: Words in the names of folders and files that speak of derivatives.
MARKERS = ("thumb", "cache", "preview", "resized")


def path_keywords(path: Column) -> Column:
    """The parts of a path that hold a marker, as they stand."""
    return F.filter(F.split(path, "/"), lambda p: F.lower(p).rlike("|".join(MARKERS)))


def name_prefixes(path: Column) -> Column:
    low = F.lower(stem(path))
    return F.filter(F.array(F.lit("thumb_"), F.lit("img_")), lambda p: F.startswith(low, p))


def name_suffixes(path: Column) -> Column:
    name = stem(path)
    size = F.regexp_extract(name, r"(_\d{3,4})$", 1)
    words = F.filter(F.array(F.lit("_thumb"), F.lit("_small")), lambda p: F.endswith(F.lower(name), p))
    return F.concat(F.filter(F.array(size), lambda x: x != ""), words)


# ---- sizes and scores -------------------------------------------------------


def resolution(width: Column, height: Column) -> Column:
    return F.coalesce(width, F.lit(0)).cast("long") * F.coalesce(height, F.lit(0))


def quality_class(width: Column, height: Column) -> Column:
    pixels = resolution(width, height)
    return F.when((F.coalesce(width, F.lit(0)) == 0) | (F.coalesce(height, F.lit(0)) == 0), "unknown").when(pixels >= 2_000_000, "high").when(pixels >= 500_000, "medium").otherwise("low")


def megapixels(width: Column, height: Column) -> Column:
    return F.round(resolution(width, height) / F.lit(1e6), 1)


def file_size_text(size: Column) -> Column:
    """Bytes with one decimal in the largest fitting unit, ties to even."""
    out = F.format_string("%.1f TB", F.bround(size / F.lit(1024.0**4), 1))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(size < F.lit(1024.0 ** (power + 1)), F.format_string(f"%.1f {unit}", F.bround(size / F.lit(1024.0**power), 1))).otherwise(out)
    return out


#: What the first generation's score looks for in names and folders.
SCORE_NAMES = ("img_", "dsc", "dscn", "dscf", "p000", "p100")
SCORE_FOLDERS = ("/pictures/", "/photos/", "/dcim/", "/camera/", "/my pictures/")
SCORE_REFUSE = ("/cache/", "/temp/", "/.trash")
SCORE_GENERIC = ("stock", "wallpaper", "icon", "template", "sample")


def legacy_confidence(path: Column, width: Column, height: Column, make: Column, model: Column, thumbnail: Column) -> Column:
    """The additive score of 0 to 100 of the first generation; it starts at 50."""
    low, name = F.lower(path), F.lower(basename(path))
    points = lambda when, n: F.when(when, n).otherwise(0)
    some = lambda test, values: reduce(Column.__or__, [test(v) for v in values])
    w, h = F.coalesce(width, F.lit(0)), F.coalesce(height, F.lit(0))
    total = (
        F.lit(50)
        + points((F.coalesce(make, F.lit("")) != "") | (F.coalesce(model, F.lit("")) != ""), 40)
        + points(some(name.startswith, SCORE_NAMES), 20)
        + points(some(low.contains, SCORE_FOLDERS), 20)
        + points((w >= 800) & (h >= 800), 10)
        - points(thumbnail, 15)
        - points(some(low.contains, SCORE_REFUSE), 20)
        - points(some(low.contains, SCORE_GENERIC), 20)
        - points((w < 200) | (h < 200), 20)
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), total))


def confidence_bucket(score: Column) -> Column:
    return F.when(score >= 70, "high").when(score >= 40, "medium").otherwise("low")


def bucket_folder(score: Column) -> Column:
    """The folder of a confidence bucket."""
    return F.concat(confidence_bucket(score), F.lit("_confidence"))


#: Image types by their first bytes, and their suffixes.
MIME_SUFFIX = {"image/jpeg": ".jpg", "image/png": ".png", "image/gif": ".gif", "image/bmp": ".bmp", "image/tiff": ".tiff", "image/webp": ".webp", "image/heic": ".heic", "image/heif": ".heif"}


def sniff_mime(content: Column) -> Column:
    """The image type by its first bytes; null for anything else."""
    head = F.hex(F.substring(content, 1, 12))
    return (
        F.when(head.startswith("FFD8FF"), "image/jpeg")
        .when(head.startswith("89504E470D0A1A0A"), "image/png")
        .when(head.startswith("47494638"), "image/gif")
        .when(head.startswith("424D"), "image/bmp")
        .when(head.startswith("49492A00") | head.startswith("4D4D002A"), "image/tiff")
        .when(head.rlike("^52494646.{8}57454250$"), "image/webp")
        .when(head.rlike("^.{8}66747970(68656963|68656978)"), "image/heic")
        .when(head.rlike("^.{8}66747970(6D696631|6D736631)"), "image/heif")
    )


def suffix_for(mime: Column, path: Column) -> Column:
    """By type, else by the file's own suffix, else .bin."""
    known = F.create_map(*[F.lit(x) for pair in MIME_SUFFIX.items() for x in pair])
    own = F.lower(suffix(path))
    return F.coalesce(F.try_element_at(known, mime), F.when(own != "", own), F.lit(".bin"))


def link_path(photo_id: Column, mime: Column, path: Column, root: str = "files") -> Column:
    return F.concat(F.lit(root + "/"), F.substring(photo_id, 1, 2), F.lit("/"), photo_id, suffix_for(mime, path))
