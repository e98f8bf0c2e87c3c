"""Reading file trees, and what is derived from files: type, identity, sizes, date sources, link plans."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.functions import dates as D
from twinfold.functions import exprs as X
from twinfold.operators.ordering import numbered_rows
from twinfold.sources.file_tree import listable, read_contents, walk
from twinfold.sources.pictures import TEXT_TAGS, exif_entries, picture_size

#: Names that operating systems leave behind.
SKIP_NAMES = (".DS_Store", "Thumbs.db", "desktop.ini", ".picasa.ini")


def scan_files(spark: SparkSession, root: str, contents: bool = True) -> DataFrame:
    """source_path, filename, mtime, file_size, content of all regular files below root, in dotted folders too.

    A content is a whole file in a task's memory; who needs none asks for no contents, and the column is left out.

    Folders are listed by tasks (see walk), and so are contents read. A store that tasks can't list by themselves
    is left to Spark's own listing, which knows no names that start with a dot or underscore.
    """
    skipped = F.col("filename").isin(*SKIP_NAMES) | F.col("filename").startswith("._")
    if listable(root):
        found = walk(spark, root).filter(~skipped)
        return read_contents(found) if contents else found
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.col("path").alias("source_path"), X.basename(F.col("path")).alias("filename"), F.col("modificationTime").alias("mtime"), F.col("length").alias("file_size"), *(["content"] if contents else [])).filter(~skipped)


EXIF = "exif_make string, exif_model string, exif_software string, exif_datetime string, exif_datetime_original string, exif_datetime_digitized string"


def tiff_tags(data: bytes) -> dict[str, str]:
    """The text tags of a picture's EXIF data."""
    return {TEXT_TAGS[t]: v for t, v in exif_entries(data).items() if t in TEXT_TAGS}


def picture_fields(content: pd.Series) -> pd.DataFrame:
    """width, height and the six EXIF fields; nulls where there are none or they are malformed."""
    names = [x.split()[0] for x in EXIF.split(", ")]
    out = []
    for c in content:
        data = bytes(c) if c is not None else b""
        tags = tiff_tags(data)
        out.append((*(picture_size(data) or (None, None)), *(tags.get(n) for n in names)))
    found = pd.DataFrame(out, columns=["width", "height", *names], dtype=object)
    return found.astype({"width": "Int64", "height": "Int64"})


def describe_files(files: DataFrame) -> DataFrame:
    """Image files with id (SHA-256), mime_type, width, height and EXIF fields; others are dropped.

    The contents end here: nothing downstream carries them.
    """
    from pyspark.sql.functions import pandas_udf

    read = pandas_udf(picture_fields, f"width long, height long, {EXIF}")
    known = files.withColumn("mime_type", X.sniff_mime(F.col("content"))).filter("mime_type is not null")
    fields = [f"e.{x.split()[0]}" for x in EXIF.split(", ")]
    return known.withColumn("e", read("content")).select(F.sha2("content", 256).alias("id"), "source_path", "filename", "mtime", "file_size", "mime_type", "e.width", "e.height", *fields)


def new_paths(files: DataFrame, known_paths: DataFrame) -> DataFrame:
    """Rows whose source_path isn't recorded yet."""
    return files.join(known_paths.select("source_path"), "source_path", "left_anti")


def photos_of(rows: DataFrame, known_photos: DataFrame | None = None) -> DataFrame:
    """One row per new id: that of its first path."""
    fields = [c for c in rows.columns if c not in ("id", "source_path", "filename", "mtime")]
    first = rows.groupBy("id").agg(F.min_by(F.struct(*fields), "source_path").alias("x")).select("id", "x.*")
    return first if known_photos is None else first.join(known_photos.select("id"), "id", "left_anti")


def numbered_paths(rows: DataFrame, start: int = 0) -> DataFrame:
    """path_id, photo_id, source_path, filename, mtime; path_id counts on from start in the order of paths."""
    named = rows.select(F.col("id").alias("photo_id"), "source_path", "filename", "mtime")
    return numbered_rows(named, "source_path", "path_id", start + 1).select("path_id", "photo_id", "source_path", "filename", "mtime")


def date_sources(rows: DataFrame) -> DataFrame:
    """photo_id, source_type, date_value, confidence, raw_value, source_path: up to six per file.

    A digitized time counts only if it differs from the original, a plain one only if it differs from both;
    the latter is medium at best; file times are always low.
    """
    original, digitized, plain = (D.exif_datetime(F.col(f"exif_datetime{x}")) for x in ("_original", "_digitized", ""))
    rate = lambda value: D.exif_confidence(value, F.col("exif_make"), F.col("exif_model"), F.col("exif_software"))
    item = lambda kind, value, confidence, raw: F.struct(F.lit(kind).alias("source_type"), value.alias("date_value"), confidence.alias("confidence"), raw.alias("raw_value"))
    capped = F.when(rate(plain) == "high", "medium").otherwise(rate(plain))
    name, folder = D.date_from_filename(F.col("filename")), D.date_from_path(F.col("source_path"))
    mtime = F.date_format("mtime", "yyyy-MM-dd'T'HH:mm:ss")
    items = F.array(
        item("exif_original", original, rate(original), F.col("exif_datetime_original")),
        item("exif_digitized", F.when(~digitized.eqNullSafe(original), digitized), rate(digitized), F.col("exif_datetime_digitized")),
        item("exif_datetime", F.when(~plain.eqNullSafe(original) & ~plain.eqNullSafe(digitized), plain), capped, F.col("exif_datetime")),
        item("filename", name, F.lit("medium"), F.col("filename")),
        item("path_semantic", folder, D.path_confidence(folder), F.col("source_path")),
        item("mtime", mtime, F.lit("low"), mtime),
    )
    return rows.select(F.col("id").alias("photo_id"), "source_path", F.explode(items).alias("s")).select("photo_id", "s.*", "source_path").filter("date_value is not null")


def import_hashes(photos: DataFrame, other: DataFrame) -> DataFrame:
    """photos with perceptual_hash filled in from another catalog where it is missing; dhash stays as it is.

    Where the other catalog has several for an id, the smallest counts.
    """
    theirs = other.groupBy(F.col("id").alias("__id")).agg(F.min("perceptual_hash").alias("__hash"))
    joined = photos.join(theirs, photos["id"] == theirs["__id"], "left")
    return joined.withColumn("perceptual_hash", F.coalesce("perceptual_hash", "__hash")).drop("__id", "__hash")


def link_plan(photos: DataFrame, paths: DataFrame, root: str = "files") -> DataFrame:
    """photo_id, src, dest: each photo's first path and its place in the link farm."""
    first = paths.groupBy(F.col("photo_id").alias("id")).agg(F.min_by("source_path", "path_id").alias("src"))
    return photos.join(first, "id").select(F.col("id").alias("photo_id"), "src", X.link_path(F.col("id"), F.col("mime_type"), F.col("src"), root).alias("dest"))


def make_links(plan: DataFrame) -> DataFrame:
    """Carry out a link plan on the executors' shared file system: photo_id, done, error. What exists is skipped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for photo, src, dest in batch[["photo_id", "src", "dest"]].itertuples(index=False, name=None):
                try:
                    os.makedirs(os.path.dirname(dest), exist_ok=True)
                    os.link(src.removeprefix("file:"), dest)
                    out.append((photo, True, None))
                except FileExistsError:
                    out.append((photo, False, None))
                except OSError as error:
                    out.append((photo, False, str(error)))
            yield pd.DataFrame(out, columns=["photo_id", "done", "error"], dtype=object)

    return plan.mapInPandas(run, "photo_id string, done boolean, error string")


def write_tsv(query: DataFrame, path: str) -> None:
    query.write.mode("overwrite").option("sep", "\t").option("nullValue", "").option("emptyValue", "").option("header", "true").csv(path)


#: Words that are digested at once, and words whose bits are summed at once; a longer text goes by itself.
TEXT_WORDS, SUM_WORDS = 1 << 18, 1 << 15


def text_hashes(photos: DataFrame, salts: tuple[str, str] = ("", "d:")) -> DataFrame:
    """photos (id, text) plus phash and dhash: 64-bit majority hashes of the distinct words, one per salt.

    Stands in for perceptual hashes of pictures: similar texts get hashes a few bits apart. Words come from
    lower(trim(text)); bit b is set when more words have it set than not; no words give nulls.
    """
    import hashlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def sums(bits: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How often each of 64 bits, a byte each, is set in each run of rows; up to 255 rows add up without a carry."""
        pieces = -(-np.diff(starts, append=len(bits)) // 255)
        first = np.cumsum(pieces) - pieces
        cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
        return np.add.reduceat(np.add.reduceat(bits, cuts, axis=0).view(np.uint8), first, axis=0, dtype=np.int32)

    def part(ids, words):
        """The hashes of some rows: each distinct word is digested once, and bits are summed word by word for all rows."""
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        some, flat = np.flatnonzero(sizes), pc.list_flatten(words).dictionary_encode()
        places, spelled = flat.indices.to_numpy(), [w.encode() for w in flat.dictionary.to_pylist()]
        starts = np.cumsum(sizes[some]) - sizes[some]
        out = []
        for salt in salts:
            held = np.zeros(len(sizes), np.int64)
            if len(some):
                digests = np.frombuffer(b"".join(hashlib.md5(salt.encode() + w).digest()[:8] for w in spelled), np.uint8).reshape(-1, 8)
                bits = np.unpackbits(digests, axis=1).view(np.uint64)
                ones = np.concatenate([sums(bits[places[starts[a] : end]], starts[a:b] - starts[a]) for a, b, end in spans(starts, len(places), SUM_WORDS)])
                held[some] = np.packbits(2 * ones > sizes[some, None], axis=1).view(">i8").ravel()
            out.append(pa.array(held, mask=sizes == 0))
        return pa.RecordBatch.from_arrays([ids, *out], ["id", "phash", "dhash"])

    def spans(starts: np.ndarray, total: int, most: int) -> Iterator[tuple[int, int, int]]:
        """(first row, row after the last, end of its words) of runs of rows with so many words at most, or one row."""
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + most)))
            yield a, b, int(starts[b]) if b < len(starts) else total
            a = b

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, _ in spans(np.cumsum(sizes) - sizes, int(sizes.sum()), TEXT_WORDS):
                yield part(batch.column("id").slice(a, b - a), batch.column("words").slice(a, b - a))

    words = F.array_distinct(F.filter(F.split(F.lower(F.trim("text")), r"[ \t\n\r\f\x0b]+"), lambda w: w != ""))
    return photos.select("id", words.alias("words")).mapInArrow(run, "id string, phash long, dhash long")


def picture_hashes(files: DataFrame, wanted: tuple[str, ...] = ("phash", "dhash", "phash_16", "colorhash", "pixel_digest")) -> DataFrame:
    """files (content and others) plus the wanted hashes; null where a type has no decoder (JPEG, TIFF, WebP, HEIC) or the file is damaged.

    Pictures are turned upright for the hashes, not for the digest of pixels. The contents end here.
    """
    from pyspark.sql.functions import pandas_udf

    def read(content: pd.Series) -> pd.DataFrame:
        from twinfold.sources.rasters import many_hashes

        rows = many_hashes([bytes(c) if c is not None else b"" for c in content], wanted)
        return pd.DataFrame([[r.get(n) for n in wanted] for r in rows], columns=list(wanted), dtype=object)

    found = files.withColumn("__h", pandas_udf(read, ", ".join(f"{n} string" for n in wanted))("content"))
    return found.select(*[c for c in files.columns if c != "content"], *[f"__h.{n}" for n in wanted])
