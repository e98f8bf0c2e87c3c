"""Exact deduplication through a log-structured merge index of content digests.

Rows come to the index in batches. A batch is a memtable: its digests are combined, looked up in the runs that
are there, and flushed as a new run, sorted by digest, with a filter. Runs of one size class (a power of the
fan-out in rows) are merged into one of the next as soon as there are as many as the fan-out, so each digest is
rewritten a logarithmic number of times; a merged entry keeps the smallest and the largest identifier and the
number of rows. A lookup asks the filter of each run first and reads a run for what passes alone.

Filters are of a blocked Bloom kind: a table of (slot, word) with eight digests a slot or fewer, made when a run
is first asked. Up to FILTER_SLOTS rows it is broadcast; a larger run's filter meets the digests asked by slot, and
shuffles some two bytes for each of its digests instead of the entries. The filter of hits, which texts are held
against in the scan, has FILTER_SLOTS rows at most; beyond some ten hits a slot it passes more, and loses none.

Digests met twice, within a batch or by lookup, are hits, and hits are verified byte by byte before they
count as copies. The texts of hits alone are shuffled for that, once: a filter of the hits, broadcast, tells
them from the rest in the scan.

Nothing is ever gathered by key except counts and extremes, which Spark combines before its shuffle:
a digest that holds a third of all rows costs one row per task.

Cases: a null text counts as empty; null identifiers rank below all others; rows that repeat both
identifier and text are one group of which exactly one row is kept; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinfold.llm.shared import free_name, lower_az, new_path, stored

SALTS = 8
#: Rows that a memtable takes at least, batches that a table is dealt into at most, and runs of one size class that are merged.
MEMTABLE_ROWS, BATCHES, FAN_OUT = 50_000, 5, 4
#: Rows of a filter that is broadcast, 12 bytes each, and the bits that a digest sets in its word.
FILTER_SLOTS, FILTER_BITS = 1 << 18, 4


def slots_for(rows: int) -> int:
    """Slots of a filter of so many digests: a power of two that gives each eight or fewer on average."""
    return 1 << max(10, math.ceil(math.log2(max(rows, 1) / 8)))


def digest_filter(digests: DataFrame, slots: int = FILTER_SLOTS) -> DataFrame:
    """slot, word: the filter of a table of digests."""
    slot, mask = _place(F.col("digest"), slots)
    return digests.groupBy(slot.alias("slot")).agg(F.bit_or(mask).alias("word"))


def _place(digest: Column, slots: int) -> tuple[Column, Column]:
    """(slot, mask) of a digest: low bits of its hash name the slot, high ones the bits in the word."""
    h = F.xxhash64(digest)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 40 + 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(FILTER_BITS)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return h.bitwiseAND(F.lit(slots - 1).cast("long")), mask


def may_hold(rows: DataFrame, table: DataFrame, digest: str = "digest", slots: int = FILTER_SLOTS) -> DataFrame:
    """rows plus may_hold: false where the filter rules the digest out. Filters up to FILTER_SLOTS are broadcast."""
    slot, mask = _place(F.col(digest), slots)
    words = table.select(F.col("slot").alias("__slot"), F.col("word").alias("__word"))
    words = F.broadcast(words) if slots <= FILTER_SLOTS else words
    joined = rows.withColumns({"__at": slot, "__mask": mask}).join(words, F.col("__at") == F.col("__slot"), "left")
    return joined.withColumn("may_hold", F.coalesce(F.col("__word").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))).drop("__at", "__mask", "__slot", "__word")


def combined(rows: DataFrame) -> DataFrame:
    """Entries (digest, smallest, largest, copies) with one per digest."""
    return rows.groupBy("digest").agg(F.min("smallest").alias("smallest"), F.max("largest").alias("largest"), F.sum("copies").alias("copies"))


@dataclass(frozen=True)
class Run:
    path: str
    rows: int

    @property
    def slots(self) -> int:
        return slots_for(self.rows)


class DigestIndex:
    """digest -> (smallest, largest, copies), as sorted runs with filters below one folder."""

    def __init__(self, spark: SparkSession, path: str, runs: list[Run] | None = None, fan_out: int = FAN_OUT):
        self.spark, self.path, self.runs, self.fan_out, self.flushed = spark, path.rstrip("/"), list(runs or []), fan_out, 0
        self.filters: set[str] = set()

    def _flush(self, entries: DataFrame) -> Run:
        path = f"{self.path}/run-{self.flushed:05d}"
        self.flushed += 1
        entries.sortWithinPartitions("digest").write.parquet(path)
        written = self.spark.read.schema(entries.schema).parquet(path)
        return Run(path, written.count())

    def filter_of(self, run: Run) -> DataFrame:
        """The run's filter; the first call writes it beside the run."""
        if run.path not in self.filters:
            digest_filter(self.spark.read.parquet(run.path), run.slots).write.mode("overwrite").parquet(f"{run.path}-filter")
            self.filters.add(run.path)
        return self.spark.read.parquet(f"{run.path}-filter")

    def append(self, rows: DataFrame) -> DataFrame:
        """Take a batch of rows (id, digest). Returns its hits: digests that repeat in it or are known already."""
        entry = rows.select("digest", F.col("id").alias("smallest"), F.col("id").alias("largest"), F.lit(1).cast("long").alias("copies"))
        new = self._flush(combined(entry))
        memtable = self.spark.read.parquet(new.path)
        hits = memtable.filter("copies > 1").select("digest")
        if self.runs:
            hits = hits.unionByName(self.lookup(memtable).select("digest"))
        hits = stored(hits, "hits")
        self.runs.append(new)
        self._merge_classes()
        return hits

    def _merge_classes(self) -> None:
        """Merge what has as many runs of one size class as the fan-out, from the smallest class on."""
        while True:
            classes: dict[int, list[Run]] = {}
            for run in self.runs:
                classes.setdefault(int(math.log(max(run.rows, 1), self.fan_out)), []).append(run)
            full = next((runs for _, runs in sorted(classes.items()) if len(runs) >= self.fan_out), None)
            if full is None:
                return
            self._merge(full)

    def _merge(self, runs: list[Run]) -> None:
        """Older files stay until the folder is dropped, so readers go on."""
        merged = self._flush(combined(self.spark.read.parquet(*(r.path for r in runs))))
        self.runs = [r for r in self.runs if r not in runs] + [merged]

    def compact(self) -> None:
        """Merge all runs into one."""
        if len(self.runs) > 1:
            self._merge(self.runs)

    def table(self) -> DataFrame:
        """All runs' entries; digests in several runs have several."""
        return self.spark.read.parquet(*(r.path for r in self.runs))

    def lookup(self, digests: DataFrame) -> DataFrame:
        """The merged entries of those of the distinct digests given that are known."""
        found = None
        for run in self.runs:
            asked = may_hold(digests.select("digest"), self.filter_of(run), slots=run.slots).filter("may_hold").select("digest")
            entries = self.spark.read.parquet(run.path).join(asked, "digest", "left_semi")
            found = entries if found is None else found.unionByName(entries)
        if found is None:
            return digests.select("digest", F.lit(None).alias("smallest"), F.lit(None).alias("largest"), F.lit(0).cast("long").alias("copies")).filter("false")
        return combined(found)


def sha256_bytes(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hashed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = lower_az(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digest", digest(F.col("text")))


def _mixed_digests(texts: DataFrame, hits: DataFrame, hit_filter: DataFrame) -> DataFrame:
    """Digests of hits whose texts are not all the same bytes.

    Texts that pass the filter meet the hits on (digest, salt), so that Spark may split a hot digest, and only
    the smallest and largest text of each go on.
    """
    asked = hits.select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = may_hold(texts, hit_filter).filter("may_hold").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    found = salted.join(asked, ["digest", "salt"], "left_semi").groupBy("digest").agg(F.min("text").alias("first"), F.max("text").alias("last"))
    return found.filter(F.col("first") != F.col("last")).select("digest")


@dataclass(frozen=True)
class Indexed:
    """What a table of texts has in its index: rows (id, digest), entries, hits and their filter, and hits of unequal bytes."""

    texts: DataFrame
    rows: DataFrame
    entries: DataFrame
    hit_filter: DataFrame
    mixed: DataFrame


def index_texts(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column] = sha256_bytes, batches: int | None = None) -> Indexed:
    """batches defaults to as many memtables as the rows fill, up to BATCHES."""
    spark = docs.sparkSession
    texts = _hashed(docs, id_col, text_col, digest)
    rows = stored(texts.select("id", "digest"), "digests")
    if batches is None:
        batches = min(BATCHES, max(1, -(-rows.count() // MEMTABLE_ROWS)))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(batches)))
    index = DigestIndex(spark, new_path(spark, "digest-index"))
    hits = None
    for batch in range(batches):
        found = index.append(dealt.filter(F.col("batch") == batch).select("id", "digest"))
        hits = found if hits is None else hits.unionByName(found)
    index.compact()
    if batches > 1:  # one batch names each digest once
        hits = stored(hits.distinct(), "hits")
    hit_filter = stored(digest_filter(hits), "hit-filter")
    mixed = stored(_mixed_digests(texts, hits, hit_filter), "mixed-digests")
    return Indexed(texts, rows, index.table(), hit_filter, mixed)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", digest: Callable[[Column], Column] = sha256_bytes) -> DataFrame:
    """One row per row of docs: id, digest, keep_id, group_size, kept.

    Texts are the same when equal after lower-casing A-Z. keep names the identifier that stays,
    "smallest" or "largest". digest is the content address; texts that share a digest but not their
    bytes are told apart in a second pass over those digests alone.
    """
    found = index_texts(docs, id_col, text_col, digest)
    groups = found.entries.select("digest", F.col(keep).alias("keep_id"), F.col("copies").alias("group_size"))
    # Rows that repeat both identifier and text are counted, and come back one by one at the end.
    counted = lambda rows, *keys: rows.groupBy(*keys, "id").agg(F.count(F.lit(1)).alias("times"))
    if found.mixed.isEmpty():
        out = counted(found.rows, "digest").join(groups, "digest")
    else:
        plain = counted(found.rows.join(found.mixed, "digest", "left_anti"), "digest").join(groups, "digest")
        odd = counted(found.texts.join(found.mixed, "digest", "left_semi"), "digest", "text")
        same = odd.groupBy("digest", "text").agg((F.min if keep == "smallest" else F.max)("id").alias("keep_id"), F.sum("times").alias("group_size"))
        out = plain.unionByName(odd.join(same, ["digest", "text"]).drop("text"))
    each = out.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return each.select("id", "digest", "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """docs without the rows that repeat another's text; its columns are unchanged.

    Content addresses are SHA-256 here; hits of unequal bytes, should there ever be any, all stay.
    Rows that the filter of hits rules out have no copies and stay where they are. The others are dealt by
    text and identifier, as only the rows of the identifier to keep go on.
    """
    found = index_texts(docs, id_col, text_col)
    mark, turn, may = (free_name(docs, n) for n in ("digest", "turn", "may_hold"))
    text = lower_az(F.coalesce(F.col(text_col), F.lit("")))
    flagged = may_hold(docs.select(F.struct(*docs.columns).alias("row"), sha256_bytes(text).alias("digest")), found.hit_filter)
    alone = flagged.filter("not may_hold").select("row.*")
    rows = flagged.filter("may_hold").select("row.*", F.col("digest").alias(mark))
    kept = found.entries.filter("copies > 1").select(F.col("digest").alias("__digest"), F.col(keep).alias("__keep"))
    kept = kept.join(found.mixed.withColumnRenamed("digest", "__digest"), "__digest", "left_anti")
    lost = found.rows.join(kept, F.col("digest") == F.col("__digest")).filter(~F.col("id").eqNullSafe(F.col("__keep"))).select(F.col("digest").alias(may), F.col("id").alias(turn)).distinct()
    left = rows.join(lost, (rows[mark] == lost[may]) & rows[id_col].eqNullSafe(lost[turn]), "left_anti")
    first = Window.partitionBy(mark, id_col).orderBy(F.col(text_col).asc_nulls_first())
    return alone.unionByName(left.withColumn(turn, F.row_number().over(first)).filter(F.col(turn) == 1).select(*docs.columns))
