"""Pairs and groups of a catalog that grows: a batch meets the catalog and itself, the catalog never itself again.

The catalog keeps an index of its hashes' bands. A batch looks up, in each band, the values within reach of its
own hashes; the work follows the batch. Groups are labels by smallest member: the batch's links join labels,
not photos, and what changes is a table of labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.functions import exprs as X
from twinfold.operators.components import connected_components, relabel
from twinfold.operators.similarity import SCENE_BANDS, SCENE_BITS, band_meet, band_rows, probe_rows
from twinfold.sources.scratch import stored


@dataclass(frozen=True)
class GrowingCatalog:
    """photos (id, phash, dhash), index (band, value, phash: each distinct hash once) and labels (node, label), all stored."""

    photos: DataFrame
    index: DataFrame
    labels: DataFrame

    @classmethod
    def empty(cls, photos: DataFrame) -> GrowingCatalog:
        """A catalog without photos, of the types of photos."""
        none = photos.select("id", "phash", "dhash").filter("false")
        ids = none.select(F.col("id").alias("node"), F.col("id").alias("label"))
        return cls(stored(none, "catalog"), stored(band_rows(none.select("phash"), "phash", SCENE_BITS, SCENE_BANDS), "catalog-index"), stored(ids, "catalog-labels"))


#: A batch with at least one in so many of all hashes meets the index in tiles of bands; a smaller one looks its bands up.
TILED_SHARE = 8


def _near_hashes(fresh: DataFrame, index: DataFrame) -> DataFrame:
    """phash, other: each hash of fresh and the hashes of index within a scene's reach, itself too."""
    known = index.filter("band = 0").select("phash")
    if fresh.count() * TILED_SHARE < known.count():
        probes = probe_rows(fresh, "phash", SCENE_BITS, SCENE_BANDS)
        met = probes.join(index.withColumnRenamed("phash", "other").hint("merge"), ["band", "value"]).select("phash", "other")
        return met.filter(F.bit_count(F.col("phash").bitwiseXOR(F.col("other"))) <= SCENE_BITS).distinct()
    marked = known.join(fresh.withColumn("fresh", F.lit(True)), "phash", "left").select("phash", F.lit(0).cast("long").alias("dhash"), F.coalesce("fresh", F.lit(False)).alias("fresh"))
    once = stored(band_meet(stored(marked, "met"), SCENE_BITS, SCENE_BANDS).select("a_phash", "b_phash"), "near-once")
    both = once.toDF("phash", "other").unionByName(once.toDF("other", "phash"))
    itself = fresh.select("phash", F.col("phash").alias("other"))
    return both.join(fresh, "phash", "left_semi").unionByName(itself)


def new_pairs(catalog: GrowingCatalog, batch: DataFrame, index: DataFrame) -> DataFrame:
    """id_1 < id_2, phash_dist, dhash_dist of the pairs of one scene with a photo of the batch, each once.

    batch has ids that the catalog lacks; index has the bands of both.
    """
    near = stored(_near_hashes(batch.select("phash").distinct(), index), "near-new")
    mine = batch.select("id", "phash", "dhash")
    both = catalog.photos.withColumn("fresh", F.lit(False)).unionByName(mine.withColumn("fresh", F.lit(True)))
    theirs = both.toDF("y", "other", "d", "fresh")
    met = mine.join(near, "phash").join(theirs, "other").filter("NOT fresh OR id < y")
    p, d = X.hamming(F.col("phash"), F.col("other")), X.hamming(F.col("dhash"), F.col("d"))
    return met.filter(X.is_same_scene(p, d)).select(F.least("id", "y").alias("id_1"), F.greatest("id", "y").alias("id_2"), p.alias("phash_dist"), d.alias("dhash_dist"))


def insert_photos(catalog: GrowingCatalog, photos: DataFrame) -> tuple[GrowingCatalog, DataFrame]:
    """The catalog with those photos whose ids it lacks, and the pairs that they bring. Rows without both hashes and repeated ids count as none."""
    fresh = photos.select("id", "phash", "dhash").filter("id is not null and phash is not null and dhash is not null").dropDuplicates(["id"])
    batch = stored(fresh.join(catalog.photos.select("id"), "id", "left_anti"), "batch")
    unseen = batch.select("phash").distinct().join(catalog.index.select("phash").distinct(), "phash", "left_anti")
    index = stored(catalog.index.unionByName(band_rows(unseen, "phash", SCENE_BITS, SCENE_BANDS)), "catalog-index")
    pairs = stored(new_pairs(catalog, batch, index), "new-pairs")
    ends = pairs.select(F.col("id_1").alias("node")).unionByName(pairs.select(F.col("id_2").alias("node"))).distinct()
    known = stored(catalog.labels.unionByName(ends.join(catalog.labels, "node", "left_anti").select("node", F.col("node").alias("label"))), "catalog-labels")
    links = relabel(relabel(pairs.select("id_1", "id_2"), "id_1", known), "id_2", known)
    labels = stored(relabel(known, "label", connected_components(links, "id_1", "id_2")), "catalog-labels")
    return GrowingCatalog(stored(catalog.photos.unionByName(batch), "catalog"), index, labels), pairs
