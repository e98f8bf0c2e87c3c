"""Hamming self-joins over 64-bit hashes.

Where every pair counts, rows meet in blocks: each row belongs to one of B blocks by hash and is sent to the
B block pairs it takes part in; a block pair is the key of a plain equi-join, so the work is spread evenly, no
side is broadcast, and B follows from the number of rows, so that no task meets more than PAIRS_PER_TASK.

Where a threshold holds and rows are many, bands prune. With t differing bits at most, one of b bands differs in t // b bits at
most. Rows look up, in each band, all values within that reach of their own; a pair counts in the first band
that brings it together, so nothing has to be made distinct. Equal hashes are collapsed first, so copies
don't multiply what is compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.functions import exprs as X
from twinfold.operators import meeting as M
from twinfold.sources.scratch import stored

#: Pairs that one task of a full join meets.
PAIRS_PER_TASK = 20_000_000


def _blocks(df: DataFrame, key: str, blocks: int, left: bool) -> DataFrame:
    """df once per block pair i <= j that a row takes part in: on the left its own block is i, on the right j."""
    own = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    spread = df.withColumn("__own", own)
    if left:
        return spread.withColumn("__j", F.explode(F.sequence(F.col("__own"), F.lit(blocks - 1)))).withColumnRenamed("__own", "__i")
    return spread.withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__own")))).withColumnRenamed("__own", "__j")


def block_sides(rows: DataFrame, key: str, blocks: int) -> tuple[DataFrame, DataFrame]:
    """rows as the left and the right of all block pairs (__i, __j), with columns prefixed a_ and b_."""
    side = lambda p: rows.select(*[F.col(c).alias(f"{p}_{c}") for c in rows.columns])
    return _blocks(side("a"), f"a_{key}", blocks, True), _blocks(side("b"), f"b_{key}", blocks, False)


def block_join(rows: DataFrame, key: str, condition: Callable[[Callable[[str], Column], Callable[[str], Column]], Column], blocks: int | None = None) -> DataFrame:
    """Each pair of rows that meets the (symmetric) condition once, in either order, with columns prefixed a_ and b_.

    The rows are stored first. blocks defaults to what keeps the pairs of a task bounded, and to enough for
    the cores there are.
    """
    rows = stored(rows, "block-rows")
    if blocks is None:
        cores = rows.sparkSession.sparkContext.defaultParallelism
        blocks = max(math.ceil(rows.count() / math.sqrt(PAIRS_PER_TASK)), math.ceil(math.sqrt(8 * cores)), 1)
    tasks = blocks * (blocks + 1) // 2
    a, b = (x.repartition(tasks, "__i", "__j") for x in block_sides(rows, key, blocks))
    test = condition(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"))
    once = (F.col("__i") < F.col("__j")) | (F.col(f"a_{key}") < F.col(f"b_{key}"))
    return a.join(b, ["__i", "__j"]).filter(once & test).drop("__i", "__j")


def bands_of(bits: int, bands: int) -> list[tuple[int, int]]:
    """(first bit, width) of each band."""
    ends = [round(k * bits / bands) for k in range(bands + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _band(value: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def band_rows(rows: DataFrame, column: str, threshold: int, bands: int, bits: int = 64) -> DataFrame:
    """rows once per band, with band and value, the band's bits of the column."""
    own = F.explode(F.array(*[F.struct(F.lit(k).alias("band"), _band(F.col(column), *p).alias("value")) for k, p in enumerate(bands_of(bits, bands))]))
    return rows.withColumn("k", own).select("*", "k.band", "k.value").drop("k")


def probe_rows(rows: DataFrame, column: str, threshold: int, bands: int, bits: int = 64) -> DataFrame:
    """rows once per band and value within reach: with threshold bits between two columns, one band has threshold // bands at most."""
    reach = threshold // bands

    def ball(k: int, at: int, width: int) -> Column:
        centre, masks = _band(F.col(column), at, width), [sum(1 << i for i in x) for n in range(reach + 1) for x in combinations(range(width), n)]
        return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.struct(F.lit(k).alias("band"), centre.bitwiseXOR(m).alias("value")))

    probes = F.explode(F.concat(*[ball(k, *p) for k, p in enumerate(bands_of(bits, bands))]))
    return rows.withColumn("k", probes).select("*", "k.band", "k.value").drop("k")


def band_join(rows: DataFrame, column: str, threshold: int, bands: int, bits: int = 64) -> DataFrame:
    """Pairs of rows with distinct values of column that are at most threshold bits apart, once each, in either order.

    Columns are prefixed a_ and b_. rows must be stored, or cheap to read twice.
    """
    side = lambda p: rows.select(*[F.col(c).alias(f"{p}_{c}") for c in rows.columns])
    a, b = band_rows(side("a"), f"a_{column}", threshold, bands, bits), probe_rows(side("b"), f"b_{column}", threshold, bands, bits)
    diff = F.col(f"a_{column}").bitwiseXOR(F.col(f"b_{column}"))
    first = F.lit(None).cast("int")
    for k, p in reversed(list(enumerate(bands_of(bits, bands)))):
        first = F.when(F.bit_count(_band(diff, *p)) <= threshold // bands, F.lit(k)).otherwise(first)
    once = (F.col(f"a_{column}") < F.col(f"b_{column}")) & (F.bit_count(diff) <= threshold) & (first == F.col("band"))
    # Sizes are estimated before the explosion, so a broadcast of the probes must be ruled out here.
    return a.join(b.hint("merge"), ["band", "value"]).filter(once).drop("band", "value")


#: Bits at the head of a band that make its blocks, the most rows of a block on average, and pairs that are looked at at once.
BLOCK_BITS, BAND_ROWS, PIECE_PAIRS = 4, 1 << 19, 1 << 18


def band_tiles(rows: DataFrame, column: str, threshold: int, bands: int, head: int) -> DataFrame:
    """rows once per band and block within reach by the first bits of the band (head of them), with band, __tile and __second."""
    masks = [sum(1 << i for i in x) for n in range(threshold // bands + 1) for x in combinations(range(head), n)]

    def ball(k: int, at: int, width: int) -> Column:
        own = _band(F.col(column), at + width - head, head)
        return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.struct(F.lit(k).alias("band"), own.alias("own"), own.bitwiseXOR(m).alias("other")))

    spread = rows.withColumn("k", F.explode(F.concat(*[ball(k, *p) for k, p in enumerate(bands_of(64, bands))])))
    size = F.lit(1 << head).cast("long")
    tile = (F.col("k.band") * size + F.least("k.own", "k.other")) * size + F.greatest("k.own", "k.other")
    side = F.when(F.col("k.own") != F.col("k.other"), (F.col("k.own") > F.col("k.other")).cast("int"))
    return spread.withColumn("band", F.col("k.band")).withColumn("__tile", tile).withColumn("__second", side).drop("k")


def band_meet(rows: DataFrame, threshold: int, bands: int, head: int | None = None) -> DataFrame:
    """a_phash, a_dhash, b_phash, b_dhash of pairs of rows at most threshold bits of phash apart, each once, in either order.

    rows: phash, dhash, fresh; distinct and stored. Rows that aren't fresh don't meet each other. A tile is two blocks of
    a band; each value there meets, as arrays, the rows whose value lies within reach. So a row is sent to few tiles
    (55 of a scene's five bands), and no candidate is a row.
    """
    import numpy as np
    import pyarrow as pa

    plan, reach, n = bands_of(64, bands), threshold // bands, rows.count()
    if head is None:
        head = min(max(math.ceil(math.log2(max(n, 1) / BAND_ROWS)), BLOCK_BITS), min(w for _, w in plan))
    names = ["a_phash", "a_dhash", "b_phash", "b_dhash"]
    part = lambda p, at, width: (p >> np.uint64(at)) & np.uint64((1 << width) - 1)

    def side(table, place):
        p, d = M.words(table, "phash"), M.words(table, "dhash")
        fresh = table["fresh"].to_numpy()
        value = part(p, *place)
        order = np.argsort(value, kind="stable")
        return tuple(x[order] for x in (p, d, value, fresh))

    def cross(x, y, same):
        """(places in x, places in y) of pairs within the threshold, from each value of x and what y has within reach of it."""
        cuts = [*np.flatnonzero(np.diff(x[2], prepend=~x[2][:1])).tolist(), len(x[2])]
        for s, e in zip(cuts, cuts[1:]):
            start = s if same else 0
            near = start + np.flatnonzero(np.bitwise_count(y[2][start:] ^ x[2][s]) <= reach)
            if not len(near):
                continue
            there, step = y[0][near], max(1, PIECE_PAIRS // len(near))
            for i in range(s, e, step):
                j = min(i + step, e)
                met = np.bitwise_count(x[0][i:j, None] ^ there[None]) <= threshold
                if same:
                    met &= np.arange(i, j)[:, None] < near[None]
                r, c = np.nonzero(met)
                if len(r):
                    yield r + i, near[c]

    def visit(a, b):
        k = a["band"][0].as_py()
        x = side(a, plan[k])
        y = x if b is None else side(b, plan[k])
        some = lambda t, kept: tuple(v[kept] for v in t)
        if x[3].all() and y[3].all():
            turns = [(x, y, b is None)]
        elif b is None:
            turns = [(some(x, x[3]), some(x, x[3]), True), (some(x, x[3]), some(x, ~x[3]), False)]
        else:
            turns = [(some(x, x[3]), y, False), (some(x, ~x[3]), some(y, y[3]), False)]
        shape = pa.schema([(n, pa.int64()) for n in names])

        def given(found, x, y):
            r, c = (np.concatenate(v) for v in zip(*found))
            diff = x[0][r] ^ y[0][c]
            first = np.ones(len(r), bool)  # of the bands that bring the two together
            for place in plan[:k]:
                first &= np.bitwise_count(part(diff, *place)) > reach
            r, c = r[first], c[first]
            yield from M.sent(shape, [v.view(np.int64) for v in (x[0][r], x[1][r], y[0][c], y[1][c])])

        for x, y, same in turns:
            found, size = [], 0
            for r, c in cross(x, y, same):
                found.append((r, c))
                size += len(r)
                if size > M.BATCH:
                    yield from given(found, x, y)
                    found, size = [], 0
            if found:
                yield from given(found, x, y)

    spread = band_tiles(rows.select("phash", "dhash", "fresh"), "phash", threshold, bands, head)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism * 16, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return M.met(spread, visit, ", ".join(f"{c} long" for c in names), min(tasks, 1 + n // 500))


#: The most bits of phash between two photos of one scene, and the bands that find them.
SCENE_BITS, SCENE_BANDS = 14, 5
#: Distinct hashes from which tiles of bands cost less than meeting all pairs.
BAND_FROM = 20_000


def _scene() -> tuple[Column, Column]:
    return X.hamming(F.col("a_phash"), F.col("b_phash")), X.hamming(F.col("a_dhash"), F.col("b_dhash"))


def similar_hashes(hashed: DataFrame, band_from: int = BAND_FROM) -> DataFrame:
    """a_phash, a_dhash, b_phash, b_dhash, phash_dist, dhash_dist of all pairs of distinct hashes in one scene.

    hashed (phash, dhash; without nulls) must be stored. Few hashes meet in blocks; from band_from distinct
    ones on, pairs come out of tiles of bands.
    """
    p, d = _scene()
    both = stored(hashed.select("phash", "dhash").distinct(), "distinct-hashes")
    if both.count() < band_from:
        rows = both.withColumn("key", F.struct("phash", "dhash"))
        return block_join(rows, "key", lambda a, b: X.is_same_scene(p, d)).select("a_phash", "a_dhash", "b_phash", "b_dhash", p.alias("phash_dist"), d.alias("dhash_dist"))
    found = band_meet(both.withColumn("fresh", F.lit(True)), SCENE_BITS, SCENE_BANDS)
    return found.filter(X.is_same_scene(p, d)).select("*", p.alias("phash_dist"), d.alias("dhash_dist"))


def similar_pairs(photos: DataFrame, band_from: int = BAND_FROM) -> DataFrame:
    """id_1 < id_2, phash_dist, dhash_dist of all pairs in the same scene; photos need id, phash, dhash."""
    hashed = stored(photos.filter("phash is not null and dhash is not null").select("id", "phash", "dhash"), "hashed")
    one, two = hashed.select(F.col("id").alias("x"), F.col("phash").alias("a_phash"), F.col("dhash").alias("a_dhash")), hashed.select(F.col("id").alias("y"), F.col("phash").alias("b_phash"), F.col("dhash").alias("b_dhash"))
    across = similar_hashes(hashed, band_from).join(one, ["a_phash", "a_dhash"]).join(two, ["b_phash", "b_dhash"]).select(F.least("x", "y").alias("id_1"), F.greatest("x", "y").alias("id_2"), "phash_dist", "dhash_dist")
    same = one.alias("l").join(two.alias("r"), (F.col("l.a_phash") == F.col("r.b_phash")) & (F.col("l.a_dhash") == F.col("r.b_dhash")) & (F.col("x") < F.col("y"))).select(F.col("x").alias("id_1"), F.col("y").alias("id_2"), F.lit(0).alias("phash_dist"), F.lit(0).alias("dhash_dist"))
    return across.unionByName(same)


def banded_pairs(photos: DataFrame, threshold: int, column: str = "phash", bits: int = 64) -> DataFrame:
    """id_1 < id_2, dist of all pairs at most threshold bits apart, out of threshold + 1 bands."""
    hashed = stored(photos.filter(F.col(column).isNotNull()).select("id", column), "hashed")
    near = band_join(hashed.select(column).distinct(), column, threshold, threshold + 1, bits)
    a, b = f"a_{column}", f"b_{column}"
    one, two = hashed.toDF("x", a), hashed.toDF("y", b)
    dist = X.hamming(F.col(a), F.col(b))
    across = near.join(one, a).join(two, b).select(F.least("x", "y").alias("id_1"), F.greatest("x", "y").alias("id_2"), dist.alias("dist"))
    same = one.join(two, F.col(a) == F.col(b)).filter("x < y").select(F.col("x").alias("id_1"), F.col("y").alias("id_2"), F.lit(0).alias("dist"))
    return across.unionByName(same)


#: Words of a wide hash, and the columns of a pair table.
WIDE_WORDS = 4
PAIR_INPUT = "photo_id_1 string, photo_id_2 string, same_primary_group int, phash_dist int, dhash_dist int, phash16_dist int, colorhash_dist int"


def spread_words(photos: DataFrame, words: int = WIDE_WORDS) -> DataFrame:
    return photos.select("id", "group_id", "phash", "dhash", *[F.get("phash_16", F.lit(k)).alias(f"w{k}") for k in range(words)], "colorhash")


def pair_distances(met: DataFrame, words: int = WIDE_WORDS) -> DataFrame:
    """The row of a pair table for rows that met, with columns prefixed a_ and b_."""
    apart = lambda c: X.hamming(F.col(f"a_{c}"), F.col(f"b_{c}"))
    wide = sum((apart(f"w{k}") for k in range(1, words)), apart("w0"))
    return met.select(
        F.least("a_id", "b_id").alias("photo_id_1"),
        F.greatest("a_id", "b_id").alias("photo_id_2"),
        F.coalesce((F.col("a_group_id") == F.col("b_group_id")).cast("int"), F.lit(0)).alias("same_primary_group"),
        apart("phash").alias("phash_dist"),
        apart("dhash").alias("dhash_dist"),
        wide.alias("phash16_dist"),
        apart("colorhash").alias("colorhash_dist"),
    )


def all_pairs(photos: DataFrame, blocks: int | None = None, words: int = WIDE_WORDS) -> DataFrame:
    """photo_id_1 < photo_id_2, same_primary_group, and four distances of every pair of photos.

    Photos need id, group_id (or null), phash, dhash, phash_16 (array of so many words) and colorhash.
    """
    return pair_distances(block_join(spread_words(photos, words), "id", lambda a, b: F.lit(True), blocks), words)


#: Fields of a pair table's histogram and their bits in a packed key; distances stay below 2^10.
SUMMARY = {"phash16_dist": 10, "colorhash_dist": 10, "phash_dist": 10, "dhash_dist": 10, "same_primary_group": 1}


def pair_summary(pairs: DataFrame) -> DataFrame:
    """The five-dimensional histogram of a pair table, counted under one packed key. Rows with a null distance count too."""
    key, at, fields = F.lit(0).cast("long"), 0, []
    for name, bits in SUMMARY.items():
        # One more than the distance, so that 0 is null.
        key = key.bitwiseOR(F.shiftleft(F.coalesce(F.col(name) + 1, F.lit(0)).cast("long"), at))
        value = F.shiftrightunsigned("key", at).bitwiseAND(F.lit((1 << bits + 1) - 1)).cast("int")
        fields.append(F.nullif(value, F.lit(0)).alias(name))
        at += bits + 1
    counted = pairs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(*[(f - 1).alias(name) for f, name in zip(fields, SUMMARY)], "count")


def pair_counts(photos: DataFrame, fields: list[str], blocks: int | None = None, words: int = WIDE_WORDS) -> DataFrame:
    """The histogram of the pair table of photos by some of its fields, without any pair; the count is called count where all are asked.

    Photos without one of the hashes make no pair.
    """
    found = M.pair_counts(spread_words(photos, words), fields, blocks=blocks, count=words)
    return found.withColumnRenamed("pairs", "count") if "phash16_dist" in fields else found


def pair_totals(photos: DataFrame, words: int = WIDE_WORDS) -> DataFrame:
    """pairs, the sums of the four distances, and pairs of one group, over all pairs of photos, in time linear in photos.

    A bit that n photos have and m don't adds n * m to the sum of distances. Photos without one of the hashes make no pair.
    """
    import numpy as np

    wide = [f"w{k}" for k in range(words)]
    columns = ["phash", "dhash", *wide, "colorhash"]
    rows = stored(spread_words(photos, words).select("group_id", *M.numbers(columns)).dropna(subset=columns), "totals")

    def bits(batches):
        import pyarrow as pa

        total, n = np.zeros((len(columns), 64), np.int64), 0
        for batch in batches:
            n += len(batch)
            for k, c in enumerate(columns if len(batch) else []):
                total[k] += np.unpackbits(batch.column(c).to_numpy().view(np.uint8).reshape(len(batch), 8), axis=1).sum(axis=0, dtype=np.int64)
        place = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place[0]), pa.array(place[1]), pa.array(total.ravel()), pa.array(np.full(total.size, n))], ["field", "bit", "ones", "n"])

    each = rows.select(*columns).mapInArrow(bits, "field int, bit int, ones long, n long").groupBy("field", "bit").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    apart = lambda *names: F.sum(F.when(F.col("field").isin([columns.index(c) for c in names]), F.col("ones") * (F.col("n") - F.col("ones"))))
    pairs = F.coalesce(F.max("n"), F.lit(0)).alias("n")
    sums = each.agg(pairs, apart("phash").alias("phash_dist"), apart("dhash").alias("dhash_dist"), apart(*wide).alias("phash16_dist"), apart("colorhash").alias("colorhash_dist"))
    sizes = rows.filter("group_id is not null").groupBy("group_id").agg(F.count(F.lit(1)).alias("m"))
    same = sizes.agg(F.coalesce(F.sum(F.expr("m * (m - 1) div 2")), F.lit(0)).alias("same_primary_group"))
    some = lambda c: F.when(F.col("n") > 1, F.col(c)).alias(c)
    return sums.crossJoin(same).select(F.expr("n * (n - 1) div 2").alias("pairs"), *[some(c) for c in ("phash_dist", "dhash_dist", "phash16_dist", "colorhash_dist", "same_primary_group")])


def distance_histogram(photos: DataFrame, column: str = "phash", blocks: int | None = None) -> DataFrame:
    """dist -> pairs over all pairs of photos that have the hash, without writing any pair."""
    return M.pair_counts(photos, [f"{column}_dist"], blocks=blocks).withColumnRenamed(f"{column}_dist", "dist")


#: Fixed value: photos in a published sample.
SAMPLE_SIZE = 5000


def sampled(photos: DataFrame, size: int) -> DataFrame:
    """A sample that doesn't depend on partitioning: the rows with the smallest hashes of their ids."""
    return photos.orderBy(F.xxhash64("id"), "id").limit(size)


def sampled_pairs(sample: DataFrame, column: str = "phash", most: int = 20, blocks: int | None = None) -> DataFrame:
    """id_1, id_2, dist of the pairs of a sample that are at most so far apart by one hash."""
    dist = X.hamming(F.col(f"a_{column}"), F.col(f"b_{column}"))
    rows = sample.filter(F.col(column).isNotNull()).select("id", column)
    return block_join(rows, "id", lambda a, b: dist <= most, blocks).select(F.least("a_id", "b_id").alias("id_1"), F.greatest("a_id", "b_id").alias("id_2"), dist.alias("dist"))


def compared_pairs(sample: DataFrame, low: int = 10, high: int = 14, blocks: int | None = None) -> DataFrame:
    """id_1, id_2, phash_dist, dhash_dist of the pairs of a sample at the border of a scene by phash, to be laid out by dhash."""
    p, d = _scene()
    rows = sample.filter("phash is not null and dhash is not null").select("id", "phash", "dhash")
    return block_join(rows, "id", lambda a, b: p.between(low, high), blocks).select(F.least("a_id", "b_id").alias("id_1"), F.greatest("a_id", "b_id").alias("id_2"), p.alias("phash_dist"), d.alias("dhash_dist"))


def pairs_between(members: DataFrame, condition: Column, keep: int | None = None, side_rows: int = 16_384) -> DataFrame:
    """For group pairs (g1, g2) with members (g1, g2, side, id, phash, dhash): pairs across that meet condition.

    condition is on phash_dist and dhash_dist. keep takes the worst few of each group pair, by distance. A group
    pair meets in tiles of about side_rows members a side, and each tile gives its worst few.
    """
    import numpy as np
    import pyarrow as pa

    span = members.sparkSession.range(65 * 65).select(F.expr("int(id div 65)").alias("phash_dist"), F.expr("int(id % 65)").alias("dhash_dist"))
    allowed = np.zeros((65, 65), bool)
    for r in span.filter(condition).collect():
        allowed[r["phash_dist"], r["dhash_dist"]] = True
    rows = stored(members.filter("side in (1, 2) and g1 is not null and g2 is not null and phash is not null and dhash is not null").select("g1", "g2", "side", "id", "phash", "dhash"), "between")
    parts = lambda side: F.ceil(F.sum((F.col("side") == side).cast("long")) / side_rows).cast("int")
    plan = rows.groupBy("g1", "g2").agg(parts(1).alias("n1"), parts(2).alias("n2")).filter("n1 > 0 and n2 > 0")
    own, other = F.when(F.col("side") == 1, F.col("n1")).otherwise(F.col("n2")), F.when(F.col("side") == 1, F.col("n2")).otherwise(F.col("n1"))
    dealt = rows.join(plan, ["g1", "g2"]).withColumn("own", F.pmod(F.xxhash64("id"), own).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    place = lambda k: F.when(F.col("side") == k, F.col("own")).otherwise(F.col("other"))
    spread = dealt.withColumn("__tile", F.struct("g1", "g2", place(1).alias("x"), place(2).alias("y"))).withColumn("__second", F.col("side").cast("int") - 1)
    kinds = {x.name: x.dataType.simpleString() for x in rows.schema}
    schema = f"g1 {kinds['g1']}, g2 {kinds['g2']}, id_1 {kinds['id']}, id_2 {kinds['id']}, phash_dist int, dhash_dist int"

    def visit(a, b):
        if b is None:
            return
        tile = M.Tile(a, b)
        one, two, n = M.ranked(a, b)
        bound, best = [0], [np.zeros((4, 0), np.int64)]

        def test(t, x, y):
            p, d = t.apart("phash", x, y), t.apart("dhash", x, y)
            far = p.astype(np.uint16) * np.uint16(65) + d
            return (far >= bound[0]) & allowed.ravel()[far]

        shape = pa.schema([("g1", a["g1"].type), ("g2", a["g2"].type), ("id_1", a["id"].type), ("id_2", a["id"].type), ("phash_dist", pa.int32()), ("dhash_dist", pa.int32())])

        def given(x, y):
            first = pa.array(np.zeros(len(x), np.int64))
            far = [M.at_pairs(tile, c, x, y).astype(np.int32) for c in ("phash", "dhash")]
            return M.sent(shape, [a["g1"].take(first), a["g2"].take(first), a["id"].take(pa.array(x)), b["id"].take(pa.array(y)), *far])

        for x, y in M.hits(tile, test):
            if not keep:
                yield from given(x, y)
                continue
            far = M.at_pairs(tile, "phash", x, y).astype(np.int64) * 65 + M.at_pairs(tile, "dhash", x, y)
            both = np.concatenate([best[0], np.stack([-far, one[x] * n + two[y], x, y])], axis=1)
            best[0] = both[:, np.lexsort((both[1], both[0]))[:keep]]
            if best[0].shape[1] == keep:
                bound[0] = int(-best[0][0, -1])
        if keep:
            yield from given(best[0][2], best[0][3])

    slim = spread.select("g1", "g2", "id", "phash", "dhash", F.xxhash64("__tile.*").alias("__tile"), "__second")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism * 16, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = M.met(slim, visit, schema, tasks)
    if keep:
        order = Window.partitionBy("g1", "g2").orderBy(F.desc("phash_dist"), F.desc("dhash_dist"), "id_1", "id_2")
        met = met.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= keep).drop("turn")
    return met.select("g1", "g2", "id_1", "id_2", "phash_dist", "dhash_dist")
