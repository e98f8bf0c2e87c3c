"""Pairs that meet as arrays, against brute force."""

import random
from collections import Counter
from itertools import combinations

import pytest

from twinfold.operators import grouping as G
from twinfold.operators import meeting as M
from twinfold.operators import similarity as S


def near_words(seed, n, bits=8):
    """Rows (id, group_id, phash, dhash, phash_16, colorhash) whose hashes are few bits from a few centres."""
    rng = random.Random(seed)
    base = [rng.getrandbits(63) for _ in range(3)]
    word = lambda: rng.choice(base) ^ sum(1 << k for k in rng.sample(range(63), rng.randrange(bits)))
    return [(f"{rng.randrange(10**9):09d}-{k}", rng.choice([None, 1, 2, 7]), word(), word(), [word() for _ in range(4)], rng.getrandbits(14)) for k in range(n)]


SCHEMA = "id string, group_id long, phash long, dhash long, phash_16 array<long>, colorhash long"


def apart(x, y):
    return (x ^ y).bit_count()


def pair_row(a, b):
    a, b = sorted((a, b))
    same = int(a[1] is not None and a[1] == b[1])
    return a[0], b[0], same, apart(a[2], b[2]), apart(a[3], b[3]), sum(map(apart, a[4], b[4])), apart(a[5], b[5])


def counts(df):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


def test_bridges_are_counted_without_the_pairs(spark):
    rows = near_words(1, 150)
    df = spark.createDataFrame(rows + [("nohash", 1, None, 1, [1] * 4, 1)], SCHEMA)
    pairs = [(min(a[1], b[1]), max(a[1], b[1])) for a, b in combinations(rows, 2) if None not in (a[1], b[1]) and a[1] != b[1] and apart(a[2], b[2]) <= 9]
    want = {k: n for k, n in Counter(pairs).items() if n >= 20}
    assert len(want) > 1
    for blocks in (1, 5, None):
        assert counts(G.bridges_at(df, 9, 20, blocks=blocks)) == want
    plan = G.bridges_at(df, 9, 20, blocks=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_bridges_of_many_groups(spark, monkeypatch):
    rows = [(f"{k:03d}", k % 40, 0) for k in range(80)]
    monkeypatch.setattr(M, "BINS", 100)  # more group pairs than a table may have
    got = counts(G.bridges_at(spark.createDataFrame(rows, "id string, group_id long, phash long"), 0, 1, blocks=2))
    assert len(got) == 40 * 39 // 2 and set(got.values()) == {4}


@pytest.mark.parametrize("blocks", [1, 4, None])
def test_counts_are_those_of_the_pair_table(spark, blocks, monkeypatch):
    rows = near_words(2, 101)
    df = spark.createDataFrame(rows + [("nohash", 1, None, None, None, None)], SCHEMA)
    table = [pair_row(a, b)[2:] for a, b in combinations(rows, 2)]
    assert {(r["dist"],): r["pairs"] for r in S.distance_histogram(df, blocks=blocks).collect()} == Counter((t[1],) for t in table)
    assert counts(S.pair_counts(df, ["phash_dist", "dhash_dist"], blocks)) == Counter(t[1:3] for t in table)
    assert counts(S.pair_counts(df, ["same_primary_group", "phash_dist"], blocks)) == Counter(t[:2] for t in table)
    want = Counter((t[3], t[4], t[1], t[2], t[0]) for t in table)
    assert counts(S.pair_counts(df, list(S.SUMMARY), blocks)) == want
    monkeypatch.setattr(M, "BINS", 10)
    assert counts(S.pair_counts(df, list(S.SUMMARY), blocks)) == want


def test_keys_beyond_the_bounds_seen_so_far(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    monkeypatch.setattr(M, "BUFFER", 700)
    monkeypatch.setattr(M, "PIECE", (4, 32))
    wide = [[(1 << rng.randrange(k // 4 + 1)) - 1 for k in range(90)] for _ in range(6)]
    tile = pa.table(dict(zip(["w0", "w1", "w2", "w3", "colorhash", "phash"], wide)))
    visit, _ = M.counting(["phash16_dist", "colorhash_dist", "phash_dist"])
    got = Counter()
    for batch in visit(tile, None):
        for *key, n in zip(*[c.to_pylist() for c in batch.columns]):
            got[tuple(key)] += n
    rows = list(zip(*wide))
    assert got == Counter((sum(apart(x[k], y[k]) for k in range(4)), apart(x[4], y[4]), apart(x[5], y[5])) for x, y in combinations(rows, 2))


def test_totals_are_those_of_the_pair_table(spark):
    rows = near_words(3, 60)
    table = [pair_row(a, b)[2:] for a, b in combinations(rows, 2)]
    df = spark.createDataFrame(rows + [("nohash", 1, None, 1, [1] * 4, 1)], SCHEMA)
    assert tuple(S.pair_totals(df).first()) == (len(table), *(sum(t[k] for t in table) for k in (1, 2, 3, 4, 0)))

    for few in (0, 1):
        assert tuple(S.pair_totals(spark.createDataFrame(rows[:few], SCHEMA)).first()) == (0, None, None, None, None, None)


@pytest.mark.parametrize("blocks", [1, 4])
def test_pairs_in_limits_and_nearest_pairs(spark, blocks):
    rows = near_words(5, 90)
    photos = S.spread_words(spark.createDataFrame(rows + [("nohash", 1, None, None, None, None)], SCHEMA))
    table = [pair_row(a, b) for a, b in combinations(rows, 2)]
    limits = spark.createDataFrame([(c, 90 + 5 * c) for c in range(9)], "colorhash_dist int, max_phash16 int")
    want = sorted((t[0], t[1], t[5], t[6]) for t in table if t[6] < 9 and t[5] <= 90 + 5 * t[6])
    assert len(want) > 50 and sorted(map(tuple, G.pairs_within(photos, limits, blocks).collect())) == want
    zone = spark.createDataFrame([(7, 80, 100), (5, 0, 70)], "colorhash_dist int, lo int, hi int")
    want = sorted((t[0], t[1], t[5], t[6]) for t in table if t[6] == 7 and 80 <= t[5] <= 100 or t[6] == 5 and t[5] <= 70)
    assert want and sorted(map(tuple, G.pairs_met_in_zone(photos, zone, blocks).collect())) == want
    off = sorted((abs(t[5] - 100) + abs(t[6] - 7), t[0], t[1]) for t in table)
    want = [(a, b, o) for o, a, b in off if o <= 12][:24]
    assert len(want) == 24 and list(map(tuple, M.nearest_pairs(photos, 100, 7, 12, 24, blocks).collect())) == want


@pytest.mark.parametrize("side_rows", [4, 1000])
def test_worst_pairs_of_two_groups_meet_in_tiles(spark, side_rows):
    from pyspark.sql import functions as F

    rows = near_words(6, 60)
    sides = [(g, g + 1, s, r[0], r[2], r[3]) for k, r in enumerate(rows) for g, s in ((k % 3, 1), (k % 3 - 1, 2))]
    df = spark.createDataFrame(sides, "g1 long, g2 long, side int, id string, phash long, dhash long")
    far = [(a[0], a[1], a[3], b[3], apart(a[4], b[4]), apart(a[5], b[5])) for a in sides for b in sides if a[:2] == b[:2] and (a[2], b[2]) == (1, 2)]
    far = sorted((t for t in far if t[4] > 8 or t[5] % 2), key=lambda t: (t[0], -t[4], -t[5], t[2], t[3]))
    test = (F.col("phash_dist") > 8) | (F.col("dhash_dist") % 2 == 1)
    assert sorted(map(tuple, S.pairs_between(df, test, None, side_rows).collect())) == sorted(far)
    want = [t for g in {t[0] for t in far} for t in [x for x in far if x[0] == g][:5]]
    assert sorted(map(tuple, S.pairs_between(df, test, 5, side_rows).collect())) == sorted(want)



def test_a_job_by_fields_keeps_counts_and_goes_on(spark):
    from twinfold.operators.pair_jobs import PairJob
    from twinfold.sources.scratch import new_path

    rows = near_words(7, 50)
    df = spark.createDataFrame(rows, SCHEMA)
    folder, by = new_path(spark, "job"), ["same_primary_group", "phash_dist"]
    job = PairJob(spark, folder, by).start(df, steps=5)
    job.run(2)
    assert job.remaining() == [2, 3, 4]
    again = PairJob(spark, folder, by).start(df.limit(0)).run()
    want = Counter(pair_row(a, b)[2:4] for a, b in combinations(rows, 2))
    assert again.remaining() == [] and counts(again.counts()) == want
    assert sum(r["pairs"] for r in again.manifest().collect()) == 50 * 49 // 2 and not again._has("pairs/step=0")


@pytest.mark.parametrize("several", [False, True])
def test_expansion_shuffles_no_expanded_rows(spark, several):
    photos = [("e", "a"), ("e", "b"), ("e", "b"), ("e", "z"), ("f", "c"), ("f", None), (None, "a"), (None, "a")]
    groups = [("a", 1), ("b", 1), ("c", 1), ("d", 2), ("z", None), ("a", 1)] + [("a", 2), ("c", 2)] * several
    df = G.expand_to_groups(spark.createDataFrame(photos, "entity string, photo_id string"), spark.createDataFrame(groups, "photo_id string, group_id long"))
    mates = {(e, m) for e, p in photos for x, g in groups for m, h in groups if p == x and g is not None and g == h}
    got = list(map(tuple, df.collect()))
    assert len(got) == len(set(got)) and set(got) == mates | set(photos)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Aggregate" if several else "Union")


def test_scenes_out_of_tiles_of_bands(spark):
    rng = random.Random(8)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(3)]
    rows = {(signed(rng.choice(base) ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(13)))), rng.randrange(3)): rng.random() < 0.3 for _ in range(300)}
    rows |= {(p, 9): True for p, _ in list(rows)[:5]}
    df = spark.createDataFrame([(p, d, f) for (p, d), f in rows.items()], "phash long, dhash long, fresh boolean")
    mask = (1 << 64) - 1
    close = {frozenset(x) for x in combinations(rows, 2) if ((x[0][0] ^ x[1][0]) & mask).bit_count() <= 14}
    for head in (1, 4):
        sides = lambda df: [frozenset({(r["a_phash"], r["a_dhash"]), (r["b_phash"], r["b_dhash"])}) for r in S.band_meet(df, S.SCENE_BITS, S.SCENE_BANDS, head).collect()]  # noqa: B023, E731
        got = sides(df)
        assert len(got) == len(set(got)) and set(got) == {x for x in close if any(rows[y] for y in x)}
        every = sides(df.selectExpr("phash", "dhash", "true AS fresh"))
        assert len(every) == len(close) and set(every) == close
    assert S.band_tiles(df, "phash", S.SCENE_BITS, S.SCENE_BANDS, S.BLOCK_BITS).count() == 55 * len(rows)


def test_bridges_are_added_up_without_places_of_pairs(spark, monkeypatch):
    def fail(*args):
        raise AssertionError("places of pairs")

    rng = random.Random(10)
    rows = [(f"{k:03d}", rng.choice([None, 3, 4, *range(10, 40)]), rng.getrandbits(3)) for k in range(200)]
    want = Counter((min(a[1], b[1]), max(a[1], b[1])) for a, b in combinations(rows, 2) if None not in (a[1], b[1]) and a[1] != b[1] and apart(a[2], b[2]) <= 1)
    monkeypatch.setattr(M, "hits", fail)
    monkeypatch.setattr(M, "PIECE", (4, 32))
    for blocks in (1, 3):
        assert counts(G.bridges_at(spark.createDataFrame(rows, "id string, group_id long, phash long"), 1, 1, blocks=blocks)) == want


def test_each_tile_is_a_task_of_its_own(spark):
    import pyarrow as pa

    def sizes(a, b):
        yield pa.RecordBatch.from_pydict({"rows": [len(a) + (0 if b is None else len(b))]})

    for blocks in (1, 5):
        spread = M.tiles(spark.range(400), "id", blocks)
        found = M.met_singly(spread, sizes, "rows long", M.tile_codes(blocks))
        assert found.rdd.glom().map(len).collect() == [1] * (blocks * (blocks + 1) // 2)


def test_pairs_of_one_group_are_counted_apart(spark):
    """Few pairs have one group here, so all pairs are counted without the flag, and those few are taken off."""
    rng = random.Random(11)
    rows = [(i, rng.choice([None, *range(40)]), *rest) for i, _, *rest in near_words(11, 120)]
    table = [pair_row(a, b)[2:] for a, b in combinations(rows, 2)]
    assert 0 < sum(t[0] for t in table) < len(table) / 20
    df = spark.createDataFrame(rows, SCHEMA)
    for blocks in (1, 3):
        assert counts(S.pair_counts(df, ["same_primary_group", "phash_dist"], blocks)) == Counter(t[:2] for t in table)
        assert counts(S.pair_counts(df, list(S.SUMMARY), blocks)) == Counter((t[3], t[4], t[1], t[2], t[0]) for t in table)


def test_columns_alike_are_compared_once(monkeypatch):
    import pyarrow as pa

    rng = random.Random(12)
    p, d, x, c = ([rng.getrandbits(60) for _ in range(70)] for _ in range(4))
    tile = pa.table({"w0": p, "w1": d, "w2": x, "w3": p, "phash": p, "dhash": d, "colorhash": c})
    calls, real = [], M.np.bitwise_count
    monkeypatch.setattr(M.np, "bitwise_count", lambda v: calls.append(v.size) or real(v))
    fields = ["phash16_dist", "colorhash_dist", "phash_dist", "dhash_dist"]
    visit, _ = M.counting(fields)
    got = Counter()
    for batch in visit(tile.slice(0, 30), tile.slice(30)):
        for *key, n in zip(*[col.to_pylist() for col in batch.columns]):
            got[tuple(key)] += n
    far = lambda v, i, j: apart(v[i], v[j])
    assert got == Counter((2 * far(p, i, j) + far(d, i, j) + far(x, i, j), far(c, i, j), far(p, i, j), far(d, i, j)) for i in range(30) for j in range(30, 70))
    assert sum(calls) == 4 * 30 * 40
