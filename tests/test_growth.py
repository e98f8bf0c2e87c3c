"""Growing catalogs, resumable pair jobs, and the history of curation."""

import random

from pyspark.sql import functions as F

from twinfold.operators import curate
from twinfold.operators.components import connected_components
from twinfold.operators.incremental import GrowingCatalog, insert_photos
from twinfold.operators.pair_jobs import PairJob
from twinfold.operators.similarity import all_pairs, similar_pairs
from twinfold.sources.scratch import new_path, stored

HASHED = "id string, phash long, dhash long"


def hashed_rows(n, seed):
    rng = random.Random(seed)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(9)]
    out = []
    for k in range(n):
        p, d = rng.choice(base), rng.choice(base[:2])
        for _ in range(rng.randrange(12)):
            p ^= 1 << rng.randrange(64)
        out.append((f"{k:03d}", signed(p), signed(d)))
    return out


def test_three_batches_are_one(spark):
    rows = hashed_rows(150, 5)
    rng = random.Random(1)
    order = rng.sample(rows, len(rows))
    batches = [order[:40], order[40:41] + order[10:20], [], order[41:] + [("x", None, 1), ("y", 1, None), (None, 1, 1), order[60]]]
    catalog = GrowingCatalog.empty(spark.createDataFrame([], HASHED))
    pairs, known = [], set()
    for batch in batches:
        catalog, brought = insert_photos(catalog, spark.createDataFrame(batch, HASHED))
        found = [tuple(r) for r in brought.collect()]
        assert all(not {a, b} <= known for a, b, *_ in found)  # old photos never meet again
        pairs += found
        known |= {r[0] for r in batch}
    whole = spark.createDataFrame(rows, HASHED)
    assert len(pairs) == len(set(pairs)) and set(pairs) == {tuple(r) for r in similar_pairs(whole).collect()}
    want = {tuple(r) for r in connected_components(similar_pairs(whole), "id_1", "id_2").collect()}
    assert {tuple(r) for r in catalog.labels.collect()} == want and len({x[1] for x in want}) > 3
    assert catalog.photos.count() == len(rows)


def test_what_meets_follows_the_batch(spark):
    """A large catalog and one new photo: the rows that a lookup reads beyond the index are the photo's own."""
    rows = hashed_rows(300, 6)
    catalog, _ = insert_photos(GrowingCatalog.empty(spark.createDataFrame([], HASHED)), spark.createDataFrame(rows, HASHED))
    grown, brought = insert_photos(catalog, spark.createDataFrame([("new", rows[0][1], rows[0][2])], HASHED))
    found = [tuple(r) for r in brought.collect()]
    assert found and all("new" in r[:2] for r in found)
    assert grown.index.count() == catalog.index.count()  # its hash was known


def test_a_large_batch_makes_no_row_of_a_probe(spark, monkeypatch):
    def fail(*args):
        raise AssertionError("probes as rows")

    monkeypatch.setattr("twinfold.operators.incremental.probe_rows", fail)
    rows = spark.createDataFrame(hashed_rows(80, 7), HASHED)
    first, one = insert_photos(GrowingCatalog.empty(spark.createDataFrame([], HASHED)), rows.filter("id < '050'"))
    _, two = insert_photos(first, rows.filter("id >= '050'"))
    found = [tuple(r) for r in one.unionByName(two).collect()]
    assert len(found) == len(set(found)) and set(found) == {tuple(r) for r in similar_pairs(rows).collect()}


def wide(spark, n):
    rng = random.Random(n)
    word = lambda: rng.getrandbits(63)
    return spark.createDataFrame([(f"{k:03d}", rng.choice([None, 1, 2]), word(), word(), [word() for _ in range(4)], rng.getrandbits(14)) for k in range(n)], "id string, group_id long, phash long, dhash long, phash_16 array<long>, colorhash long")


def test_a_stopped_job_goes_on(spark, monkeypatch):
    photos = stored(wide(spark, 60), "wide")
    folder = new_path(spark, "job")
    job = PairJob(spark, folder).start(photos, steps=7)
    assert job.remaining() == list(range(7)) and job.pairs().count() == 0
    job.run(3)
    done = {r["step"]: r["pairs"] for r in job.manifest().collect()}
    assert set(done) == {0, 1, 2} and job.pairs().count() == sum(done.values())
    # A step that is stopped after its part is written, but before its row is.
    real = PairJob.manifest
    monkeypatch.setattr("twinfold.operators.pair_jobs.PAIR_INPUT", "no schema")
    try:
        PairJob(spark, folder).step(3)
        raise AssertionError("it should have failed")
    except Exception as error:
        assert not isinstance(error, AssertionError)
    monkeypatch.undo()
    assert real(job).count() == 3
    taken = []
    again = PairJob(spark, folder).start(wide(spark, 5), steps=99)  # the plan and the photos are those of the first start
    step = again.step
    again.step = lambda k: (taken.append(k), step(k))
    again.run()
    assert taken == [3, 4, 5, 6] and again.remaining() == []
    got = [tuple(r) for r in again.pairs().collect()]
    assert len(got) == 60 * 59 // 2 and set(got) == {tuple(r) for r in all_pairs(photos).collect()}
    assert sum(r["pairs"] for r in again.manifest().collect()) == len(got)


def test_history_is_replay(spark):
    rng = random.Random(3)
    ids = [f"p{k:02d}" for k in range(14)]
    start = {p: 1 + k % 3 for k, p in enumerate(ids)}
    rejected = {"p00": (1, "THUMBNAIL")}
    actions, states = [], [(dict(start), dict(rejected))]
    new = 4
    for _ in range(9):
        groups, refused = map(dict, states[-1])
        picked = rng.sample(ids, rng.randrange(1, 5))
        if rng.random() < 0.6:
            source = rng.choice(sorted(set(groups.values())))
            actions.append(("split", source, picked, new))
            groups = {p: new if p in picked and g == source else g for p, g in groups.items()}
            new += 1
        else:
            actions.append(("reject", 1, picked, None))
            refused |= {p: (1, "MANUAL") for p in picked if p not in refused}
        states.append((groups, refused))
    log = spark.createDataFrame([(k + 1, *a) for k, a in enumerate([(t, s, p, n) for t, s, p, n in actions])], curate.LOG)
    now, refused = states[-1]
    groups = spark.createDataFrame(list(now.items()), "photo_id string, group_id long")
    rejections = spark.createDataFrame([(p, *x) for p, x in refused.items()], "photo_id string, group_id long, rule_name string")
    history, refusals = stored(curate.membership_history(groups, log), "history"), stored(curate.rejection_history(rejections, log), "refusals")
    for k, (want, kept) in enumerate(states):
        assert dict(map(tuple, curate.as_of(history, k).collect())) == want, k
        assert {r["photo_id"]: (r["group_id"], r["rule_name"]) for r in curate.as_of(refusals, k).collect()} == kept, k
    assert history.groupBy("photo_id").agg(F.count_if(F.col("to_action").isNull()).alias("n")).filter("n <> 1").count() == 0


def test_tiles_are_cut_without_the_whole_text_beside_each(spark, tmp_path):
    from twinfold.plans import picture_queries
    from twinfold.plans.fixtures import catalog

    spark.createDataFrame([(1, "abcdefghi" * 40), (2, "x"), (3, ""), (4, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tiles = picture_queries._tiles(catalog(spark, str(tmp_path)))
    plan = tiles._jdf.queryExecution().optimizedPlan().toString()
    assert "hex(" not in plan and "sequence" not in next(line for line in plan.splitlines() if "Generate" in line).split("posexplode")[0]
    rows = {(r["doc_id"], r["tile"]): bytes(r["content"])[1078:] for r in tiles.collect()}
    assert len(rows) == 6 and rows[1, 4] == (b"abcdefghi" + bytes(3)) * 8 and rows[2, 0] == b"x" + bytes(95)


def test_losers_meet_folded_classes(spark, monkeypatch):
    from twinfold.operators import survivors as V

    rng = random.Random(3)
    rows = [(f"m{k:03d}", k % 3, rng.choice([0, 1, 3, 7, 15, 127, None]), rng.choice([5, 9, 12, None]), rng.randrange(1, 50)) for k in range(240)]
    members = stored(spark.createDataFrame(rows, "id string, group_id long, phash long, dhash long, res long"), "folded")
    near = V.near_hashes(members.filter("dhash is not null"))

    def forbidden(*_):
        raise AssertionError("classes meet one by one")

    monkeypatch.setattr(V, "same_photos", forbidden)
    found = V._best_of_same(members.filter("res < 30"), members, near, F.max("b_res").alias("most"), F.min("b_first").alias("first"), F.max("b_last").alias("last"))
    got = {r["id"]: (r["most"], r["first"], r["last"]) for r in found.collect()}

    def same(a, b):
        if a[1] != b[1] or None in (a[2], a[3], b[2], b[3]):
            return False
        bits = (a[2] ^ b[2]).bit_count()
        return bits <= V.SURE_BITS or bits <= V.SAME_BITS and a[3] == b[3]

    want = {a[0]: (max(b[4] for b in met), min(b[0] for b in met), max(b[0] for b in met)) for a in rows if a[4] < 30 and (met := [b for b in rows if same(a, b)])}
    assert got == want and len(want) > 50


def test_planned_rank_makes_hashes_once(spark, monkeypatch):
    from twinfold.plans import fixtures, rule_queries

    class Once(fixtures.Catalog):
        @property
        def photos(self):
            raise AssertionError("hashes are made again")

    assert rule_queries._members(Once(spark, "/root/testdata/sf0.001")).columns
