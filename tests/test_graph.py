"""Components, clustering, extension and similarity joins against brute force on generated graphs."""

import os
import random

import pytest

from twinfold.operators.cluster import complete_linkage, link_completely, single_linkage_extend
from twinfold.operators.components import connected_components
from twinfold.operators.grouping import composite_groups, legacy_groups, second_groups
from twinfold.operators.similarity import banded_pairs, compared_pairs, sampled, sampled_pairs, similar_pairs
from twinfold.plans import registry


def components(spark, edges):
    rows = connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()
    out = {}
    for r in rows:
        out.setdefault(r["label"], set()).add(r["node"])
    return out


def brute_components(edges):
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    out = {}
    for n in parent:
        out.setdefault(root(n), set()).add(n)
    return out


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    for n, m in ((300, 260),):
        edges = [tuple(rng.sample(range(n), 2)) for _ in range(m)]
        assert components(spark, edges) == brute_components(edges)
    assert components(spark, [(None, 1), (5, 5)]) == {}


@pytest.mark.parametrize("order", ["up", "down", "shuffled"])
def test_chain_of_ten_thousand(spark, order):
    n = 10_000
    names = list(range(n)) if order == "up" else list(range(n))[::-1]
    if order == "shuffled":
        random.Random(3).shuffle(names)
    assert components(spark, list(zip(names, names[1:]))) == {0: set(range(n))}


def test_star_of_chains(spark):
    rays, length = 100, 100
    edges = [(0 if k == 0 else 1 + r * length + k - 1, 1 + r * length + k) for r in range(rays) for k in range(length)]
    assert components(spark, edges) == {0: set(range(1 + rays * length))}


def near(d):
    p, q = d
    return p <= 10 or p <= 12 and q < 22 or p <= 14 and q <= 17


def brute_linkage(distances, ok=near):
    """The published order, spelled out: of all pairs of clusters that may merge, the closest, then the smallest numbers."""
    clusters = {n: [n] for e in distances for n in e}
    apart = lambda a, b: distances.get((min(a, b), max(a, b)))
    while True:
        best = None
        for a in clusters:
            for b in clusters:
                if a < b:
                    across = [apart(x, y) for x in clusters[a] for y in clusters[b]]
                    if None not in across and all(map(ok, across)):
                        best = min(x for x in (best, (max(across), a, b)) if x)
        if best is None:
            return sorted(sorted(c) for c in clusters.values())
        clusters[best[1]] += clusters.pop(best[2])


def tied_graph(rng, n, kinds, density):
    """Distances out of a few values only, so that ties are the rule."""
    values = [(rng.randrange(16), rng.randrange(26)) for _ in range(kinds)]
    return {(i, j): rng.choice(values) for i in range(n) for j in range(i + 1, n) if rng.random() < density}


def test_complete_linkage_follows_the_published_order_of_ties():
    four = {(0, 1): (5, 5), (0, 2): (5, 5), (1, 2): (5, 5), (2, 3): (5, 5)}
    assert link_completely([(i, j, d) for (i, j), d in four.items()]) == [[0, 1, 2], [3]]  # the smaller number stays, so 0 goes on first
    rng = random.Random(42)
    for turn in range(3000):
        graph = tied_graph(rng, rng.randrange(2, 10), rng.randrange(1, 5), rng.choice((0.3, 0.6, 0.9, 1.0)))
        links = [(i, j, d) for (i, j), d in graph.items() if near(d)]
        rng.shuffle(links)
        want = brute_linkage({k: d for k, d in graph.items() if near(d)})
        assert sorted(link_completely(links)) == want, graph
    assert link_completely([]) == []


def test_linkage_in_rounds_is_linkage_in_tasks(spark):
    rng = random.Random(43)
    rows, want, at = [], [], 0
    for _ in range(16):
        n = rng.randrange(2, 12)
        graph = {(i + at, j + at): d for (i, j), d in tied_graph(rng, n, rng.randrange(1, 4), rng.choice((0.4, 0.7, 1.0))).items()}
        want += brute_linkage({k: d for k, d in graph.items() if near(d)})
        rows += [(f"{i:03d}", f"{j:03d}", *d, near(d)) for (i, j), d in graph.items()]
        at += n
    df = spark.createDataFrame(rows, "id_1 string, id_2 string, phash_dist int, dhash_dist int, ok boolean").repartition(5)
    for most in (200_000, 12, 0):  # all in tasks, large components in rounds, all in rounds
        found = {}
        for r in complete_linkage(df, ok="ok", task_edges=most).collect():
            found.setdefault(r["cluster_id"], []).append(int(r["photo_id"]))
        assert {int(k) for k in found} == {min(c) for c in found.values()}
        assert sorted(map(sorted, found.values())) == sorted(want)


def brute_extension(clusters, singles, links):
    linked = lambda a, b: any((min(x, y), max(x, y)) in links for x in a for y in b)
    found = [set(c) for c in clusters]
    merged = True
    while merged:
        merged = False
        for a in found:
            for b in found:
                if a is not b and linked(a, b) and not merged:
                    found = [c for c in found if c is not a and c is not b] + [a | b]
                    merged = True
    for s in sorted(singles):
        hit = [c for c in found if linked({s}, c)]
        if hit:
            found = [c for c in found if c not in hit] + [{s}.union(*hit)]
    return {min(c): c for c in found}


def test_single_linkage_extension_visits_singles_once_in_order(spark):
    rng = random.Random(5)
    members, edges, want, at = [], [], {}, 0
    for turn in range(60):
        n = rng.randrange(4, 16)
        nodes = list(range(at, at + n))
        at += n
        rng.shuffle(nodes)
        clusters, singles = [], []
        while nodes:
            take = min(len(nodes), rng.choice((1, 1, 1, 2, 3)))
            part, nodes = nodes[:take], nodes[take:]
            clusters, singles = (clusters + [part], singles) if take > 1 else (clusters, singles + part)
        links = {tuple(sorted(rng.sample(range(at - n, at), 2))) for _ in range(rng.randrange(n))} | ({(k, k + 1) for k in range(at - n, at - 1)} if turn % 8 == 0 else set())
        members += [(x, min(c)) for c in clusters for x in c] + [(s, None) for s in singles]
        edges += links
        want |= brute_extension(clusters, singles, links)
    got = {}
    for r in single_linkage_extend(spark.createDataFrame(members, "photo_id long, cluster_id long"), spark.createDataFrame(edges, "id_1 long, id_2 long")).collect():
        got.setdefault(r["cluster_id"], set()).add(r["photo_id"])
    assert got == want


def test_extension_with_shortcuts_is_extension_in_tasks(spark):
    rng = random.Random(6)
    members, edges, want, at = [], [], {}, 0
    for _ in range(40):
        n = rng.randrange(3, 30)
        first, singles = [at, at + 1], list(range(at + 2, at + n))
        links = {tuple(sorted(rng.sample(range(at, at + n), 2))) for _ in range(n)} | {(k, k + 2) for k in range(at, at + n - 2)}
        at += n
        members += [(x, min(first)) for x in first] + [(s, None) for s in singles]
        edges += links
        want |= brute_extension([first], singles, links)
    df, links = spark.createDataFrame(members, "photo_id long, cluster_id long"), spark.createDataFrame(edges, "id_1 long, id_2 long")
    for most in (0, 25, 10**6):
        got = {}
        for r in single_linkage_extend(df, links, task_edges=most).collect():
            got.setdefault(r["cluster_id"], set()).add(r["photo_id"])
        assert got == want


def test_extension_along_a_chain_takes_few_rounds(spark):
    """10,000 singles in a row behind one cluster, with shortcuts alone: rounds go with the logarithm."""
    n = 10_000
    members = spark.createDataFrame([(0, 0), (1, 0)] + [(k, None) for k in range(2, n)], "photo_id long, cluster_id long")
    chain = spark.createDataFrame([(k, k + 1) for k in range(n - 1)], "id_1 long, id_2 long")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    found = single_linkage_extend(members, chain, task_edges=0)
    assert [tuple(r) for r in found.groupBy("cluster_id").count().collect()] == [(0, n)]
    jobs = len(tracker.getJobIdsForGroup("chain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 400, jobs


def test_second_and_composite_groups(spark):
    rng = random.Random(77)
    n = 60
    pairs = {(a, b): (rng.randrange(40, 100), rng.randrange(6)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.12}
    relaxed, strict = {k: 90 - 6 * k for k in range(4)}, {0: 60, 1: 95, 4: 99}
    inside = lambda limits: lambda d: d[1] in limits and d[0] <= limits[d[1]]
    near_pairs = {k: d for k, d in pairs.items() if inside(relaxed)(d)}
    kernels = brute_linkage(near_pairs, inside(relaxed))
    links = {k for k, d in pairs.items() if inside(strict)(d)}
    ends = {x for k in links for x in k} - {x for c in kernels for x in c}
    table = spark.createDataFrame([(f"{a:02d}", f"{b:02d}", *d) for (a, b), d in pairs.items()], "photo_id_1 string, photo_id_2 string, phash16_dist int, colorhash_dist int")
    limits = lambda x: spark.createDataFrame(list(x.items()), "colorhash_dist int, max_phash16 int")
    for isolated in (False, True):
        clusters = [c for c in kernels if len(c) > 1]
        singles = [c[0] for c in kernels if len(c) == 1] + (sorted(ends) if isolated else [])
        known = {x for c in clusters for x in c} | set(singles)
        want = {frozenset(c) for c in brute_extension(clusters, singles, {k for k in links if set(k) <= known}).values() if len(c) > 1}
        second = second_groups(table, limits(relaxed), limits(strict), include_isolated=isolated)
        rows = second.collect()
        assert {frozenset(int(x) for x in c) for c in groups_of(second)} == want
        order = sorted({r["group_id"]: min(x["photo_id"] for x in rows if x["group_id"] == r["group_id"]) for r in rows}.items())
        assert [g for g, _ in order] == list(range(len(want))) and [f for _, f in order] == sorted(f for _, f in order)
    first = [(f"{k:02d}", k % 23) for k in range(0, n, 2)]
    kept = [f"{k:02d}" for k in range(n) if k % 5]
    both = [(a, b) for a in kept for b in kept if a < b and (dict(first).get(a), True) == (dict(first).get(b, -1), True)]
    both += [(min(f"{x:02d}" for x in c), f"{y:02d}") for c in want for y in c]
    composite = composite_groups(spark.createDataFrame(first, "photo_id string, group_id int"), second, spark.createDataFrame([(k,) for k in kept], "id string"))
    assert groups_of(composite) == {frozenset(c) for c in brute_components([b for b in both if b[0] != b[1]]).values()}


def groups_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["group_id"], set()).add(r["photo_id"])
    return {frozenset(c) for c in out.values()}


def test_joins_agree_with_all_pairs(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(12)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for k in range(120):
        p, d = rng.choice(base), rng.choice(base[:3])
        for _ in range(rng.randrange(9)):
            p ^= 1 << rng.randrange(64)
        rows.append((f"{k:03d}", signed(p), signed(d)))
    rows += [("x", None, 1), ("y", 0, None), ("z0", 0, 0), ("z1", 0, 0), ("z2", -1, -1)]
    df = spark.createDataFrame(rows, "id string, phash long, dhash long")
    full = [r for r in rows if r[1] is not None and r[2] is not None]
    dist = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    want = {(a[0], b[0]) for a in full for b in full if a[0] < b[0] and near((dist(a[1], b[1]), dist(a[2], b[2])))}
    for band_from in (0, 10**6):  # out of bands, out of blocks
        got = [(r["id_1"], r["id_2"]) for r in similar_pairs(df, band_from=band_from).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    want = {(a[0], b[0], dist(a[1], b[1])) for a in rows for b in rows if a[1] is not None and b[1] is not None and a[0] < b[0] and dist(a[1], b[1]) <= 6}
    got = [tuple(r) for r in banded_pairs(df, 6).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    ends = sorted({(a, b) for a, b, d in want if d <= 2})
    groups = brute_components(ends)
    assert {frozenset(c) for c in groups.values()} == groups_of(legacy_groups(df, threshold=2))


def test_samples_keep_near_and_border_pairs(spark):
    rng = random.Random(12)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for k in range(300):
        p = rng.choice([0, 0x0F0F0F0F0F0F0F0F])
        for _ in range(rng.randrange(12)):
            p ^= 1 << rng.randrange(64)
        rows.append((f"{k:03d}", signed(p), signed(rng.getrandbits(64))))
    df = spark.createDataFrame([*rows, ("x", None, 1), ("y", 0, None)], "id string, phash long, dhash long")
    dist = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    part = sampled(df, 120)
    ids = {r["id"] for r in part.collect()}
    assert len(ids) == 120 and ids == {r["id"] for r in sampled(df.repartition(7), 120).collect()}
    full = {(a[0], b[0]): (dist(a[1], b[1]), dist(a[2], b[2])) for a in rows for b in rows if a[0] < b[0] and {a[0], b[0]} <= ids}
    pairs = lambda df: [tuple(r) for r in df.collect() if not {r["id_1"], r["id_2"]} & {"x", "y"}]
    assert sorted(pairs(sampled_pairs(part))) == sorted((*k, p) for k, (p, _) in full.items() if p <= 20)
    assert sorted(pairs(sampled_pairs(part, "dhash"))) == sorted((*k, d) for k, (_, d) in full.items() if d <= 20)
    assert sorted(pairs(compared_pairs(part))) == sorted((*k, p, d) for k, (p, d) in full.items() if 10 <= p <= 14)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables here")
def test_registered_samples_have_the_published_size(spark):
    histogram = registry.queries()["j3_sampled_distances"](spark, "/root/testdata/sf0.1")
    assert histogram.agg({"pairs": "sum"}).first()[0] == 5000 * 4999 // 2
