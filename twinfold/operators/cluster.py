"""Clustering inside components: complete linkage and the ordered single-linkage extension.

Complete linkage merges the closest two clusters again and again; equal distances go by the clusters'
numbers, and a merged cluster keeps the smaller number. An edge that is smallest among all edges of both its
ends stays so until it merges: merging elsewhere never brings an edge to the front (the new distance is the
larger of two, under the smaller number). So all such edges may merge at once, in rounds of Spark joins, with
the same result. Components with few edges are finished in one task each; large ones take rounds until what
is left of them is small.
"""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.operators.components import connected_components, relabel
from twinfold.sources.scratch import stored

#: Edges of a component that one task may hold.
TASK_EDGES = 200_000


def link_completely(edges: list[tuple[str, str, tuple]]) -> list[list[str]]:
    """Complete linkage over edges (i, j, key): closest clusters first, a missing pair forbids.

    The distance of two clusters is the largest key across them. Clusters are numbered by their smallest
    member, and among equal keys the pair with the smallest numbers merges first.
    """
    apart: dict[str, dict[str, tuple]] = {}
    for i, j, key in edges:
        apart.setdefault(i, {})[j] = key
        apart.setdefault(j, {})[i] = key
    members = {n: [n] for n in apart}
    heap = [(key, a, b) for a, near in apart.items() for b, key in near.items() if a < b]
    heapq.heapify(heap)
    while heap:
        key, a, b = heapq.heappop(heap)
        if a not in apart or apart[a].get(b) != key:
            continue  # an entry that a merger has overtaken
        gone, mine = apart.pop(b), apart[a]
        members[a] += members.pop(b)
        del mine[b]
        for c in gone:
            if c != a:
                del apart[c][b]
        for c in list(mine):
            if c not in gone:
                del mine[c], apart[c][a]
            elif gone[c] > mine[c]:
                mine[c] = apart[c][a] = gone[c]
                heapq.heappush(heap, (gone[c], min(a, c), max(a, c)))
    return [sorted(m) for m in members.values()]


def _merge_round(edges: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """(edges after the round, mergers (node, label)); edges: i < j and keys."""
    order = F.struct(*names, "i", "j")
    first = edges.select(F.col("i").alias("n"), order.alias("e")).unionByName(edges.select(F.col("j").alias("n"), order.alias("e"))).groupBy("n").agg(F.min("e").alias("e"))
    # An edge that is the first of both its ends turns up twice.
    mutual = first.groupBy("e").agg(F.count(F.lit(1)).alias("ends")).filter("ends = 2")
    mergers = stored(mutual.select(F.col("e.j").alias("node"), F.col("e.i").alias("label")), "mergers")
    size = mergers.select(F.col("label").alias("__n"), F.lit(2).alias("__size"))
    moved = relabel(relabel(edges, "i", mergers), "j", mergers).filter("i <> j")
    pairs = moved.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), F.struct(*names).alias("key")).groupBy("i", "j").agg(F.max("key").alias("key"), F.count(F.lit(1)).alias("links"))
    sized = pairs.join(size.toDF("i", "size_i"), "i", "left").join(size.toDF("j", "size_j"), "j", "left")
    whole = sized.filter(F.col("links") == F.coalesce("size_i", F.lit(1)) * F.coalesce("size_j", F.lit(1)))
    return stored(whole.select("i", "j", *[F.col(f"key.{k}").alias(k) for k in names]), "merged-edges"), mergers


def complete_linkage(edges: DataFrame, src: str = "id_1", dst: str = "id_2", keys: tuple[str, ...] = ("phash_dist", "dhash_dist"), ok: str | None = None, task_edges: int = TASK_EDGES) -> DataFrame:
    """photo_id, cluster_id (smallest member) for every node with a mergeable edge; ok names that flag.

    Edges that aren't mergeable count as missing, which forbids a merger just the same. A pair counts once.
    """
    names = [f"k{n}" for n in range(len(keys))]
    flat = (edges.filter(ok) if ok else edges).select(F.least(src, dst).alias("i"), F.greatest(src, dst).alias("j"), *[F.col(k).alias(n) for n, k in zip(names, keys)])
    left = stored(flat.filter("i is not null and j is not null and i <> j").dropDuplicates(["i", "j"]), "linkage")
    nodes = stored(left.select(F.col("i").alias("photo_id")).unionByName(left.select(F.col("j").alias("photo_id"))).distinct().withColumn("cluster_id", F.col("photo_id")), "linkage-nodes")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = [(i, j, tuple(k)) for i, j, *k in group[["i", "j", *names]].itertuples(index=False, name=None)]
        out = [(n, c[0]) for c in link_completely(rows) for n in c]
        return pd.DataFrame(out, columns=["node", "label"], dtype=object)

    while not left.isEmpty():
        labels = connected_components(left, "i", "j").select(F.col("node").alias("i"), F.col("label").alias("component"))
        placed = stored(left.join(labels, "i"), "linkage-components")
        big = stored(placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > task_edges).select("component"), "linkage-big")
        small = placed.join(F.broadcast(big) if big.isEmpty() else big, "component", "left_anti")
        kind = left.schema["i"].dataType.simpleString()
        done = small.groupBy("component").applyInPandas(run, f"node {kind}, label {kind}")
        nodes = stored(relabel(nodes, "cluster_id", done), "linkage-nodes")
        if big.isEmpty():
            break
        left, mergers = _merge_round(placed.join(big, "component", "left_semi").drop("component"), names)
        nodes = stored(relabel(nodes, "cluster_id", mergers), "linkage-nodes")
    return nodes


def reached_singles(onward: DataFrame, front: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """reached: the singles of front (reached), and all that links lead to from there, always to a larger one.

    onward: stored links (id_1 > id_2) between singles. Where few links hang together, one task passes over them
    in order. Elsewhere shortcuts come first: from each single to its smallest linked one below, and by
    doubling to the 2nd, 4th, 8th and so on along that way; then the front moves over links and shortcuts, until
    nothing is new. Shortcuts lead only where links do, so they change the number of rounds alone.
    """
    labels = connected_components(onward, "id_1", "id_2").select(F.col("node").alias("id_1"), F.col("label").alias("component"))
    placed = stored(onward.join(labels, "id_1"), "onward-components")
    big = stored(placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > task_edges).select("component"), "onward-big")
    kind = onward.schema["id_1"].dataType.simpleString()
    seed = front.select(F.col("reached").alias("id_2"), F.lit(True).alias("seed"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        reached = set(group.loc[group["seed"], "id_2"])
        for one, two in sorted(group[["id_1", "id_2"]].itertuples(index=False, name=None)):
            if two in reached:
                reached.add(one)
        return pd.DataFrame({"reached": list(reached)}, dtype=object)

    seeded = placed.join(big, "component", "left_anti").join(seed, "id_2", "left").withColumn("seed", F.coalesce("seed", F.lit(False)))
    found = [front, seeded.groupBy("component").applyInPandas(run, f"reached {kind}")]
    if not big.isEmpty():
        links = placed.join(big, "component", "left_semi").select("id_1", "id_2")
        jump = stored(links.groupBy("id_1").agg(F.min("id_2").alias("id_2")), "jump")
        ways = [links]
        while True:
            further = jump.select(F.col("id_1").alias("id_2"), F.col("id_2").alias("far"))
            jump = stored(jump.join(further, "id_2").select("id_1", F.col("far").alias("id_2")), "jump")
            if jump.isEmpty():
                break
            ways.append(jump)
        ways = stored(reduce(DataFrame.unionByName, ways), "ways")
        moving = reached = stored(front.join(ways.select(F.col("id_2").alias("reached")).distinct(), "reached", "left_semi"), "reached")
        while not moving.isEmpty():
            more = ways.join(moving, ways["id_2"] == moving["reached"], "left_semi").select(F.col("id_1").alias("reached")).distinct()
            moving = stored(more.join(reached, "reached", "left_anti"), "reached")
            reached = stored(reached.unionByName(moving), "reached-all")
        found.append(reached)
    return stored(reduce(DataFrame.unionByName, found).distinct(), "reached-all")


def single_linkage_extend(members: DataFrame, strict: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """photo_id, cluster_id after extension. Singles that stay single get no row.

    members: photo_id, cluster_id (its smallest member) or null for singles; strict: links (id_1, id_2).
    Clusters joined by a link merge. Then singles are visited once, in order of their ids, and each joins, or
    joins up, the clusters it has a link to by then. So a single is reached when it links to a member of a
    cluster, or to a smaller single that is reached; and among what is reached, links make components.
    """
    known = stored(members.select("photo_id", "cluster_id"), "extend-members")
    side = lambda k: known.select(F.col("photo_id").alias(f"id_{k}"), F.col("cluster_id").alias(f"c_{k}"))
    once = strict.select("id_1", "id_2").filter("id_1 <> id_2").join(side(1), "id_1").join(side(2), "id_2")
    links = stored(once.unionByName(once.select(F.col("id_2").alias("id_1"), F.col("id_1").alias("id_2"), F.col("c_2").alias("c_1"), F.col("c_1").alias("c_2"))), "extend-links")
    onward = stored(links.filter("c_1 is null and c_2 is null and id_2 < id_1").select("id_1", "id_2").distinct(), "onward")
    front = stored(links.filter("c_1 is null and c_2 is not null").select(F.col("id_1").alias("reached")).distinct(), "reached")
    reached = reached_singles(onward, front, task_edges)
    node = lambda k: F.coalesce(f"c_{k}", f"id_{k}").alias(f"n_{k}")
    hit = lambda k: reached.select(F.col("reached").alias(f"id_{k}"), F.lit(True).alias(f"hit_{k}"))
    live = links.filter("id_1 < id_2").join(hit(1), "id_1", "left").join(hit(2), "id_2", "left").filter("(c_1 is not null or hit_1) and (c_2 is not null or hit_2)")
    labels = connected_components(live.select(node(1), node(2)), "n_1", "n_2")
    start = known.join(reached, known["photo_id"] == reached["reached"], "left").filter("cluster_id is not null or reached is not null").select("photo_id", F.coalesce("cluster_id", "photo_id").alias("cluster_id"))
    return relabel(start, "cluster_id", labels)
