"""Every registered query over the smallest tables, against its SQL where it has one."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__
from twinfold.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if sql := registry.oracle_sql().get(name):
        found = duck.sql(sql)
        order = sorted(range(len(found.columns)), key=lambda k: found.columns[k])
        assert sorted(df.columns) == sorted(found.columns)
        assert got == sorted(tuple(plain(r[k]) for k in order) for r in found.fetchall())


def test_unique_in_order_takes_whole_texts(spark, duck):
    texts = [t for (t,) in duck.sql("SELECT DISTINCT coalesce(text, '') FROM documents").fetchall()]
    assert max(map(len, texts)) > 60
    want = sorted((hashlib.sha256(t.encode()).hexdigest(), " ".join(dict.fromkeys(t.split(" ")))) for t in texts)
    assert sorted((r["id"], r["words"]) for r in registry.queries()["x21_unique_in_order"](spark, SF).collect()) == want


def test_shortest_path_lists_no_paths(spark):
    plan = registry.queries()["x19_shortest_path"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" in plan and "collect_list" not in plan


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() >= 0


def test_second_groups_make_no_row_of_a_far_pair(spark, monkeypatch):
    from twinfold.operators import similarity

    def fail(*args):
        raise AssertionError("all pairs as rows")

    monkeypatch.setattr(similarity, "all_pairs", fail)
    monkeypatch.setattr(similarity, "block_join", fail)
    assert registry.queries()["g3_complete_linkage_cells"](spark, SF).count() >= 0


def test_violations_are_counted_without_pairs_of_a_cluster(spark, monkeypatch):
    """Three photos in one cluster with two links, and two clusters that could merge: counted, and no cluster meets itself."""
    from types import SimpleNamespace

    from twinfold.plans import graph_queries as Q

    near = spark.createDataFrame([("a", "b", 1, 1), ("b", "c", 1, 1), ("c", "d", 2, 2), ("e", "f", 1, 1)], "id_1 string, id_2 string, phash_dist int, dhash_dist int")
    clusters = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e"), ("f", "f")], "photo_id string, cluster_id string")
    monkeypatch.setattr(Q, "_near", lambda c: near)
    monkeypatch.setattr(Q.K, "complete_linkage", lambda pairs: clusters)
    found = Q._violations(SimpleNamespace())
    assert [tuple(r) for r in found.collect()] == [(6, 1, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan


def test_pair_lookup_finds_pairs_once(spark, monkeypatch):
    from twinfold.plans import graph_queries as Q

    calls, real = [], Q.S.similar_pairs
    monkeypatch.setattr(Q.S, "similar_pairs", lambda h: calls.append(1) or real(h))
    assert registry.queries()["j12_pair_lookup"](spark, SF).count() > 0 and len(calls) == 1


@pytest.mark.parametrize("name", ["g2_complete_linkage", "g2_violations", "g3_complete_linkage_cells", "g4_single_linkage_extend", "g5_primary_groups", "g9_second_groups", "g10_composite_groups"])
def test_linkage_goes_by_numbers(spark, monkeypatch, name):
    """Edges hold numbers, not digests, and the result has the ids again."""
    from twinfold.operators import cluster, grouping
    from twinfold.plans import graph_queries as Q

    kinds, real = set(), cluster.complete_linkage

    def linkage(edges, *args, **named):
        kinds.update(kind for c, kind in edges.dtypes if c.startswith(("id_", "photo_id")))
        return real(edges, *args, **named)

    monkeypatch.setattr(Q.K, "complete_linkage", linkage)
    monkeypatch.setattr(grouping, "complete_linkage", linkage)
    found = registry.queries()[name](spark, SF)
    assert kinds == {"bigint"}
    assert name == "g2_violations" or {len(r["photo_id"]) for r in found.select("photo_id").collect()} <= {64}


def test_numbers_follow_the_order_of_keys(spark):
    from twinfold.operators.ordering import by_number, named

    keys = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(300)]
    rows, names = by_number(spark.createDataFrame(list(zip(keys, range(300))), "id string, n int").repartition(5), "id")
    assert rows.dtypes == [("id", "bigint"), ("n", "int")]
    assert sorted((r["id"], r["n"]) for r in rows.collect()) == [(k, n) for k, (_, n) in enumerate(sorted(zip(keys, range(300))))]
    back = named(rows.withColumn("again", rows["id"]), names, "id", "again")
    assert back.columns == ["id", "n", "again"] and sorted(map(tuple, back.collect())) == sorted((k, n, k) for n, k in enumerate(keys))


def test_natural_gap_counts_pairs_once(spark):
    plan = registry.queries()["a21_natural_gap"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
