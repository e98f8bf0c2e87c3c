"""Pages and neighbours by ranges of the order."""

import random
import re

import pytest

from twinfold.operators.catalog import neighbours
from twinfold.operators.ranges import RangedTable, neighbours_in_order


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), k, "x") for k in range(3000)]
    rng.shuffle(rows)
    kept = RangedTable.of(spark.createDataFrame(rows, "g long, id long, n string").repartition(5), "g", "id", range_rows=200)
    return kept, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("size", [1, 28, 700, 5000])
def test_pages_are_slices_of_the_order(table, size):
    kept, rows = table
    last = -(-len(rows) // size)
    for number in {-1, 1, 2, last // 2, last, last + 1}:
        at = (max(1, number) - 1) * size
        assert [tuple(r) for r in kept.page(number, size).collect()] == rows[at : at + size], number


def test_a_page_reads_its_ranges_alone(table):
    kept, rows = table
    sizes = [r["n"] for r in kept.ranges.collect()]
    assert len(sizes) > 8 and sum(sizes) == len(rows)
    assert kept.between(1500, 1509).count() <= 2 * max(sizes) < len(rows) / 3
    plan = kept.page(150, 10)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(__range#\d+ = \d+\)", plan)  # whole ranges, by folder


def test_empty_tables_and_one_range(spark):
    none = spark.createDataFrame([], "g long, id long")
    assert RangedTable.of(none, "g").page(1, 5).count() == 0 and neighbours_in_order(none, "g").count() == 0
    same = spark.createDataFrame([(7, 1)] * 30, "g long, id long")
    assert RangedTable.of(same, "g", range_rows=4).page(2, 20).count() == 10


@pytest.mark.parametrize("values", [[], [5], [None], [None, 4], [None, *range(0, 600, 3), 5, 5]])
def test_neighbours_over_many_ranges(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "group_id long")
    order = sorted(set(values), key=lambda v: (v is not None, v or 0))
    want = {(v, order[k - 1] if k else None, order[k + 1] if k + 1 < len(order) else None) for k, v in enumerate(order)}
    assert {tuple(r) for r in neighbours_in_order(rows, "group_id", range_rows=20).collect()} == want
    assert {tuple(r) for r in neighbours(rows).collect()} == want
