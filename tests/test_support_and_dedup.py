"""Support at the boundary, duplicates with ids, components that do not settle."""

import pytest

from tessera.operators import cluster as K
from tessera.operators import rules as A
from tessera.plans.job import distinct_rows


def test_itemset_at_exactly_min_support_is_kept(spark):
    rows = [(i, ["a", "b"] if i < 7 else ["c"]) for i in range(100)]
    tx = spark.createDataFrame(rows, "tid int, items array<string>")
    assert 0.07 * 100 > 7
    for miner in (A.frequent_itemsets, A.fpgrowth_itemsets):
        got = {tuple(r["items"]): r["support"] for r in miner(tx, "items", 0.07).collect()}
        assert got == {("a",): 0.07, ("b",): 0.07, ("a", "b"): 0.07, ("c",): 0.93}


@pytest.mark.parametrize("support,n,count", [(0.07, 100, 7), (0.1, 10, 1), (0.5, 3, 2), (0.0, 5, 0), (1.0, 8, 8)])
def test_least_count(support, n, count):
    assert A.least_count(support, n) == count


def test_distinct_rows_ignore_the_id(spark):
    df = spark.createDataFrame([(3, 1, None), (1, 1, None), (2, 2, "x"), (9, 2, "x"), (4, 2, None)], "id int, v int, c string")
    assert sorted(map(tuple, distinct_rows(df, "id").collect()), key=str) == [(1, 1, None), (2, 2, "x"), (4, 2, None)]


def test_components_that_do_not_settle_raise(spark):
    n = 60
    v = spark.createDataFrame([(i,) for i in range(n)], "vid long")
    e = spark.createDataFrame([(i, i + 1) for i in range(n - 1)] + [(i + 1, i) for i in range(n - 1)], "id_a long, id_b long")
    with pytest.raises(RuntimeError):
        K.connected_components(v, e, max_rounds=1)
