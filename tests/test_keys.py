import random

import numpy as np
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from contestry.operators.components import component_labels, local_roots
from contestry.operators.keys import dimension, numbered


def test_numbering_equals_the_global_window(spark, partitions):
    rng = random.Random(partitions)
    data = [(rng.choice([None, 1, 2, 3]), rng.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int, c int").repartition(7)
    out = numbered(df, "n", ["a", "b", "c"], unique=True)
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("a", "b", "c")).cast("long"))
    assert rows(out) == rows(expected)


def test_numbering_without_a_key_is_dense_and_ordered(spark):
    """Four of ten rows are copies of one row."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 4, -1).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b")
    )
    out = numbered(df.repartition(5), "n", ["a"]).collect()
    assert sorted(r["n"] for r in out) == list(range(1, 5001))
    assert [r["a"] for r in sorted(out, key=lambda r: r["n"])] == sorted(r["a"] for r in out)


def test_copies_spread_over_partitions(spark):
    df = spark.range(20000).select(F.lit(1).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        out = numbered(df.repartition(4), "n", ["a"])
        data = [f for f in out.inputFiles() if "-offsets-" not in f]
        files = spark.read.parquet(*data).groupBy("_metadata.file_path").count()
        sizes = [r["count"] for r in files.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert sum(sizes) == 20000 and max(sizes) < 20000 / 3


def test_numbering_of_nothing(spark):
    assert numbered(spark.range(0), "n", ["id"], unique=True).collect() == []
    assert numbered(spark.range(0), "n", ["id"]).collect() == []


def test_dimension_equals_the_plain_window(spark, partitions):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)] + [(f"t{i % 300}",) for i in range(900)], "name string")
    expected = df.distinct().withColumn("id", F.row_number().over(Window.orderBy("name")).cast("long"))
    assert rows(dimension(df, "id")) == rows(expected)


def test_tied_rows_get_the_same_numbers_again(spark, partitions):
    """Rows that agree in the order but not in the rest, read in different orders."""
    data = [(1, i % 7, None if i % 5 == 0 else f"x{i % 3}", float(i % 4)) for i in range(400)]
    df = spark.createDataFrame(data, "a int, b int, c string, d double")
    first = rows(numbered(df.repartition(7), "n", ["a"]))
    assert first == rows(numbered(df.orderBy(F.desc("b")).repartition(3), "n", ["a"]))
    spark.conf.set("spark.sql.shuffle.partitions", 9 - partitions)
    assert first == rows(numbered(df.coalesce(1), "n", ["a"]))


def union_find(edges):
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = {}
    for n in parent:
        groups.setdefault(root(n), set()).add(n)
    return sorted(sorted(g) for g in groups.values())


def check_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    groups = {}
    for node, component in component_labels(df, "a", "b").collect():
        groups.setdefault(component, set()).add(node)
    assert sorted(sorted(g) for g in groups.values()) == union_find(edges)


def test_components_of_random_graphs(spark, partitions):
    for seed in range(2):
        rng = random.Random(seed)
        check_components(spark, [(rng.randrange(300), rng.randrange(300)) for _ in range(170)])


def test_components_of_a_shuffled_path(spark):
    ids = list(range(200))
    random.Random(5).shuffle(ids)
    check_components(spark, list(zip(ids, ids[1:])))


def test_components_of_a_hub_and_of_loops(spark):
    check_components(spark, [(500, i) for i in range(1, 400)] + [(1000, 1000), (1001, 1002)])


def test_a_hub_is_not_gathered_in_one_task(spark):
    """A star of 20,000 nodes: the joins on its root are split over many tasks."""
    conf = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(1, 20_000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
        extra = spark.createDataFrame([(5, 30_000), (30_000, 30_001)], "a long, b long")
        labels = component_labels(edges.union(extra), "a", "b")
        assert labels.filter("component = 0").count() == labels.count() == 20_002
        # every round but the last points at one root: see how its table was written
        parts = spark.read.parquet(*labels.inputFiles()).groupBy("_metadata.file_path").count()
        assert max(r["count"] for r in parts.collect()) < 20_002 / 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_local_roots_equal_a_plain_walk():
    rng = np.random.default_rng(4)
    for n, edges in ((1, 0), (9, 5), (200, 90), (200, 300)):
        a, b = rng.integers(0, n, edges), rng.integers(0, n, edges)
        expected = list(range(n))
        for _ in range(n):  # the smallest name spreads along the edges
            for x, y in zip(a.tolist(), b.tolist()):
                expected[x] = expected[y] = min(expected[x], expected[y])
        assert local_roots(n, a, b).tolist() == expected
    path = np.arange(999)
    assert not local_roots(1000, path, path + 1).any() and not local_roots(1000, path[::-1] + 1, path[::-1]).any()
