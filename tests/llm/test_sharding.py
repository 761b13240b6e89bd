import random
from collections import Counter

from pyspark.sql import functions as F

from corpusflow.llm.sharding import kd_shards


def _place(df, shards):
    return kd_shards(df, F.col("size"), [F.col("size"), F.col("kind"), F.col("id")], [F.col("id")], shards)


def test_bytes_are_near_equal_though_a_value_holds_a_third_of_all_rows(spark):
    rng = random.Random(5)
    rows = [(i, 500 if i % 3 == 0 else rng.randint(1, 2000), None if i % 7 == 0 else i % 4, "x") for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, size long, kind int, slot string")
    got = _place(df, 24).collect()
    assert sorted(r["id"] for r in got) == list(range(6000))
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert sorted(by) == list(range(24))
    sizes = [sum(r["size"] for r in rows) for rows in by.values()]
    assert max(sizes) - min(sizes) <= 3 * 2000
    assert all(sorted(r["slot"] for r in rows) == list(range(len(rows))) for rows in by.values())


def test_cells_are_boxes(spark):
    df = spark.range(1000).select("id", F.lit(10).alias("size"), F.lit(1).alias("kind"))
    got = _place(df, 4).groupBy("shard").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n")).orderBy("a").collect()
    assert [r["n"] for r in got] == [250] * 4
    assert all(x["b"] < y["a"] for x, y in zip(got, got[1:]))


def test_few_equal_null_and_no_rows(spark):
    schema = "id long, size long, kind int"
    few = _place(spark.createDataFrame([(1, 5, None), (2, 5, 1)], schema), 8).collect()
    assert len(few) == 2 and all(0 <= r["shard"] < 8 for r in few)
    equal = _place(spark.createDataFrame([(None, 5, None)] * 10, schema), 3).collect()
    sizes = Counter(r["shard"] for r in equal)
    assert sum(sizes.values()) == 10 and sorted(sizes.values()) in ([3, 3, 4], [2, 4, 4])
    assert all({r["slot"] for r in equal if r["shard"] == s} == set(range(n)) for s, n in sizes.items())
    assert _place(spark.createDataFrame([], schema), 3).count() == 0


def test_rows_equal_in_everything_are_dealt_out(spark):
    rows = [(i, 50, 1) for i in range(1000)] + [(5000, 50, 1)] * 1000
    sizes = Counter(r["shard"] for r in _place(spark.createDataFrame(rows, "id long, size long, kind int").repartition(3), 8).collect())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 4


def test_columns_pass_whatever_their_names(spark):
    names = ["_weight", "_raw", "_tie", "_at", "_cell", "_run", "_salt", "_row", "shard", "a.b"]
    df = spark.range(20).select("id", F.lit(3).alias("size"), F.lit(1).alias("kind"), *[F.lit(n).alias(n) for n in names])
    got = _place(df, 4)
    assert got.columns == ["id", "size", "kind", *[n for n in names if n != "shard"], "shard", "slot"]
    assert all(r[n] == n for r in got.collect() for n in names if n != "shard")


def plain_tree(rows, shards, first=0):
    """The same tree by sorting: rows are (place in each dimension scaled to 0..1, size, id)."""
    if shards == 1 or not rows:
        return {r[2]: first for r in rows}
    dims = range(len(rows[0][0]))
    widths = [max(r[0][d] for r in rows) - min(r[0][d] for r in rows) for d in dims]
    dim = max(dims, key=lambda d: (widths[d], -d))
    rows = sorted(rows, key=lambda r: r[0][dim])
    half, total, run, cut = shards // 2, sum(r[1] for r in rows), 0, 0
    goal = total * half / shards
    while run < goal:
        run += rows[cut][1]
        cut += 1
    if goal - (run - rows[cut - 1][1]) < run - goal:
        cut -= 1
    return plain_tree(rows[:cut], half, first) | plain_tree(rows[cut:], shards - half, first + half)


def test_shards_against_a_plain_tree(spark):
    rng = random.Random(8)
    # Whole values far apart, so that neither ties nor the room of one value matter.
    points = [(i, rng.randint(1, 900), a, b) for i, (a, b) in enumerate(zip(rng.sample(range(10**9), 700), rng.sample(range(10**6), 700)))]
    df = spark.createDataFrame(points, "id long, size long, a long, b long").repartition(3)
    got = {r["id"]: r["shard"] for r in kd_shards(df, F.col("size"), [F.col("a"), F.col("b")], [F.col("id")], 11).collect()}
    spread = [(min(p[d] for p in points), max(p[d] for p in points)) for d in (2, 3)]
    scaled = [(tuple((p[2 + d] - low) / (high - low + 1) for d, (low, high) in enumerate(spread)), p[1], p[0]) for p in points]
    assert got == plain_tree(scaled, 11)


def test_no_python_on_the_path(spark):
    plan = _place(spark.range(50).select("id", F.lit(1).alias("size"), F.lit(1).alias("kind")), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
