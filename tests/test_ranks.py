"""Order statistics, tiles and average ranks against plain ones, and dedup by a Bloom filter."""

import random
from decimal import Decimal

import pandas as pd
import plans
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions import bloom
from balcao.operators import cuts, quality
from balcao.operators.ordered import average_ranks
from balcao.sources.staged import staged_feed

SMALL = "/root/testdata/sf0.001"


def values(n=3000, seed=1):
    """Groups of one value, few values, one row, negative and nearly unique values."""
    rnd = random.Random(seed)
    rows = [("same", 5)] * 700 + [("one", -3)] + [("two", 1), ("two", 2)]
    rows += [("few", rnd.choice([1, 1, 1, 1, 2, 3, 50])) for _ in range(n)] + [("many", rnd.randrange(-(10**7), 10**7)) for _ in range(n)]
    return [(g, Decimal(v) / 100, f"k{i:05d}") for i, (g, v) in enumerate(rows)]


@pytest.mark.parametrize("octave", [1, 64, cuts.OCTAVE])
def test_quantiles_are_exact_whatever_the_buckets(spark, monkeypatch, octave):
    monkeypatch.setattr(cuts, "OCTAVE", octave)
    rows = values()
    df = spark.createDataFrame(rows, "g string, x decimal(12,2), k string").unionByName(
        spark.createDataFrame([("few", None, "z")], "g string, x decimal(12,2), k string")).repartition(7)
    probs = {"q1": (1, 4), "p95": (19, 20), "lo": (0, 1), "hi": (1, 1)}
    found = {r["g"]: r for r in cuts.distribution(df, ["g"], "x", probs).collect()}
    frame = pd.DataFrame(rows, columns=["g", "x", "k"]).assign(x=lambda d: d.x.astype(float))
    for g, own in frame.groupby("g"):
        r = found[g]
        assert r["n"] == len(own) and float(r["minimum"]) == own.x.min() and float(r["maximum"]) == own.x.max()
        for name, (a, b) in probs.items():
            assert float(r[name]) == pytest.approx(own.x.quantile(a / b), abs=1e-6)
        assert float(r["mean"]) == pytest.approx(own.x.mean(), abs=1e-6)
        assert (r["stddev"] is None) == (len(own) == 1) and (len(own) == 1 or r["stddev"] == pytest.approx(own.x.std()))


@pytest.mark.parametrize("n", [1, 3, 7, 153, 2000])
def test_tiles_of_several_orders_equal_ntile(spark, n):
    rnd = random.Random(n)
    rows = [(f"c{i:04d}", rnd.randrange(4), rnd.randrange(10**6)) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, few int, many int").repartition(3)
    orders = {"a": -F.col("few"), "b": F.col("many"), "c": F.col("few")}
    for k in (5, 10):
        tiles = cuts.Tiles(df, orders, "id", k)
        whole = {name: F.ntile(k).over(Window.orderBy(key, "id")) for name, key in orders.items()}
        got = df.select("id", *[tiles.of(name).alias(name) for name in orders]).orderBy("id").collect()
        assert got == df.select("id", *[c.alias(name) for name, c in whole.items()]).orderBy("id").collect()


def test_tiles_sort_only_rows_of_equal_key(spark):
    """Of two keys, one unique and one of few values, only the rows tied at a border are sorted, and no other is moved."""
    df = spark.range(40_000).select(F.col("id").cast("string").alias("id"), (F.xxhash64("id") % 10**9).alias("v"), (F.col("id") % 90).alias("few"))
    sorted_rows, real = [], cuts.number_rows
    try:
        cuts.number_rows = lambda rows, *a, **b: sorted_rows.append(rows.count()) or real(rows, *a, **b)
        cuts.Tiles(df, {"v": F.col("v")}, "id", 5)
        assert not sorted_rows
        cuts.Tiles(df.filter("id < 39999"), {"v": F.col("v"), "few": F.col("few")}, "id", 5)
    finally:
        cuts.number_rows = real
    assert 0 < sum(sorted_rows) <= 4 * 445


@pytest.mark.parametrize("partitions", ["1", "23"])
def test_average_ranks_over_range_borders(spark, partitions):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([1, 1, 1, 2]), rnd.randrange(50), rnd.randrange(10**6), 7) for i in range(4000)]
    names = ["id", "hot", "few", "many", "same"]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = average_ranks(spark.createDataFrame(rows, names), "id", names[1:]).orderBy("id").toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = pd.DataFrame(rows, columns=names)
    for c in names[1:]:
        assert (got[c].astype(float) == want[c].rank() - 2000.5).all()


def test_bloom_filter_misses_no_key(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("k"))
    bits = bloom.size_for(5000)
    words = bloom.build(keys, "k", bits).first()["words"]
    assert len(words) == bits // 64
    held = bloom.build(keys, "k", bits).scalar()
    tested = spark.range(100_000).select("id", bloom.might_hold(held, F.xxhash64("id"), bits).alias("held"))
    told = tested.groupBy((F.col("id") < 5000).alias("own"), "held").count().collect()
    counts = {(r["own"], r["held"]): r["count"] for r in told}
    assert counts[(True, True)] == 5000 and counts.get((False, True), 0) < 1000
    assert bloom.size_for(0) == bloom.LEAST_BITS and bloom.size_for(10**12) == bloom.MOST_BITS


def test_a_full_filter_only_moves_more(spark, monkeypatch):
    feed = staged_feed(spark, SMALL, True)
    want = quality.accepted(quality.tag(feed)).drop("ordinal")
    monkeypatch.setattr(bloom, "MOST_BITS", 64)
    found = quality.accepted_rows(feed).drop("ordinal")
    assert found.count() == want.count() and found.exceptAll(want).count() == 0


def test_only_repeated_ids_are_moved(spark):
    feed = staged_feed(spark, SMALL)
    with plans.fixed_plans(spark):
        before = plans.metric(quality.accepted(quality.tag(feed)), "ShuffleExchangeExec", "dataSize")
        after = plans.metric(quality.accepted_rows(feed), "ShuffleExchangeExec", "dataSize")
    assert 0 < after < before / 10


def test_one_id_repeated_a_million_times(spark):
    from test_quality import GOOD

    from balcao import vocab

    hot = spark.range(1_000_000, numPartitions=16).select(
        *[F.lit(GOOD[c] if c != "txn_id" else "HOT").alias(c) for c in vocab.STAGING_COLUMNS], F.struct("id").alias("ordinal"))
    own = spark.range(1000).select(
        *[(F.lit(GOOD[c]) if c != "txn_id" else F.concat(F.lit("T"), "id")).alias(c) for c in vocab.STAGING_COLUMNS], F.struct("id").alias("ordinal"))
    found = quality.accepted_rows(hot.unionByName(own))
    assert found.count() == 1001 and found.filter("txn_id = 'HOT'").first()["ordinal"]["id"] == 0
