import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from termloom.operators import scale


@pytest.fixture
def skewed(spark):
    """A third of all rows share one key."""
    pick = random.Random(3)
    data = [
        (i, "hot" if pick.random() < 0.34 else f"k{pick.randint(0, 40)}") for i in range(3000)
    ]
    pick.shuffle(data)
    return data, spark.createDataFrame(data, "row_id long, key string").repartition(7)


@pytest.mark.parametrize("width", [1, 50, 65_536])
def test_ordinals_equal_a_count_in_row_order(skewed, width):
    data, df = skewed
    seen, expected = {}, []
    for row_id, key in sorted(data):
        expected.append((key, seen.get(key, 0), row_id))
        seen[key] = seen.get(key, 0) + 1
    found = scale.ordinals(df, ["key"], rows=width).select("key", "ordinal", "row_id")
    assert rows(found) == sorted(expected, key=str)


def test_pieces_never_decrease_over_all_longs(spark):
    ids = [-(2**63), -(2**62), -1, 0, 1, 2**53 + 1, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "row_id long")
    for size in (1, 3, 100):
        placed = scale.with_pieces(df, "row_id", size).orderBy("row_id")
        found = [r["_piece"] for r in placed.collect()]
        assert found == sorted(found)
        assert len(set(found)) <= -(-len(ids) // size)
    assert scale.with_pieces(df.limit(0), "row_id", 1).count() == 0


@pytest.mark.parametrize("far", [[], [2**62], [-(2**62), 2**62], [10**9 + i for i in range(3000)]])
def test_far_ids_leave_pieces_even(spark, far):
    ids = [*range(5000), *far]
    df = spark.createDataFrame([(i,) for i in ids], "row_id long").repartition(4)
    sizes = [r["count"] for r in scale.with_pieces(df, "row_id", 100).groupBy("_piece").count().collect()]
    assert max(sizes) <= 2 * len(ids) / len(sizes)
    assert len(sizes) > 0.8 * len(ids) / 100


def test_records_are_numbered_by_file_and_place(spark, folder):
    from termloom.sources import readers, writers

    data = [(i, f"line {i}\nsecond, \"quoted\"") for i in range(57)]
    df = spark.createDataFrame(data, "k long, text string").repartitionByRange(4, "k")
    writers.write_csv(df.sortWithinPartitions("k"), folder)
    found = scale.number_records(readers.read_csv(spark, folder))
    assert rows(found.select("row_id", F.col("k").cast("long"))) == sorted(((i, i) for i, _ in data), key=str)
    assert found.columns == ["row_id", "k", "text"]
    assert "_metadata" not in found.columns


@pytest.mark.parametrize("wanted", [1, 7, 500, 10_000])
def test_cutoffs_equal_sorting(skewed, wanted):
    data, df = skewed
    groups = {}
    for row_id, key in data:
        groups.setdefault(key, []).append(row_id)
    expected = {k: sorted(v)[min(wanted, len(v)) - 1] for k, v in groups.items()}
    bucket = F.floor(F.col("row_id") / 10)
    found = scale.cutoffs(df, ["key"], "row_id", bucket, lambda _: F.lit(wanted))
    assert {r["key"]: r["cutoff"] for r in found.collect()} == expected


def test_cutoffs_give_no_row_where_nothing_is_wanted(skewed):
    _, df = skewed
    found = scale.cutoffs(df, ["key"], "row_id", F.col("row_id"), lambda _: F.lit(0))
    assert found.count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_broadcast_join(spark, skewed, how):
    _, df = skewed
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("other", 3)], "key string, v int")
    small = scale.lookup_join(df, lookup, ["key"], 3, "row_id", how)
    unknown = scale.lookup_join(df, lookup, ["key"], None, "row_id", how)
    large = scale.lookup_join(df, lookup, ["key"], scale.BROADCAST_ROWS + 1, "row_id", how)
    columns = ["row_id", "key", "v"]
    assert rows(small.select(columns)) == rows(unknown.select(columns)) == rows(
        large.select(columns)
    )


def test_salted_join_spreads_a_hot_key(spark, skewed):
    _, df = skewed
    lookup = spark.createDataFrame([("hot", 1)], "key string, v int")
    plan = scale.lookup_join(df, lookup, ["key"], None, "row_id")._jdf.queryExecution()
    assert "_salt" in plan.toString()


@pytest.mark.parametrize("parts", [1, 5])
def test_number_rows_follows_partition_order(spark, parts):
    df = spark.range(0, 1000, 1, parts).select((F.col("id") * 3).alias("v"))
    found = scale.number_rows(df).orderBy("row_id").collect()
    assert [(r["row_id"], r["v"]) for r in found] == [(i, 3 * i) for i in range(1000)]


def test_number_files_follows_paths_without_a_copy(spark, folder):
    spark.range(0, 500, 1, 4).write.parquet(folder)
    found = scale.number_files(spark, folder).orderBy("row_id").collect()
    assert [(r["row_id"], r["id"]) for r in found] == [(i, i) for i in range(500)]


def test_digest_keeps_fields_apart(spark):
    df = spark.createDataFrame(
        [("a", "b:c"), ("a:b", "c"), ("ab", ""), ("", "ab"), ("a", "b:c")], "x string, y string"
    )
    keys = [bytes(r[0]) for r in df.select(scale.digest(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 4 and keys[0] == keys[4]


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert scale.spread(wide) is wide
    assert scale.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == 8


def test_shared_folder_is_the_configured_one(spark):
    assert scale.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
