import numpy as np
import pytest
from conftest import frame
from pyspark.sql import functions as F

from shelfmark.functions.encoders import HashedEncoder
from shelfmark.operators import pairs
from shelfmark.operators.skew import counted_bytes, find_hot_keys, join_counted, skew_join


@pytest.fixture(scope="module")
def catalog(spark):
    items = spark.createDataFrame(
        [(1, "rug", "soft rug"), (2, "table", "dining table")],
        "item_id bigint, item_name string, item_text string",
    )
    queries = spark.createDataFrame([(10, "kid rug"), (11, "table")], "query_id bigint, query string")
    labels = spark.createDataFrame(
        [(10, 1, 1.0), (10, 1, 1.0), (11, 2, None), (11, 9, 1.0), (99, 1, 1.0), (None, 1, 0.0)],
        "query_id bigint, product_id bigint, label_score float",
    )
    return items, labels, queries


def test_one_row_per_label_of_a_known_item_and_query(catalog):
    got = sorted(map(tuple, pairs.judged_pairs(*catalog).collect()), key=repr)
    assert got == [
        (10, 1, "kid rug", "soft rug", 1.0),
        (10, 1, "kid rug", "soft rug", 1.0),
        (11, 2, "table", "dining table", None),
    ]


def test_incomplete_pairs_are_counted(catalog):
    judged = pairs.judged_pairs(*catalog)
    assert tuple(pairs.incomplete_count(judged, "score").first()) == (3, 1)
    assert pairs.complete_pairs(judged, "score").count() == 2


def test_hot_keys_are_found_and_split(spark):
    many = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("key"),
        F.lit("same").alias("note"),
    ).unionAll(spark.range(50).select(F.lit(None).cast("bigint"), F.lit("same")))
    few = spark.range(9000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    few = few.unionAll(few.where("key = 7"))
    hot = find_hot_keys(many, "key", min_rows=100)
    assert [key for key, _ in hot] == [7] and hot[0][1] == 3  # of 8 partitions
    assert find_hot_keys(many, "key") == []
    plain = many.join(few, "key").groupBy("key", "note", "twice").count()
    split = skew_join(many, few, "key", hot=hot)
    assert split.columns == many.join(few, "key").columns
    assert sorted(map(tuple, split.groupBy("key", "note", "twice").count().collect())) == sorted(
        map(tuple, plain.collect())
    )


def test_rows_of_a_hot_key_are_dealt_over_its_parts(spark):
    same = spark.range(0, 4000, 1, 8).select(F.lit(7).cast("bigint").alias("key"))
    few = spark.createDataFrame([(7, "x")], "key bigint, name string")
    joined = skew_join(same, few, "key", hot=[(7, 4)])
    assert joined.count() == 4000
    plan = skew_join(same, few, "key", hot=[(7, 4)], shuffled=True)._jdf.queryExecution()
    assert plan.executedPlan().toString().count("SortMergeJoin") == 1
    assert "_part" in plan.toString()


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_vectors_meet_by_key(spark, broadcast_bytes):
    rng = np.random.default_rng(0)
    q, p = rng.normal(size=(3, 4)), rng.normal(size=(5, 4))
    judged = spark.createDataFrame(
        [(i % 3, i % 5, float(i)) for i in range(30)], "query_id bigint, item_id bigint, score double"
    )
    linked = pairs.join_vectors(
        judged, frame(spark, "query_id", range(3), q), frame(spark, "item_id", range(5), p), 4,
        broadcast_bytes=broadcast_bytes,
    )
    assert ("Broadcast" in linked._jdf.queryExecution().toString()) == (broadcast_bytes > 0)
    weights = [0.0, 1.0, 2.0, 3.0]
    rows = pairs.pair_cosine(linked, {"plain": None, "weighted": weights}).collect()
    assert len(rows) == 60
    for r in rows:
        w = np.array(weights if r.model == "weighted" else [1.0] * 4)
        a, b = q[r.query_id], p[r.item_id]
        want = (w * a * b).sum() / np.sqrt((w * a * a).sum() * (w * b * b).sum())
        assert abs(r.cosine - want) < 1e-6


def test_cosine_of_missing_and_zero_vectors_is_null(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], [-1.0, 0.0]), (2, None, [1.0, 0.0]), (3, [0.0, 0.0], [1.0, 0.0])],
        "id bigint, query_vec array<float>, item_vec array<float>",
    )
    assert {r.id: r.cosine for r in pairs.pair_cosine(df).collect()} == {1: -1.0, 2: None, 3: None}


def test_text_pairs_are_encoded(catalog):
    items, labels, queries = catalog
    judged = pairs.judged_pairs(items, labels, queries).select("query_id", "item_id", "score")
    scored = pairs.pair_cosine(pairs.encode_pairs(judged, queries, items, HashedEncoder(64)))
    assert scored.count() == 3
    assert all(r.cosine > 0 for r in scored.collect())


def test_a_query_is_held_out_as_a_whole(spark):
    df = spark.range(4000).select((F.col("id") % 400).alias("query_id"), pairs.is_held_out().alias("out"))
    assert df.groupBy("query_id").agg(F.count_distinct("out").alias("n")).where("n > 1").count() == 0
    share = df.where("out").count() / 4000
    assert 0.1 < share < 0.3


def test_sizes_are_counted(spark):
    df = spark.createDataFrame([(1, "four"), (2, None), (3, "ü")], "id bigint, name string")
    assert counted_bytes(df) == 3 * 64 + 6
    assert counted_bytes(df, budget=10) == 3 * 64  # strings not read
    assert counted_bytes(df.where("false")) == 0


@pytest.mark.parametrize("budget", [0, 1 << 20])
def test_counted_join(spark, budget):
    many = spark.range(100).select((F.col("id") % 7).alias("key"), "id")
    few = spark.range(5).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    joined = join_counted(many, few, "key", counted_bytes(few), budget=budget)
    assert ("Broadcast" in joined._jdf.queryExecution().toString()) == (budget > 0)
    assert joined.count() == many.where("key < 5").count()
