import pytest
from pyspark.sql import types as T

from shelfmark.functions.text import (
    label_score,
    score_labels,
    search_text,
    searchable,
    split_by_text,
    to_documents,
)
from shelfmark.operators.profile import class_histogram, index_quality, label_histogram


@pytest.fixture(scope="module")
def products(spark):
    rows = [(1, "rug", "soft rug"), (2, "table", None), (3, "chair", ""), (4, None, None)]
    return spark.createDataFrame(
        rows, "product_id int, product_name string, product_description string"
    )


def test_only_a_missing_description_falls_back_on_the_name(products):
    got = products.select("product_id", search_text("product_description", "product_name")).collect()
    assert dict(map(tuple, got)) == {1: "soft rug", 2: "table", 3: "", 4: None}


def test_items_without_text_are_set_aside(products):
    good, aside = split_by_text(searchable(products))
    assert sorted(r.item_id for r in good.collect()) == [1, 2, 3]
    assert [r.item_id for r in aside.collect()] == [4]


def test_documents_keep_all_other_columns(products):
    row = to_documents(products, "product_description").where("metadata.product_id = 1").first()
    assert row.page_content == "soft rug"
    assert row.metadata.asDict() == {"product_id": 1, "product_name": "rug"}


def test_label_scores(spark):
    labels = spark.createDataFrame(
        [("Exact",), ("PARTIAL",), ("irrelevant",), ("maybe",), (None,)], "label string"
    )
    scored = score_labels(labels)
    assert scored.schema["label_score"].dataType == T.FloatType()
    assert [r.label_score for r in scored.collect()] == [1.0, 0.75, 0.0, None, None]
    assert score_labels(scored).columns == scored.columns
    other = labels.select(label_score("label", {"maybe": 0.5}).alias("s")).collect()
    assert [r.s for r in other] == [None, None, None, 0.5, None]


def test_histograms(spark):
    log = spark.createDataFrame(
        [("a", "rugs"), ("b", "rugs"), (None, "beds"), ("c", None), ("d", "beds"), ("e", "beds")],
        "query string, query_class string",
    )
    assert [tuple(r) for r in class_histogram(log).collect()] == [("beds", 2), ("rugs", 2), (None, 1)]
    scores = spark.createDataFrame([(1.0,), (1.0,), (None,)], "label_score float")
    assert [tuple(r) for r in label_histogram(scores).collect()] == [(1.0, 2), (None, 1)]


def test_index_quality(spark):
    schema = "item_id bigint, embedding array<float>"
    source = spark.range(3)
    good = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], schema)
    assert index_quality(good, source).first().ok
    for bad in (
        [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [1.0, 1.0])],
        [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0])],
        [(1, [1.0, 0.0]), (2, None), (3, [1.0, 1.0])],
        [(1, [1.0, 0.0]), (2, [1.0]), (3, [1.0, 1.0])],
        [(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [1.0, 1.0])],
        [(1, [1.0, 0.0]), (2, [0.0, 1.0])],
    ):
        assert not index_quality(spark.createDataFrame(bad, schema), source).first().ok
    empty = spark.createDataFrame([], schema)
    assert index_quality(empty, spark.range(0)).first().ok
