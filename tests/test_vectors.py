import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.functions import vectors as V


@pytest.fixture(scope="module")
def pair(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(20, 7)), rng.normal(size=(20, 7))
    rows = [(i, x.tolist(), y.tolist()) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "id bigint, a array<float>, b array<float>")
    return df, a.astype(np.float32).astype(float), b.astype(np.float32).astype(float)


def test_values(pair):
    df, a, b = pair
    got = (
        df.select(
            V.dot(F.col("a"), F.col("b")),
            V.norm(F.col("a")),
            V.cosine(F.col("a"), F.col("b")),
            V.l2_squared(F.col("a"), F.col("b")),
        )
        .toPandas()
        .to_numpy()
    )
    dot, norm = (a * b).sum(1), np.sqrt((a * a).sum(1))
    cosine = dot / (norm * np.sqrt((b * b).sum(1)))
    want = np.stack([dot, norm, cosine, ((a - b) ** 2).sum(1)], axis=1)
    np.testing.assert_allclose(got, want, rtol=1e-12)


def test_reweight_gives_unit_vectors_with_weighted_dot(pair):
    df, a, b = pair
    w = np.arange(7) + 0.5
    row = df.select(
        V.cosine(V.reweight(F.col("a"), w), V.reweight(F.col("b"), w)), V.norm(V.reweight(F.col("a"), w))
    ).toPandas().to_numpy()
    want = (w * a * b).sum(1) / np.sqrt((w * a * a).sum(1) * (w * b * b).sum(1))
    np.testing.assert_allclose(row[:, 0], want, atol=1e-6)
    np.testing.assert_allclose(row[:, 1], 1, atol=1e-6)


def test_no_length_and_wrong_length(spark):
    df = spark.createDataFrame(
        [([0.0, 0.0], [1.0, 2.0]), ([1.0, 2.0, 3.0], [1.0, 2.0]), (None, [1.0, 2.0])],
        "a array<float>, b array<float>",
    )
    rows = df.select(
        V.cosine(F.col("a"), F.col("b")), V.l2_squared(F.col("a"), F.col("b")), V.unit(F.col("a"))
    ).collect()
    assert [r[0] for r in rows] == [None, None, None]
    assert [r[1] for r in rows] == [5.0, None, None]
    assert rows[0][2] == [0.0, 0.0]


def test_opposite_vectors_are_not_clamped(spark):
    df = spark.createDataFrame([([1.0, 0.0], [-2.0, 0.0])], "a array<float>, b array<float>")
    assert df.select(V.cosine(F.col("a"), F.col("b"))).first()[0] == -1.0


def test_length_is_worked_out_once_for_a_vector(spark):
    """Not once for each number of it, which grows with the square of the dimension."""
    dim = 2000
    made = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda i: (i + F.col("id")).cast("float"))
    df = spark.range(0, 300, 1, 1).select(made.alias("a"))
    began = time.monotonic()
    for moved in (V.unit(F.col("a")), V.reweight(F.col("a"), [1.0] * dim)):
        assert df.where(F.abs(V.norm(moved) - 1) < 1e-3).count() == 300
    assert time.monotonic() - began < 20
