import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.functions.encoders import HashedEncoder
from shelfmark.operators import evaluate, metric, training
from shelfmark.operators.pairs import pair_cosine
from shelfmark.plans import tuning
from shelfmark.sources import index


def scored(spark, rows):
    return spark.createDataFrame(rows, "cosine double, score double")


def test_agreement_uses_complete_pairs(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=50), rng.normal(size=50)
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(0.5, None), (None, 1.0)]
    got = evaluate.agreement(scored(spark, rows)).first()
    assert got.pairs == 50
    assert got.mean_cosine == pytest.approx(x.mean())
    assert got.correlation == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_a_constant_side_has_no_correlation(spark):
    got = evaluate.agreement(scored(spark, [(0.1, 1.0), (0.1, 0.0), (0.1, 0.75)])).first()
    assert got.correlation is None and got.mean_cosine == pytest.approx(0.1)
    empty = evaluate.agreement(scored(spark, [])).first()
    assert (empty.pairs, empty.mean_cosine, empty.correlation) == (0, None, None)


@pytest.fixture(scope="module")
def planted(spark):
    """Pairs whose score follows the first 8 of 32 dimensions only."""
    rng = np.random.default_rng(7)
    q, p = rng.normal(size=(3000, 32)), rng.normal(size=(3000, 32))
    near = (q[:, :8] * p[:, :8]).sum(1)
    score = (near > 0).astype(float)
    rows = [
        (i % 300, i, q[i].tolist(), p[i].tolist(), float(score[i])) for i in range(3000)
    ] + [(1, 3000, [1.0] * 32, [1.0] * 32, None)]
    return spark.createDataFrame(
        rows,
        "query_id bigint, item_id bigint, query_vec array<float>, item_vec array<float>, score double",
    ).repartition(5).cache()


def test_gram_sums(planted):
    rows = planted.dropna().toPandas()
    q, p = (np.stack(rows[c]).astype(float) for c in ("query_vec", "item_vec"))
    z = np.concatenate([q * p, rows.score.to_numpy()[:, None]], axis=1)
    got = {(r.i, r.j): r.value for r in metric.gram_sums(planted).collect()}
    assert len(got) == 33 * 34 // 2
    for (i, j), value in got.items():
        assert value == pytest.approx((z[:, i] * z[:, j]).sum(), abs=1e-6)


def test_nonnegative_solution_meets_its_conditions():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 10))
    y = x @ np.array([1, -1, 2, 0, 0, -3, 1, 0, 1, 0.5])
    gram, target = x.T @ x, x.T @ y
    w = metric._nonnegative_solution(gram, target, 0.0, 2000)
    with pytest.raises(RuntimeError, match="did not converge"):
        metric._nonnegative_solution(gram, target, 0.0, 1)
    slope = gram @ w - target
    assert (w >= 0).all() and (slope > -1e-5).all() and np.abs(slope * w).max() < 1e-4


def test_planted_signal_is_found(spark, planted, tmp_path):
    tuned = tuning.tune(planted)
    assert tuned.improved
    weights = np.array(tuned.weights)
    assert weights[:8].mean() > 10 * weights[8:].mean()
    rows = {(r.model, r.held_out): r for r in tuned.comparison.collect()}
    assert len(rows) == 4
    assert rows["tuned", True].correlation > rows["original", True].correlation + 0.1
    line = evaluate.side_by_side(
        tuned.comparison.where("held_out"), tuning.BEFORE, tuning.AFTER
    ).first()
    assert line.correlation_after == rows["tuned", True].correlation
    assert line.mean_cosine_before == rows["original", True].mean_cosine

    # The space is written as a new version and agrees with its query encoder.
    encoder = HashedEncoder(32)
    path = str(tmp_path / "index")
    items = spark.createDataFrame(
        [(1, "a", "kid proof rug"), (2, "b", "table")], "item_id bigint, item_name string, item_text string"
    )
    index.write_index(items, path, encoder)
    version, tuned_encoder = tuning.reindex(index.read_index(spark, path, encoder), encoder, tuned, path)
    opened = index.read_index(spark, path, tuned_encoder)
    assert (version, opened.version) == (2, 2)
    rows = {r.item_text: r.embedding for r in opened.with_texts().collect()}
    for text, vector in rows.items():
        np.testing.assert_allclose(vector, tuned_encoder.open()([text])[0], atol=1e-6)
    assert index.read_index(spark, path, encoder, version=1).rows == 2


def test_no_signal_keeps_the_old_index(spark):
    rng = np.random.default_rng(9)
    rows = [
        (i % 50, rng.normal(size=4).tolist(), rng.normal(size=4).tolist(), 0.0) for i in range(300)
    ]
    pairs = spark.createDataFrame(
        rows, "query_id bigint, query_vec array<float>, item_vec array<float>, score double"
    )
    tuned = tuning.tune(pairs)
    assert not tuned.improved and not any(tuned.weights)
    with pytest.raises(ValueError, match="index kept"):
        tuning.reindex(None, HashedEncoder(4), tuned, "unused")
    with pytest.raises(ValueError, match="no complete pair"):
        metric.fit_weights(pairs.withColumn("score", F.lit(None).cast("double")))


def test_models_are_compared_in_one_scan(planted):
    compared = evaluate.compare_models(planted, {"original": None, "equal": [2.0] * 32})
    a, b = sorted(compared.collect(), key=lambda r: r.model)
    assert a.pairs == b.pairs == 3000
    assert a.correlation == pytest.approx(b.correlation)
    again = evaluate.compare_models(planted, {"original": None, "equal": [2.0] * 32})
    assert again._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    one = evaluate.agreement(pair_cosine(planted)).first()
    assert one.mean_cosine == pytest.approx(a.mean_cosine)


def test_training_examples_leave_out_what_is_incomplete(spark):
    df = spark.createDataFrame(
        [(1, "q", "t", 1.0), (2, None, "t", 1.0), (3, "q", None, 1.0), (4, "q", "t", None)],
        "id bigint, query string, item_text string, score double",
    )
    rows = training.training_examples(df, "id").collect()
    assert [tuple(r) for r in rows] == [(1, ["q", "t"], 1.0)]


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_shuffled_batches(spark, parts):
    df = spark.range(1000).repartition(parts)
    rows = training.shuffled_batches(df, "id", seed=3, batch_size=16).collect()
    at = {r.id: r.position for r in rows}
    assert sorted(at.values()) == list(range(1, 1001))
    assert {r.id: r.batch_id for r in rows} == {i: (p - 1) // 16 for i, p in at.items()}
    first = [i for i, _ in sorted(at.items(), key=lambda x: x[1])]
    assert first != sorted(first)
    again = training.shuffled_batches(spark.range(1000), "id", seed=3).collect()
    assert {r.id: r.position for r in again} == at
    other = training.shuffled_batches(spark.range(1000), "id", seed=4).collect()
    assert {r.id: r.position for r in other} != at
