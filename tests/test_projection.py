import numpy as np
import pytest

from shelfmark.functions.encoders import HashedEncoder, ProjectedEncoder, encoder_of, spec_of
from shelfmark.operators import projection
from shelfmark.plans import tuning
from shelfmark.plans.search import open_search, search
from shelfmark.sources import index

SCHEMA = "id bigint, query_id bigint, query_vec array<float>, item_vec array<float>, score double"


def pairs_of(spark, rng, n, dim, signal):
    """The score follows some directions of the space, which are not its axes."""
    turn, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    q, p = rng.normal(size=(n, dim)), rng.normal(size=(n, dim))
    near = ((q @ turn[:, :signal]) * (p @ turn[:, :signal])).sum(1)
    rows = [(i, i % (n // 10), q[i].tolist(), p[i].tolist(), float(near[i] > 0)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def loss(matrix, q, p, score):
    a, b = q @ matrix.T, p @ matrix.T
    cosine = (a * b).sum(1) / np.linalg.norm(a, axis=1) / np.linalg.norm(b, axis=1)
    return ((cosine - score) ** 2).mean()


def test_gradient_is_that_of_the_loss(spark):
    rng = np.random.default_rng(1)
    pairs = pairs_of(spark, rng, 60, 5, 2)
    extra = spark.createDataFrame(
        [(100, 1, [0.0] * 5, [1.0] * 5, 1.0), (101, 1, None, [1.0] * 5, 1.0), (102, 1, [1.0] * 5, [1.0] * 5, None)], SCHEMA
    )
    matrix = rng.normal(size=(3, 5))
    slope, value, n = projection.gradient(projection.usable_pairs(pairs.union(extra)).repartition(4), matrix)
    rows = pairs.collect()
    q, p, score = (np.array([r[c] for r in rows], np.float64) for c in ("query_vec", "item_vec", "score"))
    assert n == 60 and value == pytest.approx(loss(matrix, q, p, score))
    for i in range(3):
        for j in range(5):
            moved = matrix.copy()
            moved[i, j] += 1e-5
            other = matrix.copy()
            other[i, j] -= 1e-5
            assert slope[i, j] == pytest.approx((loss(moved, q, p, score) - loss(other, q, p, score)) / 2e-5, abs=1e-6)
    assert projection.gradient(pairs.where("false"), matrix)[2] == 0


def test_principal_map_keeps_what_reaches_farthest(spark):
    rng = np.random.default_rng(2)
    wide = rng.normal(size=(200, 6)) * np.array([5, 0.1, 0.1, 3, 0.1, 0.1])
    rows = [(i, 0, wide[i].tolist(), wide[-i].tolist(), 1.0) for i in range(200)]
    found = projection.principal_map(spark.createDataFrame(rows, SCHEMA), 2)
    assert sorted(np.abs(found).argmax(axis=1).tolist()) == [0, 3] and (found.max(axis=1) > 0.9).all()


def test_a_fitted_map_beats_the_diagonal(spark):
    """The planted directions are no axes, so re-weighting the axes cannot find them."""
    pairs = pairs_of(spark, np.random.default_rng(3), 2000, 12, 3).repartition(4).cache()
    training = projection.Training(steps=8, epochs=4, warm_up=4, rate=0.5)
    matrix, compared = tuning.tune_projection(pairs, 6, training=training)
    assert matrix.shape == (6, 12)
    found = {(r.model, r.held_out): r for r in compared.collect()}
    assert len(found) == 4 and found["original", True].pairs == found["projected", True].pairs
    diagonal = {
        r.model: r.correlation for r in tuning.tune(pairs).comparison.where("held_out").collect()
    }
    best = max(c for c in diagonal.values() if c is not None)
    assert found["projected", True].correlation > best + 0.1
    again, _ = tuning.tune_projection(pairs.repartition(7), 6, training=training)
    np.testing.assert_allclose(again, matrix, atol=1e-6)


def test_projected_vectors(spark):
    rows = [(1, [3.0, 4.0, 0.0]), (2, None), (3, [0.0, 0.0, 2.0])]
    df = spark.createDataFrame(rows, "item_id bigint, embedding array<float>")
    got = {r.item_id: r.embedding for r in projection.apply_projection(df, np.eye(3)[:2]).collect()}
    assert got == {1: pytest.approx([0.6, 0.8]), 2: None, 3: [0.0, 0.0]}


def test_a_projected_index_is_searched_by_path(spark, tmp_path):
    path, base = str(tmp_path / "index"), HashedEncoder(16)
    rows = [(1, "rug", "kid proof rug"), (2, "table", "farmhouse table"), (3, "sofa", "kid sofa")]
    index.write_index(spark.createDataFrame(rows, "item_id bigint, item_name string, item_text string"), path, base)
    matrix = np.random.default_rng(4).normal(size=(6, 16))
    version, encoder = tuning.reindex_projected(index.read_index(spark, path), base, matrix, path)
    assert version == 2 and encoder_of(spec_of(encoder)) == encoder and encoder.dim == 6
    for row in index.read_index(spark, path).with_texts().collect():
        np.testing.assert_allclose(row.embedding, encoder.open()([row.item_text])[0], atol=1e-6)
    asked = spark.createDataFrame([(1, "kid rug")], "query_id bigint, query string")
    want = search(asked, index.read_index(spark, path, encoder), encoder, 2)
    assert sorted(map(tuple, open_search(spark, path)(asked, 2).collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError, match="the map takes"):
        ProjectedEncoder.of(HashedEncoder(8), matrix)


def test_pairs_that_share_an_id_are_fitted_once_each(spark, monkeypatch):
    """Pairs keep their number, and batches their order, whether or not ids repeat."""
    rng = np.random.default_rng(5)
    seen = []

    def counted(pairs, matrix):
        seen.append(sorted(r.score for r in pairs.collect()))
        return np.zeros_like(matrix), 0.0, len(seen[-1])

    monkeypatch.setattr(projection, "gradient", counted)
    training = projection.Training(steps=4, epochs=1)
    for repeated in (1, 3):
        rows = [(i // repeated, 0, rng.normal(size=3).tolist(), rng.normal(size=3).tolist(), float(i)) for i in range(240)]
        pairs = spark.createDataFrame(rows, SCHEMA).repartition(3)
        del seen[:]
        projection.fit_projection(pairs, 2, training)
        assert sorted(x for part in seen for x in part) == [float(i) for i in range(240)]
        assert len(seen) == 4 and max(map(len, seen)) - min(map(len, seen)) <= 32
        if repeated == 1:
            placed = projection.shuffled_batches(pairs.select("id"), "id").collect()
            steps = {float(r.id): r.batch_id * 4 // 15 for r in placed}
            assert [{steps[x] for x in part} for part in seen] == [{0}, {1}, {2}, {3}]
