import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from shelfmark.session import ship  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(root / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


def frame(spark, id_col, ids, vectors):
    rows = [
        (int(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)
    ]
    return spark.createDataFrame(rows, f"{id_col} bigint, embedding array<float>")


def brute_force(query_ids, queries, item_ids, items, k, metric="l2", digits=6):
    """The expected rows, from every pair."""
    scale = 10.0**digits
    rows = set()
    for qid, q in zip(query_ids, np.asarray(queries, dtype=np.float32).astype(float)):
        scored = []
        for iid, x in zip(item_ids, np.asarray(items, dtype=np.float32).astype(float)):
            if metric == "l2":
                score = ((q - x) ** 2).sum()
            else:
                lengths = np.sqrt((q * q).sum()) * np.sqrt((x * x).sum())
                if lengths == 0:
                    continue
                score = (q * x).sum() / lengths
            score = float(np.floor(score * scale + 0.5001) / scale) + 0.0
            scored.append((score if metric == "l2" else -score, int(iid), score))
        for rank, (_, iid, score) in enumerate(sorted(scored)[:k], start=1):
            rows.add((int(qid), iid, rank, score))
    return rows


def rows_of(df):
    collected = df.collect()
    rows = {tuple(r) for r in collected}
    assert len(rows) == len(collected)
    return rows
