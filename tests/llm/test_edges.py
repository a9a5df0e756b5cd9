"""Every operator on rows with nulls, repeats, extremes and clashing names, and on none."""

import pytest

import corpus_pipeline
from shelfmark.llm import alignment, elias_fano, imatch, license_scan, line_dedup, mixing, near_dedup, packing, quality, repeats, sharding, toxicity

ROWS = 16
OPERATORS = {
    "lines": lambda s, d: line_dedup.drop_recurring_lines(d),
    "op1": line_dedup.op1_line_dedup,
    "op2": license_scan.op2_license_scan,
    "op5": mixing.op5_mixing,
    "mix": lambda s, d: mixing.mix(d),
    "op6": quality.op6_quality,
    "judge": lambda s, d: quality.judge(d),
    "op7": near_dedup.op7_lsh_forest,
    "op8": elias_fano.op8_elias_fano,
    "op9": imatch.op9_imatch,
    "op10": sharding.op10_sharding,
    "op11": repeats.op11_repeats,
    "op12": alignment.op12_alignment,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, messy, nothing, name):
    assert len(OPERATORS[name](spark, messy).collect()) == ROWS
    assert OPERATORS[name](spark, nothing).collect() == []


def test_toxicity(spark, messy, nothing):
    labels = spark.createDataFrame(
        [(6, 1), (6, 0), (7, None), (8, 0), (None, 1), (10, 0), (99, 1)], "doc_id bigint, toxic int"
    )
    got = toxicity.op3_toxicity(spark, messy, labels).collect()
    assert len(got) == ROWS and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.op3_toxicity(spark, nothing, labels).collect() == []
    unlabelled = toxicity.op3_toxicity(spark, messy, labels.limit(0)).collect()
    assert len(unlabelled) == ROWS and all(r["score"] < 0.5 for r in unlabelled)


def test_packing(spark, messy, nothing):
    pieces = packing.op4_packing(spark, messy).collect()
    assert sum(r["start"] == 0 for r in pieces) == ROWS
    assert packing.op4_packing(spark, nothing).collect() == []


def test_stages_keep_columns_and_values(spark, messy, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, messy, "")
        assert out.columns == messy.columns
        rows = {tuple(r) for r in messy.drop("text", "n_chars").collect()}
        assert {tuple(r) for r in out.drop("text", "n_chars").collect()} <= rows
        assert stage(spark, nothing, "").collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, "").collect() == []
