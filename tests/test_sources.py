import pytest
from pyspark.sql import functions as F

from shelfmark.config import Names
from shelfmark.plans.catalog import catalog_documents, load_catalog
from shelfmark.sources import files, tables

PRODUCT_HEADER = (
    "product_id\tproduct_name\tproduct_class\tcategory_hierarchy\tproduct_description\t"
    "product_features\trating_count\taverage_rating\treview_count\n"
)


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "product.csv").write_text(
        PRODUCT_HEADER
        + '1\trug\tRugs\tHome / Rugs\tsoft, "kid" rug\tcolor: red|size: 5\t12.0\t4.5\t10.0\n'
        + '2\ttable\tTables\tHome\t"two lines\nand ""quotes"""\t\t\t\t\n'
        + "3\tchair\tChairs\tHome\t\t\t1\t2\t3\n"
        + '4\tlamp\tLamps\tHome\t""\t\t1\t2\t3\n'
        + "many\tbad key\tX\tY\tZ\t\t1\t2\t3\n"
        + "6\tfew fields\n"
        + "7\ttoo many\tX\tY\tZ\tW\t1\t2\t3\textra\n",
        encoding="utf-8",
    )
    (tmp_path / "query.csv").write_text(
        "query_id\tquery\tquery_class\n0\tkid-proof rug\tRugs\n1\tfarmhouse table\t\n"
    )
    (tmp_path / "label.csv").write_text(
        "id\tquery_id\tproduct_id\tlabel\n0\t0\t1\tExact\n1\t1\t2\tPartial\n2\t1\t1\tIrrelevant\n3\t0\t9\t?\n"
    )
    return tmp_path


def test_product_edge_rows(spark, inputs):
    rows = {r.product_name: r for r in files.read_products(spark, str(inputs / "product.csv")).collect()}
    assert len(rows) == 7
    assert rows["rug"].product_description == 'soft, "kid" rug'
    assert (rows["rug"].product_id, rows["rug"].rating_count) == (1, 12.0)
    assert rows["table"].product_description == 'two lines\nand "quotes"'
    assert rows["table"].average_rating is None
    assert rows["chair"].product_description is None
    assert rows["lamp"].product_description is None
    assert rows["bad key"].product_id is None
    assert rows["few fields"].review_count is None
    assert rows["too many"].review_count == 3.0


def test_a_file_read_by_line_splits_on_line_breaks(spark, inputs):
    by_line = files.read_products(spark, str(inputs / "product.csv"), multi_line=False)
    assert by_line.count() == 8


def test_preview_has_no_schema(spark, inputs):
    seen = files.preview_file(spark, str(inputs / "query.csv"))
    assert seen.columns[0] == "_c0" and seen.count() == 3


def test_load_catalog_can_run_again(spark, inputs):
    names = Names(database="loaded", root=str(inputs / "store"))
    paths = [str(inputs / f"{n}.csv") for n in ("product", "query", "label")]
    for _ in range(2):
        load_catalog(spark, *paths, names)
    labels = tables.load_table(spark, "loaded.labels")
    assert {r.id: r.label_score for r in labels.collect()} == {0: 1.0, 1: 0.75, 2: 0.0, 3: None}
    assert tables.load_bronze(spark, names.bronze("queries")).count() == 2
    assert catalog_documents(spark, names).where("item_id = 3").first().item_text == "chair"
    described = {r.col_name: r.data_type for r in tables.describe(spark, "loaded.products").collect()}
    assert described["product_id"] == "int" and described["average_rating"] == "float"
    assert tables.peek(labels, 2).count() == 2


def test_bronze_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_bronze(spark.range(5), path)
    tables.save_bronze(spark.range(3).withColumn("x", F.lit("a")), path)
    again = tables.load_bronze(spark, path)
    assert again.columns == ["id", "x"] and again.count() == 3


def test_column_is_added_once(spark):
    df = tables.add_column_if_missing(spark.range(2), "label_score", "float")
    assert df.schema["label_score"].dataType.simpleString() == "float"
    assert tables.add_column_if_missing(df, "label_score", "double") is df
