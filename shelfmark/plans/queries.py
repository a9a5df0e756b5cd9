"""Every job of the library, run over the given tables.

The tables stand in for a catalog like this:

* documents are products, benchmark items are queries and labels judge documents;
* lineitem rows are judgements that link a supplier (the query) and a part (the
  product), and likewise two embeddings of the same numbers;
* conversation turns are a query log and the bodies of search requests.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.config import Names
from shelfmark.functions import text
from shelfmark.functions.encoders import HashedEncoder
from shelfmark.functions.requests import decode_requests, encode_request
from shelfmark.operators import codes, evaluate, lists, metric, nearest, pairs, profile, projection, training, tree
from shelfmark.operators.encode import encode, spread
from shelfmark.operators.skew import join_counted
from shelfmark.plans import tuning
from shelfmark.plans.catalog import load_catalog
from shelfmark.plans.search import open_search, search
from shelfmark.session import ensure_checkpoints, new_work_dir, ship
from shelfmark.sources import files, index, tables
from shelfmark.streaming.search import read_answers, read_rejected, stream_search

DIM = 384
VECTOR_DIM = 64
LISTS = 16
PROBES = (1, 4, 8)
LEAVES = 64
FIXED_RANK = 4
FITTED_RANK = 16
CODE_PARTS = 16
RERANKED = (10, 20, 50)
FIXED_WEIGHTS = tuple(1.0 / (1 + d) for d in range(VECTOR_DIM))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- stand-ins -------------------------------------------------------------


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text labels of documents: (product_id, label)."""
    label = (
        F.when((F.col("toxic") == 1) & (F.col("quality") == 0), "unknown")
        .when(F.col("toxic") == 1, "Irrelevant")
        .when(F.col("quality") == 1, "EXACT")
        .otherwise("partial")
    )
    return _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("product_id"), label.alias("label")
    )


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as (item_id, item_name, item_text), whole texts."""
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("item_id"),
        F.concat_ws(" ", "lang", "source").alias("item_name"),
        F.col("text").alias("item_text"),
    )


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document judged against one benchmark item; the items take
    turns: (id, query_id, product_id, label_score)."""
    asked = benchmark_queries(spark, sf_dir)
    turn = F.pmod("product_id", asked.agg(F.count(F.lit(1))).scalar())
    scored = text.score_labels(judged_documents(spark, sf_dir))
    return scored.withColumn("query_id", turn).withColumn("id", F.col("product_id"))


def vectors(spark: SparkSession, sf_dir: str, id_col: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(id_col), "embedding"
    )


def judged_vectors(spark: SparkSession, sf_dir: str, *also: Column) -> DataFrame:
    """Lineitems as judgements of two embeddings: equal labels 1, neighbours 0.75. ``also``
    are named columns of lineitem to keep."""
    judged = _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("query_id"), F.col("l_partkey").alias("item_id"), *also
    )
    held = _table(spark, sf_dir, "embeddings")
    rows = held.count()
    # Labels first: the wide vectors join last.
    for key in ("query_id", "item_id"):
        kind = held.select(F.col("vec_id").alias(key), F.col("label").alias(f"{key}_label"))
        judged = join_counted(judged, kind, key, 24 * rows)
    gap = F.abs(F.col("query_id_label") - F.col("item_id_label"))
    score = F.when(gap == 0, 1.0).when(gap == 1, 0.75).otherwise(0.0)
    kept = [c for c in judged.columns if c not in ("query_id_label", "item_id_label")]
    return pairs.join_vectors(
        judged.select(*kept, score.alias("score")),
        vectors(spark, sf_dir, "query_id"),
        vectors(spark, sf_dir, "item_id"),
        VECTOR_DIM,
        query_rows=rows,
        item_rows=rows,
    )


# --- tables and text -------------------------------------------------------


def label_score(spark, sf_dir):
    scored = text.score_labels(judged_documents(spark, sf_dir))
    return scored.withColumn("label_score", F.col("label_score").cast("double"))


def label_score_histogram(spark, sf_dir):
    return profile.label_histogram(label_score(spark, sf_dir))


def query_class_histogram(spark, sf_dir):
    log = _table(spark, sf_dir, "conversations").select(
        F.col("text").alias("query"), F.col("role").alias("query_class")
    )
    return profile.class_histogram(log)


def search_text(spark, sf_dir):
    """Items whose text falls back on the name, or is set aside for want of both."""
    products = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("product_id"),
        F.when(F.col("source") != "src0", F.concat_ws(" ", "lang", "source")).alias("product_name"),
        F.when(F.col("lang") != "de", F.col("text")).alias("product_description"),
    )
    good, aside = text.split_by_text(text.searchable(products))
    documents = text.to_documents(good, "item_text")
    return documents.select(
        "metadata.item_id", "metadata.item_name", "page_content", F.lit(False).alias("set_aside")
    ).unionByName(
        aside.select(
            "item_id", "item_name", F.col("item_text").alias("page_content"),
            F.lit(True).alias("set_aside"),
        )
    )


def file_roundtrip(spark, sf_dir):
    """Parts written as tab-separated text, read by schema, stored and read back."""
    root = new_work_dir(spark, "files")
    names = Names(database=f"files_{uuid.uuid4().hex}", root=root)
    source = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_class"),
        F.concat_ws(" / ", "p_brand", "p_type").alias("category_hierarchy"),
        F.when(F.col("p_size") > 25, F.concat(F.lit('a "'), "p_name", F.lit('"\nof size '), "p_size")).alias(
            "product_description"
        ),
        F.lit(None).cast("string").alias("product_features"),
        F.col("p_size").cast("float").alias("rating_count"),
        F.col("p_retailprice").cast("float").alias("average_rating"),
        F.lit(None).cast("float").alias("review_count"),
    )
    source.write.csv(f"{root}/in", sep="\t", header=True, escape='"', emptyValue="")
    read = files.read_products(spark, f"{root}/in")
    tables.create_database(spark, names.database, f"{root}/database")
    tables.save_bronze(read, names.bronze(names.products))
    bronze = tables.load_bronze(spark, names.bronze(names.products))
    tables.save_table(bronze, names.table(names.products), f"{root}/tables/products")
    stored = tables.load_table(spark, names.table(names.products))
    return stored.select(
        F.col("product_id").cast("bigint"),
        "product_name",
        "product_class",
        "category_hierarchy",
        "product_description",
        F.col("rating_count").cast("double"),
        F.round(F.col("average_rating").cast("double"), 2).alias("average_rating"),
    )


def catalog_load(spark, sf_dir):
    """Three files written, loaded into tables with scored labels, and joined again."""
    root = new_work_dir(spark, "load")
    names = Names(database=f"load_{uuid.uuid4().hex}", root=root)
    docs = _table(spark, sf_dir, "documents")
    products = docs.select(
        F.col("doc_id").cast("int").alias("product_id"),
        F.concat_ws(" ", "lang", "source").alias("product_name"), F.col("source").alias("product_class"),
        F.col("lang").alias("category_hierarchy"), F.col("text").alias("product_description"),
        F.lit(None).cast("string").alias("product_features"), F.lit(None).cast("float").alias("rating_count"),
        F.lit(None).cast("float").alias("average_rating"), F.lit(None).cast("float").alias("review_count"),
    )
    asked = benchmark_queries(spark, sf_dir).select(
        F.col("query_id").cast("int"), F.translate("query", "\n", " ").alias("query"), F.lit("all").alias("query_class")
    )
    items = asked.agg(F.count(F.lit(1))).scalar()
    judged = judged_documents(spark, sf_dir).select(
        F.col("product_id").cast("int").alias("id"), F.pmod("product_id", items).cast("int").alias("query_id"),
        F.col("product_id").cast("int"), "label",
    )
    for name, frame in (("products", products), ("queries", asked), ("labels", judged)):
        frame.write.csv(f"{root}/{name}", sep="\t", header=True, escape='"', emptyValue="")
    load_catalog(spark, f"{root}/products", f"{root}/queries", f"{root}/labels", names)
    stored = {n: tables.load_table(spark, names.table(n)) for n in (names.products, names.queries, names.labels)}
    labels = tables.add_column_if_missing(stored[names.labels], "label_score", "float")
    labels = tables.add_column_if_missing(labels, "note", "string")
    return (
        labels.join(stored[names.queries], "query_id")
        .join(stored[names.products], "product_id")
        .select(
            F.col("id").cast("bigint"), F.col("query_id").cast("bigint"), "label",
            F.col("label_score").cast("double"), "note", "query", "product_name",
            F.length("product_description").cast("bigint").alias("text_chars"),
        )
    )


def table_preview(spark, sf_dir):
    """A stored table described, looked at, and its file read raw."""
    root = new_work_dir(spark, "preview")
    names = Names(database=f"preview_{uuid.uuid4().hex}", root=root)
    held = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    tables.create_database(spark, names.database, f"{root}/database")
    tables.save_table(held, names.table("part"), f"{root}/part")
    stored = tables.load_table(spark, names.table("part"))
    described = tables.describe(spark, names.table("part")).where(F.col("col_name").isin("p_partkey", "p_brand"))
    held.write.csv(f"{root}/raw", sep="\t")
    raw = files.preview_file(spark, f"{root}/raw").select(F.lit("file").alias("look"), F.col("_c0").alias("seen"))
    seen = tables.peek(stored, 10).agg(F.count(F.lit(1)).cast("string").alias("seen"))
    return (
        raw.unionByName(described.select(F.lit("column").alias("look"), F.concat_ws(" ", "col_name", "data_type").alias("seen")))
        .unionByName(seen.select(F.lit("peek").alias("look"), "seen"))
    )


def index_quality(spark, sf_dir):
    """An index written from documents, some without text, against its source."""
    encoder = HashedEncoder(DIM)
    path = new_work_dir(spark, "index")
    items = document_items(spark, sf_dir).withColumn(
        "item_text", F.when(F.pmod("item_id", F.lit(7)) != 0, F.col("item_text"))
    )
    version = index.write_index(items, path, encoder)
    opened = index.read_index(spark, path, encoder)
    usable, _ = text.split_by_text(items)
    aside = index.read_aside(spark, path, version).agg(F.count(F.lit(1)).alias("set_aside"))
    checked = profile.index_quality(opened.items, usable)
    return checked.withColumn("set_aside", aside.scalar())


# --- judged pairs and agreement --------------------------------------------


def judged_pairs(spark, sf_dir):
    label = (
        F.when(F.col("l_returnflag") == "A", "EXACT")
        .when(F.col("l_returnflag") == "N", "Partial")
        .when(F.col("l_linestatus") == "F", "irrelevant")
        .otherwise("unknown")
    )
    labels = _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("query_id"), F.col("l_partkey").alias("product_id"),
        label.alias("label"),
    )
    products = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") > 25, F.concat_ws(" ", "p_type", "p_name", "p_brand")).alias(
            "product_description"
        ),
    )
    asked = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("query_id"), F.col("s_name").alias("query")
    )
    linked = pairs.judged_pairs(text.searchable(products), text.score_labels(labels), asked)
    return linked.withColumn("score", F.col("score").cast("double"))


def pair_cosine(spark, sf_dir):
    scored = pairs.pair_cosine(judged_vectors(spark, sf_dir))
    return scored.select("query_id", "item_id", "score", F.round("cosine", 6).alias("cosine"))


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.withColumns(
        {c: F.round(c, 6) for c in ("mean_cosine", "correlation")}
    )


def mean_cosine_and_corr(spark, sf_dir):
    return _rounded(evaluate.agreement(pairs.pair_cosine(judged_vectors(spark, sf_dir))))


def compare_models(spark, sf_dir):
    models = {"original": None, "weighted": FIXED_WEIGHTS}
    return _rounded(evaluate.compare_models(judged_vectors(spark, sf_dir), models))


def text_agreement(spark, sf_dir):
    """Text to agreement: every judged query and document encoded once."""
    judged = judgements(spark, sf_dir).select(
        "query_id", F.col("product_id").alias("item_id"), F.col("label_score").alias("score")
    )
    linked = pairs.encode_pairs(
        judged, benchmark_queries(spark, sf_dir), document_items(spark, sf_dir), HashedEncoder(DIM)
    )
    return _rounded(evaluate.agreement(pairs.pair_cosine(linked)))


def fit_metric_gram(spark, sf_dir):
    return metric.gram_sums(judged_vectors(spark, sf_dir)).select(
        "i", "j", F.round("value", 6).alias("value")
    )


def fit_metric_weights(spark, sf_dir):
    weights = metric.fit_weights(judged_vectors(spark, sf_dir))
    fitted = spark.createDataFrame(list(enumerate(weights)), "dimension bigint, weight double")
    return fitted.select("dimension", F.round("weight", 4).alias("weight"))


def tuning_comparison(spark, sf_dir):
    compared = tuning.tune(judged_vectors(spark, sf_dir)).comparison
    return compared.withColumns({c: F.round(c, 4) for c in ("mean_cosine", "correlation")})


def _named_pairs(spark, sf_dir) -> DataFrame:
    """The judged vectors with an id for each judgement, written once."""
    ensure_checkpoints(spark)
    named = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("id")
    return judged_vectors(spark, sf_dir, named).checkpoint()


def projection_step(spark, sf_dir):
    """The gradient of the cosine loss over all judgements, at a fixed map."""
    rows, cols = np.indices((FIXED_RANK, VECTOR_DIM))
    matrix = 1.0 / (1 + (rows * 7 + cols) % 11)
    slope, loss, n = projection.gradient(projection.usable_pairs(judged_vectors(spark, sf_dir)), matrix)
    cells = [(int(i), int(j), float(slope[i, j]), loss, n) for i in range(FIXED_RANK) for j in range(VECTOR_DIM)]
    made = spark.createDataFrame(cells, "i bigint, j bigint, value double, loss double, pairs bigint")
    return made.withColumns({c: F.round(c, 6) for c in ("value", "loss")})


def projection_comparison(spark, sf_dir):
    """Held-out agreement of a map fitted on the cosine loss, beside the vectors as they are."""
    _, compared = tuning.tune_projection(_named_pairs(spark, sf_dir), FITTED_RANK)
    return compared.withColumns({c: F.round(c, 4) for c in ("mean_cosine", "correlation")})


def apply_metric(spark, sf_dir):
    moved = metric.apply_metric(vectors(spark, sf_dir, "item_id"), FIXED_WEIGHTS)
    return _long(moved, "item_id")


def training_examples(spark, sf_dir):
    judged = pairs.judged_pairs(
        document_items(spark, sf_dir),
        judgements(spark, sf_dir),
        benchmark_queries(spark, sf_dir),
        "id",
    )
    examples = training.training_examples(judged, "id", "item_id")
    return training.shuffled_batches(examples, "id").select(
        "item_id",
        F.col("texts")[0].alias("query"),
        F.col("texts")[1].alias("item_text"),
        F.col("label").cast("double"),
        "position",
        "batch_id",
    )


# --- nearest items ---------------------------------------------------------


def _self_search(spark, sf_dir, **how) -> DataFrame:
    return nearest.knn_exact(
        vectors(spark, sf_dir, "query_id"), vectors(spark, sf_dir, "item_id"), **how
    )


def knn_exact_l2(spark, sf_dir):
    return nearest.ordered(_self_search(spark, sf_dir))


def knn_exact_cosine(spark, sf_dir):
    return nearest.ordered(_self_search(spark, sf_dir, metric="cosine"))


def knn_block(spark, sf_dir):
    return _self_search(spark, sf_dir, strategy="queries")


def knn_pruned(spark, sf_dir):
    return _self_search(spark, sf_dir, strategy="lists")


def _listed(spark, sf_dir):
    items = vectors(spark, sf_dir, "item_id")
    centroids = lists.fit_centroids(items, LISTS)
    return lists.assign_lists(items, centroids), centroids


def knn_lists_full(spark, sf_dir):
    listed, centroids = _listed(spark, sf_dir)
    asked = vectors(spark, sf_dir, "query_id")
    # No broadcast: both sides meet in bounded cells.
    return lists.knn_lists(asked, listed, centroids, nprobe=LISTS, broadcast_bytes=0)


def knn_lists_scan(spark, sf_dir):
    listed, centroids = _listed(spark, sf_dir)
    return lists.knn_lists(vectors(spark, sf_dir, "query_id"), listed, centroids, nprobe=LISTS)


def knn_repeated(spark, sf_dir):
    """Queries that share ids, searched in blocks of a few."""
    asked = vectors(spark, sf_dir, "query_id").withColumn("query_id", F.pmod("query_id", F.lit(50)))
    return nearest.knn_exact(
        asked, vectors(spark, sf_dir, "item_id"), strategy="queries", broadcast_bytes=64 * 1024
    )


def _given_lists(spark, sf_dir):
    """Lists around the first vectors, so that what is in them needs no fit."""
    items = vectors(spark, sf_dir, "item_id")
    first = items.where(F.col("item_id") < LISTS).orderBy("item_id").collect()
    centroids = lists.Centroids(np.array([r["embedding"] for r in first], np.float32))
    ensure_checkpoints(spark)
    return lists.assign_lists(items, centroids).checkpoint(), centroids


def knn_lists_probe(spark, sf_dir):
    listed, centroids = _given_lists(spark, sf_dir)
    return lists.knn_lists(vectors(spark, sf_dir, "query_id"), listed, centroids, nprobe=PROBES[1])


def knn_lists_recall(spark, sf_dir):
    """Share of the exact results that each number of visited lists finds."""
    listed, centroids = _given_lists(spark, sf_dir)
    asked = vectors(spark, sf_dir, "query_id")
    exact = _self_search(spark, sf_dir).select("query_id", "item_id")
    found = None
    for nprobe in PROBES:
        part = lists.knn_lists(asked, listed, centroids, nprobe=nprobe)
        part = part.select("query_id", "item_id", F.lit(nprobe).cast("bigint").alias("nprobe"))
        found = part if found is None else found.unionByName(part)
    total = exact.agg(F.count(F.lit(1)))
    return (
        found.join(exact, ["query_id", "item_id"], "left_semi")
        .groupBy("nprobe")
        .agg(F.count(F.lit(1)).alias("hits"))
        .select("nprobe", F.round(F.col("hits") / total.scalar(), 4).alias("recall"))
    )


def knn_tree(spark, sf_dir):
    """Exact search through a tree of lists, whose leaves are never held in one place."""
    fitted, held = tree.fit_tree(vectors(spark, sf_dir, "item_id"), LEAVES)
    listed = tree.assign_leaves(held, fitted).checkpoint()
    return tree.knn_tree(vectors(spark, sf_dir, "query_id"), listed, fitted)


def knn_codes(spark, sf_dir):
    """Codes name what could be among the best, whole vectors rank it."""
    listed, centroids = _listed(spark, sf_dir)
    book = codes.fit_codes(listed, centroids)
    coded = codes.encode_items(listed, book)
    asked, items = (vectors(spark, sf_dir, c) for c in ("query_id", "item_id"))
    return codes.knn_codes(asked, coded, items, book)


def knn_codes_recall(spark, sf_dir):
    """Share of the exact results found when so many items of a query are ranked. The
    parts of the first vectors are the codes, so that what is found needs no fit."""
    items, asked = (vectors(spark, sf_dir, c) for c in ("item_id", "query_id"))
    first = items.where(F.col("item_id") < LISTS).orderBy("item_id").collect()
    given = np.array([r["embedding"] for r in first], np.float64)
    origin = lists.Centroids(np.zeros((1, VECTOR_DIM), np.float32))
    book = codes.CodeBook(origin, given.reshape(len(first), CODE_PARTS, -1).transpose(1, 0, 2).copy())
    coded = codes.encode_items(items.withColumn("list_id", F.lit(0).cast("bigint")), book)
    ensure_checkpoints(spark)
    coded = coded.checkpoint()
    exact = _self_search(spark, sf_dir).select("query_id", "item_id")
    found = None
    for rerank in RERANKED:
        part = codes.knn_codes(asked, coded, items, book, rerank=rerank)
        part = part.select("query_id", "item_id", F.lit(rerank).cast("bigint").alias("rerank"))
        found = part if found is None else found.unionByName(part)
    total = exact.agg(F.count(F.lit(1)))
    return (
        found.join(exact, ["query_id", "item_id"], "left_semi")
        .groupBy("rerank")
        .agg(F.count(F.lit(1)).alias("hits"))
        .select("rerank", F.round(F.col("hits") / total.scalar(), 4).alias("recall"))
    )


# --- encode, index and search ----------------------------------------------


def _long(frame: DataFrame, id_col: str) -> DataFrame:
    return frame.select(id_col, F.posexplode("embedding")).select(
        id_col,
        F.col("pos").cast("bigint").alias("dimension"),
        F.round(F.col("col").cast("double"), 6).alias("value"),
    )


def encode_hashed(spark, sf_dir):
    items = spread(document_items(spark, sf_dir), "item_id")
    encoded = encode(items, "item_text", HashedEncoder(DIM))
    return _long(encoded, "item_id").where(F.col("value") != 0)


def index_roundtrip(spark, sf_dir):
    """Two versions written; the newest is read back."""
    path = new_work_dir(spark, "index")
    held = vectors(spark, sf_dir, "item_id")
    for _ in range(2):
        index.write_vectors(held, path, "given", VECTOR_DIM)
    opened = index.read_index(spark, path)
    return _long(opened.items, "item_id").withColumn("version", F.lit(opened.version).cast("bigint"))


def semantic_search(spark, sf_dir):
    encoder = HashedEncoder(DIM)
    path = new_work_dir(spark, "index")
    index.write_index(document_items(spark, sf_dir), path, encoder)
    opened = index.read_index(spark, path, encoder)
    return nearest.ordered(search(benchmark_queries(spark, sf_dir), opened, encoder))


def semantic_search_lists(spark, sf_dir):
    """The same search on an index with lists, visiting all of them."""
    encoder = HashedEncoder(DIM)
    path = new_work_dir(spark, "index")
    index.write_index(document_items(spark, sf_dir), path, encoder, lists=LISTS)
    opened = index.read_index(spark, path, encoder)
    return search(benchmark_queries(spark, sf_dir), opened, encoder, nprobe=LISTS)


def _changes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Every third document with another text and every benchmark item as a new one; and
    every tenth document, to be removed."""
    docs = document_items(spark, sf_dir)
    replaced = docs.where(F.pmod("item_id", F.lit(3)) == 0).withColumn(
        "item_text", F.concat(F.lit("changed "), F.substring("item_text", 1, 200))
    )
    new = benchmark_queries(spark, sf_dir).select(
        (-F.col("query_id") - 1).alias("item_id"), F.lit("benchmark").alias("item_name"), F.col("query").alias("item_text")
    )
    return replaced.unionByName(new), docs.where(F.pmod("item_id", F.lit(10)) == 7).select("item_id")


def index_merge(spark, sf_dir):
    """Search of an index changed twice: what changed is encoded and written, no more."""
    path = new_work_dir(spark, "index")
    index.write_index(document_items(spark, sf_dir), path, HashedEncoder(DIM))
    changed, removed = _changes(spark, sf_dir)
    index.change_index(spark, path, changed.where("item_id >= 0"), removed)
    index.change_index(spark, path, changed.where("item_id < 0"))
    return open_search(spark, path)(benchmark_queries(spark, sf_dir))


def tuned_search(spark, sf_dir):
    """Search of an index moved to a weighted space, no text encoded again; opened by its
    path alone."""
    encoder = HashedEncoder(DIM)
    path = new_work_dir(spark, "index")
    index.write_index(document_items(spark, sf_dir), path, encoder)
    weights = tuple(1.0 / (1 + d) for d in range(DIM))
    tuned = tuning.Tuned(weights, None, True)
    tuning.reindex(index.read_index(spark, path, encoder), encoder, tuned, path)
    return open_search(spark, path)(benchmark_queries(spark, sf_dir))


# --- requests and streaming ------------------------------------------------


def _requests(spark, sf_dir, query=None) -> DataFrame:
    """One request body per conversation turn."""
    turns = _table(spark, sf_dir, "conversations")
    query = F.col("text") if query is None else query
    body = encode_request(F.col("turn"), ["role", "query"], F.col("role"), query)
    return turns.select("conv_id", "turn", body.alias("body"))


def requests_roundtrip(spark, sf_dir):
    return decode_requests(_requests(spark, sf_dir))


def _streamed(spark, sf_dir, requests: DataFrame) -> str:
    """Requests sent through a file stream; the folder of the answers."""
    encoder = HashedEncoder(DIM)
    root = new_work_dir(spark, "stream")
    version = index.write_index(document_items(spark, sf_dir), f"{root}/index", encoder)
    width = _table(spark, sf_dir, "conversations").agg(F.max("turn") + 1).first()[0] or 1
    request_id = F.col("conv_id") * F.lit(width) + F.col("turn")
    inbox = requests.select(request_id.alias("request_id"), "body")
    inbox.repartition(2).write.parquet(f"{root}/inbox")
    arriving = spark.readStream.schema(inbox.schema).option("maxFilesPerTrigger", 1).parquet(
        f"{root}/inbox"
    )
    running = stream_search(
        arriving, f"{root}/index", encoder, f"{root}/out", f"{root}/rejected",
        f"{root}/checkpoint", version=version, available_now=True,
    )
    if not running.awaitTermination(1800):
        running.stop()
        raise TimeoutError("the stream did not finish")
    return root


def stream_search_requests(spark, sf_dir):
    """Every conversation turn sent as a request through a file stream."""
    root = _streamed(spark, sf_dir, _requests(spark, sf_dir))
    return read_answers(spark, f"{root}/out").select(
        "request_id", "pos", "rank", "product_id", "product_name", "score"
    )


def request_outcomes(spark, sf_dir):
    """What became of each request, where every fifth turn asks nothing and every
    seventh conversation sends a body that cannot be read."""
    query = F.when(F.pmod("turn", F.lit(5)) != 0, F.col("text"))
    sent = _requests(spark, sf_dir, query)
    body = F.when(F.pmod("conv_id", F.lit(7)) == 0, F.lit("{")).otherwise(F.col("body"))
    root = _streamed(spark, sf_dir, sent.withColumn("body", body))
    answered = read_answers(spark, f"{root}/out").select("request_id", F.lit("answered").alias("outcome"))
    refused = read_rejected(spark, f"{root}/rejected").select("request_id", F.col("reason").alias("outcome"))
    return answered.distinct().unionByName(refused)


QUERIES = {
    "label_score": label_score,
    "label_score_histogram": label_score_histogram,
    "query_class_histogram": query_class_histogram,
    "search_text": search_text,
    "file_roundtrip": file_roundtrip,
    "catalog_load": catalog_load,
    "table_preview": table_preview,
    "index_quality": index_quality,
    "judged_pairs": judged_pairs,
    "pair_cosine": pair_cosine,
    "mean_cosine_and_corr": mean_cosine_and_corr,
    "compare_models": compare_models,
    "text_agreement": text_agreement,
    "fit_metric_gram": fit_metric_gram,
    "fit_metric_weights": fit_metric_weights,
    "tuning_comparison": tuning_comparison,
    "projection_step": projection_step,
    "projection_comparison": projection_comparison,
    "apply_metric": apply_metric,
    "training_examples": training_examples,
    "knn_exact_l2": knn_exact_l2,
    "knn_exact_cosine": knn_exact_cosine,
    "knn_block": knn_block,
    "knn_pruned": knn_pruned,
    "knn_lists_full": knn_lists_full,
    "knn_lists_scan": knn_lists_scan,
    "knn_repeated": knn_repeated,
    "knn_lists_probe": knn_lists_probe,
    "knn_lists_recall": knn_lists_recall,
    "knn_tree": knn_tree,
    "knn_codes": knn_codes,
    "knn_codes_recall": knn_codes_recall,
    "encode_hashed": encode_hashed,
    "index_roundtrip": index_roundtrip,
    "semantic_search": semantic_search,
    "semantic_search_lists": semantic_search_lists,
    "index_merge": index_merge,
    "tuned_search": tuned_search,
    "requests_roundtrip": requests_roundtrip,
    "stream_search": stream_search_requests,
    "request_outcomes": request_outcomes,
}
