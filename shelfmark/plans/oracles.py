"""The same results in SQL, over the same tables, for an independent check."""

from __future__ import annotations

_LABELS = """
  SELECT doc_id AS product_id,
         CASE WHEN toxic = 1 AND quality = 0 THEN 'unknown'
              WHEN toxic = 1 THEN 'Irrelevant'
              WHEN quality = 1 THEN 'EXACT'
              ELSE 'partial' END AS label
  FROM labels
"""

_SCORE = """CASE lower(label) WHEN 'exact' THEN 1.0 WHEN 'partial' THEN 0.75
              WHEN 'irrelevant' THEN 0.0 END"""

_JUDGED_TEXTS = f"""
  SELECT b.item_id AS query_id, d.doc_id AS item_id, b.text AS query, d.text AS item_text,
         CAST({_SCORE} AS DOUBLE) AS score
  FROM ({_LABELS}) l
  JOIN documents d ON d.doc_id = l.product_id
  JOIN benchmark b ON b.item_id = l.product_id % (SELECT count(*) FROM benchmark)
"""

_JUDGED_VECTORS = """
  SELECT l.l_suppkey AS query_id, l.l_partkey AS item_id,
         q.embedding::DOUBLE[] AS q, p.embedding::DOUBLE[] AS p,
         CASE abs(q.label - p.label) WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.75::DOUBLE
              ELSE 0.0::DOUBLE END AS score
  FROM lineitem l JOIN embeddings q ON q.vec_id = l.l_suppkey
  JOIN embeddings p ON p.vec_id = l.l_partkey
"""

_COSINE = (
    "list_inner_product({a}, {b}) / nullif(sqrt(list_inner_product({a}, {a})"
    " * list_inner_product({b}, {b})), 0)"
)

_AGREEMENT = """count(*) AS pairs, round(avg(cosine), 6) AS mean_cosine,
         CASE WHEN stddev_pop(cosine) * stddev_pop(score) = 0 THEN NULL
              ELSE round(corr(cosine, score), 6) END AS correlation"""


def _encoded(source: str, id_col: str, text_col: str, dim: int = 384) -> str:
    """(id, vec) by hashed words, vectors of 32-bit floats."""
    return rf"""
  SELECT g.id, list(CAST(coalesce(s.total, 0) / coalesce(s.length, 1) AS FLOAT) ORDER BY g.d) AS vec
  FROM (SELECT {id_col} AS id, unnest(range({dim})) AS d FROM {source}) g
  LEFT JOIN (
    SELECT id, d, total, sqrt(sum(total * total) OVER (PARTITION BY id)) AS length
    FROM (
      SELECT id, CAST('0x' || h[1:8] AS BIGINT) % {dim} AS d,
             sum(1 - 2 * (CAST('0x' || h[9] AS BIGINT) % 2))::DOUBLE AS total
      FROM (SELECT id, md5(lower(word)) AS h
            FROM (SELECT {id_col} AS id,
                         unnest(regexp_extract_all({text_col}, '[\p{{L}}\p{{N}}]+')) AS word
                  FROM {source}))
      GROUP BY ALL)
  ) s ON s.id = g.id AND s.d = g.d AND s.length > 0
  GROUP BY g.id
"""


def _knn(asked: str, held: str, metric: str = "l2") -> str:
    """(query_id, item_id, rank, score) of the five best of ``held`` (id, vec)."""
    if metric == "l2":
        score, order = "pow(list_distance(q.vec::DOUBLE[], i.vec::DOUBLE[]), 2)", "score"
    else:
        score, order = "list_cosine_similarity(q.vec::DOUBLE[], i.vec::DOUBLE[])", "score DESC"
    return f"""
  SELECT query_id, item_id, rank, score FROM (
    SELECT query_id, item_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY {order}, item_id) AS rank
    FROM (SELECT q.id AS query_id, i.id AS item_id, round({score} + 1e-10, 6) AS score
          FROM ({asked}) q, ({held}) i))
  WHERE rank <= 5
"""


_VECTORS = "SELECT vec_id AS id, embedding AS vec FROM embeddings"
_KNN_L2 = _knn(_VECTORS, _VECTORS)
_DOCUMENT_VECTORS = _encoded("documents", "doc_id", "text")
_WEIGHTED = """list_transform({v}, lambda x, d: x / sqrt(d::DOUBLE))"""
_LONG = """SELECT id AS item_id, (unnest(range(len(vec))))::BIGINT AS dimension,
         round(unnest(vec)::DOUBLE, 6) AS value"""

_SEARCH = f"""
  SELECT k.query_id, k.rank, k.item_id AS product_id,
         concat_ws(' ', d.lang, d.source) AS product_name, d.text AS product_description, k.score
  FROM ({_knn(_encoded("benchmark", "item_id", "text"), _DOCUMENT_VECTORS)}) k
  JOIN documents d ON d.doc_id = k.item_id
"""

_CHANGED = """
  SELECT doc_id, concat_ws(' ', lang, source) AS name,
         CASE WHEN doc_id % 3 = 0 THEN 'changed ' || text[1:200] ELSE text END AS text
  FROM documents WHERE doc_id % 3 = 0 OR doc_id % 10 <> 7
  UNION ALL SELECT -item_id - 1, 'benchmark', text FROM benchmark
"""

_CENTRES = """
  SELECT item, list_id, row_number() OVER (PARTITION BY item ORDER BY gap, list_id) AS place
  FROM (SELECT i.vec_id AS item, c.vec_id AS list_id,
               round(pow(list_distance(i.embedding::DOUBLE[], c.embedding::DOUBLE[]), 2) + 1e-13, 9) AS gap
        FROM embeddings i, embeddings c WHERE c.vec_id < 16)
"""


def _probed(nprobe: int) -> str:
    """The five best items of the lists whose centres are nearest a query."""
    return f"""
  SELECT query_id, item_id, rank, score FROM (
    SELECT query_id, item_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score, item_id) AS rank
    FROM (SELECT q.vec_id AS query_id, i.vec_id AS item_id,
                 round(pow(list_distance(q.embedding::DOUBLE[], i.embedding::DOUBLE[]), 2) + 1e-10, 6) AS score
          FROM embeddings q JOIN ({_CENTRES}) v ON v.item = q.vec_id AND v.place <= {nprobe}
          JOIN ({_CENTRES}) h ON h.list_id = v.list_id AND h.place = 1
          JOIN embeddings i ON i.vec_id = h.item))
  WHERE rank <= 5
"""


_RECALL = " UNION ALL ".join(
    f"""SELECT {n}::BIGINT AS nprobe, round(count(*) / (SELECT count(*) FROM exact), 4) AS recall
  FROM ({_probed(n)}) p SEMI JOIN exact USING (query_id, item_id)"""
    for n in (1, 4, 8)
)
_WEIGHTED_DOCUMENTS, _WEIGHTED_BENCHMARK = (
    f"""SELECT id, list_transform(vec, lambda x: CAST(x / sqrt(list_inner_product(vec, vec)) AS FLOAT)) AS vec
  FROM (SELECT id, {_WEIGHTED.format(v="vec::DOUBLE[]")} AS vec FROM ({encoded}))"""
    for encoded in (_DOCUMENT_VECTORS, _encoded("benchmark", "item_id", "text"))
)

_HELD_OUT = "CAST('0x' || md5('42:' || query_id)[1:8] AS BIGINT) % 1000000 < 200000"


def _fitted(pairs: str, sweeps: int = 150) -> str:
    """CTEs that end in ``fitted`` (w): the ridge problem under w >= 0 solved one
    coordinate at a time, in SQL."""
    return f"""
  numbered AS (SELECT row_number() OVER () AS n, q, p, score FROM {pairs}),
  terms AS (
    SELECT n, unnest(range(64)) AS d, unnest(q) * unnest(p) AS v FROM numbered
    UNION ALL SELECT n, 64, score FROM numbered),
  sums AS MATERIALIZED (
    SELECT a.d AS i, b.d AS j, sum(a.v * b.v) AS value FROM terms a JOIN terms b ON a.n = b.n
    WHERE a.d < 64 GROUP BY 1, 2),
  ridge AS (SELECT 1e-3 * sum(value) / 64 + 1e-12 AS r FROM sums WHERE i = j),
  gram AS MATERIALIZED (
    SELECT i, list(value + CASE WHEN i = j THEN r ELSE 0 END ORDER BY j) FILTER (j < 64) AS along,
           max(value) FILTER (j = 64) AS target
    FROM sums, ridge GROUP BY i),
  steps(n, w) AS (
    SELECT 0, list_transform(range(64), lambda x: 0.0::DOUBLE)
    UNION ALL
    SELECT n + 1, list_transform(w, lambda x, k: CASE WHEN k = i + 1 THEN
      greatest(0.0, x - (list_inner_product(along, w) - target) / along[i + 1]) ELSE x END)
    FROM steps JOIN gram ON i = n % 64 WHERE n < {64 * sweeps}),
  fitted AS (SELECT w FROM steps WHERE n = {64 * sweeps})"""


_REQUEST_ID = "conv_id * (SELECT max(turn) + 1 FROM conversations) + turn"

ORACLES = {
    "label_score": f"""
  SELECT product_id, label, CAST({_SCORE} AS DOUBLE) AS label_score FROM ({_LABELS})
""",
    "label_score_histogram": f"""
  SELECT CAST({_SCORE} AS DOUBLE) AS label_score, count(*) AS number_of_labels
  FROM ({_LABELS}) GROUP BY 1
""",
    "query_class_histogram": """
  SELECT role AS query_class, count(text) AS number_of_queries FROM conversations GROUP BY role
""",
    "search_text": """
  SELECT doc_id AS item_id, name AS item_name, coalesce(description, name) AS page_content,
         description IS NULL AND name IS NULL AS set_aside
  FROM (SELECT doc_id, CASE WHEN source <> 'src0' THEN concat_ws(' ', lang, source) END AS name,
               CASE WHEN lang <> 'de' THEN text END AS description
        FROM documents)
""",
    "file_roundtrip": """
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_class,
         concat_ws(' / ', p_brand, p_type) AS category_hierarchy,
         CASE WHEN p_size > 25 THEN concat('a "', p_name, '"', chr(10), 'of size ', p_size) END
           AS product_description,
         p_size::DOUBLE AS rating_count, round(p_retailprice::FLOAT::DOUBLE, 2) AS average_rating
  FROM part
""",
    "catalog_load": f"""
  SELECT l.product_id AS id, b.item_id AS query_id, l.label, CAST({_SCORE} AS DOUBLE) AS label_score,
         NULL::VARCHAR AS note, replace(b.text, chr(10), ' ') AS query,
         concat_ws(' ', d.lang, d.source) AS product_name, length(d.text) AS text_chars
  FROM ({_LABELS}) l JOIN documents d ON d.doc_id = l.product_id
  JOIN benchmark b ON b.item_id = l.product_id % (SELECT count(*) FROM benchmark)
""",
    "table_preview": """
  SELECT 'file' AS look, concat(p_partkey, chr(9), p_brand) AS seen FROM part
  UNION ALL SELECT 'column', unnest(['p_partkey bigint', 'p_brand string'])
  UNION ALL SELECT 'peek', CAST(least(10, count(*)) AS VARCHAR) FROM part
""",
    "index_quality": r"""
  SELECT count(*) AS items, count(DISTINCT doc_id) AS distinct_ids, 0::BIGINT AS null_vectors,
         0::BIGINT AS zero_vectors, 0::BIGINT AS broken_vectors, 384::BIGINT AS min_dim, 384::BIGINT AS max_dim,
         (SELECT count(*) FROM documents WHERE doc_id % 7 <> 0 AND text IS NOT NULL) AS source_items,
         count(*) = (SELECT count(*) FROM documents WHERE doc_id % 7 <> 0 AND text IS NOT NULL) AS ok,
         (SELECT count(*) FROM documents) - count(*) AS set_aside
  FROM documents WHERE doc_id % 7 <> 0 AND regexp_matches(text, '[\p{L}\p{N}]')
""",
    "judged_pairs": """
  SELECT s_suppkey AS query_id, p_partkey AS item_id, s_name AS query,
         CASE WHEN p_size > 25 THEN concat_ws(' ', p_type, p_name, p_brand) ELSE p_name END
           AS item_text,
         CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE WHEN l_returnflag = 'N' THEN 0.75::DOUBLE
              WHEN l_linestatus = 'F' THEN 0.0::DOUBLE END AS score
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
""",
    "pair_cosine": f"""
  SELECT query_id, item_id, score, round({_COSINE.format(a="q", b="p")}, 6) AS cosine
  FROM ({_JUDGED_VECTORS})
""",
    "mean_cosine_and_corr": f"""
  SELECT {_AGREEMENT}
  FROM (SELECT score, {_COSINE.format(a="q", b="p")} AS cosine FROM ({_JUDGED_VECTORS}))
""",
    "compare_models": f"""
  WITH pairs AS ({_JUDGED_VECTORS}),
  weighted AS (SELECT score, {_WEIGHTED.format(v="q")} AS q, {_WEIGHTED.format(v="p")} AS p
               FROM pairs)
  SELECT model, {_AGREEMENT}
  FROM (SELECT 'original' AS model, score, {_COSINE.format(a="q", b="p")} AS cosine FROM pairs
        UNION ALL
        SELECT 'weighted', score, {_COSINE.format(a="q", b="p")} FROM weighted)
  GROUP BY model
""",
    "text_agreement": f"""
  SELECT {_AGREEMENT}
  FROM (SELECT score, {_COSINE.format(a="q", b="p")} AS cosine
        FROM (SELECT j.score, b.vec::DOUBLE[] AS q, d.vec::DOUBLE[] AS p
              FROM ({_JUDGED_TEXTS}) j
              JOIN ({_encoded("benchmark", "item_id", "text")}) b ON b.id = j.query_id
              JOIN ({_DOCUMENT_VECTORS}) d ON d.id = j.item_id))
  WHERE cosine IS NOT NULL AND score IS NOT NULL
""",
    "fit_metric_gram": f"""
  WITH pairs AS (SELECT row_number() OVER () AS n, q, p, score FROM ({_JUDGED_VECTORS})),
  columns AS (
    SELECT n, unnest(range(64)) AS d, unnest(q) * unnest(p) AS v FROM pairs
    UNION ALL SELECT n, 64, score FROM pairs)
  SELECT a.d::BIGINT AS i, b.d::BIGINT AS j, round(sum(a.v * b.v), 6) AS value
  FROM columns a JOIN columns b ON a.n = b.n AND a.d <= b.d GROUP BY 1, 2
""",
    "fit_metric_weights": f"""
  WITH RECURSIVE pairs AS ({_JUDGED_VECTORS}), {_fitted("pairs")}
  SELECT unnest(range(64)) AS dimension, round(unnest(w), 4) AS weight FROM fitted
""",
    "tuning_comparison": f"""
  WITH RECURSIVE pairs AS (SELECT *, {_HELD_OUT} AS held_out FROM ({_JUDGED_VECTORS})),
  training AS (SELECT * FROM pairs WHERE NOT held_out), {_fitted("training")},
  moved AS (
    SELECT held_out, score, list_transform(q, lambda x, k: x * sqrt(w[k])) AS q,
           list_transform(p, lambda x, k: x * sqrt(w[k])) AS p FROM pairs, fitted),
  scored AS (
    SELECT 'original' AS model, held_out, score, {_COSINE.format(a="q", b="p")} AS cosine FROM pairs
    UNION ALL SELECT 'tuned', held_out, score, {_COSINE.format(a="q", b="p")} FROM moved)
  SELECT model, held_out, count(*) AS pairs, round(avg(cosine), 4) AS mean_cosine,
         round(corr(cosine, score), 4) AS correlation
  FROM scored WHERE cosine IS NOT NULL AND score IS NOT NULL GROUP BY model, held_out
""",
    "projection_step": f"""
  WITH map AS (
    SELECT list_transform(range(4), lambda i:
      list_transform(range(64), lambda j: 1.0::DOUBLE / (1 + (i * 7 + j) % 11))) AS m),
  moved AS (
    SELECT q, p, score, list_transform(m, lambda r: list_inner_product(r, q)) AS a,
           list_transform(m, lambda r: list_inner_product(r, p)) AS b
    FROM ({_JUDGED_VECTORS}), map),
  sized AS (
    SELECT *, list_inner_product(a, b) / sqrt(list_inner_product(a, a) * list_inner_product(b, b)) AS cosine,
           sqrt(list_inner_product(a, a)) AS la, sqrt(list_inner_product(b, b)) AS lb FROM moved),
  slopes AS (
    SELECT cosine, score, unnest(range(4)) AS i, unnest(a) AS ai, unnest(b) AS bi, la, lb, q, p FROM sized),
  cells AS (
    SELECT i, unnest(range(64)) AS j, cosine, score,
           2 * (cosine - score) * ((bi / (la * lb) - ai * cosine / (la * la)) * unnest(q)
                                 + (ai / (la * lb) - bi * cosine / (lb * lb)) * unnest(p)) AS slope
    FROM slopes)
  SELECT i, j, round(avg(slope), 6) AS value,
         round(avg(pow(cosine - score, 2)), 6) AS loss, count(*) AS pairs
  FROM cells GROUP BY i, j
""",
    "apply_metric": f"""
  {_LONG}
  FROM (SELECT id, list_transform(vec, lambda x: CAST(x / sqrt(list_inner_product(vec, vec)) AS FLOAT))
                 AS vec
        FROM (SELECT vec_id AS id, {_WEIGHTED.format(v="embedding::DOUBLE[]")} AS vec
              FROM embeddings))
""",
    "training_examples": f"""
  SELECT item_id, query, item_text, score AS label, position,
         ((position - 1) // 16)::BIGINT AS batch_id
  FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || item_id), item_id) AS position
        FROM ({_JUDGED_TEXTS}) WHERE score IS NOT NULL)
""",
    "knn_exact_l2": _KNN_L2,
    "knn_exact_cosine": _knn(_VECTORS, _VECTORS, "cosine"),
    "knn_block": _KNN_L2,
    "knn_pruned": _KNN_L2,
    "knn_lists_full": _KNN_L2,
    "knn_lists_scan": _KNN_L2,
    "knn_repeated": f"SELECT query_id % 50 AS query_id, item_id, rank, score FROM ({_KNN_L2})",
    "knn_lists_probe": _probed(4),
    "knn_lists_recall": f"WITH exact AS ({_KNN_L2}) {_RECALL}",
    "knn_tree": _KNN_L2,
    "knn_codes": _KNN_L2,
    "knn_codes_recall": f"""
  WITH exact AS ({_KNN_L2}),
  parts AS (
    SELECT vec_id, unnest(range(16)) AS part,
           unnest(list_transform(range(16), lambda p: embedding[p * 4 + 1:p * 4 + 4]::DOUBLE[])) AS piece
    FROM embeddings),
  coded AS (
    SELECT i.vec_id, i.part, c.piece AS code,
           row_number() OVER (PARTITION BY i.vec_id, i.part
                              ORDER BY list_distance(i.piece, c.piece), c.vec_id) AS place
    FROM parts i JOIN parts c ON i.part = c.part AND c.vec_id < 16),
  far AS (
    SELECT q.vec_id AS query_id, i.vec_id AS item_id, round(sum(pow(list_distance(q.piece, i.code), 2)), 9) AS gap
    FROM parts q JOIN coded i ON q.part = i.part AND i.place = 1 GROUP BY ALL),
  named AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY gap, item_id) AS place FROM far)
  SELECT n.rerank, round(count(*) / (SELECT count(*) FROM exact), 4) AS recall
  FROM named JOIN exact USING (query_id, item_id)
  JOIN (SELECT unnest([10, 20, 50])::BIGINT AS rerank) n ON named.place <= n.rerank
  GROUP BY n.rerank
""",
    "index_merge": f"""
  SELECT k.query_id, k.rank, k.item_id AS product_id, d.name AS product_name,
         d.text AS product_description, k.score
  FROM ({_knn(_encoded("benchmark", "item_id", "text"), _encoded(f"({_CHANGED})", "doc_id", "text"))}) k
  JOIN ({_CHANGED}) d ON d.doc_id = k.item_id
""",
    "tuned_search": f"""
  SELECT k.query_id, k.rank, k.item_id AS product_id,
         concat_ws(' ', d.lang, d.source) AS product_name, d.text AS product_description, k.score
  FROM ({_knn(_WEIGHTED_BENCHMARK, _WEIGHTED_DOCUMENTS)}) k
  JOIN documents d ON d.doc_id = k.item_id
""",
    "encode_hashed": f"SELECT * FROM ({_LONG} FROM ({_DOCUMENT_VECTORS})) WHERE value <> 0",
    "index_roundtrip": f"SELECT *, 2::BIGINT AS version FROM ({_LONG} FROM ({_VECTORS}))",
    "semantic_search": _SEARCH,
    "semantic_search_lists": _SEARCH,
    "requests_roundtrip": """
  SELECT conv_id, turn, 0::BIGINT AS pos, text AS query FROM conversations
""",
    "stream_search": f"""
  SELECT k.query_id AS request_id, 0::BIGINT AS pos, k.rank, k.item_id AS product_id,
         concat_ws(' ', d.lang, d.source) AS product_name, k.score
  FROM ({_knn(_encoded(f"(SELECT {_REQUEST_ID} AS request_id, text FROM conversations)",
                       "request_id", "text"), _DOCUMENT_VECTORS)}) k
  JOIN documents d ON d.doc_id = k.item_id
""",
    "request_outcomes": f"""
  SELECT {_REQUEST_ID} AS request_id,
         CASE WHEN conv_id % 7 = 0 THEN 'unreadable' WHEN turn % 5 = 0 OR text IS NULL THEN 'no query'
              ELSE 'answered' END AS outcome
  FROM conversations
""",
}
