"""The queries of this folder that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from shelfmark.llm import license_scan, line_dedup, near_dedup, prefix_trie, quality, repeats

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACED = r"[^\x20\x09-\x0D]+"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _line_dedup() -> str:
    s = line_dedup.Settings()
    return rf"""
WITH RECURSIVE rows AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(range(len(lines))) AS line, unnest(lines) AS words FROM rows),
parsed AS (
  SELECT doc_id, line,
    regexp_extract_all(regexp_replace(words, '[^ \t-\r]*[0-9][^ \t-\r]*', '{line_dedup.WILD}', 'g'),
                       '{_SPACED}') AS tokens
  FROM line),
said AS (SELECT *, len(tokens) AS n, tokens[1:{s.depth}] AS lead FROM parsed
  WHERE len(tokens) > 0
    AND len(list_filter(tokens, lambda t: t <> '{line_dedup.WILD}')) >= {s.constant} * len(tokens)),
shapes AS (
  SELECT n, lead, tokens, row_number() OVER (ORDER BY count(*) DESC, min({{'d': doc_id, 'l': line}})) AS rank,
    n - ceil({s.similarity} * n)::INT + 1 AS bands
  FROM said WHERE n >= {s.min_tokens} GROUP BY n, lead, tokens),
banded AS (
  SELECT *, unnest(range(bands)) AS band, tokens[{s.depth + 1}:] AS rest FROM shapes),
keyed AS (
  SELECT n, lead, tokens, rank, band,
    list_filter(rest, lambda t, i: (i - 1) % bands = band) AS held FROM banded
  UNION ALL
  SELECT n, lead, tokens, rank, -band - 1, list_filter(rest, lambda t, i: (i - 1) % bands <> band)
  FROM banded WHERE bands > 2),
heads AS (
  SELECT tokens, rank, min(rank) OVER (PARTITION BY n, lead, band, held) AS head FROM keyed),
met AS (SELECT DISTINCT tokens, rank, head FROM heads WHERE head < rank),
up AS (
  SELECT met.rank, min(met.head) AS head FROM met JOIN shapes m ON m.rank = met.head
  WHERE len(list_filter(range(1, m.n + 1), lambda i: met.tokens[i] = m.tokens[i])) >= {s.similarity} * m.n
  GROUP BY met.rank),
chase AS (
  SELECT rank, head FROM up
  UNION ALL
  SELECT chase.rank, up.head FROM chase JOIN up ON chase.head = up.rank),
roots AS (SELECT rank, min(head) AS root FROM chase GROUP BY rank),
placed AS (
  SELECT doc_id, line, s.n, coalesce(root, shapes.rank) AS template, CASE WHEN shapes.rank IS NULL THEN s.tokens END AS short
  FROM said s LEFT JOIN shapes ON s.n = shapes.n AND s.lead = shapes.lead AND s.tokens = shapes.tokens
  LEFT JOIN roots USING (rank)),
recurring AS (
  SELECT template, short, min({{'d': doc_id, 'l': line}}) AS first FROM placed
  GROUP BY template, short
  HAVING count(DISTINCT doc_id) >= CASE WHEN min(n) < {s.min_tokens} THEN {s.short_documents} ELSE {s.min_documents} END),
drops AS (
  SELECT p.doc_id, list(p.line) AS dropped FROM placed p
  JOIN recurring r ON p.template IS NOT DISTINCT FROM r.template AND p.short IS NOT DISTINCT FROM r.short
  WHERE {{'d': p.doc_id, 'l': p.line}} <> r.first GROUP BY p.doc_id),
cut AS (
  SELECT doc_id, len(lines) AS n_lines, coalesce(len(dropped), 0) AS n_dropped,
    CASE WHEN dropped IS NULL THEN text ELSE coalesce(array_to_string(
      list_transform(list_filter(range(len(lines)), lambda i: NOT list_contains(dropped, i)), lambda i: lines[i + 1]),
      chr(10)), '') END AS kept
  FROM rows LEFT JOIN drops USING (doc_id))
SELECT doc_id, n_lines, n_dropped, length(kept) AS kept_chars, md5(kept) AS kept_md5 FROM cut"""


def _license_scan() -> str:
    s = license_scan.Settings()
    listed = [(p, label, True) for p, label in license_scan.PHRASES.items()]
    listed += [(p, label, False) for p, label in license_scan.NOTICES.items()]
    rows = []
    for number, (phrase, label, base) in enumerate(listed):
        words = phrase.split()
        for at in range(len(words) - 1):
            rows.append(f"({number}, '{label}', {base}, {len(words) - 1}, {at}, '{words[at]} {words[at + 1]}')")
    return rf"""
WITH templates(template, label, base, grams, spot, gram) AS (VALUES {", ".join(rows)}),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
g AS (SELECT doc_id, unnest(range(len(words) - 1)) AS place,
  unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS gram FROM w WHERE len(words) > 1),
votes AS (
  SELECT doc_id, template, label, base, grams, place - spot AS diagonal, list(DISTINCT spot) AS found, min(place) AS start
  FROM g JOIN templates USING (gram) GROUP BY ALL),
gaps AS (
  SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {s.drift} AS apart
  FROM votes WHERE NOT base),
spans AS (
  SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM gaps),
found AS (
  SELECT doc_id, label, base, start, 1.0::DOUBLE AS coverage FROM votes WHERE base AND len(found) = grams
  UNION ALL
  SELECT doc_id, label, base, min(start), len(list_distinct(flatten(list(found)))) / grams
  FROM spans GROUP BY doc_id, template, label, base, grams, span
  HAVING len(list_distinct(flatten(list(found)))) >= {s.coverage} * grams),
per AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score,
    count(*) FILTER (NOT base) AS notices
  FROM found GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score,
  coalesce(notices, 0) AS notices
FROM w LEFT JOIN per USING (doc_id)"""


def _quality() -> str:
    failed = []
    for rule in quality.RULES:
        bounds = []
        if rule.least is not None:
            bounds.append(f"{rule.measure} < {rule.least}")
        if rule.most is not None:
            bounds.append(f"{rule.measure} > {rule.most}")
        failed.append(f"CASE WHEN {' OR '.join(bounds)} THEN '{rule.measure}' END")
    window = quality.WINDOW
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_SPACED}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - {window - 2})) AS place,
    unnest(list_transform(range(1, len(words) - {window - 2}), lambda i: words[i : i + {window - 1}])) AS said
  FROM w WHERE len(words) >= {window}),
again AS (SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, said) > 1),
covered AS (SELECT DISTINCT doc_id, place + k AS place FROM again, range({window}) AS r(k)),
repeats AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, len(words) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(text) - length(translate(text, '{quality._SYMBOLS}', '')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: lower(x) IN ({_quoted(quality.STOP_WORDS)}))) AS n_stop_words,
    len(lines) AS n_lines, length(text) - length(replace(text, '!', '')) AS n_shouts
  FROM w LEFT JOIN repeats USING (doc_id)),
measured AS (
  SELECT *, word_chars / greatest(n_words, 1) AS mean_word_length, n_symbols / greatest(n_words, 1) AS symbols_per_word,
    n_shouts / greatest(n_words, 1) AS shouting, n_stop_words / greatest(n_words, 1) AS stop_word_share,
    n_dup_lines / greatest(n_lines, 1) AS duplicate_line_share,
    n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts),
judged AS (SELECT *, concat_ws(',', {", ".join(failed)}) AS failed_rules FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged"""


def _near() -> str:
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_SPACED}') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 1 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingle
  FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= {near_dedup.SIMILAR_PERCENT} * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.other FROM reached r JOIN edges e ON e.a = r.doc_id),
groups AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM groups LEFT JOIN n USING (doc_id)"""


def _repeats() -> str:
    n = repeats.WINDOW
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS said FROM documents),
sized AS (SELECT *, length(said) // 2 AS n_bytes FROM texts),
-- In pieces of 500 bytes and what their last window needs: cutting near the end of a long text is slow.
numbers AS (SELECT row, said, unnest(range((n_bytes + 499) // 500)) AS piece FROM sized WHERE n_bytes >= {n}),
pieces AS (SELECT row, piece, said[1000 * piece + 1:1000 * piece + {1000 + 2 * n - 2}] AS said FROM numbers),
starts AS (SELECT row, piece, said, unnest(range(least(500, length(said) // 2 - {n - 1}))) AS i FROM pieces),
windows AS (SELECT row, 500 * piece + i AS i, md5_number(said[2 * i + 1:2 * i + {2 * n}]) AS part FROM starts),
again AS (SELECT part FROM windows GROUP BY part HAVING count(*) > 1),
covered AS (
  SELECT row, i, i > coalesce(lag(i) OVER (PARTITION BY row ORDER BY i), -{n} - 1) + {n} AS opens
  FROM windows SEMI JOIN again USING (part)),
numbered AS (SELECT row, i, sum(opens::INT) OVER (PARTITION BY row ORDER BY i) AS span FROM covered),
spans AS (SELECT row, min(i) AS first, max(i) + {n} AS last FROM numbered GROUP BY row, span),
gaps AS (
  SELECT row, coalesce(lag(last) OVER (PARTITION BY row ORDER BY first), 0) AS first, first AS last FROM spans
  UNION ALL SELECT row, max(last), NULL FROM spans GROUP BY row),
kept AS (
  SELECT row, string_agg(said[2 * first + 1:2 * coalesce(last, n_bytes)], '' ORDER BY first) AS said
  FROM gaps JOIN sized USING (row) GROUP BY row),
removed AS (SELECT row, sum(last - first)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.said, sized.said))) AS kept_sha256
FROM sized LEFT JOIN removed USING (row) LEFT JOIN kept USING (row)"""


def _trie() -> str:
    t = prefix_trie
    return rf"""
WITH said AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
counted AS (SELECT conv_id, conv_id::VARCHAR AS digits, count(*) AS own FROM said GROUP BY conv_id),
crc AS (
  SELECT conv_id, own, conv_id - conv_id % {t.FAMILY} AS first,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(digits) + 1), lambda i: ascii(digits[i])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT)
      % {t.TAKEN} AS h
  FROM counted),
convs AS (
  SELECT c.conv_id, c.first, c.h, least(c.h, coalesce(f.own, 0)) AS m
  FROM crc c LEFT JOIN counted f ON f.conv_id = c.first),
rebuilt AS (
  SELECT c.conv_id, s.place, s.role, s.text FROM convs c JOIN said s ON s.conv_id = c.first AND s.place < c.h
  UNION ALL
  SELECT c.conv_id, c.m + s.place - c.h, s.role, s.text
  FROM convs c JOIN said s ON s.conv_id = c.conv_id AND s.place >= c.h),
below AS (
  SELECT conv_id, place + 1 AS depth, strlen(text) AS bytes,
    md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY place)) AS node FROM rebuilt),
members AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
    max(depth) OVER (PARTITION BY conv_id) AS length
  FROM (SELECT conv_id, depth, bytes, node FROM below UNION ALL SELECT conv_id, 0, 0, '' FROM convs)),
grouped AS (
  SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, count(*) AS n_convs, min(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n FROM grouped WHERE parent IS NOT NULL GROUP BY parent),
nodes AS (
  SELECT g.*, coalesce(c.n, 0) AS n_children, (g.n_convs - 1) * g.bytes AS saved
  FROM grouped g LEFT JOIN children c USING (node)),
sums AS (
  SELECT a.node, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(w.saved) AS saved_tokens
  FROM nodes w JOIN members a ON a.conv_id = w.conv_id AND a.depth <= w.depth GROUP BY a.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = n.parent"""


ORACLES = {
    "op1_line_dedup": _line_dedup(),
    "op2_license_scan": _license_scan(),
    "op6_quality": _quality(),
    "op7_lsh_forest": _near(),
    "op11_repeats": _repeats(),
    "op13_prefix_trie": _trie(),
}
