"""Registered queries of this subpackage, each over the whole of its tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetgrain.llm import (
    centroid_walk,
    decontaminate,
    exact_dedup,
    host_boilerplate,
    jaccard_groups,
    language_pieces,
    line_crf,
    mixing,
    personal_data,
    prefix_trie,
    quality_rules,
    token_files,
    url_rules,
)
from fleetgrain.llm.common import prepare, table

TOKENIZER = "word_bpe_49k.json"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("broken_rules")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), pieces AS (
  SELECT doc_id, first, array_to_string(w[first:first + 7], ' ') AS piece
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS first FROM d WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, first FROM pieces QUALIFY count(*) OVER (PARTITION BY doc_id, piece) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(generate_series(first, first + 7)) AS place FROM twice) GROUP BY doc_id
), counts AS (
  SELECT doc_id, lang, w, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x))) AS n_capitals,
         len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])) AS n_same,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id)
), measured AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM counts
), levels AS (
  SELECT doc_id, lang, unnest([
    {'rule': 'symbols', 'part': n_symbols, 'whole': word_chars}, {'rule': 'bangs', 'part': n_bangs, 'whole': n_words},
    {'rule': 'capitals', 'part': n_capitals, 'whole': n_words}, {'rule': 'dup_lines', 'part': n_dup_lines, 'whole': len(lines)},
    {'rule': 'repeats', 'part': n_repeat_words, 'whole': n_words}, {'rule': 'stutter', 'part': n_same, 'whole': n_words}], recursive := true)
  FROM measured
), leveled AS (
  SELECT doc_id, lang, rule, CASE WHEN whole > 0 THEN least(100, 100 * part // whole) ELSE 0 END AS level FROM levels
), marks AS (
  SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), held AS (
  SELECT lang, rule, min(level) AS level, bool_and(good) AS good
  FROM leveled JOIN marks USING (doc_id) JOIN (SELECT doc_id, t FROM d) USING (doc_id) GROUP BY lang, rule, t
), strata AS (
  SELECT lang, rule, count(*) FILTER (good) AS n FROM held GROUP BY ALL
), tried AS (
  SELECT s.lang, s.rule, s.n, cutoff, count(*) FILTER (good AND level > cutoff) AS false_rejects,
         count(*) FILTER (NOT good AND level > cutoff) AS caught
  FROM strata s CROSS JOIN range(100) c(cutoff) JOIN held h ON h.rule = s.rule AND h.lang IS NOT DISTINCT FROM s.lang GROUP BY ALL
), tested AS (
  SELECT *, n = 0 OR false_rejects >= n OR list_sum(list_transform(range(0, false_rejects + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01e0) + (n - i) * ln(0.99e0))))
      > 0.05e0 / (SELECT count(*) FROM strata) AS fails
  FROM tried
), certified AS (
  SELECT *, max(CASE WHEN fails THEN cutoff ELSE -1 END) OVER (PARTITION BY lang, rule) AS last_failure FROM tested
), chosen AS (
  SELECT lang, rule, arg_max(cutoff, (caught - 20 * false_rejects) * 1000 + cutoff) AS cutoff
  FROM certified WHERE cutoff > last_failure AND caught > 20 * false_rejects GROUP BY lang, rule
), broken AS (
  SELECT DISTINCT doc_id FROM leveled l JOIN chosen c ON c.rule = l.rule AND c.lang IS NOT DISTINCT FROM l.lang AND level > cutoff
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM based
"""


PIECES = "piece_bpe_32k.model"


def op2_language_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return language_pieces.predict(docs, language_pieces.learn(docs, public_tokenizers.path(PIECES)))


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.apply_rules(table(spark, sf_dir, "pages"), rules)


OP3_SQL = """
WITH urls AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, split_part(split_part(rest, '#', 1), '?', 1) AS rest FROM urls
), parts AS (
  SELECT page_id, split_part(rest, '/', 1) AS raw_host,
         translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(split_part(rest, '/', 1)) + 1) AS path
  FROM cut
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return line_crf.score(docs, *line_crf.learn(docs, table(spark, sf_dir, "labels")))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_files.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_groups.cluster(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[first:first + 4], ' ') AS piece
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS first
        FROM doc_words WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
  FROM shingles x JOIN shingles y ON x.piece = y.piece AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM doc_words
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("starts", "ends")


OP7_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[first:first + size - 1], ' ') AS piece
  FROM (SELECT item_id, words, least(len(words), 10) AS size,
          unnest(generate_series(1, greatest(1, len(words) - 9))) AS first FROM item_words WHERE len(words) > 0)
), sizes AS (
  SELECT DISTINCT size FROM item_windows
), doc_windows AS (
  SELECT doc_id, size, first, array_to_string(words[first:first + size - 1], ' ') AS piece
  FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS first
        FROM doc_words, sizes WHERE len(words) >= size)
), hits AS (
  SELECT doc_id, size, first, item_id FROM doc_windows JOIN item_windows USING (size, piece)
), hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(first, first + size - 1)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return personal_data.scan(table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_host_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return host_boilerplate.extract(table(spark, sf_dir, "pages"))


def op11_centroid_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return centroid_walk.cluster(table(spark, sf_dir, "embeddings"))[0]


def _op11_round(n: int) -> str:
    return f"""
, near{n} AS (
  SELECT nth, vec_id, v, min({{'d': list_sum(list_transform(generate_series(1, 64), lambda i: (v[i] - c[i]) * (v[i] - c[i]))), 'k': cluster}}) AS best
  FROM kept, cents{n} GROUP BY nth, vec_id, v
), sums{n} AS (
  SELECT k, dim, sum(x) AS total, count(*) AS n FROM (
    SELECT best.k AS k, unnest(generate_series(1, 64)) AS dim, unnest(v) AS x FROM near{n}) GROUP BY k, dim
), moved{n} AS (
  SELECT k, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY dim) AS c FROM sums{n} GROUP BY k
), cents{n + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(moved{n}.c, cents{n}.c) AS c FROM cents{n} LEFT JOIN moved{n} ON k = cluster
)"""


OP11_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS nth, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), cents0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v AS c
  FROM (SELECT v, sha256('1:' || vec_id) AS h FROM kept ORDER BY h, v LIMIT 16)
){"".join(map(_op11_round, range(4)))}
, assigned AS (
  SELECT vec_id, best.k::INTEGER AS cluster, best.d::BIGINT AS distance FROM near3
)
SELECT vec_id, a.cluster, distance, sum(distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM assigned a JOIN cents3 ON cents3.cluster = a.cluster
"""


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.judge(table(spark, sf_dir, "documents"), all_digests=True)


OP12_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t)::BIGINT AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


# the unsigned crc32 is folded bit by bit over steps: a byte to mix in, or -1 for one shift
OP13_SQL = r"""
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), steps AS (
  SELECT conv_id, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM own
), hashed AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], steps), lambda c, s:
    CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) % 4 AS h FROM steps
), rebuilt AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(o.turns, h + 1, len(o.turns))) AS turns
  FROM own o JOIN hashed USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), prefixes AS (
  SELECT conv_id, len(turns) AS size, d, list_slice(turns, 1, d) AS prefix
  FROM (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS d FROM rebuilt)
), nodes AS (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM prefixes GROUP BY d, prefix
), measured AS (
  SELECT *, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(prefix[-1].x, '[^ 	-
]+')) END AS words,
         CASE WHEN d = 0 THEN NULL ELSE list_slice(prefix, 1, d - 1) END AS up
  FROM nodes
), families AS (
  SELECT up, count(*) AS n_children FROM measured WHERE d > 0 GROUP BY up
), counted AS (
  SELECT m.*, coalesce(n_children, 0) AS n_children FROM measured m LEFT JOIN families f ON f.up = m.prefix
), ancestors AS (
  SELECT list_slice(prefix, 1, k) AS prefix, n_children, n_convs, words
  FROM (SELECT *, unnest(generate_series(0, d)) AS k FROM counted)
), below AS (
  SELECT prefix, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM ancestors GROUP BY prefix
)
SELECT c.conv_id, c.d::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN below USING (prefix) LEFT JOIN nodes p ON p.prefix = c.up
"""


QUERIES = {
    "op1_quality_rules": (op1_quality_rules, OP1_SQL),
    "op2_language_pieces": (op2_language_pieces, None),
    "op3_url_rules": (op3_url_rules, OP3_SQL),
    "op4_line_crf": (op4_line_crf, None),
    "op5_token_files": (op5_token_files, None),
    "op6_jaccard_groups": (op6_jaccard_groups, OP6_SQL),
    "op7_decontamination": (op7_decontamination, OP7_SQL),
    "op8_personal_data": (op8_personal_data, None),
    "op9_source_mix": (op9_source_mix, None),
    "op10_host_boilerplate": (op10_host_boilerplate, None),
    "op11_centroid_walk": (op11_centroid_walk, OP11_SQL),
    "op12_exact_dedup": (op12_exact_dedup, OP12_SQL),
    "op13_prefix_trie": (op13_prefix_trie, OP13_SQL),
}
