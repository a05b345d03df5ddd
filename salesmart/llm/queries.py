"""The queries of this package over the test tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.llm import (
    conversation_trie,
    decontaminate,
    language_id,
    line_dedup,
    merkle,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    suffix_dedup,
    url_filter,
)
from salesmart.llm.common import Run, table
from salesmart.session import scratch_path

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def register(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


@register
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, n, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
        FROM documents)
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, n, line, coalesce(keeper > doc_id, false) AS dropped
  FROM lines LEFT JOIN frequent USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@register
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_documents(table(spark, sf_dir, "documents"), scratch_path(spark, "blob-ledger"))
    return secret_scan.digest(found)


@register
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@register
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@register
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


@register
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


@register
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_strings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.learn(docs, table(spark, sf_dir, "labels")))


@register
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", "verified"
    )


@register
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


_STRIPPED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op1_substring_dedup"] = f"""
WITH docs AS (SELECT doc_id, {_STRIPPED} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS key
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM docs)
), later AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM later
), kept AS (
  SELECT d.doc_id, d.i, d.word, g.i IS NULL AS stays
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs) d
  LEFT JOIN gone g USING (doc_id, i)
), joined AS (
  SELECT doc_id, count(*) FILTER (NOT stays) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (stays) AS text
  FROM kept GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(joined.text, '')) AS kept_sha256
FROM docs LEFT JOIN joined USING (doc_id)
"""


def _rule_sql(rank: int, rule: secret_scan.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, n, hits, secret[n] AS secret,
         list_sum(list_transform(gaps[:n], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:n - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, hits, secret, gaps, unnest(generate_series(1, len(hits))) AS n
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS hits,
                     regexp_extract_all(coalesce(text, ''), '{pattern}', {rule.group}) AS secret,
                     string_split_regex(coalesce(text, ''), '{pattern}') AS gaps
              FROM documents))
  WHERE length(secret[n]) >= {rule.min_chars}"""


SQL["op3_secret_scan"] = f"""
WITH found AS ({' UNION ALL '.join(_rule_sql(i, r) for i, r in enumerate(secret_scan.RULES))}
), spans AS (
  SELECT doc_id, rank, kind, start, kind || ':' || start::BIGINT || ':' || (start + length(hits[n]))::BIGINT AS span FROM found
), joined AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b,
         count(*) FILTER (kind = 'hex') AS c,
         string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)
"""

SQL["op4_quality_rules"] = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, {_STRIPPED} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS key
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM docs)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1))
  GROUP BY doc_id
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, greatest(len(lines), 1) AS n_lines,
         length(t) - length(translate(t, '!', '')) AS n_bangs,
         len(list_filter(string_split_regex({_LOWER.format('t')}, '[\\x20\\x09-\\x0D.,!?;:]+'),
                         lambda x: x IN ({', '.join(f"'{x}'" for x in quality_rules.STOP_WORDS)}))) AS n_stop_words
  FROM docs LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.1 AND n_stop_words / n_words >= 0.02
       AND n_dup_lines / n_lines <= 0.5 AND n_bangs / n_words <= 0.25 AS kept
FROM counts
"""

SQL["op8_decontaminate"] = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, w, least(len(w), 10) AS n
  FROM (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark)
  WHERE len(w) > 0
), grams AS (
  SELECT DISTINCT n, item_id, array_to_string(w[i : i + n - 1], ' ') AS key
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM items)
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM docs, (SELECT DISTINCT n FROM items))
), found AS (SELECT doc_id, n, i, item_id FROM places JOIN grams USING (n, key)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id
), names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""

# CRC-32 of a decimal number, bit by bit.
_CRC32 = """xor(list_reduce(list_transform(string_split({}::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
  list_reduce(range(8), lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END, xor(c, b)),
  4294967295), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LEVEL = """
  SELECT tree, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {}) WHERE n > 1 GROUP BY tree, level, pos // 8"""

SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, leaf, other, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (SELECT doc_id, lang, {_leaf('text')} AS leaf,
               CASE WHEN {_CRC32.format('doc_id')} % 3 = 0 THEN {_leaf(_LOWER.format('text'))} END AS other
        FROM documents)
), low AS (
  SELECT tree, 0 AS level, pos, leaf AS h FROM leaves UNION ALL {_LEVEL.format('low')}
), subroots AS (SELECT tree, max(level) AS levels, arg_max(h, level) AS subroot FROM low GROUP BY tree),
high AS (
  SELECT 0 AS tree, 0 AS level, tree AS pos, subroot AS h FROM subroots UNION ALL {_LEVEL.format('high')}
), root AS (SELECT max(level) AS levels, arg_max(h, level) AS root FROM high),
steps AS (
  SELECT tree, pos, unnest(generate_series(0, levels - 1)) AS step, false AS top FROM leaves JOIN subroots USING (tree)
  UNION ALL
  SELECT l.tree, l.pos, unnest(generate_series(s.levels, s.levels + root.levels - 1)), true
  FROM leaves l JOIN subroots s USING (tree), root
), places AS (
  SELECT t.tree, t.pos, t.step, top, CASE WHEN top THEN 0 ELSE t.tree END AS in_tree,
         CASE WHEN top THEN t.step - s.levels ELSE t.step END AS level,
         CASE WHEN top THEN t.tree ELSE t.pos END // pow(8, CASE WHEN top THEN t.step - s.levels ELSE t.step END)::BIGINT AS at
  FROM steps t JOIN subroots s USING (tree)
), nodes AS (SELECT false AS top, * FROM low UNION ALL SELECT true, * FROM high),
siblings AS (
  SELECT p.tree, p.pos, p.step, coalesce(string_agg(h, '' ORDER BY n.pos) FILTER (n.pos < p.at), '') AS lefts,
         coalesce(string_agg(h, '' ORDER BY n.pos) FILTER (n.pos > p.at), '') AS rights
  FROM places p JOIN nodes n ON n.top = p.top AND n.tree = p.in_tree AND n.level = p.level AND n.pos // 8 = p.at // 8
  GROUP BY p.tree, p.pos, p.step
), proofs AS (
  SELECT tree, pos, string_agg(lefts || rights, '' ORDER BY step) AS proof FROM siblings GROUP BY tree, pos
), folded AS (
  SELECT tree, pos, 0 AS step, coalesce(other, leaf) AS h FROM leaves
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, sha256(lefts || f.h || rights)
  FROM folded f JOIN siblings s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step
), ends AS (SELECT tree, pos, arg_max(h, step) AS folded_root FROM folded GROUP BY tree, pos)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (tree, pos) LEFT JOIN proofs USING (tree, pos), root
"""

SQL["op13_conversation_trie"] = f"""
WITH turns AS (
  SELECT conv_id, list({{'k': sha256(coalesce(role, '') || chr(0) || coalesce(text, '')), 'n': length(coalesce(text, ''))}}
                       ORDER BY turn NULLS FIRST, role, text) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (SELECT conv_id, own, {_CRC32.format('conv_id')} % 6 AS h FROM turns),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(f.own[:h], []), c.own[h + 1 :]) AS seq
  FROM heads c LEFT JOIN turns f ON f.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
  SELECT conv_id, depth, len(seq) = depth AS ends, CASE WHEN depth > 0 THEN seq[depth].n ELSE 0 END AS n,
         array_to_string(list_transform(seq[:depth], lambda t: t.k), '') AS key
  FROM (SELECT conv_id, seq, unnest(generate_series(0, len(seq))) AS depth FROM whole)
), nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS own,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends
  FROM prefixes GROUP BY key, depth
), families AS (
  SELECT c.*, p.conv_id AS parent_conv_id, count(k.key) AS n_children
  FROM nodes c LEFT JOIN nodes p ON c.depth = p.depth + 1 AND left(c.key, 64 * p.depth) = p.key
       LEFT JOIN nodes k ON k.depth = c.depth + 1 AND left(k.key, 64 * c.depth) = c.key
  GROUP BY ALL
), sums AS (
  SELECT left(key, 64 * up) AS key, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(generate_series(0, depth)) AS up FROM families) GROUP BY 1, 2
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
       sha256(ends) AS ends_sha256
FROM families JOIN sums USING (key, depth)
"""
