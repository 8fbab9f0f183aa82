"""DuckDB SQL of the queries it can express, with rules and references written out."""

_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leads(n: int) -> str:
    return ", ".join(f"lead(x, {i}) OVER o" for i in range(1, n))


SUBSTRING = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), w AS (
  SELECT r, doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM d
), win AS (
  SELECT r, doc_id, p, x, concat_ws(' ', x, {_leads(13)}) AS g, lead(x, 12) OVER o IS NOT NULL AS full_window
  FROM w WINDOW o AS (PARTITION BY r ORDER BY p)
), firsts AS (
  SELECT g, min(doc_id) AS first_id FROM win WHERE full_window GROUP BY g
), marked AS (
  SELECT win.*, coalesce(max(CASE WHEN full_window AND first_id < doc_id THEN 1 ELSE 0 END)
    OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM win LEFT JOIN firsts USING (g)
), kept AS (
  SELECT r, sum(gone) AS n_removed, string_agg(x, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS kept FROM marked GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

CONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents
), dw AS (
  SELECT r, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM d
), i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, row_number() OVER () AS ir, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws
  FROM benchmark
), iw AS (
  SELECT ir, item, least(13, len(ws)) AS n, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM i
), item_windows AS (
  SELECT DISTINCT item, n, array_to_string(run[1:n], ' ') AS g FROM (
    SELECT item, n, [x, {_leads(13)}] AS run FROM iw WINDOW o AS (PARTITION BY ir ORDER BY p)
  ) WHERE run[n] IS NOT NULL
), lengths AS (
  SELECT DISTINCT n FROM item_windows
), found AS (
  SELECT r, p, runs.n, g FROM (
    SELECT r, p, n, array_to_string(run[1:n], ' ') AS g FROM (
      SELECT r, p, [x, {_leads(13)}] AS run FROM dw WINDOW o AS (PARTITION BY r ORDER BY p)
    ), lengths WHERE run[n] IS NOT NULL
  ) AS runs SEMI JOIN item_windows USING (g, n)
), hits AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, p + unnest(range(n)) AS place FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
    SELECT DISTINCT r, item FROM found JOIN item_windows USING (g, n)
  ) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(ws) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

# The references of the quality rules.
_CLASS_REFERENCES = """
  ('de', 'lower', 0.9152), ('de', 'upper', 0.0148), ('de', 'other_letter', 0.0445), ('de', 'symbol', 0.0), ('de', 'punctuation', 0.0255),
  ('en', 'lower', 0.9543), ('en', 'upper', 0.017), ('en', 'other_letter', 0.0), ('en', 'symbol', 0.0), ('en', 'punctuation', 0.0287),
  ('es', 'lower', 0.8654), ('es', 'upper', 0.0146), ('es', 'other_letter', 0.0922), ('es', 'symbol', 0.0), ('es', 'punctuation', 0.0277),
  ('fr', 'lower', 0.8509), ('fr', 'upper', 0.0129), ('fr', 'other_letter', 0.1073), ('fr', 'symbol', 0.0), ('fr', 'punctuation', 0.0289)
"""
_WORD_REFERENCES = """
  ('de', 'der', 0.0525), ('de', 'die', 0.0267), ('de', 'und', 0.0214), ('de', 'den', 0.0126), ('de', 'von', 0.0102), ('de', 'zu', 0.0088),
  ('de', 'das', 0.0081), ('de', 'mit', 0.0065), ('de', 'sich', 0.0062), ('de', 'des', 0.0055), ('de', 'auf', 0.0051), ('de', 'ist', 0.0041),
  ('de', ' ', 0.8323),
  ('en', 'the', 0.0535), ('en', 'of', 0.027), ('en', 'and', 0.0218), ('en', 'to', 0.0156), ('en', 'in', 0.0105), ('en', 'is', 0.009),
  ('en', 'that', 0.008), ('en', 'it', 0.0067), ('en', 'for', 0.0062), ('en', 'on', 0.0052), ('en', 'was', 0.0056), ('en', 'as', 0.0039),
  ('en', ' ', 0.8269),
  ('es', 'de', 0.0537), ('es', 'la', 0.0269), ('es', 'que', 0.02), ('es', 'el', 0.014), ('es', 'en', 0.0125), ('es', 'y', 0.0099),
  ('es', 'los', 0.0086), ('es', 'se', 0.0071), ('es', 'del', 0.0058), ('es', 'las', 0.0076), ('es', 'un', 0.0054), ('es', 'por', 0.0051),
  ('es', ' ', 0.8233),
  ('fr', 'de', 0.0537), ('fr', 'la', 0.0284), ('fr', 'le', 0.0202), ('fr', 'et', 0.0144), ('fr', 'les', 0.0121), ('fr', 'des', 0.0107),
  ('fr', 'en', 0.0102), ('fr', 'un', 0.0081), ('fr', 'du', 0.007), ('fr', 'une', 0.0058), ('fr', 'que', 0.0052), ('fr', 'est', 0.0046),
  ('fr', ' ', 0.8195)
"""
_DIVERGENCE = "sqrt(greatest(0, sum(CASE WHEN s > 0 THEN s * log2(2 * s / (s + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (s + q)) ELSE 0 END) / 2))"


def _class(name: str, others: str) -> str:
    return f"SELECT r, '{name}' AS bin, length(regexp_replace(t, '{others}', '', 'g')) AS n FROM d"


QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM (SELECT r, regexp_extract_all(t, '{_WORD}') AS ws FROM d)
), runs AS (
  SELECT r, p, concat_ws(' ', x, {_leads(3)}) AS g, lead(x, 2) OVER o IS NOT NULL AS full_run
  FROM w WINDOW o AS (PARTITION BY r ORDER BY p)
), again AS (
  SELECT r, p, (full_run AND count(*) OVER (PARTITION BY r, g, full_run) > 1)::INT AS b FROM runs
), covered AS (
  SELECT r, max(b) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM again
), words AS (
  SELECT r, count(*) AS n_words, sum(c)::BIGINT AS n_repeat_words FROM covered GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{_WORD}') GROUP BY r
), classes AS (
  {_class("lower", "[^a-z]")} UNION ALL {_class("upper", "[^A-Z]")} UNION ALL {_class("other_letter", "[\\x00-\\x7F]")}
  UNION ALL {_class("symbol", "[^#*$%&|<>]")} UNION ALL {_class("punctuation", "[\\x20\\x09-\\x0Da-zA-Z0-9#*$%&|<>]|[^\\x00-\\x7F]")}
), class_shares AS (
  SELECT r, bin, n / greatest(sum(n) OVER (PARTITION BY r), 1) AS s FROM classes
), class_refs(lang, bin, q) AS (VALUES {_CLASS_REFERENCES}
), class_distances AS (
  SELECT r, min(v) AS class_distance FROM (
    SELECT r, lang, {_DIVERGENCE} AS v FROM class_shares JOIN class_refs USING (bin) GROUP BY r, lang
  ) GROUP BY r
), word_refs(lang, bin, q) AS (VALUES {_WORD_REFERENCES}
), common AS (
  SELECT r, lower(x) AS bin, count(*) AS n FROM w WHERE lower(x) IN (SELECT bin FROM word_refs) GROUP BY r, lower(x)
), own AS (
  SELECT r, lang, word_refs.bin, q, coalesce(n, 0) / greatest(n_words, 1) AS s
  FROM words JOIN word_refs ON word_refs.bin <> ' ' LEFT JOIN common USING (r, bin)
), word_shares AS (
  SELECT r, lang, bin, q, s FROM own
  UNION ALL
  SELECT r, lang, ' ', any_value(rest.q), 1.0 - sum(s) FROM own JOIN (SELECT lang, q FROM word_refs WHERE bin = ' ') AS rest USING (lang) GROUP BY r, lang
), word_distances AS (
  SELECT r, min(v) AS word_distance FROM (SELECT r, lang, {_DIVERGENCE} AS v FROM word_shares GROUP BY r, lang) GROUP BY r
), rules AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(class_distance, 0) AS class_distance, coalesce(word_distance, 0) AS word_distance
  FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN class_distances USING (r) LEFT JOIN word_distances USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT (word_chars >= 200 AND class_distance > 0.15) AND NOT (n_words >= 200 AND word_distance > 0.29) AS kept
FROM rules
"""

TRIE = """
WITH c AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), k AS (
  SELECT conv_id, ts, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda crc, b:
    list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295::BIGINT), 4294967295) % 9 AS h
  FROM c
), f AS (
  SELECT k.conv_id, list_concat(coalesce(b.ts[1:k.h], []), coalesce(k.ts[k.h + 1:], [])) AS ts
  FROM k LEFT JOIN k AS b ON b.conv_id = k.conv_id - k.conv_id % 5
), p AS (
  SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS depth FROM f
), nodes AS (
  SELECT ts[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(ts) = depth) AS ends
  FROM p GROUP BY node, depth
), links AS (
  SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), sizes AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[depth].t) END AS own
  FROM nodes LEFT JOIN links USING (node, depth)
), below AS (
  SELECT node[1:up] AS node, up AS depth, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM (SELECT node, own, n_children, unnest(range(depth + 1)) AS up FROM sizes) GROUP BY ALL
)
SELECT s.conv_id, s.depth, parent.conv_id AS parent_conv_id, s.n_convs, s.n_children, n_leaves, saved_tokens,
  sha256(coalesce(s.ends, '')) AS ends_sha256
FROM sizes AS s JOIN below USING (node, depth) LEFT JOIN nodes AS parent ON s.depth > 0 AND parent.depth = s.depth - 1 AND parent.node = s.node[1:s.depth - 1]
"""

SQL = {
    "op1_substring_dedup": SUBSTRING,
    "op3_benchmark_decontamination": CONTAMINATION,
    "op6_quality_rules": QUALITY,
    "op12_conversation_trie": TRIE,
}
