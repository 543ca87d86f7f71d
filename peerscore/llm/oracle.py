"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from peerscore.llm.quality_rules import BASE, POLICIES, RULES, mask

WORDS = r"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _rules() -> str:
    bits = " + ".join(
        f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values())
    )
    return f"CAST({bits} AS BIGINT)"


ORACLE: dict[str, str] = {
    "op1_quality_rules": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         {WORDS.format(text="text")} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: length(translate(x, {BLANKS}, '')) > 0) AS lines
  FROM documents
), each AS (
  SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs
), runs AS (
  SELECT r, i, w, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c, lead(w, 3) OVER o AS d,
         lead(w, 4) OVER o AS e
  FROM each WINDOW o AS (PARTITION BY r ORDER BY i)
), counted AS (
  SELECT r, i, e IS NOT NULL AND count(*) OVER (PARTITION BY r, w, b, c, d, e) > 1 AS again FROM runs
), covered AS (
  SELECT r, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit
  FROM counted
), repeated AS (
  SELECT r, count(*) FILTER (WHERE hit) AS n FROM covered GROUP BY r
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(translate(text, {BLANKS}, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals
  FROM docs LEFT JOIN repeated USING (r)
), ledger AS (SELECT *, {_rules()} AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & {mask(BASE)}) <> 0 AS base_failed,
       (failed & {mask(POLICIES["v1"])}) = 0 AS kept, failed
FROM ledger
""",
    "op2_ngram_jaccard_join": f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {WORDS.format(text=LOWER.format(text="text"))} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) >= 5 THEN
      list_transform(range(1, CAST(len(w) - 3 AS BIGINT)), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM docs
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
""",
    "op4_mixing": f"""
WITH docs AS (
  SELECT doc_id, source, CAST(len({WORDS.format(text="text")}) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || coalesce(text, '')) AS h
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INT)]
                 AS DOUBLE) AS weight FROM sizes
), ranked AS (
  SELECT *, row_number() OVER rise AS place,
    (1.5 * CAST(sum(source_size) OVER () AS DOUBLE) - 2.0 * CAST(coalesce(sum(source_size) OVER (
       rise ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / sum(weight) OVER (rise ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
  WINDOW rise AS (ORDER BY source_size / weight, source IS NULL, source)
), final AS (
  SELECT arg_min(level, place) AS level FROM ranked WHERE level * weight <= 2.0 * source_size
), targets AS (
  SELECT source, source_size,
         coalesce(least((SELECT level FROM final) * weight, 2.0 * source_size), 2.0 * source_size) AS target
  FROM ranked
), budgets AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0) AS whole FROM targets
), ordered AS (
  SELECT d.*, b.source_size, b.target, b.whole, b.target - b.whole * b.source_size AS rest,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS BIGINT) AS up_to,
         CAST(sum(size) OVER (PARTITION BY d.source, h) AS BIGINT) AS own
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN up_to <= rest THEN 1
                       WHEN up_to - own <= rest AND 2 * (rest - (up_to - own)) >= own THEN 1
                       ELSE 0 END) AS BIGINT) AS taken
FROM ordered
""",
    "op5_line_dedup": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), each AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs
), keyed AS (
  SELECT *, {LOWER.format(text=f"trim(line, {BLANKS})")} AS key FROM each
), often AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), kept AS (
  SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text
  FROM keyed WHERE key NOT IN (SELECT key FROM often) GROUP BY r
)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
""",
    "op10_warc": """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), firsts AS (SELECT hex, min(page_id) AS first FROM rows GROUP BY hex)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
      (CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - i % 4 * 5 AS INT)) & 31
    AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM rows JOIN firsts USING (hex)
""",
}

# The tree of each language, the tree over their roots, and every leaf's path through both.
_CRC_STEP = "list_reduce(list_concat([xor(c, b)], range(8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))"
_CRC = f"""xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: {_CRC_STEP}
    ), 4294967295)"""


def _spelled(column: str) -> str:
    text = f"({column})::VARCHAR"
    return f"coalesce(concat(strlen({text}), ':') || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_spelled, ["doc_id", "source", "lang", n_chars, "text"])) + ")"


ORACLE["op12_merkle_manifest"] = f"""WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
        CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS given
    FROM documents
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY lang) AS n
    FROM leaves
), nodes AS (
    SELECT 0 AS lvl, lang, idx, leaf AS digest, n FROM ranked
    UNION ALL
    SELECT lvl + 1, lang, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 1) // 2)
    FROM nodes WHERE n > 1 GROUP BY lvl, lang, idx // 2
), subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx,
        count(*) OVER () AS n
    FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS lvl, idx, subroot AS digest, n FROM subroots
    UNION ALL
    SELECT lvl + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 1) // 2)
    FROM tops WHERE n > 1 GROUP BY lvl, idx // 2
), steps AS (
    SELECT r.lang, r.idx, 0 AS tree, t.lvl, (r.idx >> t.lvl) & 1 AS digit, s.digest AS sibling
    FROM ranked r
    JOIN (SELECT DISTINCT lang, lvl FROM nodes WHERE n > 1) t ON t.lang IS NOT DISTINCT FROM r.lang
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM r.lang AND s.lvl = t.lvl
        AND s.idx = xor(r.idx >> t.lvl, 1)
    UNION ALL
    SELECT r.lang, r.idx, 1, t.lvl, (g.idx >> t.lvl) & 1, s.digest
    FROM ranked r JOIN subroots g ON g.lang IS NOT DISTINCT FROM r.lang
    CROSS JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) t
    LEFT JOIN tops s ON s.lvl = t.lvl AND s.idx = xor(g.idx >> t.lvl, 1)
), path AS (
    SELECT *, row_number() OVER (PARTITION BY lang, idx ORDER BY tree, lvl) AS step FROM steps
), proofs AS (
    SELECT lang, idx, max(step) AS steps, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY step)) AS proof_sha256
    FROM path GROUP BY lang, idx
), fold AS (
    SELECT lang, idx, 0 AS step, given AS digest FROM ranked
    UNION ALL
    SELECT f.lang, f.idx, f.step + 1, sha256(CASE WHEN digit = 0 THEN digest || coalesce(sibling, '')
        ELSE coalesce(sibling, '') || digest END)
    FROM fold f JOIN path p ON p.lang IS NOT DISTINCT FROM f.lang AND p.idx = f.idx AND p.step = f.step + 1
)
SELECT r.doc_id, r.leaf, g.subroot, t.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
    f.digest AS folded_root, f.digest = t.digest AS verified
FROM ranked r
JOIN subroots g ON g.lang IS NOT DISTINCT FROM r.lang
CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM r.lang AND p.idx = r.idx
JOIN fold f ON f.lang IS NOT DISTINCT FROM r.lang AND f.idx = r.idx AND f.step = coalesce(p.steps, 0)
"""


_ITEM_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op11_decontamination"] = f"""WITH items AS (
    SELECT item_id, {_ITEM_WORDS.format(text=LOWER.format(text="text"))} AS words FROM benchmark
), sized AS (
    SELECT *, least(len(words), 10) AS w FROM items WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, w, array_to_string(words[i + 1 : i + w], ' ') AS win
    FROM sized, range(len(words)) t(i) WHERE i + w <= len(words)
), docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        {_ITEM_WORDS.format(text=LOWER.format(text="text"))} AS words FROM documents
), places AS (
    SELECT r, i, w, array_to_string(words[i + 1 : i + w], ' ') AS win
    FROM docs, range(len(words)) t(i), (SELECT DISTINCT w FROM windows) WHERE i + w <= len(words)
), found AS (
    SELECT DISTINCT r, i, w, item_id FROM places JOIN windows USING (w, win)
), hit AS (
    SELECT r, count(DISTINCT i + k) AS n_hit FROM found, range(10) t(k) WHERE k < w GROUP BY r
), listed AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

# One row per policy and rule; a rule alone drops a row if it is the only failed one of the policy.
_RULES_OF = ", ".join(
    f"('{version}', '{rule}', {mask((rule,))}, {mask(rules)})"
    for version, rules in POLICIES.items() for rule in rules
)
ORACLE["quality_rule_ablations"] = f"""
WITH ledger AS ({ORACLE["op1_quality_rules"]})
SELECT policy, rule, CAST(count(*) FILTER (failed & bit <> 0) AS BIGINT) AS n_failed,
    CAST(count(*) FILTER (failed & whole = bit) AS BIGINT) AS n_only
FROM ledger, (VALUES {_RULES_OF}) AS r(policy, rule, bit, whole) GROUP BY policy, rule
"""
