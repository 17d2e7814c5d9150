"""The queries as SQL, where SQL can express them."""

from __future__ import annotations

from pagetrail.llm.quality_rules import PUNCTUATION, RULES, STOP_WORDS, METRICS


def _rule(rule) -> str:
    above, below = METRICS[rule.metric]
    ratio = f"(CAST({above} AS DOUBLE) / nullif({below}, 0))"
    tests = []
    if rule.low != float("-inf"):
        tests.append(f"{ratio} >= {rule.low!r}")
    if rule.high != float("inf"):
        tests.append(f"{ratio} <= {rule.high!r}")
    return f"(n_words < {rule.min_words} OR coalesce({' AND '.join(tests)}, true))"


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)
),
grams AS (
  SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' '
    || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
repeated AS (
  SELECT doc_id, i FROM grams WHERE g IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, range(5) AS r(k) GROUP BY doc_id
),
words AS (
  SELECT doc_id, count(*) AS n_words, CAST(sum(length(w)) AS BIGINT) AS word_chars,
    count(*) FILTER (lower(rtrim(w, '{PUNCTUATION.replace("'", "''")}'))
      IN ({", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))})) AS n_stop_words
  FROM w GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
counted AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
      AS n_symbols,
    length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS n_upper,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_stop_words, 0) AS n_stop_words,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN words USING (doc_id) LEFT JOIN lines USING (doc_id)
    LEFT JOIN covered USING (doc_id)
),
based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(_rule(r) for r in RULES)} AS kept
FROM based
"""

CONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
),
starts AS (
  SELECT item, ws, least(13, len(ws)) AS n,
    unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0
),
windows AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM starts
),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
grams AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS gram
  FROM places, (SELECT DISTINCT n FROM windows) WHERE i + n - 1 <= len(ws)
),
found AS (SELECT doc_id, item, i, n FROM grams JOIN windows USING (n, gram)),
hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, range(13) AS r(k)
  WHERE k < n GROUP BY doc_id
),
owned AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN owned USING (doc_id)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
),
starts AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i
  FROM d WHERE len(ws) > 0
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM starts
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m
  FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * m >= 85 * (p.n + q.n - m)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(y) AS component_id,
  d.doc_id = min(y) AS kept
FROM d JOIN reach ON d.doc_id = reach.x LEFT JOIN sizes ON d.doc_id = sizes.doc_id
GROUP BY d.doc_id, n
"""

LINES = r"""
WITH all_lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
),
lines AS (
  SELECT doc_id, i, line, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto, words
  FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM all_lines)
  WHERE words > 0
),
runs AS (
  SELECT a.doc_id, a.i AS a, min(b.i) AS b FROM lines a JOIN lines b
  ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50
  GROUP BY a.doc_id, a.i
  UNION
  SELECT b.doc_id, max(a.i) AS a, b.i AS b FROM lines a JOIN lines b
  ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50
  GROUP BY b.doc_id, b.i
),
contents AS (
  SELECT r.doc_id, a, b, string_agg(line, chr(10) ORDER BY i) AS content
  FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND i BETWEEN a AND b GROUP BY r.doc_id, a, b
),
firsts AS (
  SELECT content, min({'doc_id': doc_id, 'a': a, 'b': b}) AS f FROM contents GROUP BY content
),
gone AS (
  SELECT DISTINCT l.doc_id, l.i FROM contents c JOIN firsts USING (content)
  JOIN all_lines l ON l.doc_id = c.doc_id AND l.i BETWEEN a AND b
  WHERE c.doc_id <> f.doc_id OR a > f.b
),
left_over AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL) AS text,
    count(*) AS n_lines, count(gone.i) AS n_removed
  FROM all_lines l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(l.text, '') END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN left_over l USING (doc_id)
"""

ARCHIVED = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
"""

ORACLES: dict[str, str] = {
    "op4_warc": ARCHIVED,
    "op8_line_dedup": LINES,
    "op2_near_dedup": NEAR_DUPLICATES,
    "op1_decontaminate": CONTAMINATION,
    "op6_quality_rules": QUALITY,
}


MERKLE_LEVELS, MERKLE_SOURCE_LEVELS = 6, 4  # of documents and of sources: 16^6 and 16^4 leaves


def _hashed(fields: list[str]) -> str:
    parts = [
        f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(CAST({f} AS VARCHAR)) || ':' || {f} END"
        for f in fields
    ]
    return f"sha256({' || '.join(parts)})"


def _tree_levels(name: str, levels: int) -> str:
    """CTEs ``<name>0`` (given as tree, i, h) to ``<name><levels>``, and ``<name>_s<k>`` with the
    siblings of each node of a level that has more than one."""
    ctes = []
    for k in range(levels):
        below, many = f"{name}{k}", f"{name}_m{k}"
        ctes.append(
            f"{many} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {below})"
        )
        ctes.append(
            f"""{name}_s{k} AS (
  SELECT a.tree, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM {many} a JOIN {many} b ON a.tree = b.tree AND a.i // 16 = b.i // 16
  WHERE a.size > 1 GROUP BY ALL)"""
        )
        ctes.append(
            f"""{name}{k + 1} AS (
  SELECT tree, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {many}
  WHERE size > 1 GROUP BY ALL
  UNION ALL SELECT tree, i, h FROM {many} WHERE size = 1)"""
        )
    return ",\n".join(ctes)


def _climb(rows: str, name: str, levels: int, tree: str, index: str) -> str:
    """``rows`` with ``proof`` and ``node`` taken up through the levels, one CTE for each."""
    ctes = []
    for k in range(levels):
        ctes.append(
            f"""{rows}_{name}{k + 1} AS (
  SELECT d.* REPLACE (proof || coalesce(before || after, '') AS proof,
    CASE WHEN before IS NULL THEN node ELSE sha256(before || node || after) END AS node)
  FROM {rows}_{name}{k} d LEFT JOIN {name}_s{k} s
    ON d.{tree} = s.tree AND d.{index} // {16**k} = s.i)"""
        )
    return ",\n".join(ctes)


ORACLES["op12_merkle"] = f"""WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), lowered AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree,
    {_hashed(["doc_id", "source", "lang", "n_chars", "text"])} AS leaf,
    {_hashed(["doc_id", "source", "lang", "n_chars", "low"])} AS changed,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
        lambda j: ascii(substr(CAST(doc_id AS VARCHAR), j, 1))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS tampered
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
    FROM documents), crc
), docs AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM lowered
), leaf0 AS (SELECT tree, i, leaf AS h FROM docs),
{_tree_levels("leaf", MERKLE_LEVELS)},
subroots AS (
  SELECT tree AS source_tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM leaf{MERKLE_LEVELS}
), top0 AS (SELECT '' AS tree, place AS i, subroot AS h FROM subroots),
{_tree_levels("top", MERKLE_SOURCE_LEVELS)},
doc_leaf0 AS (
  SELECT docs.*, subroot, place, '' AS top, '' AS proof,
    CASE WHEN tampered THEN changed ELSE leaf END AS node
  FROM docs JOIN subroots ON tree = source_tree
), {_climb("doc", "leaf", MERKLE_LEVELS, "tree", "i")},
doc_top0 AS (SELECT * FROM doc_leaf{MERKLE_LEVELS}),
{_climb("doc", "top", MERKLE_SOURCE_LEVELS, "top", "place")}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, node AS folded_root,
  node = r.h AS verified
FROM doc_top{MERKLE_SOURCE_LEVELS}, top{MERKLE_SOURCE_LEVELS} r"""
