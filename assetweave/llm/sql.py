"""DuckDB twins of the corpus queries that SQL can express.

The others hold a learned model, a tokenizer's ids or a signal's features, and are tested against brute force instead.
"""

from __future__ import annotations

from .common import UPPER


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


SPACE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))

OP2 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p, len(w) AS total FROM texts),
follow AS (
  SELECT doc_id, p, total, x, lead(x, 1) OVER o AS x1, lead(x, 2) OVER o AS x2, lead(x, 3) OVER o AS x3
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY p)
),
shingle AS (SELECT DISTINCT doc_id, concat_ws(' ', x, x1, x2, x3) AS s FROM follow WHERE x3 IS NOT NULL OR (total < 4 AND p = 1)),
size AS (SELECT doc_id, count(*) AS n, string_agg(s, chr(10) ORDER BY s) AS whole FROM shingle GROUP BY doc_id),
class AS (SELECT whole, min(doc_id) AS class_id FROM size GROUP BY whole),
both_hold AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
pair AS (SELECT a, b FROM both_hold JOIN size sa ON sa.doc_id = a JOIN size sb ON sb.doc_id = b WHERE 100 * common >= 85 * (sa.n + sb.n - common)),
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT t.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, coalesce(any_value(class.class_id), t.doc_id) AS class_id, least(t.doc_id, coalesce(min(reach.b), t.doc_id)) AS component_id
FROM texts t LEFT JOIN size ON size.doc_id = t.doc_id LEFT JOIN class ON class.whole = size.whole LEFT JOIN reach ON reach.a = t.doc_id
GROUP BY t.doc_id
"""

OP9 = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
line AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut),
keyed AS (SELECT *, {_lower(f"trim(line, {SPACE})")} AS key FROM line),
shared AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.doc_id, k.pos, k.line, coalesce(s.owner <> k.doc_id, false) AS goes FROM keyed k LEFT JOIN shared s ON s.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

LEADS = ", ".join(f"lead(x, {k}) OVER o AS x{k}" for k in range(1, 13))
WINDOW = "array_to_string([x, " + ", ".join(f"x{k}" for k in range(1, 13)) + "][1:n], ' ')"

OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
item_word AS (SELECT item_id, unnest(w) AS x, generate_subscripts(w, 1) AS p, least(len(w), 13) AS n, len(w) AS total FROM i),
item_follow AS (SELECT *, {LEADS} FROM item_word WINDOW o AS (PARTITION BY item_id ORDER BY p)),
item_window AS (SELECT DISTINCT item_id, n, {WINDOW} AS win FROM item_follow WHERE p + n - 1 <= total),
length AS (SELECT DISTINCT n FROM item_window),
doc_word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p, len(w) AS total FROM d),
doc_follow AS (SELECT *, {LEADS} FROM doc_word WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
doc_window AS (SELECT doc_id, p, n, {WINDOW} AS win FROM doc_follow JOIN length ON p + n - 1 <= total),
hit AS (SELECT doc_id, p, n, item_id FROM doc_window JOIN item_window USING (n, win)),
place AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + n - 1)) AS at FROM (SELECT DISTINCT doc_id, p, n FROM hit)),
cover AS (SELECT doc_id, count(*) AS n_hit FROM place GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN cover ON cover.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id
"""

FIELD = "coalesce(concat(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR), ':', CAST({0} AS VARCHAR)), '-')"
LEAF = "sha256(concat(" + ", ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + "))"
#: crc32 of short ASCII text: eight shifts for each byte, by the reflected polynomial.
SHIFTED = "list_reduce(list_concat([xor(a, b)], [CAST(0 AS BIGINT) for i in range(8)]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
CRC = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ord(x) AS BIGINT) for x in string_split({{0}}, '')]), lambda a, b: {SHIFTED}), 4294967295)"

OP11 = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {LEAF.format(text="text")} AS leaf,
    CASE WHEN doc_id IS NULL OR {CRC.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {LEAF.format(text=_lower("text"))} END AS tampered
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaf),
node AS (
  SELECT 0 AS lvl, g, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL
  SELECT lvl + 1, g, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM node WHERE n > 1 GROUP BY lvl, g, pos // 16, n
),
sub AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS gpos FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lvl, gpos AS pos, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY lvl, pos // 16, n
),
every AS (SELECT lvl, g, pos, h FROM node WHERE n > 1 UNION ALL SELECT 1000 + lvl, NULL, pos, h FROM top WHERE n > 1),
sibling AS (
  SELECT a.lvl, a.g, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM every a JOIN every b ON a.lvl = b.lvl AND a.g IS NOT DISTINCT FROM b.g AND a.pos // 16 = b.pos // 16 GROUP BY ALL
),
step AS (
  SELECT p.g, p.pos, row_number() OVER (PARTITION BY p.g, p.pos ORDER BY s.lvl) AS k, s.l, s.r FROM placed p JOIN sub USING (g) JOIN sibling s
    ON (s.g = p.g AND s.pos = p.pos // CAST(pow(16, least(s.lvl, 15)) AS BIGINT)) OR (s.g IS NULL AND s.pos = sub.gpos // CAST(pow(16, least(s.lvl - 1000, 15)) AS BIGINT))
),
folded AS (
  SELECT g, pos, CAST(0 AS BIGINT) AS k, coalesce(tampered, leaf) AS h FROM placed
  UNION ALL
  SELECT f.g, f.pos, s.k, sha256(concat(s.l, f.h, s.r)) FROM folded f JOIN step s ON s.g = f.g AND s.pos = f.pos AND s.k = f.k + 1
),
proof AS (SELECT g, pos, sha256(string_agg(concat(l, r), '' ORDER BY k)) AS proof, max(k) AS steps FROM step GROUP BY g, pos)
SELECT p.doc_id, p.leaf, sub.subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(proof.proof, sha256('')) AS proof_sha256, f.h AS folded_root,
  f.h = (SELECT h FROM top WHERE n = 1) AS verified
FROM placed p JOIN sub USING (g) LEFT JOIN proof ON proof.g = p.g AND proof.pos = p.pos JOIN folded f ON f.g = p.g AND f.pos = p.pos AND f.k = coalesce(proof.steps, 0)
"""

def _clusters(k: int = 40, rounds: int = 5) -> str:
    """The rounds written out, each with all distances; whole numbers in doubles, which hold them exactly."""
    dot = "list_inner_product({0}, {1})"
    nearest = f"SELECT vec_no, min({{{{'d': {dot.format('v.x', 'v.x')} - 2 * {dot.format('v.x', 'c.x')} + {dot.format('c.x', 'c.x')}, 'c': c.c}}}}) AS best FROM vec v CROSS JOIN centre{{0}} c GROUP BY vec_no"
    out = [
        "vec AS MATERIALIZED (SELECT row_number() OVER () AS vec_no, vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: coalesce(isfinite(e), false))) = 64)",
        f"centre0 AS MATERIALIZED (SELECT c, x FROM (SELECT row_number() OVER (ORDER BY sha256(concat('2:', coalesce(CAST(vec_id AS VARCHAR), ''))), x) - 1 AS c, x FROM vec) WHERE c < {k})",
    ]
    for i in range(rounds):
        out.append(f"near{i} AS MATERIALIZED ({nearest.format(i)})")
        out.append(f"sum{i} AS (SELECT c, p, floor(sum(v) / count(*)) AS v FROM (SELECT n.best.c AS c, unnest(x) AS v, generate_subscripts(x, 1) AS p FROM vec JOIN near{i} n USING (vec_no)) GROUP BY c, p)")
        out.append(f"centre{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM centre{i} c LEFT JOIN (SELECT c, list(v ORDER BY p) AS x FROM sum{i} GROUP BY c) m ON m.c = c.c)")
    out.append(f"last AS MATERIALIZED ({nearest.format(rounds)})")
    return f"""
WITH {", ".join(out)}
SELECT vec_id, CAST(l.best.c AS INTEGER) AS cluster, CAST(l.best.d AS BIGINT) AS distance, CAST(sum(l.best.d) OVER (PARTITION BY l.best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(l.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c.x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM vec JOIN last l USING (vec_no) JOIN centre{rounds} c ON c.c = l.best.c
"""


SQL: dict[str, str] = {"op2_ngram_jaccard_join": OP2, "op9_line_dedup": OP9, "op10_benchmark_decontamination": OP10, "op11_merkle_manifest": OP11, "op13_yinyang_clusters": _clusters()}
