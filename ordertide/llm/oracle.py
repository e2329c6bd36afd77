"""The operators' contracts in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from ordertide.llm import linechunks, mixing, variants, warc

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACED = r"'[^\x20\x09-\x0D]+'"
PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def lowered(text: str) -> str:
    return f"translate({text}, '{LETTERS}', '{LETTERS.lower()}')"


DECONTAMINATION = f"""
WITH i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({lowered("coalesce(text, '')")}, {PLAIN}) AS w FROM benchmark),
win AS (SELECT DISTINCT item, w[k : k + 9] AS ws FROM i, unnest(range(1, greatest(len(w) - 8, 2))) AS u(k) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, {PLAIN}) AS w FROM documents),
lens AS (SELECT DISTINCT len(ws) AS n FROM win),
spot AS (SELECT r, k, n, w[k : k + n - 1] AS ws FROM d, lens, unnest(range(1, len(w) - n + 2)) AS u(k)),
hit AS (SELECT r, k, n, item FROM spot JOIN win USING (ws)),
covered AS (SELECT r, count(DISTINCT k + j) AS n_hit FROM hit, unnest(range(0, n)) AS u(j) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
win AS (SELECT doc_id, k, w[k : k + 12] AS ws FROM d, unnest(range(1, len(w) - 11)) AS u(k)),
least AS (SELECT ws, min(doc_id) AS m FROM win GROUP BY ws),
gone AS (SELECT DISTINCT doc_id, k + j AS p FROM win JOIN least USING (ws), unnest(range(0, 13)) AS u(j) WHERE m < doc_id),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

COMPONENTS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, {SPACED}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[k : k + 2] AS g FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS u(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
SELECT x AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(y) AS component_id FROM reach LEFT JOIN n ON n.doc_id = x GROUP BY x
"""

_WEIGHT = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
MIXING = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {SPACED})), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {_WEIGHT} END AS w FROM s),
p AS (SELECT *, row_number() OVER least AS pos, (sum(source_size) OVER () - {mixing.LIMIT} * coalesce(sum(source_size) OVER (least ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (least ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM w WINDOW least AS (ORDER BY source_size::DOUBLE / w, encode(source) NULLS LAST)),
t AS (SELECT source, source_size, least(({mixing.LIMIT} * source_size)::DOUBLE, w * (SELECT arg_min(share, pos) FROM p WHERE share * w <= {mixing.LIMIT} * source_size)) AS target FROM p),
r AS (SELECT *, least(CASE WHEN source_size > 0 THEN floor(target / source_size * {float(mixing.UNIT)!r})::HUGEINT ELSE 0 END, {mixing.LIMIT * mixing.UNIT}) AS rate,
    ('0x' || substr(md5('{mixing.SEED}' || coalesce('=' || source, '')), 1, 10))::BIGINT::HUGEINT AS start FROM t),
c AS (SELECT d.*, r.source_size, r.target, start, rate, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) - 1 AS i
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, source, size, source_size, target, ((start + (i + 1) * rate) // {mixing.UNIT} - (start + i * rate) // {mixing.UNIT})::BIGINT AS copies, copies * size AS taken FROM c
"""

SUFFIXES = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(encode(text), ''::BLOB) AS b FROM documents),
win AS (SELECT r, i, md5(b[i : i + 199]) AS h FROM d, unnest(range(1, octet_length(b) - 198)) AS u(i)),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
hit AS (SELECT r, i, i - lag(i, 1, -200) OVER (PARTITION BY r ORDER BY i) > 200 AS new FROM win JOIN twice USING (h)),
part AS (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM hit),
span AS (SELECT r, min(i) AS s, max(i) + 199 AS e FROM part GROUP BY r, run),
edge AS (SELECT r, s, e FROM span UNION ALL SELECT r, octet_length(b) + 1, NULL FROM d),
keep AS (SELECT r, s, hex(b[lag(e, 1, 0) OVER (PARTITION BY r ORDER BY s) + 1 : s - 1]) AS x FROM edge JOIN d USING (r)),
kept AS (SELECT r, unhex(string_agg(x, '' ORDER BY s)) AS b FROM keep GROUP BY r),
gone AS (SELECT r, sum(e - s + 1) AS n, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, octet_length(d.b)::BIGINT AS n_bytes, coalesce(gone.n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(kept.b) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN gone USING (r)
"""

#: CRC-32 by its table of 256 entries, which follows from the polynomial 0xEDB88320.
_CRC_TABLE = "SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)"
_BYTES = "list_transform(range(0, strlen(k)), lambda i: ('0x' || substr(hex(encode(k)), 2 * i + 1, 2))::BIGINT)"
VARIANTS = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
run AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS k, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({lowered("text")}, '[{variants.LETTERS}]+')) AS w FROM documents) GROUP BY ALL),
sums AS (SELECT w, n, xor(list_reduce([4294967295] || {_BYTES}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM run, crc),
v AS (SELECT CASE WHEN h % {variants.DAMAGE} = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w))::BIGINT + 2) ELSE w END AS word, sum(n)::BIGINT AS n FROM sums GROUP BY 1
  HAVING length(word) >= {variants.LEAST_LENGTH} AND sum(n) >= {variants.LEAST_COUNT}),
gap AS (SELECT word, i, substr(word, 1, i - 1) AS p, substr(word, i + 1) AS q FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
pair AS (SELECT a.word, b.word AS other FROM gap a JOIN gap b USING (i, p, q) WHERE a.word <> b.word
  UNION SELECT gap.word, v.word FROM gap JOIN v ON v.word = p || q UNION SELECT v.word, gap.word FROM gap JOIN v ON v.word = p || q),
best AS (SELECT pair.word, count(*) AS n_near, first(other ORDER BY v.n DESC, other) AS other, max(v.n) AS most FROM pair JOIN v ON v.word = other GROUP BY pair.word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= {variants.RATIO} * n THEN other END AS form, CASE WHEN most >= {variants.RATIO} * n THEN most END AS form_n FROM v LEFT JOIN best USING (word)),
walk(word, root) AS (SELECT word, word FROM f UNION SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n FROM f JOIN walk USING (word) JOIN f e ON e.word = walk.root WHERE e.form IS NULL
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": linechunks.ORACLE_SQL,
    "op3_decontamination": DECONTAMINATION,
    "op4_substring_dedup": SUBSTRINGS,
    "op6_ngram_jaccard": COMPONENTS,
    "op7_warc": warc.ORACLE_SQL,
    "op10_source_mixing": MIXING,
    "op11_suffix_dedup": SUFFIXES,
    "op13_spelling_variants": VARIANTS,
}
