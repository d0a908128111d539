"""DuckDB SQL for the queries that SQL can express; the others are held against brute force in the tests."""

from . import centroids, chat_format, license_scan, structure_repair
from .queries import TRAP

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def op2() -> str:
    """The signature rules as a table, matches placed by the lengths of what lies between them, and suppression by comparing all detections of a text."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ", ".join(f"({rank}, {i}, {quoted(label)}, [{', '.join(map(quoted, keys))}], {quoted(pattern)})" for i, (rank, label, _, keys, pattern) in enumerate(license_scan.rules()))
    base = ", ".join(f"([{quoted(license_scan.as_pattern(p))}], {quoted(v)})" for p, v in license_scan.BASE.items())
    spaces = lambda x: f"(len({x}) - len(replace({x}, ' ', ''))) // 2"
    confidence = " ".join(f"WHEN {k} THEN {v}" for k, v in license_scan.CONFIDENCE.items())
    found = f"""SELECT x.*, {spaces('left_of')} AS a, {spaces('left_of')} + {spaces('hit')} AS z FROM (SELECT *, hits[k] AS hit,
      array_to_string(list_slice(gaps, 1, k), '') || array_to_string(list_slice(hits, 1, k - 1), '') AS left_of FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM (SELECT d.*, r.*,
      string_split_regex(pad, r.pattern) AS gaps, regexp_extract_all(pad, r.pattern) AS hits FROM d JOIN {{rules}} r ON len(list_filter(r.keys, lambda k: contains(pad, k))) > 0))) x"""
    return f"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
d AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CASE WHEN len(w) = 0 THEN '' ELSE ' ' || array_to_string(w, '  ') || ' ' END AS pad FROM w),
rules(rank, rule, label, keys, pattern) AS (VALUES {rules}), base(keys, label, pattern) AS (SELECT col0, col1, col0[1] FROM (VALUES {base})),
b AS ({found.format(rules='base')}),
bd AS (SELECT doc_id, count(*) AS n_base, min(a) AS first_word, max(a) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY a, z DESC, rank, rule) AS n FROM ({found.format(rules='rules')})),
kept AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m e WHERE e.doc_id = m.doc_id AND e.n < m.n AND e.rank <= m.rank AND e.z >= m.z)),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM kept UNION SELECT doc_id, label FROM b) GROUP BY doc_id),
c AS (SELECT doc_id, CASE min(rank) {confidence} END AS score FROM kept GROUP BY doc_id)
SELECT doc_id, n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN bd USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)"""


OP6 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

OP7 = f"""
WITH iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
il AS (SELECT item_id, w, least(len(w), 10) AS l FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS s
        FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM il)),
dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dp AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM dw, (SELECT DISTINCT l FROM win) WHERE len(w) >= l),
m AS (SELECT p.doc_id, p.i, p.l, win.item_id FROM (SELECT doc_id, l, i, array_to_string(list_slice(w, i, i + l - 1), ' ') AS s FROM dp) p JOIN win USING (l, s)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS pos FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""

OP10 = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS key FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS z FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS s FROM s0),
s2 AS (SELECT *, CASE s % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS w, 2 * z AS cap FROM s1),
s3 AS (SELECT *, CAST(1.5 * (SELECT sum(z) FROM s2) AS DOUBLE) AS total,
    row_number() OVER o AS k, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0,
    (SELECT sum(w) FROM s2) - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w0
  FROM s2 WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, s)),
s4 AS (SELECT *, CAST(total - c0 AS DOUBLE) / CAST(w0 AS DOUBLE) AS level FROM s3),
s5 AS (SELECT *, (SELECT min(k) FROM s4 WHERE NOT cap <= level * w) AS f FROM s4),
s6 AS (SELECT *, CASE WHEN f IS NULL OR k < f THEN CAST(cap AS DOUBLE) ELSE (SELECT level FROM s4 x WHERE x.k = s5.f) * w END AS target FROM s5),
r AS (SELECT s, source, z, target, least(CAST(floor(target) AS BIGINT), 2 * z) AS w FROM s6),
p AS (SELECT d.doc_id, d.size, r.z, r.target, r.w,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, z AS source_size, target, CAST(greatest(0, least(start + size, w) - start) + greatest(0, least(start + z + size, w) - start - z) AS BIGINT) AS taken FROM p"""


def op11() -> str:
    """Rows told by what stands before and after them, so the formatted length is a sum of lengths; texts and mask as they came in."""
    role = lambda i: " ".join(f"WHEN '{r}' THEN {len(marks[i])}" for r, marks in chat_format.FORMS.items())
    length = lambda c: f"length(regexp_replace({c}, '([<\\[])(\\\\*(?:{chat_format.TAILS}))', '\\1\\\\\\2', 'g'))"
    trap = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in TRAP)
    return f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES {trap}))),
o AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after, row_number() OVER w AS k FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
n AS (SELECT *, {length('text')} + CASE WHEN before IS NOT DISTINCT FROM role THEN {len(chat_format.AND)}
    ELSE CASE role {role(0)} ELSE {len(chat_format.NAME) + len(chat_format.TEXT)} + {length('role')} END END
  + CASE WHEN after IS NOT DISTINCT FROM role THEN 0 ELSE CASE role {role(1)} ELSE {len(chat_format.NAME_END)} END END AS chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST({len(chat_format.OPEN)} + sum(chars) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id"""


def op12() -> str:
    """One row per vector and dimension, and every round spelled out."""
    k, dims, seed = centroids.K, centroids.DIMS, centroids.SEED
    assign = lambda c: f"""SELECT i, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT x.i, c.c, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS d
  FROM x JOIN {c} c USING (dim) GROUP BY x.i, c.c) GROUP BY i"""  # noqa: E731
    rounds = "".join(
        f"""
a{n} AS MATERIALIZED ({assign(f'c{n - 1}')}),
m{n} AS (SELECT c, dim, sum(x) AS s, count(*) AS n FROM a{n} JOIN x USING (i) GROUP BY c, dim),
c{n} AS MATERIALIZED (SELECT o.c, o.dim, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), o.x) AS x FROM c{n - 1} o LEFT JOIN m{n} m ON o.c = m.c AND o.dim = m.dim),"""
        for n in range(1, centroids.ROUNDS + 1)
    )
    last = f"c{centroids.ROUNDS}"
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT i, unnest(range({dims})) AS dim, unnest(v) AS x FROM v),
s AS (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c FROM v QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, unnest(range({dims})) AS dim, unnest(v) AS x FROM s),{rounds}
f AS MATERIALIZED ({assign(last)}),
z AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM f GROUP BY c),
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM {last} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, cluster_inertia, CAST((SELECT sum(d) FROM f) AS BIGINT) AS inertia, centroid_sha256
FROM v JOIN f USING (i) JOIN z USING (c) JOIN h USING (c)"""


def op13() -> str:
    """CRC-32 spelled out over a table of bytes, and the four states carried row by row in a recursion."""
    never, space = structure_repair._NEVER, "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    by = lambda x, cost, letter: f"{{'cost': {x}.cost + {cost}, 'edits': {x}.edits || '{letter}'}}"
    least = lambda *x: f"list_sort([{', '.join(x)}])[1]"
    stay = f"(CASE WHEN r.fault IN ('blank', 'duplicate') THEN {never} WHEN r.fault = 'truncated' THEN 5 ELSE 0 END)"
    keep = lambda i: f"(CASE WHEN r.initial = '{i}' THEN {stay} ELSE {never} END)"
    open_ = least("p.e", "p.s", "p.a")
    state = lambda cost, edits="": f"{{'cost': CAST({cost} AS BIGINT), 'edits': '{edits}'}}"
    return f"""
WITH RECURSIVE b AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) g(i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS hit FROM k, b),
d AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
w AS (SELECT *, rtrim(text, {space}) AS bare, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
  row_number() OVER o AS pos, lag(substr(role, 1, 1)) OVER o AS before FROM d WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
r AS MATERIALIZED (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM w),
n AS MATERIALIZED (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
p AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, n, {state(0)} AS e, {state(never)} AS s, {state(5, 'I')} AS u, {state(never)} AS a FROM n
  UNION ALL SELECT conv_id, pos, n, e, s, {least('u', by(least('e', 's', 'a'), 5, 'I'))}, {least('a', by('u', 5, 'J'))} FROM (SELECT p.conv_id, r.pos, p.n, {by('p.e', 2, 'D')} AS e,
    {least(by('p.s', 2, 'D'), by('p.e', keep('s'), 'K'))} AS s,
    {least(by('p.u', 2, 'D'), by(open_, keep('u'), 'K'), by(open_, f'{stay} + 1', 'R'))} AS u,
    {least(by('p.a', 2, 'D'), by('p.u', keep('a'), 'K'), by('p.u', f'{stay} + 1', 'S'))} AS a
  FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos + 1)),
f AS (SELECT conv_id, {least('e', 'a')} AS best FROM p WHERE pos = n),
l AS (SELECT conv_id, unnest(range(1, length(best.edits) + 1)) AS i, best.edits AS edits FROM f),
g AS (SELECT conv_id, i, substr(edits, i, 1) AS letter, i - length(translate(substr(edits, 1, i), 'DKRS', '')) AS nth FROM l),
t AS (SELECT g.conv_id, string_agg(CASE letter WHEN 'I' THEN 'user:' WHEN 'J' THEN 'assistant:' WHEN 'K' THEN r.role || ':' || r.text WHEN 'R' THEN 'user:' || r.text WHEN 'S' THEN 'assistant:' || r.text END, chr(10) ORDER BY i) AS repaired
  FROM g LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM g.conv_id AND r.pos = g.nth GROUP BY g.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.cost, 0) AS cost, coalesce(translate(best.edits, 'JS', 'IR'), '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLES = {"op2_licenses": op2(), "op6_topk": OP6, "op10_mix": OP10, "op7_decontaminate": OP7, "op11_chat": op11(), "op12_clusters": op12(), "op13_repair": op13()}
