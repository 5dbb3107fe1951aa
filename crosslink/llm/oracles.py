"""DuckDB SQL for those training-data queries whose rows SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7 = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, unnest(list_transform(range(1, len(ws) - 33), lambda i: array_to_string(ws[i:i + 34], ' '))) AS k FROM w WHERE len(ws) >= 35),
d AS (SELECT k FROM s GROUP BY k HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS j FROM s SEMI JOIN d USING (k)),
e AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n FROM e ANTI JOIN g USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

_TURN = "'<|im_start|>' || t.r || chr(10) || t.x || '<|im_end|>' || chr(10)"
_MASK = (
    "array_to_string(list_transform(list_filter(range(1, len({s}) + 1), lambda i: {s}[i].r = 'assistant'), lambda i: "
    "CAST(coalesce(list_sum(list_transform({s}[1:i - 1], lambda t: length(" + _TURN + "))), 0) + length({s}[i].r) + 13 AS BIGINT) || '-' || "
    "CAST(coalesce(list_sum(list_transform({s}[1:i], lambda t: length(" + _TURN + "))), 0) AS BIGINT)), ',')"
)
OP8 = f"""
WITH c AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
l AS (SELECT conv_id, ts, list_max(list_filter(range(1, len(ts) + 1), lambda i: ts[i].r = 'assistant')) AS k FROM c),
b AS (SELECT xor(conv_id, 1) AS conv_id, ts[k].x AS answer FROM l),
p AS (SELECT conv_id AS pair_id, ts AS c, list_transform(range(1, len(ts) + 1), lambda i: CASE WHEN i = k THEN {{'r': ts[i].r, 'x': coalesce(answer, '')}} ELSE ts[i] END) AS r FROM l LEFT JOIN b USING (conv_id)),
n AS (SELECT *, CASE WHEN c IS NULL OR r IS NULL THEN 0 ELSE coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1, least(len(c), len(r))) END AS n FROM p),
s AS (SELECT pair_id, CAST(n AS BIGINT) AS shared_turns, coalesce(c, r)[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM n)
SELECT pair_id, shared_turns, array_to_string(list_transform(p, lambda t: {_TURN}), '') AS prompt,
  CASE WHEN c IS NOT NULL THEN array_to_string(list_transform(c, lambda t: {_TURN}), '') END AS chosen,
  CASE WHEN r IS NOT NULL THEN array_to_string(list_transform(r, lambda t: {_TURN}), '') END AS rejected,
  CASE WHEN c IS NOT NULL THEN {_MASK.format(s="c")} END AS chosen_mask, CASE WHEN r IS NOT NULL THEN {_MASK.format(s="r")} END AS rejected_mask
FROM s
"""



def _nibble(i: int) -> int:
    """crc32's table entry of four bits."""
    for _ in range(4):
        i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
    return i


_DIGITS = "list_transform(range(0, len(hex(encode(k)))), lambda i: CAST(instr('0123456789ABCDEF', hex(encode(k))[xor(i, 1) + 1]) - 1 AS BIGINT))"
_CRC = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_DIGITS}), lambda c, x: xor({[_nibble(i) for i in range(16)]}[(xor(c, x) & 15) + 1], c >> 4)), 4294967295)"
OP12 = rf"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
c AS (SELECT DISTINCT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM r WHERE length(run) >= 5),
l AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM r WHERE length(run) >= 5),
k AS (SELECT doc_id, w, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS k FROM c),
h AS (SELECT doc_id, w, {_CRC} AS h FROM k),
t AS (SELECT CASE WHEN h % 97 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM l JOIN h USING (doc_id, w)),
v AS (SELECT word, count(*) AS n FROM t WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
p AS (SELECT word, n, i, word[:i - 1] AS a, word[i + 1:] AS b FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
e AS (SELECT x.word, y.word AS other, y.n AS m FROM p x JOIN p y USING (i, a, b) WHERE x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM p x JOIN v y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM p x JOIN v y ON x.a || x.b = y.word),
b AS (SELECT word, count(*) AS n_near, max(m) AS m FROM e GROUP BY word),
f AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN m END AS form_n, CASE WHEN m >= 2 * n THEN (SELECT min(other) FROM e WHERE e.word = v.word AND e.m = b.m) END AS form FROM v LEFT JOIN b USING (word)),
g AS (SELECT word, form, word AS root FROM f UNION ALL SELECT g.word, f.form, f.word FROM g JOIN f ON g.form = f.word)
SELECT word, f.form, g.root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM f JOIN g USING (word) WHERE g.form IS NULL
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*) AS docs, sum(len(ts)) AS length FROM d WHERE len(ts) > 0),
q AS (SELECT item_id, term, count(*) AS uses FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
a AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + CAST((75 * n * docs) // length AS BIGINT))) AS part FROM p, s),
r AS (SELECT item_id, doc_id, CAST(sum(uses * w * part) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN a USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

ORACLES = {"op7_substring_dedup": OP7, "op8_preference": OP8, "op12_spellings": OP12, "op13_ranked": OP13}


def _licenses() -> str:
    from crosslink.llm.licenses import ANCHORS, PHRASES, SHARE, TEMPLATES, WORDS, place_of

    text = lambda s: "'" + s + "'"
    words = lambda ws: "[" + ", ".join(map(text, ws)) + "]"
    phrases = ", ".join(f"({words(p.split())}, {text(label)})" for p, label in PHRASES.items())
    templates = ", ".join(f"({i}, {text(label)}, {words(ws)})" for i, ((label, _, _), ws) in enumerate(zip(TEMPLATES, WORDS)))
    keys = ", ".join(f"({i}, {place_of(ws, k.split())}, {words(k.split())})" for i, ((_, _, ks), ws) in enumerate(zip(TEMPLATES, WORDS)) for k in ks)
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
e AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM w),
ph(pw, label) AS (VALUES {phrases}), te(id, label, tw) AS (VALUES {templates}), ke(id, kp, kw) AS (VALUES {keys}),
b AS (SELECT doc_id, i, label FROM e JOIN w USING (doc_id) JOIN ph ON e.word = pw[1] AND ws[i + 1:i + len(pw)] = pw),
tp AS (SELECT id, unnest(range(len(tw))) AS pos, unnest(tw) AS word FROM te),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM e WHERE word IN (SELECT word FROM tp) GROUP BY word),
pr AS (SELECT DISTINCT doc_id, word FROM e WHERE word IN (SELECT word FROM tp)),
kw AS (SELECT DISTINCT id, unnest(kw) AS word FROM ke), kn AS (SELECT id, count(*) AS need FROM kw GROUP BY id),
ca AS (SELECT doc_id, id FROM pr JOIN kw USING (word) JOIN kn USING (id) GROUP BY doc_id, id, need HAVING count(*) = need),
an AS (SELECT doc_id, id, word FROM (SELECT doc_id, id, word, row_number() OVER (PARTITION BY doc_id, id ORDER BY n, word) AS r FROM ca JOIN (SELECT DISTINCT id, word FROM tp) USING (id) JOIN pr USING (doc_id, word) JOIN df USING (word)) WHERE r <= {ANCHORS}),
si AS (SELECT doc_id, id, count(*) AS size FROM an JOIN tp USING (id, word) GROUP BY doc_id, id),
h AS (SELECT doc_id, id, i - pos AS start, count(*) AS n FROM an JOIN e USING (doc_id, word) JOIN tp USING (id, word) GROUP BY ALL),
ok AS (SELECT doc_id, label, n / size AS share FROM h JOIN si USING (doc_id, id) JOIN te USING (id) JOIN w USING (doc_id)
  WHERE n >= ceil(size * CAST({SHARE} AS DOUBLE)) AND NOT EXISTS (SELECT 1 FROM ke WHERE ke.id = h.id AND NOT (start + kp >= 0 AND ws[start + kp + 1:start + kp + len(kw)] = kw))),
bb AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS ls FROM b GROUP BY doc_id),
oo AS (SELECT doc_id, max(share) AS share, list(DISTINCT label) AS ls FROM ok GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word, array_to_string(list_sort(coalesce(bb.ls, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(bb.ls, []), coalesce(oo.ls, [])))), ',') AS labels, CAST(greatest(coalesce(share, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
FROM w LEFT JOIN bb USING (doc_id) LEFT JOIN oo USING (doc_id)
"""


ORACLES["op9_licenses"] = _licenses()
