"""SQL twins of those queries that SQL can express, for DuckDB."""

from __future__ import annotations

from paritas.llm import mixing, quality_rules

_BLANK, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
_ENDS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SQUEEZED = f"regexp_replace({{}}, '{_BLANK}', ' ', 'g')"
_LINE = _SQUEEZED.format(f"trim({{}}, {_ENDS})")

OP2 = f"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS ws FROM d),
win AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS five FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM win) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM again) GROUP BY 1),
l AS (SELECT doc_id, host, text, raw, {_LINE.format('lower(raw)')} AS line, len(regexp_extract_all(raw, '{_WORD}')) AS n
      FROM (SELECT *, unnest(string_split(text, chr(10))) AS raw FROM d)),
worded AS (SELECT * FROM l WHERE line <> ''),
dup AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM worded GROUP BY 1),
t AS (SELECT DISTINCT host, text, line, n FROM worded),
found AS (SELECT t.* FROM t JOIN (SELECT host, line FROM t GROUP BY 1, 2 HAVING count(*) > {quality_rules.MAX_DOCS}) c
          ON t.host IS NOT DISTINCT FROM c.host AND t.line = c.line),
own AS (SELECT host, text, sum(n) AS n FROM t GROUP BY 1, 2),
lost AS (SELECT host, text, sum(n) AS n, min(CAST('0x' || md5(line)[1:15] AS BIGINT)) AS least FROM found GROUP BY 1, 2),
cls AS (SELECT lost.host, lost.text, own.n - lost.n >= {quality_rules.MIN_LEFT} * own.n AS alone, CASE WHEN alone THEN lost.text ELSE CAST(least AS VARCHAR) END AS class
        FROM lost JOIN own ON lost.host IS NOT DISTINCT FROM own.host AND lost.text = own.text),
freq AS (SELECT found.host, line FROM found JOIN cls ON found.host IS NOT DISTINCT FROM cls.host AND found.text = cls.text
         GROUP BY 1, 2 HAVING count(DISTINCT (alone, class)) > {quality_rules.MAX_DOCS}),
gone AS (SELECT doc_id, count(*) AS lines, sum(n) AS words FROM worded w JOIN freq f ON w.host IS NOT DISTINCT FROM f.host AND w.line = f.line GROUP BY 1),
f AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, coalesce(gone.lines, 0) AS n_removed_lines, CAST(coalesce(gone.words, 0) AS BIGINT) AS n_removed_words
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, NOT base_failed AND n_words - n_removed_words >= {quality_rules.MIN_LEFT} * n_words AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)"""

_ESCAPED = r"regexp_replace(coalesce({}, ''), '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\2\\\3', 'g')"
OP3 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  CAST(sum(length('<|turn|><|text|><|end|>') + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
  FROM c GROUP BY 1)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
  0::BIGINT AS n_attachments, 0::BIGINT AS expanded_tokens FROM g"""

OP4 = f"""
WITH t AS (SELECT doc_id, {_SQUEEZED.format("coalesce(text, '')")} AS plain FROM documents),
g AS (SELECT plain, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM t JOIN g USING (plain)"""


def _passes(first: int, n: int) -> str:
    out = ""
    for k in range(first, first + n):
        out += f""",
g{k} AS (SELECT source, max(target) - sum((certain + extra) * words) AS gap FROM t{k} GROUP BY 1),
f{k} AS (SELECT t.*, gap, CASE WHEN place IS NOT NULL AND extra = 0 AND words > 0 AND words <= gap THEN words END AS fit
         FROM t{k} t JOIN g{k} g ON t.source IS NOT DISTINCT FROM g.source),
c{k} AS (SELECT *, sum(fit) OVER (PARTITION BY source ORDER BY place, fp, doc_id ROWS UNBOUNDED PRECEDING) AS taken_so_far FROM f{k}),
t{k + 1} AS (SELECT doc_id, fp, source, size, words, source_size, target, certain, place,
         CASE WHEN fit IS NOT NULL AND taken_so_far <= gap THEN 1 ELSE extra END AS extra FROM c{k})"""
    return out


def _exchange(k: int) -> str:
    return f""",
l{k} AS (SELECT * FROM (SELECT source, any_value(target) AS goal, any_value(target) - sum((certain + extra) * words) AS gap,
           any_value(target) - sum(certain * words) AS room FROM t{k} GROUP BY 1) WHERE gap > {mixing.SLACK} * goal),
y{k} AS (SELECT t.*, gap, room, CAST(floor(place * {mixing.BINS}) AS INTEGER) AS bin FROM t{k} t JOIN l{k} l ON t.source IS NOT DISTINCT FROM l.source
         WHERE place IS NOT NULL AND words > 0 AND words <= room),
h{k} AS (SELECT source, bin, sum(sum(words)) OVER (PARTITION BY source ORDER BY bin) AS upto FROM y{k} GROUP BY 1, 2),
b{k} AS (SELECT y.source, y.doc_id, y.fp, y.words, y.place, room, gap, h.bin AS until, upto - CASE WHEN h.bin >= y.bin THEN y.words ELSE 0 END AS beside
         FROM y{k} y JOIN h{k} h ON y.source IS NOT DISTINCT FROM h.source WHERE extra = 0
         UNION ALL SELECT source, doc_id, fp, words, place, room, gap, -1, 0 FROM y{k} WHERE extra = 0),
z{k} AS (SELECT source, doc_id, fp, place, room, gap, max(beside + words) AS s, max(until) AS until FROM b{k}
         WHERE beside + words <= room GROUP BY ALL HAVING max(beside + words) > room - gap),
i{k} AS (SELECT source, room, arg_max((doc_id, fp, until), (s, -place, fp, doc_id)) AS c FROM z{k} GROUP BY 1, 2),
t{k + 1} AS (SELECT doc_id, fp, t.source, size, words, source_size, target, certain, place, CASE WHEN c IS NULL THEN extra
         WHEN t.doc_id IS NOT DISTINCT FROM c[1] AND fp = c[2] THEN 1
         WHEN place IS NOT NULL AND words > 0 AND words <= room AND floor(place * {mixing.BINS}) <= c[3] THEN 1 ELSE 0 END AS extra
         FROM t{k} t LEFT JOIN i{k} i ON t.source IS NOT DISTINCT FROM i.source)"""


OP5 = f"""
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS fp, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents),
u AS (SELECT doc_id, fp, source, size, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY doc_id, fp, source, size),
s AS (SELECT source, CAST(sum(words) AS BIGINT) AS source_size FROM u GROUP BY 1),
w AS (SELECT *, [1.0::DOUBLE, 2.0, 3.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight,
        CAST({mixing.MOST} * source_size AS DOUBLE) AS ceiling FROM s),
o AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(ceiling) OVER filled, 0) AS room,
        sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0) AS rest FROM w
      WINDOW filled AS (ORDER BY ceiling / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, room / rest AS level FROM o),
x AS (SELECT source, source_size, least(ceiling, weight * (SELECT arg_min(level, ceiling / weight) FROM v WHERE level * weight <= ceiling)) AS target FROM v),
e AS (SELECT u.*, source_size, target, CASE WHEN source_size > 0 THEN least({float(mixing.MOST)}, target / source_size) ELSE 0.0 END AS expected,
        (CAST(('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), fp, '5')), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS draw
      FROM u JOIN x ON u.source IS NOT DISTINCT FROM x.source),
p AS (SELECT *, CAST(floor(expected) AS BIGINT) AS certain, expected - floor(expected) AS chance FROM e),
q AS (SELECT *, CASE WHEN chance > 0 THEN (draw / (1 - draw)) * ((1 - chance) / chance) END AS odds FROM p),
t0 AS (SELECT doc_id, fp, source, size, words, source_size, target, certain, odds / (1 + odds) AS place, 0 AS extra FROM q){_passes(0, 3)}{_exchange(3)}{_passes(4, 2)}
SELECT d.doc_id, d.size, source_size, target, (certain + extra) * d.size AS taken, certain + extra AS copies
FROM d JOIN t6 t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.fp = t.fp AND d.source IS NOT DISTINCT FROM t.source"""

OP7 = f"""
WITH l AS (SELECT doc_id, pos, raw, {_LINE.format('raw')} AS line FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
w AS (SELECT doc_id, pos, lead(pos) OVER o AS pos2, lead(pos, 2) OVER o AS pos3, line, lead(line) OVER o AS line2, lead(line, 2) OVER o AS line3
      FROM l WHERE line <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, pos) AS place FROM w WHERE line3 IS NOT NULL) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos2, pos3]) AS pos FROM later),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1),
kept AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) AS text FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_removed_lines, CASE WHEN n.n IS NULL THEN d.n_chars ELSE length(coalesce(kept.text, '')) END AS n_chars_left,
  sha256(CASE WHEN n.n IS NULL THEN d.text ELSE coalesce(kept.text, '') END) AS text_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP10 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS gram FROM (SELECT *, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * k >= 80 * (a.n + b.n - k)),
ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT y, root FROM reach JOIN ways ON node = x),
comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents LEFT JOIN n USING (doc_id) JOIN comp ON doc_id = node"""

_VECTORS = "len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP11 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {_VECTORS} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT y, root FROM reach JOIN links ON node = x),
comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1),
n AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN comp ON vec_id = node LEFT JOIN n ON vec_id = x"""

_CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY i) AS crc_of FROM (
  WITH RECURSIVE r(i, k, v) AS (SELECT range, 0, range FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM r WHERE k < 8) SELECT i, v FROM r WHERE k = 8))"""
_CRC = """xor(list_reduce([4294967295] || list_transform(range(0, length(bytes), 2), lambda i: CAST('0x' || substr(bytes, i + 1, 2) AS BIGINT)),
  lambda a, b: xor(a >> 8, crc_of[CAST(xor(a, b) & 255 AS INTEGER) + 1])), 4294967295)"""

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2),
crcs AS (SELECT run, n, {_CRC} AS h FROM runs, crc_table),
said AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crcs),
vocab AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM said WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS (SELECT a.word AS x, b.word AS y, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cut c JOIN vocab v ON c.rest = v.word UNION SELECT v.word, c.word, c.n FROM cut c JOIN vocab v ON c.rest = v.word),
best AS (SELECT x, count(*) AS n_near, arg_min(y, (-n, encode(y))) AS y, max(n) AS form_n FROM near GROUP BY 1),
forms AS (SELECT word, vocab.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * vocab.n THEN y END AS form,
  CASE WHEN form_n >= 5 * vocab.n THEN form_n END AS form_n FROM vocab LEFT JOIN best ON word = x),
led AS (SELECT word, word AS root, 0 AS steps FROM forms UNION ALL SELECT led.word, forms.form, steps + 1 FROM led JOIN forms ON led.root = forms.word WHERE forms.form IS NOT NULL)
SELECT forms.*, r.root FROM forms JOIN (SELECT word, arg_max(root, steps) AS root FROM led GROUP BY 1) r USING (word)"""

OP13 = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND {_VECTORS}),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER o AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER o <= 5"""

TWINS = {"op2_quality_rules": OP2, "op3_chat_format": OP3, "op4_exact_dedup": OP4, "op5_mix_sources": OP5, "op7_line_dedup": OP7, "op10_near_dedup": OP10,
         "op11_vector_dedup": OP11, "op12_spelling_variants": OP12, "op13_hard_negatives": OP13}
