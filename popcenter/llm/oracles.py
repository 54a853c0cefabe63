"""DuckDB SQL for the queries of this package that SQL can express.

Not here: op1 and op7 (trained models), op2 (MinHash windows), op3 and the pipeline; tests/llm holds
op7 against held-out labels and op4, op5, op10 to op13 against plain Python as well.
"""

from __future__ import annotations

from popcenter.llm.lines import MAX_LOST, MAX_SHARE, MIN_DOCS, SYMBOLS
from popcenter.llm.urls import RULES

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _words(text: str, pattern: str = WORD) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{pattern}')"


NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(f"translate(text, {ASCII_LOWER})")} AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS sh FROM d),
c AS (SELECT sh, len(sh) AS n, min(doc_id) AS rep FROM s WHERE len(sh) > 0 GROUP BY sh),
e AS (SELECT rep, n, unnest(sh) AS g FROM c),
l AS (SELECT a.rep AS x, b.rep AS y FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM r JOIN both_ways b ON r.y = b.x),
k AS (SELECT c.sh, least(c.rep, coalesce(min(r.y), c.rep)) AS component_id FROM c LEFT JOIN r ON r.x = c.rep GROUP BY c.sh, c.rep)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(k.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(k.component_id, s.doc_id) AS kept
FROM s LEFT JOIN k ON k.sh = s.sh
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t FROM p),
rep AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 35)))) AS g FROM win JOIN rep USING (t) GROUP BY doc_id),
o AS (SELECT doc_id, w, CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, j: NOT list_contains(g, j)) END AS kept
      FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM o
"""

URLS = f"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {ASCII_LOWER}) AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(entry, v) AS (VALUES {", ".join(f"('{e}', '{v}')" for e, v in RULES)}),
fit AS (SELECT page_id, arg_max(entry, length(entry)) AS rule, arg_max(v, length(entry)) AS v FROM q JOIN rules
        ON (host = split_part(entry, '/', 1) OR ends_with(host, '.' || split_part(entry, '/', 1)))
       AND starts_with(path, substr(entry, strpos(entry, '/'))) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM q LEFT JOIN fit USING (page_id)
"""

MIX = f"""
WITH lab AS (SELECT doc_id, CASE WHEN min(quality) >= 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS lw FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, source, CAST(len({_words("text")}) AS BIGINT) AS size, md5(text) AS h, coalesce(lw, 1.0) AS qw
      FROM documents LEFT JOIN lab USING (doc_id)),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT *, ([3.0, 1.0, 2.0])[1 + (i - 1) % 3]::DOUBLE AS sw, 2.0::DOUBLE * source_size AS cap FROM src),
lines AS (SELECT *, (1.5 * sum(source_size) OVER () - (sum(cap) OVER (o ROWS UNBOUNDED PRECEDING) - cap))
                    / sum(sw) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS line
          FROM w WINDOW o AS (ORDER BY cap / sw, i)),
t AS (SELECT source, source_size, least(cap, max(line) OVER () * sw)::DOUBLE AS target FROM lines),
k AS (SELECT *, -ln((('0x' || substr(md5(concat_ws('|', '11', CAST(doc_id AS VARCHAR), h)), 1, 13))::BIGINT + 0.5) / 4503599627370496) / qw
             AS key FROM d),
m AS (SELECT k.*, source_size, target,
             sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, h ROWS UNBOUNDED PRECEDING) - size / 2.0 AS middle,
             CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
      FROM k JOIN t ON t.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, round(target, 6) AS target, source,
       CAST(size * (epochs + CASE WHEN target - epochs * source_size > 0 AND middle <= target - epochs * source_size
                             THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM m
"""

LINES = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {_words("text")} AS w FROM documents),
b AS (SELECT doc_id, source, t, w, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT)
             AS word_chars, CAST(length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
g AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
r AS (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM g
      QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rw AS (SELECT doc_id, count(DISTINCT p) AS n FROM r GROUP BY doc_id),
x AS (SELECT doc_id, source, t, lower(trim(regexp_replace(unnest(ls), '{SPACE}', ' ', 'g'))) AS line FROM b),
f AS (SELECT source, line FROM x GROUP BY source, line
      HAVING count(DISTINCT doc_id) > {MIN_DOCS} AND count(DISTINCT doc_id) > {MAX_SHARE} * (
        SELECT count(DISTINCT doc_id) FROM d WHERE d.source IS NOT DISTINCT FROM x.source)),
lost AS (SELECT doc_id, CAST(sum(len(string_split(line, ' '))) AS BIGINT) AS n FROM x
         WHERE EXISTS (SELECT 1 FROM f WHERE f.source IS NOT DISTINCT FROM x.source AND f.line = x.line) GROUP BY doc_id),
o AS (SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(rw.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_lost_words
      FROM b LEFT JOIN rw USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_words <= {MAX_LOST} * n_words AS kept
FROM o
"""

LEAKS = f"""
WITH d AS (SELECT doc_id, {_words(f"translate(text, {ASCII_LOWER})", LETTER_WORD)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words(f"translate(text, {ASCII_LOWER})", LETTER_WORD)} AS w FROM benchmark),
bw AS (SELECT item, i, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT list(DISTINCT n) AS ns FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM (SELECT doc_id, w, unnest(ns) AS n FROM d, ns) WHERE len(w) >= n)),
hits AS (SELECT doc_id, dw.i, dw.n, item, bw.i AS j FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
runs AS (SELECT doc_id, item, count(*) + any_value(n) - 1 AS len FROM (
           SELECT *, i - row_number() OVER (PARTITION BY doc_id, item, i - j ORDER BY i) AS run FROM hits)
         GROUP BY doc_id, item, i - j, run),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS l FROM hits GROUP BY doc_id),
longest AS (SELECT doc_id, CAST(max(len) AS INTEGER) AS m FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(cover.n, 0) AS n_hit, CAST(coalesce(len(l), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated,
       coalesce(m, 0) AS longest_match
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
"""


COPIES = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {ASCII_LOWER}) AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""


# CRC-32 of a list of bytes, by the table of its bytes; ``crc.t`` must be in scope
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    """CRC-32 of the UTF-8 of a text whose code points are below U+0800."""
    u = "CAST(unicode(ch) AS BIGINT)"
    data = (f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN {u} < 128 THEN [{u}] "
            f"ELSE [192 + ({u} >> 6), 128 + ({u} & 63)] END))")
    return (f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {data}), "
            "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))")


SPELLING = f"""
WITH RECURSIVE {CRC_TABLE},
found AS (SELECT doc_id, translate(run, {ASCII_LOWER}) AS run, count(*) AS c FROM (
            SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents) GROUP BY ALL),
marked AS (SELECT run, c, {_crc("concat(CAST(doc_id AS VARCHAR), ':', run)")} AS h FROM found, crc),
spelled AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
            FROM marked),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
holes AS (SELECT word, n, length(word) AS l, i, substr(word, 1, i - 1) || substr(word, i + 1) AS hole
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b
           ON a.i = b.i AND a.l = b.l AND a.hole = b.hole AND a.word <> b.word
         UNION SELECT holes.word, v.word, v.n FROM holes JOIN v ON hole = v.word
         UNION SELECT v.word, holes.word, holes.n FROM holes JOIN v ON hole = v.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS top, max(near_n) AS top_n FROM near GROUP BY word),
j AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * n THEN top END AS form,
             CASE WHEN top_n >= 10 * n THEN top_n END AS form_n FROM v LEFT JOIN best USING (word)),
way(word, goal) AS (SELECT word, form FROM j WHERE form IS NOT NULL
                  UNION ALL SELECT way.word, j.form FROM way JOIN j ON j.word = way.goal WHERE j.form IS NOT NULL),
last AS (SELECT way.word, way.goal FROM way JOIN j ON j.word = way.goal WHERE j.form IS NULL)
SELECT word, form, coalesce(last.goal, word) AS root, n, n_near, form_n FROM j LEFT JOIN last USING (word)
"""

PERIODS = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, {_words("text")} AS w, {_crc("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc),
a AS (SELECT doc_id, w, h, (h // 10) % nullif(len(w), 0) AS a, 1 + (len(w) - (h // 10) % nullif(len(w), 0)) // (3 + (h // 10) % 8) AS p FROM d),
l AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
        THEN list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w FROM a),
pos AS (SELECT doc_id, n, i, w[i + 1] AS t FROM (SELECT doc_id, w, len(w) AS n, unnest(range(len(w))) AS i FROM l)),
eq AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM pos x JOIN pos y
       ON x.doc_id = y.doc_id AND x.t = y.t AND y.i > x.i AND y.i - x.i <= x.n // 3),
st AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
       FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM eq)
       GROUP BY doc_id, q, part HAVING count(*) >= 2 * q AND count(*) + q >= 24),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM st GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS c FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS s,
                  first(struct_pack(s := start, n := length, q := period) ORDER BY length / period DESC, start, period) AS b
           FROM runs GROUP BY doc_id)
SELECT l.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.n AS length, b.q AS period, 1000 * b.n // b.q AS exponent_milli,
       sha256(coalesce(listed.s, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256, CAST(len(w) AS BIGINT) AS n_words
FROM l LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_near_duplicates": NEAR_DUPLICATES,
        "op5_substrings": SUBSTRINGS,
        "op6_url_filter": URLS,
        "op8_mix": MIX,
        "op9_line_frequency": LINES,
        "op10_suffix_arrays": LEAKS,
        "op11_spelling": SPELLING,
        "op12_digest_index": COPIES,
        "op13_periodic_runs": PERIODS,
    }
