"""DuckDB SQL for the queries that SQL can express, written from the contracts.

None is given for op2 and op8 (trained models), op4 (match positions) and the pipeline; their tests compare with brute
force or measure held-out accuracy.
"""

from __future__ import annotations

from scorewright.llm.licenses import templates

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def alnum(text: str) -> str:
    return (rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def blank(text: str, lower: bool = False) -> str:
    text = f"coalesce({text}, '')"
    return rf"regexp_extract_all({f'''translate({text}, '{UPPER}', '{LOWER}')''' if lower else text}, '[^\x20\x09-\x0D]+')"


DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {alnum('text')} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {alnum('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[s:s + 12] AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0) x),
lens AS (SELECT DISTINCT len(win) AS n FROM win),
dw AS (SELECT doc_id, n, s, w[s:s + n - 1] AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN lens ON len(w) >= n) x),
hit AS (SELECT doc_id, s, n, item_id FROM dw JOIN win USING (win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) x GROUP BY 1),
it AS (SELECT doc_id, count(item_id) AS n_items, sha256(coalesce(string_agg(item_id, ',' ORDER BY item_id), '')) AS h
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) x GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)"""

LINES = r"""WITH RECURSIVE ln AS (SELECT doc_id, i - 1 AS line, trim(l[i], E' \t\n\r\x0b\x0c') AS t
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) a) b),
big AS (SELECT * FROM ln WHERE regexp_matches(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]')),
txt AS (SELECT t, length(t) AS n, row_number() OVER (ORDER BY t) AS id FROM (SELECT DISTINCT t FROM big) x),
near AS (SELECT a.id AS a, b.id AS b FROM txt a JOIN txt b ON b.n BETWEEN a.n AND a.n + 2 AND a.id <> b.id
    WHERE a.n >= 30 AND levenshtein(a.t, b.t) <= 2),
link AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
cls AS (SELECT txt.t, least(id, coalesce(min(b), id)) AS c FROM txt LEFT JOIN reach ON id = a GROUP BY txt.t, id),
ranked AS (SELECT doc_id, line, row_number() OVER (PARTITION BY c ORDER BY doc_id, line) AS k FROM big JOIN cls USING (t)),
gone AS (SELECT doc_id, line FROM ranked WHERE k > 1),
out AS (SELECT doc_id, count(*) AS n, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS r FROM gone GROUP BY 1),
kept AS (SELECT doc_id, string_agg(l[i], chr(10) ORDER BY i) AS t
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) a) b
    WHERE (doc_id, i - 1) NOT IN (SELECT (doc_id, line) FROM gone) GROUP BY doc_id)
SELECT d.doc_id, coalesce(out.n, 0) AS n_removed, coalesce(out.r, '') AS removed, sha256(coalesce(kept.t, '')) AS text_sha256
FROM documents d LEFT JOIN out USING (doc_id) LEFT JOIN kept USING (doc_id)"""

#: Base32 of the hex digest s: four characters for every five hex digits.
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(s, {i}, 5) AS BIGINT) >> {k}) & 31 AS INTEGER) + 1, 1)"
    for i in range(1, 41, 5) for k in (15, 10, 5, 0))

WARC = r"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, url, strlen(body) AS n, sha1(body) AS s FROM p),
g AS (SELECT s, max(page_id) AS latest FROM h GROUP BY s),
u AS (SELECT page_id, regexp_replace(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://|#.*$', '', 'g') AS bare FROM h),
k AS (SELECT page_id, CASE WHEN bare = '' THEN '' ELSE array_to_string(list_reverse(string_split(
        regexp_extract(bare, '^[^/?]*'), '.')), ',') || ')' || substr(bare, length(regexp_extract(bare, '^[^/?]*')) + 1) END
        AS url_key FROM u)
SELECT h.page_id, h.n AS payload_bytes, """ + BASE32 + r""" AS payload_digest,
    CASE WHEN h.page_id = g.latest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN h.page_id <> g.latest THEN g.latest END AS refers_to, k.url_key,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(h.page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM h JOIN g USING (s) JOIN k USING (page_id)"""


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


LICENSES = f"""WITH d AS (SELECT doc_id, {alnum('text')} AS w FROM documents),
t(tid, label, phrase, words, need, span) AS (VALUES {', '.join(
    f"({i}, '{label}', {phrase}, {_list(words)}, {need}, {span})" for i, label, phrase, words, need, span in templates())}),
pb AS (SELECT doc_id, label, s AS start, 1.0 AS share
    FROM (SELECT doc_id, w, label, words, unnest(range(0, len(w) - len(words) + 1)) AS s FROM d, t WHERE phrase) x
    WHERE w[s + 1:s + len(words)] = words),
nb AS (SELECT doc_id, label, need, len(words) AS m, len(list_intersect(words, w[s + 1:s + 2 * span])) AS got
    FROM (SELECT doc_id, w, label, words, need, span, unnest(list_filter(range(len(w)), lambda s: list_contains(words, w[s + 1]))) AS s
        FROM d, t WHERE NOT phrase) x),
found AS (SELECT doc_id, label, start, share FROM pb
    UNION ALL SELECT doc_id, label, NULL, CAST(got AS DOUBLE) / m FROM nb WHERE got >= need),
f AS (SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
        string_agg(DISTINCT CASE WHEN start IS NOT NULL THEN label END, ',' ORDER BY CASE WHEN start IS NOT NULL THEN label END)
            AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN f USING (doc_id)"""


def ticket(*parts: str) -> str:
    text = " || '|' || ".join(["'mix'", *[f"coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts]])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _entropy(a: str) -> str:
    return f"(SELECT ln(sum(pow(s, {a}))) - {a} * sum(pow(s, {a}) * ln(s)) / sum(pow(s, {a})) FROM sh)"


def _repeats(a: str) -> str:
    return f"(SELECT max(pow(s, {a} - 1)) / sum(pow(s, {a})) FROM sh)"


MIXING = f"""WITH RECURSIVE rows0 AS (SELECT doc_id, source, len({blank('text')}) AS n_tokens, md5(coalesce(text, '')) AS tk
    FROM documents),
src AS (SELECT source, count(*) AS docs, sum(n_tokens) AS tokens FROM rows0 GROUP BY source),
live AS (SELECT * FROM src WHERE tokens > 0),
tot AS (SELECT CAST(sum(tokens) AS DOUBLE) AS t, count(*) AS n FROM live),
sh AS (SELECT CAST(tokens AS DOUBLE) / t AS s FROM live, tot),
b1(i, lo, hi) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
    UNION ALL SELECT i + 1, CASE WHEN e >= 0.95 * ln(n) THEN mid ELSE lo END, CASE WHEN e >= 0.95 * ln(n) THEN hi ELSE mid END
    FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, {_entropy('((lo + hi) / 2)')} AS e, n FROM b1, tot WHERE i < 40) x),
a1 AS (SELECT CASE WHEN {_entropy('CAST(1 AS DOUBLE)')} >= 0.95 * ln(n) THEN 1.0
    ELSE (SELECT lo FROM b1 WHERE i = 40) END AS a FROM tot),
b2(i, lo, hi) AS (SELECT 0, a, CAST(1 AS DOUBLE) FROM a1
    UNION ALL SELECT i + 1, CASE WHEN r > 4 THEN mid ELSE lo END, CASE WHEN r > 4 THEN hi ELSE mid END
    FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid, {_repeats('((lo + hi) / 2)')} AS r FROM b2 WHERE i < 40) x),
ex AS (SELECT CASE WHEN {_repeats('a')} > 4 THEN (SELECT hi FROM b2 WHERE i = 40) ELSE a END AS a FROM a1),
z AS (SELECT sum(pow(CAST(tokens AS DOUBLE) / t, a)) AS z FROM live, tot, ex),
plan AS (SELECT source, tokens, pow(CAST(tokens AS DOUBLE) / t, a) / z AS weight,
        CAST(round(pow(CAST(tokens AS DOUBLE) / t, a) / z * t) AS BIGINT) AS goal,
        least((docs + 255) // 256, 65536) AS n_blocks FROM live, tot, ex, z),
dealt AS (SELECT r.doc_id, r.source, r.n_tokens, r.tk, p.weight, p.goal, p.tokens, p.n_blocks, p.goal // p.tokens AS "full",
        {ticket('r.doc_id', 'r.tk')} % p.n_blocks AS block
    FROM rows0 r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source),
blocks AS (SELECT source, block, goal, tokens, n_blocks, "full", sum(n_tokens) AS b_tokens FROM dealt GROUP BY ALL),
sched AS (SELECT *, row_number() OVER w - 1 AS place, sum(b_tokens) OVER w - b_tokens AS before
    FROM (SELECT *, unnest(range(0, CAST("full" + 1 AS BIGINT))) AS epoch FROM blocks) x
    WINDOW w AS (PARTITION BY source, epoch ORDER BY {ticket('source', 'epoch', 'block')}, block ROWS UNBOUNDED PRECEDING)),
take AS (SELECT source AS s_, block AS b_, epoch, b_tokens, "full" AS f_,
        (CASE WHEN epoch < "full" THEN tokens ELSE goal - "full" * tokens END) - before AS room,
        (epoch + CAST(place AS DOUBLE) / n_blocks) / ("full" + 1) AS stream_at FROM sched),
used AS (SELECT d.doc_id, d.source, d.n_tokens, round(d.weight, 6) AS weight, t.epoch, d.block, t.stream_at, t.room, t.b_tokens,
        sum(d.n_tokens) OVER (PARTITION BY d.source, t.epoch, d.block ORDER BY {ticket('t.epoch', 'd.doc_id', 'd.tk')},
            d.n_tokens ROWS UNBOUNDED PRECEDING) AS spent
    FROM dealt d JOIN take t ON d.source IS NOT DISTINCT FROM t.s_ AND d.block = t.b_
    WHERE t.epoch < t.f_ OR t.room > 0)
SELECT doc_id, source, n_tokens, weight, CAST(epoch AS INTEGER) AS epoch, CAST(block AS INTEGER) AS block, stream_at
FROM used WHERE b_tokens <= room OR spent <= room"""

NGRAM_JOIN = f"""WITH RECURSIVE d AS (SELECT doc_id, {blank('text', True)} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, w[s:s + 3] AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0) x),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
links AS (SELECT a AS doc_id, count(*) AS l FROM link GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, coalesce(l, 0) AS n_links
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN links USING (doc_id) LEFT JOIN low ON a = d.doc_id"""


def _covered(n: int, only: str = "TRUE") -> str:
    """(doc_id, c): words inside windows of n words that occur twice in their text."""
    return f"""(SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest(range(s, s + {n})) AS p FROM (
        SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS k FROM (
            SELECT doc_id, s, w[s:s + {n - 1}] AS g FROM (
                SELECT doc_id, w, unnest(range(1, len(w) - {n} + 2)) AS s FROM d WHERE len(w) >= {n} AND {only}) q1) q2) q3
        WHERE k > 1) q4 GROUP BY doc_id)"""


QUALITY_RULES = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {blank('text')} AS w FROM documents),
ln AS (SELECT doc_id, count(*) - count(DISTINCT l) AS dup
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) x WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
r8 AS {_covered(8)}, r4 AS {_covered(4)},
r201 AS {_covered(201, "doc_id IN (SELECT doc_id FROM r8 WHERE c > 201)")},
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
        coalesce(r8.c, 0) AS n_repeat_words, coalesce(r4.c, 0) AS n_covered_words, r201.c AS too_long
    FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN r8 USING (doc_id) LEFT JOIN r4 USING (doc_id) LEFT JOIN r201 USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 10 * n_covered_words <= 4 * n_words AND too_long IS NULL AS kept
FROM m"""

HARD_NEGATIVES = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
        CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM e a JOIN e c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
    score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3"""

#: Words by deletion: two words are one edit apart if deleting a letter of one gives the other, or deleting the letter at
#: one position of both gives the same.
SPELLING = f"""WITH RECURSIVE tab AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(
        [CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS t),
run AS (SELECT id, run, count(*) AS c, encode(id || ':' || run) AS bytes FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
        unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) x
    GROUP BY id, run),
crc AS (SELECT run, c, xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(bytes)), lambda i:
        CAST('0x' || substr(hex(bytes), 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM run, tab WHERE length(run) >= 7),
w AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (SELECT c, CASE WHEN h % 31 <> 0 THEN run ELSE
        substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word FROM crc) x
    WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
del AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w) x),
near AS (SELECT a.word, b.word AS other, b.n FROM del a JOIN del b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM del a JOIN w b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM del a JOIN w b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS n FROM near GROUP BY word),
v AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN other END AS form,
        CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n FROM w LEFT JOIN best b ON w.word = b.word),
path AS (SELECT word, form AS at FROM v WHERE form IS NOT NULL
    UNION ALL SELECT path.word, v.form FROM path JOIN v ON path.at = v.word WHERE v.form IS NOT NULL),
ends AS (SELECT path.word, path.at FROM path JOIN v ON path.at = v.word WHERE v.form IS NULL)
SELECT v.word, form, coalesce(ends.at, v.word) AS root, n, n_near, form_n FROM v LEFT JOIN ends ON v.word = ends.word"""

EXACT_DEDUP = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)"""

ORACLES: dict[str, str] = {
    "op1_decontamination": DECONTAMINATION,
    "op3_line_dedup": LINES,
    "op5_warc": WARC,
    "op6_license_scan": LICENSES,
    "op7_mixing": MIXING,
    "op9_ngram_jaccard": NGRAM_JOIN,
    "op10_quality_rules": QUALITY_RULES,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_spelling_variants": SPELLING,
    "op13_exact_dedup": EXACT_DEDUP,
}
