"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from logonlens.llm import collocations, license_scan, line_dedup, mixing, quality

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def mixing_sql() -> str:
    """Pairs of the lightest claimants, one after the other, and the way up from every half-block;
    then the order of all documents."""
    half = mixing.BLOCK_ROWS // 2
    return f"""WITH RECURSIVE
leaves AS (SELECT source, w, row_number() OVER (ORDER BY w, source NULLS FIRST) - 1 AS k
           FROM (SELECT source, pow(count(*), {mixing.TEMPERATURE}) AS w FROM documents GROUP BY source)),
queues AS (
  SELECT 0 AS m, count(*) AS s, list({{'w': w, 'k': k}} ORDER BY w, k) AS q FROM leaves
  UNION ALL
  SELECT m + 1, s, list_sort(list_append(q[3:], {{'w': q[1].w + q[2].w, 'k': s + m}})) FROM queues WHERE len(q) > 1),
links AS (SELECT q[i].k AS child, s + m AS parent, q[i].w / (q[1].w + q[2].w) AS p, i = 1 AS is_first
          FROM queues, range(1, 3) x(i) WHERE len(q) > 1),
hashed AS (SELECT doc_id, source, md5(concat_ws('/', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')),
             '{mixing.SEED}')) AS h FROM documents),
placed AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) - 1 AS k FROM hashed),
climb AS (
  SELECT DISTINCT p.source, p.k // {half} AS half, l.k AS node, CAST(p.k // {half} AS BIGINT) AS t
  FROM placed p JOIN leaves l ON l.source IS NOT DISTINCT FROM p.source
  UNION ALL
  SELECT source, half, parent, CAST(CASE WHEN is_first THEN ceil((t + 0.5::DOUBLE) / p) - 1 ELSE floor((t + 0.5::DOUBLE) / p) END AS BIGINT)
  FROM climb JOIN links ON node = child),
slots AS (SELECT * FROM climb WHERE node NOT IN (SELECT child FROM links))
SELECT p.doc_id, p.source, p.k // {mixing.BLOCK_ROWS} AS block, t AS slot,
  row_number() OVER (ORDER BY t, p.source NULLS FIRST, p.k) - 1 AS position
FROM placed p JOIN slots x ON x.source IS NOT DISTINCT FROM p.source AND x.half = p.k // {half}"""


def license_sql() -> str:
    """Every block of every text against every template, without a filter."""
    phrases = ", ".join(f"([{', '.join(repr(w) for w in p.split())}], '{label}')" for p, label in license_scan.PHRASES)
    templates = ", ".join(f"('{label}', {len(t.split())}, [{', '.join(repr(w) for w in sorted(set(t.split())))}])"
                          for label, t in license_scan.TEMPLATES)
    return f"""WITH phrases(p, label) AS (VALUES {phrases}),
templates(label, size, own) AS (VALUES {templates}),
docs AS (SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (SELECT r, label, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(p) - 1] = p)) - 1 AS place
           FROM docs, phrases),
base AS (SELECT r, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY r),
starts AS (SELECT r, w, label, size, own, unnest(range(0, len(w), size)) AS start FROM docs, templates),
shares AS (SELECT r, label, len(list_intersect(own, w[start + 1:start + 2 * size])) / len(own) AS share FROM starts),
best AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM shares
         WHERE share >= {license_scan.THRESHOLD} - 1e-9 GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ','), '')
    AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.share, 0.0::DOUBLE) END AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN best USING (r)"""


def quality_sql() -> str:
    q = quality
    space = r"\x20\x09-\x0D"
    kept = ["A-Z", "a-z", "0-9", space, r"#*$%&|<>", ".,;:!?"]
    counted = ", ".join(f"length(regexp_replace(t, '[^{k}]+', '', 'g'))" for k in kept)
    distance = ("sqrt(greatest(0, list_sum(list_transform(range(1, len({a}) + 1), lambda i: "
                "CASE WHEN {a}[i] > 0 THEN {a}[i] / list_sum({a}) * log2(2 * ({a}[i] / list_sum({a})) / ({a}[i] / list_sum({a}) + {b}[i] / list_sum({b}))) ELSE 0 END + "
                "CASE WHEN {b}[i] > 0 THEN {b}[i] / list_sum({b}) * log2(2 * ({b}[i] / list_sum({b})) / ({b}[i] / list_sum({b}) + {a}[i] / list_sum({a}))) ELSE 0 END)) / 2))")
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
parts AS (SELECT *, regexp_extract_all(t, '[^{space}]+') AS w,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{space}]')) AS lines,
            [{counted}, length(regexp_replace(t, '[\\x00-\\x7F]+', '', 'g'))] AS seven FROM docs),
counts AS (SELECT *, list_transform(list_append(seven, length(t) - list_sum(seven)), lambda x: CAST(x AS DOUBLE)) AS own_classes,
             list_filter(list_transform(w, lambda x: lower(trim(x, '.,;:!?|'))), lambda x: length(x) BETWEEN 1 AND {q.COMMON_CHARS}) AS short
           FROM parts),
windows AS (SELECT r, i, w[i:i + {q.WINDOW - 1}] AS win
            FROM (SELECT r, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM counts)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, sum(least({q.WINDOW}, i - before)) AS n
            FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -{q.WINDOW}) AS before FROM twice) GROUP BY r),
texts AS (SELECT lang AS ref, own_classes, short, len(w) AS n FROM counts WHERE lang IS NOT NULL
          UNION ALL SELECT NULL, own_classes, short, len(w) FROM counts),
classes AS (SELECT ref, list(total ORDER BY k) AS classes
            FROM (SELECT ref, k, sum(own_classes[k]) AS total FROM texts, range(1, {len(kept) + 3}) x(k) GROUP BY ref, k) GROUP BY ref),
totals AS (SELECT ref, sum(n) AS total FROM texts GROUP BY ref),
words AS (SELECT ref, word, count(*) AS c FROM (SELECT ref, unnest(short) AS word FROM texts) GROUP BY ref, word),
top AS (SELECT w.*, x.total FROM words w JOIN totals x ON w.ref IS NOT DISTINCT FROM x.ref WHERE c >= {q.COMMON_SHARE} * total
        QUALIFY row_number() OVER (PARTITION BY w.ref ORDER BY c DESC, word) <= {q.COMMON_WORDS}),
lists AS (SELECT ref, list(word ORDER BY c DESC, word) AS common, list(CAST(c AS DOUBLE) ORDER BY c DESC, word) AS held FROM top GROUP BY ref),
refs AS (SELECT x.ref, coalesce(common, []) AS common, list_append(coalesce(held, []), CAST(total - coalesce(list_sum(held), 0) AS DOUBLE)) AS shares,
           classes FROM totals x LEFT JOIN lists f ON f.ref IS NOT DISTINCT FROM x.ref JOIN classes c ON c.ref IS NOT DISTINCT FROM x.ref),
near AS (SELECT r, arg_min(ref, (-hits, ref)) AS ref FROM (SELECT r, f.ref, len(list_intersect(short, common)) AS hits
           FROM counts, refs f WHERE lang IS NULL AND f.ref IS NOT NULL) WHERE hits > 0 GROUP BY r),
own AS (SELECT c.*, f.classes, f.shares, list_transform(f.common, lambda x: CAST(len(list_filter(c.short, lambda y: y = x)) AS DOUBLE)) AS hits
        FROM counts c LEFT JOIN near USING (r) LEFT JOIN refs f ON f.ref IS NOT DISTINCT FROM coalesce(c.lang, near.ref)),
full_own AS (SELECT *, list_append(hits, len(w) - coalesce(list_sum(hits), 0)) AS own_words,
               list_append(list_transform(hits, lambda x: 0.0::DOUBLE), 1.0::DOUBLE) AS no_hit FROM own),
judged AS (SELECT *, CASE WHEN length(t) >= {q.MIN_CHARS_JUDGED} THEN {distance.format(a='own_classes', b='classes')} END AS cd,
             CASE WHEN len(w) >= {q.MIN_WORDS_JUDGED} THEN {distance.format(a='own_words', b='shares')}
               / nullif({distance.format(a='no_hit', b='shares')}, 0) END AS wd FROM full_own),
base AS (SELECT j.*, CAST(coalesce(v.n, 0) AS BIGINT) AS rep FROM judged j LEFT JOIN covered v USING (r))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(t) - own_classes[4] AS BIGINT) AS word_chars,
  CAST(own_classes[5] AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  rep AS n_repeat_words, len(w) < {q.MIN_WORDS} OR 100 * rep > {q.MAX_REPEAT_PERCENT} * len(w) AS base_failed,
  NOT (len(w) < {q.MIN_WORDS} OR 100 * rep > {q.MAX_REPEAT_PERCENT} * len(w))
    AND coalesce(cd, 0) <= {q.MAX_CHAR_DISTANCE} AND coalesce(wd, 0) <= {q.MAX_WORD_DISTANCE} AS kept
FROM base"""


def line_sql() -> str:
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
  string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, doc, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
keyed AS (SELECT *, translate(trim(line, {white}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (SELECT key, min(doc) AS first_doc FROM keyed WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key),
judged AS (SELECT k.*, coalesce(doc > first_doc, false) AS gone FROM keyed k LEFT JOIN firsts USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id"""


def collocation_sql() -> str:
    c = collocations
    return f"""WITH pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p
            FROM (SELECT coalesce(lang, '{c.NO_LANGUAGE}') AS lang, {_LOWER} AS t FROM documents)),
lists AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
grams AS (SELECT lang, w[i:i + k - 1] AS words, k, count(*) AS f
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, range(1, {c.LONGEST + 1}) x(k))
          GROUP BY ALL HAVING count(*) >= {c.MIN_COUNT}),
cuts AS (SELECT g.lang, g.words, g.k, g.f AS a, j, x.f AS l, y.f AS r, 2000000::HUGEINT * g.f // (x.f + y.f) AS score
         FROM (SELECT *, unnest(range(1, k)) AS j FROM grams) g
         JOIN grams x ON x.lang = g.lang AND x.words = g.words[:g.j] JOIN grams y ON y.lang = g.lang AND y.words = g.words[g.j + 1:]),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, j) = 1),
inside AS (SELECT lang, words[i:i + n - 1] AS words, max(a) AS most
           FROM (SELECT lang, words, a, n, unnest(range(1, k - n + 2)) AS i FROM scored, range(2, {c.LONGEST}) x(n) WHERE n < k) GROUP BY ALL),
kept AS (SELECT s.lang, array_to_string(s.words, ' ') AS phrase, a, l, r, score FROM scored s
         LEFT JOIN inside i ON i.lang = s.lang AND i.words = s.words WHERE most IS NULL OR 100 * most < {c.COVERED_PERCENT} * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {c.TOP}"""


ORACLE = {"op2_mixing": mixing_sql(), "op4_license_scan": license_sql(), "op6_quality": quality_sql(),
          "op12_collocations": collocation_sql(), "op13_line_dedup": line_sql()}
