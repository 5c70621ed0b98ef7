"""SQL counterparts that are longer than a few lines."""

from __future__ import annotations

from vitalgrid.llm.codes import Codes
from vitalgrid.llm.divergence import CLASSES, Rules
from vitalgrid.llm.licenses import Scan
from vitalgrid.llm.negatives import Mining


def _distance(counts: str, total: str, share: str) -> str:
    """Jensen-Shannon distance of a list of counts to a list of shares."""
    p, q = f"(z[1] / {total})", "z[2]"
    term = (
        f"CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"
        f" + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END"
    )
    return f"sqrt(greatest(0.0, list_sum(list_transform(list_zip({counts}, {share}), lambda z: {term})) / 2))"


def quality_rules(rules: Rules) -> str:
    steps = ["t0 AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS l0 FROM documents)"]
    for i, pattern in enumerate(CLASSES):
        pattern = pattern.replace("'", "''")
        steps.append(f"t{i + 1} AS MATERIALIZED (SELECT *, regexp_replace(l{i}, '{pattern}', '', 'g') AS l{i + 1} FROM t{i})")
    left = ",\n".join(steps)
    last = len(CLASSES)
    counts = ", ".join([f"length(l{i}) - length(l{i + 1})" for i in range(last)] + [f"length(l{last})"])
    sums = ", ".join(f"sum(classes[{i}])" for i in range(1, last + 2))
    parts = []
    for code, listed in rules.words.items():
        own = ", ".join(f"CAST(len(list_filter(words, lambda x: x = '{w}')) AS DOUBLE)" for w in listed)
        parts.append(f"""
  SELECT r, {_distance('classes', 'length(l0)', 'r_classes')} AS c, {_distance('counts', 'n_words', 'r_words')} AS w FROM (
    SELECT f.r, f.classes, f.l0, f.n_words, list_append(f.own, f.n_words - list_sum(f.own)) AS counts,
      list_transform(x.classes, lambda v: v / list_sum(x.classes)) AS r_classes,
      list_transform(list_append(x.own, x.n - list_sum(x.own)), lambda v: v / x.n) AS r_words
    FROM (SELECT *, [{own}] AS own FROM f) f CROSS JOIN (
      SELECT [{sums}] AS classes, [{", ".join(f"sum(own[{i}])" for i in range(1, len(listed) + 1))}] AS own, sum(n_words) AS n
      FROM (SELECT *, [{own}] AS own FROM f WHERE lang = '{code}') HAVING sum(n_words) > 0) x)""")
    return f"""
WITH {left},
f AS MATERIALIZED (
  SELECT r, doc_id, lang, l0, l5, [{counts}] AS classes, len(words) AS n_words, words,
    list_filter(string_split(l0, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM (SELECT *, list_filter(regexp_split_to_array(l0, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM t{last})),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(words[i:i + {rules.window - 1}], ' ')) AS n
  FROM (SELECT r, words, unnest(range(1, n_words - {rules.window - 2})) AS i FROM f)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {rules.window})) AS p FROM g WHERE n > 1) GROUP BY r),
near AS (SELECT r, min(c) AS c, min(w) AS w FROM ({" UNION ALL ".join(parts)}) GROUP BY r),
m AS (
  SELECT f.doc_id, n_words, length(l0) - classes[2] AS word_chars,
    length(l5) - length(regexp_replace(l5, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    CASE WHEN length(l0) >= {rules.least_chars} THEN near.c END AS char_distance,
    CASE WHEN n_words >= {rules.least_words} THEN near.w END AS word_distance
  FROM f LEFT JOIN rep USING (r) LEFT JOIN near USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {rules.base_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed,
  NOT (n_words < {rules.base_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words)
    AND coalesce(char_distance, 0) <= {rules.most_char_distance} AND coalesce(word_distance, 0) <= {rules.most_word_distance} AS kept
FROM m"""


JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, doc_id, count(*) AS n FROM s GROUP BY r, doc_id),
links AS (
  SELECT a.r AS x, b.r AS y FROM s a JOIN s b ON a.g = b.g AND a.r < b.r JOIN n na ON na.r = a.r JOIN n nb ON nb.r = b.r
  GROUP BY a.r, b.r, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
sym AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x, y FROM sym UNION SELECT reach.x, sym.y FROM reach JOIN sym ON reach.y = sym.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(o.doc_id), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN reach ON reach.x = d.r LEFT JOIN d o ON o.r = reach.y
GROUP BY d.r, d.doc_id, n.n"""


def license_scan(scan: Scan) -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, label, body.replace("'", "''")) for i, (label, body) in enumerate(scan.templates))
    phrases = ", ".join(f"('{phrase}', '{label}', {len(phrase.split())})" for phrase, label in scan.phrases)
    clean = r"trim(regexp_replace(lower(coalesce({}, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'))"
    k = scan.gram
    grams = f"array_to_string(w[i:i + {k - 1}], ' ') AS g"
    return f"""
WITH tpl AS (SELECT tpl, label, string_split({clean.format('body')}, ' ') AS w FROM (VALUES {rows}) t(tpl, label, body)),
tg AS (SELECT tpl, label, len(w) AS tw, i - 1 AS tpos, {grams} FROM (SELECT *, unnest(range(1, len(w) - {k - 2})) AS i FROM tpl)),
d AS (SELECT r, doc_id, CASE WHEN c = '' THEN [] ELSE string_split(c, ' ') END AS w
  FROM (SELECT row_number() OVER () AS r, doc_id, {clean.format('text')} AS c FROM documents)),
dg AS (SELECT r, i - 1 AS dpos, {grams} FROM (SELECT r, w, unnest(range(1, len(w) - {k - 2})) AS i FROM d)),
m AS (SELECT r, tpl, label, tw, dpos, tpos FROM dg JOIN tg USING (g)),
dia AS (SELECT r, tpl, label, tw, dpos - tpos AS diagonal, min(dpos) AS f, max(dpos) AS l, list(DISTINCT tpos) AS ats FROM m GROUP BY ALL),
part AS (SELECT *, sum(CASE WHEN diagonal - prev <= {scan.slack} THEN 0 ELSE 1 END) OVER (PARTITION BY r, tpl ORDER BY diagonal) AS part
  FROM (SELECT *, lag(diagonal) OVER (PARTITION BY r, tpl ORDER BY diagonal) AS prev FROM dia)),
span AS (SELECT r, tpl, label, tw, part, min(f) AS f, max(l) + {k - 1} AS l, flatten(list(ats)) AS ats FROM part GROUP BY ALL),
cov AS (SELECT *, len(list_distinct(flatten(list_transform(ats, lambda p: range(p, p + {k}))))) / tw AS cover, (l - f + 1) / tw AS size FROM span),
found AS (SELECT r, list(DISTINCT label) FILTER (cover >= {scan.least_cover} AND size <= {scan.most_length}) AS voted, max(cover) AS cover FROM cov GROUP BY r),
places AS (SELECT r, label, i - 1 AS place FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE list_contains(w, 'license'))
  JOIN (VALUES {phrases}) p(phrase, label, n) ON array_to_string(w[i:i + n - 1], ' ') = phrase),
base AS (SELECT r, count(*) AS n, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS own FROM places GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(own, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(voted, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE least(1.0, coalesce(cover, 0)) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""


def _whole(scale: int) -> str:
    """Usable embeddings as (r, vec_id, label, e) with whole components."""
    return f"""SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def codes(own: Codes) -> str:
    """Plain rounds: every part against every entry."""
    steps = [
        f"x AS MATERIALIZED ({_whole(int(own.scale))})",
        f"""p AS MATERIALIZED (SELECT r, vec_id, label, p, e[p * len(e) // {own.parts} + 1 : (p + 1) * len(e) // {own.parts}] AS v
  FROM (SELECT *, unnest(range({own.parts})) AS p FROM x))""",
        f"""c0 AS MATERIALIZED (SELECT p, k, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id, v) - 1 AS k FROM p)
  WHERE k < {own.entries})""",
    ]
    for i in range(own.rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, p.p, any_value(p.vec_id) AS vec_id, any_value(p.label) AS label, any_value(p.v) AS v,
    min(CAST(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 256 + k) AS m
  FROM p JOIN c{i} c ON p.p = c.p GROUP BY r, p.p)""")
        if i < own.rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.k, coalesce(n.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT p, k, list(CAST(floor(CAST(s AS DOUBLE) / n) AS BIGINT) ORDER BY j) AS v FROM (
      SELECT p, m % 256 AS k, j, sum(v[j]) AS s, count(*) AS n FROM (SELECT p, m, v, unnest(range(1, len(v) + 1)) AS j FROM a{i}) GROUP BY ALL)
    GROUP BY p, k) n ON n.p = c.p AND n.k = c.k)""")
    done = ",\n".join(steps)
    return f"""
WITH {done},
made AS (SELECT r, any_value(vec_id) AS vec_id, any_value(label) AS label, string_agg(lpad(lower(hex(m % 256)), 2, '0'), '' ORDER BY p) AS code,
  CAST(sum(m // 256) AS BIGINT) AS error FROM a{own.rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) FROM c{own.rounds}) AS codebooks_sha256 FROM made"""


def negatives(own: Mining, bump: str) -> str:
    """Every anchor against every row."""
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN {bump} ELSE label END AS label, e FROM ({_whole(int(own.scale))})
  WHERE vec_id IS NOT NULL AND label IS NOT NULL),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, x.vec_id AS id, a.label = x.label AS same,
    CAST(list_sum(list_transform(list_zip(a.e, x.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE same) WHERE r <= {own.positives})
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT pos.anchor_id, pos.id AS positive_id, pos.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY pos.anchor_id, pos.id ORDER BY s.score DESC, s.id) AS rank
  FROM pos JOIN s ON s.anchor_id = pos.anchor_id AND NOT s.same
    AND {own.least} * pos.score <= 100 * s.score AND 100 * s.score <= {own.most} * pos.score)
WHERE rank <= {own.negatives}"""


#: Base 32 by hand: 160 bits in 32 groups of five.
ARCHIVE = """
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    array_to_string(list_transform(string_split(sha1(coalesce(html, '')), ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS bits,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    list_sum(list_transform(range(5), lambda j: CAST(substr(bits, 5 * i + j + 1, 1) AS INT) * (16 >> j))) AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""
