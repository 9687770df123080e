"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from millrace.llm.license_scan import BASE, LOWER, TEMPLATES, UPPER
from millrace.llm.quality_rules import MEASURES, Rules
from millrace.llm.url_filter import RULES, UNITS, Spread

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WHITE = r"[^\x20\x09-\x0D]+"
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
PIECE_WORDS = r"[^\x20\x09]+"


def lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id, regexp_extract_all({lower("text")}, '{LETTERS}') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i)
  WHERE len(w) > 0
),
docs AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({lower("text")}, '{LETTERS}') AS w FROM documents
),
places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
),
hits AS (
  SELECT p.r, p.i, p.n, x.item_id
  FROM (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM places) p
  JOIN windows x ON x.n = p.n AND x.win = p.win
),
words AS (
  SELECT r, count(DISTINCT k) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r
),
found AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""

SUBSTRINGS = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(coalesce(text, ''), '{WHITE}') AS w FROM documents
),
windows AS (
  SELECT doc_id, r, i, array_to_string(w[i : i + 12], ' ') AS win
  FROM docs, unnest(range(1, len(w) - 11)) AS u(i)
),
gone AS (
  SELECT r, list(DISTINCT k) AS ks
  FROM (
    SELECT r, unnest(range(i, i + 13)) AS k
    FROM windows JOIN (SELECT win, min(doc_id) AS low FROM windows GROUP BY win) USING (win)
    WHERE low < doc_id
  ) GROUP BY r
),
words AS (
  SELECT r, i, w[i] AS word FROM docs, unnest(range(1, len(w) + 1)) AS u(i)
),
removed AS (SELECT r, unnest(ks) AS i FROM gone),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t
  FROM words ANTI JOIN removed USING (r, i) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(len(ks), 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({lower("text")}, '{WHITE}') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i)
  WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
),
reach AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
),
parts AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN parts USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


def url_filter(how: Spread = Spread()) -> str:
    """Rules, and the rounds of both propagations one after the other."""
    host = f"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    path = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    steps = []
    for name, verdict, src, dst in (("trust", "allow", "src", "dst"), ("distrust", "block", "dst", "src")):
        steps.append(f"""
{name}_seed AS (
  SELECT host, {UNITS}::HUGEINT * count(*) // sum(count(*)) OVER () AS seed
  FROM judged WHERE verdict = '{verdict}' GROUP BY host
),
{name}_edges AS (
  SELECT {src} AS src, {dst} AS dst, n, sum(n) OVER (PARTITION BY {src}) AS out FROM edges
),
{name}_0 AS (SELECT host, seed AS rank FROM {name}_seed)""")
        for k in range(how.rounds):
            steps.append(f"""
{name}_{k + 1} AS (
  SELECT host, sum(rank)::HUGEINT AS rank FROM (
    SELECT dst AS host, rank * {how.damping_percent} * n // (100 * out) AS rank
    FROM {name}_{k} JOIN {name}_edges ON host = src
    UNION ALL
    SELECT host, seed * {100 - how.damping_percent} // 100 FROM {name}_seed
  ) GROUP BY host
)""")
    rows = ",".join(steps)
    return f"""
WITH rules(h, p, v) AS (VALUES {rules}),
parsed AS (
  SELECT row_number() OVER () AS r, page_id, {host} AS host, {path} AS path, html FROM pages
),
fits AS (
  SELECT r, arg_max(h || p, len(h || p)) AS rule, arg_max(v, len(h || p)) AS verdict
  FROM parsed JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY r
),
judged AS (SELECT r, page_id, host, path, rule, verdict FROM parsed LEFT JOIN fits USING (r)),
links AS (
  SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''),
    '(?i)(?:href|src)\\s*=\\s*["'']?\\s*((?:https?:)?//[^\\s"''<>]+)', 1)) AS link
  FROM parsed
),
edges AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT src, translate(regexp_extract(CASE WHEN starts_with(link, '//') THEN 'http:' || link
      ELSE link END, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS dst FROM links
  ) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
),{rows},
final AS (
  SELECT j.*, CAST(coalesce(t.rank, 0) AS BIGINT) AS trust, CAST(coalesce(d.rank, 0) AS BIGINT) AS distrust
  FROM judged j LEFT JOIN trust_{how.rounds} t USING (host) LEFT JOIN distrust_{how.rounds} d USING (host)
)
SELECT page_id, host, path, rule, trust, distrust,
       coalesce(verdict, CASE WHEN distrust > 0
         AND distrust * 100.0 >= {how.threshold_percent} * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict
FROM final"""


def quality_rules(rules: Rules = Rules()) -> str:
    """Counts, sketches of logarithmic cells, limits and verdicts."""
    each = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS measure, {m.count} * 1000.0 / greatest({m.of}, 1) AS v "
        "FROM measured WHERE n_words > 0"
        for name, m in MEASURES.items()
    )

    def quartiles(keys: str, rows: str) -> str:
        part = f"{keys}, " if keys else ""
        at = ", ".join(
            f"min(CASE WHEN upto >= n * {q} THEN cell END) AS c{int(q * 100)}" for q in (0.25, 0.5, 0.75)
        )
        return f"""
  SELECT {part}measure, {at} FROM (
    SELECT {part}measure, cell, sum(rows) OVER (PARTITION BY {part}measure) AS n,
           sum(rows) OVER (PARTITION BY {part}measure ORDER BY cell ROWS UNBOUNDED PRECEDING) AS upto
    FROM (SELECT {part}measure, cell, sum(rows) AS rows FROM ({rows}) GROUP BY {part}measure, cell)
  ) GROUP BY {part}measure"""

    def lent(keys: str, wider: str, same: str) -> str:
        return f"""
    SELECT {keys}, cell, rows FROM sketch UNION ALL
    SELECT s.*, unnest([c25, c50, c75]) AS cell, {rules.borrowed} AS rows
    FROM (SELECT DISTINCT {keys} FROM sketch) s JOIN {wider} w ON s.measure = w.measure{same}"""

    def value(c: str) -> str:
        return f"(CASE WHEN {c} = 0 THEN 0.0 ELSE exp({c} / 100.0) END)"

    slack = "CASE measure " + " ".join(f"WHEN '{x}' THEN {m.slack}" for x, m in MEASURES.items()) + " END"
    tests = []
    for name, m in MEASURES.items():
        n = f"greatest({m.of}, 1)"
        share = f"{m.count} * 1000.0 / {n}"
        for side, sign, op, none in (("low", "+", ">=", "0"), ("high", "-", "<=", "'inf'::DOUBLE")):
            if m.bad not in (side, "both"):
                continue
            edge = f"coalesce({name}_{side}, {none})"
            p = f"(least({edge}, 1000.0) / 1000.0)"
            more = "0.0" if m.bad != "both" else f"{rules.mean_error} / sqrt({n})"
            if m.run:
                more = f"{1000 * rules.share_error} * sqrt({p} * (1 - {p}) * {m.run} / {n})"
            tests.append((f"max(CASE WHEN measure = '{name}' THEN {side} END) AS {name}_{side}",
                          f"{share} {sign} {more} {op} {edge}"))
    columns, inside = ", ".join(x for x, _ in tests), " AND ".join(x for _, x in tests)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WHITE}') AS w FROM documents
),
grams AS (
  SELECT r, i, array_to_string(w[i : i + 2], ' ') AS g FROM docs, unnest(range(1, len(w) - 1)) AS u(i)
),
repeats AS (
  SELECT r, count(DISTINCT k) AS n FROM (
    SELECT r, unnest(range(i, i + 3)) AS k
    FROM grams JOIN (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1) USING (r, g)
  ) GROUP BY r
),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n, count(*) AS full_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{WHITE}') GROUP BY r
),
measured AS (
  SELECT r, doc_id, lang, source, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(full_lines, 0) AS n_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
),
sketch AS (
  SELECT lang, source, measure,
         CAST(CASE WHEN v < 1 THEN 0 ELSE ceil(ln(v) * 100) END AS INTEGER) AS cell, count(*) AS rows
  FROM ({each}) GROUP BY ALL
),
e AS ({quartiles("", "SELECT * FROM sketch")}),
l AS ({quartiles("lang", lent("lang, measure", "e", ""))}),
o AS ({quartiles("lang, source", lent("lang, source, measure", "l", " AND s.lang IS NOT DISTINCT FROM w.lang"))}),
limits AS (
  SELECT lang, source, {columns} FROM (
    SELECT lang, source, measure,
           {value("c50")} + {rules.spread} * ({value("c75")} - {value("c50")}) + {slack} AS high,
           {value("c50")} - {rules.spread} * ({value("c50")} - {value("c25")}) - {slack} AS low FROM o
  ) GROUP BY lang, source
),
judged AS (
  SELECT m.*, x.* EXCLUDE (lang, source),
         n_words < {rules.min_words}
           OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed
  FROM measured m LEFT JOIN limits x
    ON m.lang IS NOT DISTINCT FROM x.lang AND m.source IS NOT DISTINCT FROM x.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {inside} AS kept
FROM judged"""


def license_scan() -> str:
    """Places of all key phrases, and the weight of the statement that stands around each."""
    rows = []
    for number, (label, body, key, base) in enumerate(
        [(*t, True) for t in BASE] + [(*t, False) for t in TEMPLATES]
    ):
        words, keys = body.split(), key.split()
        offset = next(i for i in range(len(words)) if words[i : i + len(keys)] == keys)
        rows.append(f"({number}, '{label}', {base}, {words}, {offset}, {keys})")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({lower("text")}, '{LETTERS}') AS w FROM documents
),
t(t, label, base, body, off, key) AS (VALUES {", ".join(rows)}),
vocabulary AS (SELECT DISTINCT word FROM (SELECT unnest(body) AS word FROM t)),
seen AS (
  SELECT word, count(DISTINCT r) AS n
  FROM (SELECT r, unnest(w) AS word FROM docs) JOIN vocabulary USING (word) GROUP BY word
),
weights AS (
  SELECT word, -ln((coalesce(n, 0) + 1) / ((SELECT greatest(coalesce(max(n), 0), 1) FROM seen) + 2.0)) AS weight
  FROM vocabulary LEFT JOIN seen USING (word)
),
places AS (
  SELECT r, w, t, label, base, off, i - 1 AS first
  FROM docs, t, unnest(range(1, len(w) - len(key) + 2)) AS u(i)
  WHERE w[i] = key[1] AND w[i : i + len(key) - 1] = key
),
body AS (
  SELECT t, j, word, weight
  FROM (SELECT t, unnest(body) AS word, unnest(range(len(body))) AS j FROM t) JOIN weights USING (word)
),
scored AS (
  SELECT r, t, first, label, base, off,
         sum(CASE WHEN first - off + j >= 0 AND w[first - off + j + 1] = word THEN weight ELSE 0 END)
           / greatest(sum(weight), 1e-9) AS score
  FROM places JOIN body USING (t) GROUP BY r, t, first, label, base, off
),
found AS (
  SELECT r, count(*) FILTER (base) AS n_base,
         min(first - off) FILTER (base) AS first_word, max(first - off) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM scored GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(least(greatest(coalesce(score, 0.0), 0.0), 1.0), 9) AS score
FROM docs LEFT JOIN found USING (r)"""


COLLOCATIONS = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
         {lower("text")} AS text
  FROM documents
), p AS (
  SELECT id, lang, unnest(x) AS piece, generate_subscripts(x, 1) AS part
  FROM (SELECT id, lang, regexp_split_to_array(text, '{PIECE_ENDS}') AS x FROM d)
), w AS (
  SELECT id, lang, part, unnest(x) AS w1, generate_subscripts(x, 1) AS i
  FROM (SELECT id, lang, part, regexp_extract_all(piece, '{PIECE_WORDS}') AS x FROM p)
), s AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w
  WINDOW o AS (PARTITION BY id, part ORDER BY i)
), one AS (SELECT lang, w1, count(*) AS f FROM s GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS f FROM s WHERE w2 IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, w1, w2, w3, count(*) AS a FROM s WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, w1, w2, max(a) AS b FROM (
    SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL
), c AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, l.f AS l, r.f AS r, 1 AS k
  FROM two t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1
  JOIN one r ON r.lang = t.lang AND r.w1 = t.w2
  LEFT JOIN longer g ON g.lang = t.lang AND g.w1 = t.w1 AND g.w2 = t.w2
  WHERE t.f >= 10 AND NOT coalesce(100 * g.b >= 50 * t.f, false)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, l.f, r.f, 1
  FROM three t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1
  JOIN two r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, l.f, r.f, 2
  FROM three t JOIN two l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2
  JOIN one r ON r.lang = t.lang AND r.w1 = t.w3
), x AS (
  SELECT *, (1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS score FROM c
), y AS (
  SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), z AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM y
)
SELECT z.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM z JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang) USING (lang)
WHERE rank <= 2000"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label,
         CAST(list_sum(list_transform(list_zip(a.c, b.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE own = label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                               ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE own <> label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


ORACLES = {
    "op1_license_scan": license_scan(),
    "op2_quality_rules": quality_rules(),
    "op3_url_filter": url_filter(),
    "op5_decontamination": DECONTAMINATION,
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op10_substring_dedup": SUBSTRINGS,
    "op11_collocations": COLLOCATIONS,
    "op13_hard_negatives": HARD_NEGATIVES,
}
