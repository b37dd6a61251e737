"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from perron.llm.secret_scan import ALLOWED, CLASSES, PATTERNS
from perron.llm.url_rules import HOST_RULES, PATTERN_RULES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Distinct shingles as strings; a pair with Jaccard 0.75 is found through any shared one.
OP1 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, hash(x) AS x FROM (SELECT doc_id, unnest(s) AS x FROM sets)),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
pairs AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id AND reach.root < links.b),
least AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept FROM sizes JOIN least USING (doc_id)
"""

OP2 = rf"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM wins) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY doc_id),
base AS (
  SELECT t.doc_id, t.source, len(t.w)::BIGINT AS n_words, length(array_to_string(t.w, ''))::BIGINT AS word_chars,
    (length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM texts t JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT sum(f) / sum(n) AS m, coalesce(var_samp(f / n), 0) - sum(f) / sum(n) * (1 - sum(f) / sum(n)) * avg(1 / n) AS v FROM hosts),
sized AS (SELECT m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 0) END AS s FROM prior),
rates AS (SELECT source, coalesce((f + m * s) / (n + s), m) AS rate FROM hosts, sized)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(rate, 9) AS host_rate,
  NOT base_failed AND coalesce(rate <= 0.5, true) AS kept
FROM judged LEFT JOIN rates USING (source)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op3() -> str:
    host = "".join(
        f"WHEN regexp_matches(host || path, {_quoted(r.pattern())}) THEN {_quoted(r.text)} "
        for r in sorted(HOST_RULES, key=lambda r: -len(r.text))
    )
    verdicts = "".join(f"WHEN {_quoted(r.text)} THEN {_quoted(r.verdict)} " for r in HOST_RULES)
    wild = " + ".join(f"coalesce(regexp_matches(url, {_quoted(r.pattern())})::INT, 0)" for r in PATTERN_RULES)
    return rf"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url,
    translate(regexp_extract(coalesce(rest, ''), '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {host} END AS rule, ({wild})::BIGINT AS patterns FROM parts)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE CASE WHEN patterns > 0 THEN 'block' ELSE 'allow' END END AS verdict, patterns
FROM ruled
"""


OP4 = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e') AS safe,
    replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ': ', '\c') AS safe_role FROM given),
grouped AS (
  SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(safe) + length(safe_role) + 4 + 2 + 8) AS formatted_chars,
    string_agg(substr(role, 1, 1), '' ORDER BY turn, role, text) AS roles, bool_and(role IN ('system', 'user', 'assistant')) AS known
  FROM marked GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars, known AND regexp_full_match(roles, 's?(ua)+') AS valid
FROM grouped
"""

# Windows by their words; DuckDB's sha256 takes the text itself.
OP5 = rf"""
WITH texts AS (SELECT doc_id, {WORDS} AS w FROM documents),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM texts)),
firsts AS (SELECT g, min(doc_id) AS first FROM wins GROUP BY g),
gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS ks FROM wins JOIN firsts USING (g) WHERE doc_id > first GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
    CASE WHEN ks IS NULL THEN w ELSE (SELECT list(w[k] ORDER BY k) FROM (SELECT unnest(range(1, len(w) + 1)) AS k) WHERE NOT list_contains(ks, k)) END AS k
  FROM texts t LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""

OP7 = rf"""
WITH both_texts AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM both_texts),
lengths AS (SELECT DISTINCT len(w) AS l FROM words WHERE kind = 'i' AND len(w) BETWEEN 1 AND 4 UNION SELECT 5),
sets AS (
  SELECT kind, id, list_distinct(list_transform(range(1, len(w) - l + 2), lambda i: array_to_string(w[i:i + l - 1], ' '))) AS s
  FROM words JOIN lengths ON l <= len(w) AND (kind = 'd' OR l = least(len(w), 5))),
shingles AS (SELECT kind, id, len(s) AS n, unnest(s) AS x FROM sets)
SELECT d.id AS doc_id, i.id AS item_id, i.n::BIGINT AS n_shingles, count(*)::BIGINT AS n_found
FROM shingles d JOIN shingles i ON d.x = i.x AND d.kind = 'd' AND i.kind = 'i'
GROUP BY d.id, i.id, i.n HAVING 100 * count(*) >= 75 * i.n
"""

OP9 = """
WITH sized AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS first FROM sized GROUP BY h),
bits AS (SELECT page_id, n, h, first, array_to_string(list_transform(string_split(h, ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS b
  FROM sized JOIN firsts USING (h))
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(b, 5 * k + 1, 1)::INT
    + 8 * substr(b, 5 * k + 2, 1)::INT + 4 * substr(b, 5 * k + 3, 1)::INT + 2 * substr(b, 5 * k + 4, 1)::INT + substr(b, 5 * k + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""


def _op11() -> str:
    """Positions from all text before a match; each window's letters are counted anew."""
    parts = []
    for i, p in enumerate(PATTERNS):
        size = f"length(regexp_extract(run, {_quoted(p.pattern)}, {p.group}))"
        parts.append(f"SELECT doc_id, {i} AS place, '{p.kind}' AS kind, start, start + length(run) AS stop FROM ({_matches(p.pattern)}) WHERE {size} >= {p.least}")
    allowed = _quoted("|".join(f"(?:{p})" for p in ALLOWED))
    for i, c in enumerate(CLASSES, len(PATTERNS)):
        run = "lower(run)" if c.fold else "run"
        windows = f"""SELECT doc_id, start, s, list_histogram(string_split(substr({run}, s::INT + 1, {c.window}), '')) AS h
            FROM (SELECT *, unnest(range(0, length(run) - {c.window - 1})) AS s FROM ({_matches(c.candidates())}) WHERE NOT regexp_matches(run, {allowed}))"""
        high = f"""SELECT doc_id, start, s FROM ({windows}) WHERE list_sum(list_transform(map_values(h), lambda n: {c.gains()}[n::BIGINT + 1])) <= {c.limit()}"""
        marked = f"SELECT *, coalesce(s - lag(s) OVER (PARTITION BY doc_id, start ORDER BY s) > {c.window}, true)::INT AS fresh FROM ({high})"
        numbered = f"SELECT *, sum(fresh) OVER (PARTITION BY doc_id, start ORDER BY s) AS g FROM ({marked})"
        parts.append(f"SELECT doc_id, {i}, '{c.kind}', start + min(s), start + max(s) + {c.window} FROM ({numbered}) GROUP BY doc_id, start, g")
    counts = ", ".join(f"count(*) FILTER (kind = '{p.kind}') AS n_{p.kind}" for p in PATTERNS)
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop) FILTER ({}), '')"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(parts)})
SELECT doc_id, {counts}, sha256({joined.format(f"place < {len(PATTERNS)}")}) AS base_sha256, {joined.format("kind IS NOT NULL")} AS spans
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""


def _matches(pattern: str) -> str:
    """SQL for (doc_id, run, start) of all matches."""
    p = _quoted(pattern)
    return f"""SELECT doc_id, m[i] AS run,
        (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
        FROM (SELECT doc_id, m, string_split_regex(text, {p}) AS g, unnest(range(1, len(m) + 1)) AS i
          FROM (SELECT doc_id, text, regexp_extract_all(text, {p}) AS m FROM texts) WHERE len(m) > 0)"""


# CRC-32 by its table, over a list of bytes.
CRC_TABLE = "SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))) AS t"
CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], {bytes}), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295)"

OP12 = f"""
WITH turns AS (
  SELECT conv_id, length(r) || ':' || r || x AS turn, octet_length(encode(x)) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
crc AS ({CRC_TABLE}),
convs AS (SELECT conv_id, {CRC.format(bytes="list_transform(string_split(conv_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc),
rebuilt AS (
  SELECT c.conv_id, pos, turn, size FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 WHERE pos <= h
  UNION ALL SELECT conv_id, pos + 8, turn, size FROM convs JOIN turns USING (conv_id) WHERE pos > h),
paths AS (
  SELECT conv_id, coalesce(list(md5(turn) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS codes, coalesce(list(size ORDER BY pos) FILTER (pos IS NOT NULL), []) AS sizes
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
prefixes AS (
  SELECT conv_id, d, array_to_string(codes[1:d], '') AS key, array_to_string(codes[1:d - 1], '') AS up, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(codes) AS ends
  FROM (SELECT *, unnest(range(0, len(codes) + 1)) AS d FROM paths)),
nodes AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, any_value(up) AS up, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM prefixes GROUP BY key, d),
kids AS (SELECT up AS key, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (key, d)),
sums AS (
  SELECT p.key, p.d, sum((n_children = 0)::INT) AS n_leaves, sum((n - 1) * f.size) AS saved
  FROM full_nodes f JOIN prefixes p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY ALL)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n::BIGINT AS n_convs, f.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums USING (key, d) LEFT JOIN nodes up ON up.key = f.up AND up.d = f.d - 1
"""

# Near words share what is left after taking out one letter, at the same place or as a whole word.
OP13 = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)) AS b FROM runs),
hashed AS (SELECT run, n, {CRC.format(bytes="b")} AS h FROM bytes, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON cuts.rest = words.word
  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON cuts.rest = words.word),
ranked AS (
  SELECT near.word, other, n, count(*) OVER (PARTITION BY near.word) AS n_near, row_number() OVER (PARTITION BY near.word ORDER BY n DESC, encode(other)) AS place
  FROM near JOIN words ON words.word = other),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN other END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
chain(word, top) AS (SELECT word, word FROM formed UNION ALL SELECT chain.word, form FROM chain JOIN formed ON formed.word = chain.top WHERE form IS NOT NULL),
ends AS (SELECT chain.word, top AS root FROM chain JOIN formed ON formed.word = chain.top WHERE form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN ends USING (word)
"""


def oracle_queries() -> dict[str, str]:
    return {
        "op1_minhash_near_dedup": OP1,
        "op2_quality_rules": OP2,
        "op3_url_filters": _op3(),
        "op4_chat_formatting": OP4,
        "op5_substring_dedup": OP5,
        "op7_benchmark_decontamination": OP7,
        "op9_warc": OP9,
        "op11_secret_scans": _op11(),
        "op12_prefix_trie": OP12,
        "op13_spelling_variants": OP13,
    }
