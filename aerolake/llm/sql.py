"""DuckDB SQL for the queries that SQL can express: the correctness oracle.

Not expressed: op4 (a search over repairs), op5 (a tokenizer), op7 and op10
(trained models); tests hold these against brute force or held-out rows.
"""

from __future__ import annotations

_DOMAIN_SQL = """(['web', 'news', 'books', 'forum'])[
    coalesce(try_cast(regexp_extract(coalesce(source, ''), '[0-9]+') AS BIGINT), 0) % 4 + 1]"""
_LANG_WEIGHT = "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END"
_DOMAIN_WEIGHT = "CASE domain WHEN 'web' THEN 4 WHEN 'news' THEN 3 WHEN 'books' THEN 2 ELSE 1 END"


def _fill_sql(name: str, nodes: str, parent: list[str], node: str) -> str:
    """Water-filling of one level: ``nodes`` has cap, weight and given."""
    over = f"PARTITION BY {', '.join(parent)}" if parent else ""
    return f"""
    {name}_a AS (SELECT *, CAST(cap AS DOUBLE) * CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE)
            <= CAST(given - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
               * CAST(weight AS DOUBLE) AS filled
        FROM {nodes} WINDOW o AS ({over} ORDER BY cap / weight, {node})),
    {name}_b AS (SELECT *, given - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({over}) AS rest,
            CASE WHEN filled THEN 0 ELSE weight END AS ow FROM {name}_a),
    {name}_c AS (SELECT *, sum(ow) OVER ({over}) AS all_w, sum(ow) OVER ({over} ORDER BY {node}) AS upto FROM {name}_b),
    {name} AS (SELECT * EXCLUDE (rest, ow, all_w, upto, filled), CAST(CASE WHEN filled THEN cap ELSE
            (CASE WHEN upto = all_w THEN rest ELSE floor(CAST(rest AS DOUBLE) * CAST(upto AS DOUBLE) / CAST(all_w AS DOUBLE)) END)
          - (CASE WHEN upto - ow = all_w THEN rest
                  ELSE floor(CAST(rest AS DOUBLE) * CAST(upto - ow AS DOUBLE) / CAST(all_w AS DOUBLE)) END)
            END AS BIGINT) AS budget FROM {name}_c)"""


def mix_sql(source: str, share: float, epochs: int) -> str:
    """CTEs ending in ``mixed``: doc_id, leaf, n_tokens, copies of the documents in ``source``."""
    return f"""
    tagged AS (SELECT doc_id, {_DOMAIN_SQL} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM {source}),
    leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM tagged GROUP BY ALL),
    total AS (SELECT least(CAST(floor(sum(tokens) * CAST({share} AS DOUBLE)) AS BIGINT), CAST(sum(tokens) AS BIGINT) * {epochs}) AS given
        FROM leaves),
    level1 AS (SELECT domain, CAST(sum(tokens) AS BIGINT) * {epochs} AS cap, {_DOMAIN_WEIGHT} AS weight, any_value(given) AS given
        FROM leaves, total GROUP BY domain),{_fill_sql("fill1", "level1", [], "domain")},
    level2 AS (SELECT l.domain, lang, CAST(sum(tokens) AS BIGINT) * {epochs} AS cap, {_LANG_WEIGHT} AS weight, any_value(budget) AS given
        FROM leaves l JOIN fill1 f ON l.domain = f.domain GROUP BY l.domain, lang),{_fill_sql("fill2", "level2", ["domain"], "lang")},
    level3 AS (SELECT l.domain, l.lang, source, tokens * {epochs} AS cap, 1 AS weight, budget AS given
        FROM leaves l JOIN fill2 f ON l.domain = f.domain AND l.lang = f.lang),{_fill_sql("fill3", "level3", ["domain", "lang"], "source")},
    spent AS (SELECT domain, lang, source, CASE WHEN cap = 0 THEN 0 ELSE budget // (cap // {epochs}) END AS whole,
            CASE WHEN cap = 0 THEN 0 ELSE budget % (cap // {epochs}) END AS rest FROM fill3),
    keyed AS (SELECT t.*, whole, rest, sha256('mix:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
        FROM tagged t JOIN spent USING (domain, lang, source)),
    ordered AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed),
    cuts AS (SELECT domain, lang, source, max(key) AS cut FROM ordered WHERE before < rest GROUP BY ALL),
    mixed AS (SELECT doc_id, k.domain, k.lang, k.source, n_tokens,
            CAST(whole + CASE WHEN key <= cut THEN 1 ELSE 0 END AS BIGINT) AS copies
        FROM keyed k LEFT JOIN cuts c ON k.domain = c.domain AND k.lang = c.lang AND k.source = c.source)"""


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

EXACT = """
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS n FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256 FROM t"""

SUBSTRING = f"""
    WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w)),
    known AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
    gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN known USING (g), generate_series(0, 12) AS t(k) WHERE m < doc_id),
    words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
        FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)"""

DECONTAMINATE = """
    WITH words_of AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
    items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
    item_windows AS (SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
        FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM items WHERE len(ws) > 0)),
    found AS (SELECT doc_id, i, m, item_id FROM (
            SELECT doc_id, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i
            FROM words_of, (SELECT DISTINCT m FROM item_windows)) AS d
        JOIN item_windows AS b USING (m) WHERE array_to_string(ws[i:i + m - 1], ' ') = b.g),
    hits AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM found, generate_series(0, 9) AS t(k) WHERE k < m GROUP BY doc_id),
    by_doc AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ','
            ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(b.n, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
    FROM words_of LEFT JOIN hits h USING (doc_id) LEFT JOIN by_doc b USING (doc_id)"""

JACCARD = f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    shingled AS (SELECT doc_id, list_sort(list_distinct(list_transform(generate_series(1, greatest(len(ws) - 4, 1)),
            lambda i: array_to_string(ws[i:i + 4], ' ')))) AS sh FROM w WHERE len(ws) > 0),
    sets AS (SELECT sh, min(doc_id) AS rep, count(*) AS n_copies, len(sh) AS n FROM shingled GROUP BY sh),
    one AS (SELECT rep, n, unnest(sh) AS s FROM sets),
    common AS (SELECT a.rep AS a, b.rep AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
        FROM one a JOIN one b ON a.s = b.s AND a.rep <> b.rep GROUP BY 1, 2),
    links AS (SELECT a, b FROM common WHERE 5 * c >= 4 * (na + nb - c)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    classes AS (SELECT a AS rep, least(a, min(b)) AS class_id FROM reach GROUP BY a),
    counts AS (SELECT a AS rep, count(*) AS n_links FROM links GROUP BY a)
    SELECT w.doc_id, coalesce(class_id, t.rep, w.doc_id) AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
           CAST(coalesce(t.n_copies, 1) AS BIGINT) AS n_copies
    FROM w LEFT JOIN shingled USING (doc_id) LEFT JOIN sets t USING (sh)
    LEFT JOIN classes c ON c.rep = t.rep LEFT JOIN counts k ON k.rep = t.rep"""


def _strength_sql(name: str, groups: str) -> str:
    """Method-of-moments prior strength of ``groups`` (n, bad, prior)."""
    return f"""
    {name}_m AS (SELECT sum(n * prior * (1 - prior)) AS noise, sum(n * power(bad / n - prior, 2)) AS spread,
            sum(n) AS total, count(*) AS g FROM {groups} WHERE n > 0),
    {name} AS (SELECT CASE WHEN g = 0 OR total = g OR noise = 0 THEN 1.0 ELSE round(1 / least(greatest(
            (spread * total / noise - g) / (total - g), 1 / 1001.0), 1 / 2.0) - 1, 6) END AS k FROM {name}_m)"""


_SECOND = "('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')"

URLS = f"""
    WITH urls AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    outcomes AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
    counted AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM urls LEFT JOIN outcomes USING (page_id) GROUP BY host),
    parted AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS p FROM counted),
    sized AS (SELECT *, CASE WHEN len(p) >= 3 AND length(p[-1]) = 2 AND p[-2] IN {_SECOND} THEN 2 ELSE 1 END AS z FROM parted),
    hosts AS (SELECT host, n, bad, array_to_string(p[greatest(len(p) - z, 1):], '.') AS domain,
            array_to_string(p[greatest(len(p) - z + 1, 1):], '.') AS suffix FROM sized),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad,
            (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM hosts) AS prior FROM hosts GROUP BY suffix),{_strength_sql("ks", "suffixes")},
    domains AS (SELECT h.domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value((s.bad + k * prior) / (s.n + k)) AS prior
        FROM hosts h JOIN suffixes s USING (suffix), ks GROUP BY h.domain, suffix),{_strength_sql("kd", "domains")},
    priors AS (SELECT host, h.n, h.bad, (d.bad + k * d.prior) / (d.n + k) AS prior
        FROM hosts h JOIN domains d USING (domain), kd),{_strength_sql("kh", "priors")},
    shaped AS (SELECT host, bad + k * prior AS a, n - bad + k * (1 - prior) AS b FROM priors, kh),
    judged AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.3 AS blocked FROM shaped),
    ruled AS (SELECT *, CASE
            WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM urls)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
           WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled JOIN judged USING (host)"""

# crc32 of a decimal number, bit by bit; equal words q apart are found as equal
# grams of six words, which every run of twelve words and two periods holds.
RUNS = f"""
    WITH crc AS (SELECT doc_id, {_WORDS} AS ws, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
            list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
            lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS h FROM documents),
    place AS (SELECT *, len(ws) AS n, (h // 10) % len(ws) AS a, (h // 10) % 8 AS m FROM crc),
    period AS (SELECT *, 1 + (n - a) // (3 + m) AS p FROM place),
    w AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(generate_series(0, n - 1),
            lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws FROM period),
    grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 5], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, n - 5)) AS i FROM w)),
    same AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.g = b.g AND b.i > a.i),
    islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
    stretches AS (SELECT doc_id, q, min(i) - 1 AS start, count(*) + 5 + q AS length FROM islands GROUP BY doc_id, q, island),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(12, 2 * q)
        GROUP BY doc_id, start, length),
    listed AS (SELECT doc_id, count(*) AS n_runs, max(length) AS length, string_agg(start || ',' || length || ',' || period || chr(10), ''
            ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
    longest AS (SELECT doc_id, start, period FROM runs JOIN listed USING (doc_id, length)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY start, period) = 1),
    gone AS (SELECT DISTINCT doc_id, unnest(generate_series(start + period + 1, start + length)) AS i FROM runs),
    words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM w LEFT JOIN listed USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN kept USING (doc_id)"""

DIVERGENCE = """
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
    words AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS count FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
    own AS (SELECT lang, source, term, count(*) AS count FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    langs AS (SELECT lang, CAST(sum(count) AS HUGEINT) AS n, count(*) AS v FROM kept GROUP BY lang),
    groups AS (SELECT g.lang, g.source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g
        LEFT JOIN (SELECT lang, source, CAST(sum(count) AS HUGEINT) AS n FROM own GROUP BY ALL) USING (lang, source)),
    shares AS (SELECT g.lang, g.source, k.term, coalesce(o.count, 0) AS count,
            1 + (1000000000 * (coalesce(o.count, 0) + 1)) // (g.n + l.v) AS p,
            1 + (1000000000 * (k.count + 1)) // (l.n + l.v) AS q
        FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
        LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
    pairs AS (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    parts AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
        UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE count > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 200"""

# Windows as hexadecimal digits, two a byte.
SUFFIXES = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    windows AS (SELECT doc_id, i, doc_id * 4294967296 + i AS place, substr(x, 2 * i + 1, 200) AS g
        FROM (SELECT doc_id, x, unnest(generate_series(0, len(x) // 2 - 100)) AS i FROM d)),
    known AS (SELECT g, min(place) AS first FROM windows GROUP BY g),
    repeated AS (SELECT doc_id, i FROM windows JOIN known USING (g) WHERE place > first),
    begun AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM repeated),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM begun),
    spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, span),
    pieces AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
        UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(len(x)) // 2 FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
    kept AS (SELECT doc_id, string_agg(substr(x, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS y
        FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
    counted AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(y)) AS kept_sha256
    FROM d JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)"""

SQL: dict[str, str] = {
    "op1_exact_dedup": EXACT,
    "op2_substring_dedup": SUBSTRING,
    "op3_mixing": "WITH " + mix_sql("documents", 0.6, 4) + " SELECT * FROM mixed",
    "op6_url_filter": URLS,
    "op8_jaccard_join": JACCARD,
    "op9_decontaminate": DECONTAMINATE,
    "op11_periodic_runs": RUNS,
    "op12_divergence": DIVERGENCE,
    "op13_suffix_dedup": SUFFIXES,
}
