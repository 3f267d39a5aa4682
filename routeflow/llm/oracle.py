"""DuckDB SQL for the queries that SQL can express, written from the contracts, not from the operators.

Left out: op4, op7, op12, op13 and the pipeline (tokenizer, signatures, runs, probed lists), and of op2, op5 and op8 what a model or a sample
decides; those are tested against brute force in ``tests/llm``. What SQL can say of the latter three is compared under ``op2_url_rules``,
``op5_mixing_targets`` and ``op8_base_spans``.
"""

from __future__ import annotations

W = r"'[^\x20\x09-\x0D]+'"
S = r"'[\x20\x09-\x0D]+'"

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP1 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS lead FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k:
         substr('{_B32}', 1 + CAST((
           (CAST('0x' || substr(x, 1 + (k * 5) // 4, CASE WHEN (k * 5) // 4 = 39 THEN 1 ELSE 2 END) AS BIGINT)
              >> (CASE WHEN (k * 5) // 4 = 39 THEN 4 ELSE 8 END - (k * 5) % 4 - 5)) & 31) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM g
"""

OP3 = r"""
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS n FROM raw),
s AS (SELECT doc_id, n, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS x FROM l),
o AS (SELECT * FROM s WHERE x <> ''),
f AS (SELECT x, min((doc_id, n)) AS first, length(x) AS len FROM o GROUP BY x),
k AS (SELECT x, first, len, unnest([len, len + 1]) AS t FROM f),
k2 AS (SELECT *, substr(x, 1, (t - 1) // 2) AS head, substr(x, len - (t - 1 - (t - 1) // 2) + 1, t - 1 - (t - 1) // 2) AS tail FROM k),
c AS (SELECT a.x AS ax, b.x AS bx FROM k2 a JOIN k2 b ON a.t = b.t AND a.head = b.head AND b.first < a.first
      UNION SELECT a.x, b.x FROM k2 a JOIN k2 b ON a.t = b.t AND a.tail = b.tail AND b.first < a.first),
near AS (SELECT DISTINCT ax AS x FROM c WHERE len_ok(ax, bx)),
gone AS (SELECT o.doc_id, o.n FROM o JOIN f USING (x) WHERE (o.doc_id, o.n) <> f.first OR o.x IN (SELECT x FROM near))
SELECT s.doc_id, count(*) FILTER (WHERE s.x <> '') AS n_lines, count(g.n) AS n_removed,
       sha256(coalesce(string_agg(s.line, chr(10) ORDER BY s.n) FILTER (WHERE g.n IS NULL), '')) AS clean_sha256
FROM s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.n = g.n GROUP BY s.doc_id
""".replace(
    "len_ok(ax, bx)",
    # distance of at most one, by the longest common prefix and suffix of strings of (nearly) equal length
    "abs(length(ax) - length(bx)) <= 1 AND len(list_filter(range(0, least(length(ax), length(bx)) + 1), "
    "lambda i: substr(ax, 1, i) = substr(bx, 1, i) AND substr(ax, i + 1 + CASE WHEN length(ax) >= length(bx) THEN 1 ELSE 0 END) "
    "= substr(bx, i + 1 + CASE WHEN length(bx) >= length(ax) THEN 1 ELSE 0 END))) > 0",
)

OP9 = f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), {S}, '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""

_STOP = (
    "the of and to a in is that it for was on with as be by this are at from or an not have he his they we you "
    "de la le et les des en un du une que est pour qui dans par pas au sur avec ce il se plus "
    "der die und den von zu das mit sich auf für ist im dem nicht ein als eine es auch "
    "el y los del las por con no su para al lo como más pero"
)

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang IN ('en', 'fr', 'de', 'es'), FALSE) AS listed FROM documents),
a AS (SELECT doc_id, t, listed, regexp_extract_all(t, {W}) AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {W})) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i:i+4] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM a)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(0, 5) r(j) GROUP BY doc_id),
m AS (SELECT a.doc_id, listed, len(ws)::BIGINT AS n_words, length(regexp_replace(t, {S}, '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
        len(ls) AS n_lines, len(regexp_extract_all(t, '!')) AS bangs, len(regexp_extract_all(t, '\p{{Lu}}')) AS caps,
        len(list_filter(ws, lambda x: list_contains(string_split('{_STOP}', ' '), lower(x)))) AS stops,
        len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS bullets,
        len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS dots
      FROM a LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 14 * n_words AND n_symbols <= 0.1 * n_words
       AND bangs <= 0.3 * n_words AND caps <= 0.5 * word_chars AND (NOT listed OR n_words < 50 OR stops >= 0.03 * n_words)
       AND n_dup_lines <= 0.5 * n_lines AND bullets <= 0.9 * n_lines AND dots <= 0.5 * n_lines AS kept
FROM b
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS us, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1,
             CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(us)::BIGINT AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b FROM u),
p AS (SELECT doc_id, t, n, array_to_string(us[1:a], '') AS pre, array_to_string(us[a + 1:b], '') AS mid, array_to_string(us[b + 1:], '') AS suf,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

OP2_RULES = r"""
WITH rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                               ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
a AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS named FROM u),
b AS (SELECT page_id, translate(named, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(named) + 1), '^[^?#]*') AS path FROM a)
SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
FROM b LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path
"""

OP5_TARGETS = f"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {W}))::BIGINT AS size FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS z, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM s GROUP BY source),
-- words per weight at which the sources are filled: the largest of what is left per weight once the first of them are full
l AS (SELECT max(((SELECT sum(z) FROM g) - coalesce((SELECT sum(3 * b.z) FROM g b WHERE b.z * a.w < a.z * b.w), 0))
                 / (SELECT sum(b.w) FROM g b WHERE b.z * a.w >= a.z * b.w)) AS level FROM g a)
SELECT doc_id, size, z AS source_size, round(least(3.0 * z, level * w)::DOUBLE, 3) AS target
FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source, l
"""

OP6 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {W}) AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM d),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+34], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
m AS (SELECT t.doc_id, word, k, max(i) OVER (PARTITION BY t.doc_id ORDER BY k ROWS 34 PRECEDING) IS NOT NULL AS gone
      FROM t LEFT JOIN twice ON t.doc_id = twice.doc_id AND k = i)
SELECT d.doc_id, count(word) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN m ON d.doc_id = m.doc_id GROUP BY d.doc_id
"""


def _matches(number: int, pattern: str, valid: str) -> str:
    """Rows (doc_id, kind, s, e) of the valid matches of a pattern, placed by what stands between them; ``v`` is the match, ``x`` its digits."""
    return f"""
SELECT doc_id, {number} AS kind, s, s + length(v) AS e FROM (
  SELECT doc_id, v, s, regexp_replace(v, '[^0-9]', '', 'g') AS x FROM (
    SELECT doc_id, unnest(f) AS v, unnest(list_transform(range(1, len(f) + 1), lambda k:
      length(array_to_string(gaps[1:k], '')) + length(array_to_string(f[1:k - 1], '')))) AS s
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS f, string_split_regex(t, '{pattern}') AS gaps FROM d)))
WHERE {valid}"""


_LUHN = """length(x) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(x) + 1), lambda k:
  CAST(substr(reverse(x), k, 1) AS INTEGER) * (2 - k % 2) - CASE WHEN k % 2 = 0 AND substr(reverse(x), k, 1) > '4' THEN 9 ELSE 0 END)) % 10 = 0"""

OP8_BASE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join([
    _matches(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "TRUE"),
    _matches(1, r"[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+", "len(list_filter(string_split(v, '.'), lambda p: length(ltrim(p, '0')) > 3 OR TRY_CAST(p AS BIGINT) > 255)) = 0"),
    _matches(2, r"[0-9](?:[ -]?[0-9])+", _LUHN),
    _matches(3, r"[+][0-9][ ().0-9-]+[0-9]", "length(x) BETWEEN 9 AND 15"),
])})
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip, count(*) FILTER (WHERE kind = 2) AS n_card,
       count(*) FILTER (WHERE kind = 3) AS n_phone,
       sha256(coalesce(string_agg(['email', 'ip', 'card', 'phone'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (WHERE kind IS NOT NULL), ''))
         AS base_sha256
FROM d LEFT JOIN m ON d.doc_id = m.doc_id GROUP BY d.doc_id
"""

ORACLE: dict[str, str] = {
    "op2_url_rules": OP2_RULES,
    "op5_mixing_targets": OP5_TARGETS,
    "op6_substring_dedup": OP6,
    "op8_base_spans": OP8_BASE,
    "op1_warc": OP1,
    "op3_line_dedup": OP3,
    "op9_exact_dedup": OP9,
    "op10_quality_rules": OP10,
    "op11_fill_in_middle": OP11,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
