"""DuckDB SQL of the queries that SQL can express."""

ORACLES: dict[str, str] = {}

_PARSED = """
SELECT page_id,
       coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
       coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages)
"""

ORACLES["op3_url_filter"] = f"""
WITH parsed AS (SELECT row_number() OVER () AS n, * FROM ({_PARSED})),
rules(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
hits AS (
  SELECT n, rh || rp AS rule, v FROM parsed, rules
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rh || rp) DESC, length(rh) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parsed LEFT JOIN hits USING (n)
"""

ORACLES["op4_exact_top_k"] = """
WITH good AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""


def _spans(kind: str, pattern: str, good: str) -> str:
    """Spans ``{s, r, e, k}`` of the matches ``m`` (groups: ``g``) for which ``good`` holds."""
    rank = ["assign", "access", "hex", "entropy_hex", "entropy_base64"].index(kind)
    quoted = pattern.replace("'", "''")
    group = 2 if kind == "assign" else 0
    return f"""list_transform(list_filter(list_transform(
        list_zip(regexp_extract_all(body, '{quoted}', 0), regexp_extract_all(body, '{quoted}', {group}),
                 string_split_regex(body, '{quoted}')[:len(regexp_extract_all(body, '{quoted}', 0))]),
        lambda z, i: {{'m': z[1], 'g': z[2],
            's': coalesce(list_sum(list_transform(string_split_regex(body, '{quoted}')[:i], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(regexp_extract_all(body, '{quoted}', 0)[:i - 1], lambda x: length(x))), 0)}}),
        lambda x: {good}),
        lambda x: {{'s': x.s, 'r': {rank}, 'e': x.s + length(x.m), 'k': '{kind}'}})"""


_ALLOWED = " AND ".join(
    f"NOT regexp_matches(x.m, '{p}')"
    for p in (
        "(?i)example|placeholder|changeme|your[-_]",
        "(?i)0123456789|abcdefgh",
        "(?i)(^|[^0-9a-f])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}([^0-9a-f]|$)",
    )
)


def _entropy(least: float, musts: str) -> str:
    return f"""{musts} AND {_ALLOWED}
        AND len(list_filter(base, lambda b: b.s < x.s + length(x.m) AND x.s < b.e)) = 0
        AND list_max(list_transform(range(1, length(x.m) - 18),
              lambda i: list_aggregate(string_split(substr(x.m, i, 20), ''), 'entropy'))) >= {least}"""


_NAMES = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_JOIN = "list_aggregate(list_transform(list_sort({}), lambda x: concat_ws(':', x.k, x.s, x.e)), 'string_agg', ',')"

ORACLES["op9_secret_scan"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
found AS (
  SELECT doc_id, body, list_concat(
    {_spans("assign", f"""({_NAMES})["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", "length(x.g) >= 6")},
    {_spans("access", "AKIA[A-Z0-9]+", "length(x.g) >= 20")},
    {_spans("hex", "[0-9a-f]{24,}", "TRUE")}) AS base
  FROM texts),
more AS (
  SELECT doc_id, base, list_concat(
    {_spans("entropy_hex", "[0-9A-Za-z]{20,}", _entropy(2.9, "regexp_matches(x.m, '^[0-9A-Fa-f]+$') AND regexp_matches(x.m, '[0-9]') AND regexp_matches(x.m, '[A-Fa-f]')"))},
    {_spans("entropy_base64", "[A-Za-z0-9+/_=-]{20,}", _entropy(3.85, "regexp_matches(x.m, '[0-9]') AND regexp_matches(x.m, '[a-z]') AND regexp_matches(x.m, '[A-Z]')"))}) AS extra
  FROM found)
SELECT doc_id,
       len(list_filter(base, lambda x: x.k = 'assign')) AS n_assign,
       len(list_filter(base, lambda x: x.k = 'access')) AS n_access,
       len(list_filter(base, lambda x: x.k = 'hex')) AS n_hex,
       sha256(coalesce({_JOIN.format("base")}, '')) AS base_sha256,
       coalesce({_JOIN.format("list_concat(base, extra)")}, '') AS spans
FROM more
"""

ORACLES["op13_fill_in_middle"] = r"""
WITH units AS (
  SELECT doc_id, body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         regexp_extract_all(body, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS unit
  FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)),
drawn AS (
  SELECT *, len(unit) AS n,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(digest, i, 8) AS BIGINT)) AS h
  FROM units),
placed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                   OR h[3] % 100 >= 50 THEN 'plain'
              WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parted AS (
  SELECT *, array_to_string(unit[:a], '') AS prefix, array_to_string(unit[a + 1:b], '') AS middle,
         array_to_string(unit[b + 1:], '') AS suffix
  FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parted
"""


def _vector_codes(rounds: int = 6) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
placed{r} AS MATERIALIZED (
  SELECT n, p, min_by(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT n, c.p, e, CAST(list_sum(list_transform(list_zip(c.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
                               AS BIGINT) AS d
        FROM cut c JOIN book{r} b ON c.p = b.p)
  GROUP BY n, p)""")
        if r < rounds:
            steps.append(f"""
moved{r} AS (
  SELECT p, e, list((s - ((s % m) + m) % m) // m ORDER BY i) AS x
  FROM (SELECT c.p, e, i, sum(x[i]) AS s, count(*) AS m
        FROM cut c JOIN placed{r} USING (n, p), (SELECT unnest(range(1, (SELECT max(len(x)) FROM cut) + 1)) AS i)
        GROUP BY ALL)
  GROUP BY p, e),
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN moved{r} m ON b.p = m.p AND b.e = m.e)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT n, p, v[p * len(v) // 8 + 1:(p + 1) * len(v) // 8] AS x FROM kept, (SELECT unnest(range(8)) AS p)),
book0 AS (SELECT p, n - 1 AS e, x FROM cut WHERE n <= 16),{",".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM kept JOIN placed{rounds} USING (n) GROUP BY n, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) FROM book{rounds})
         AS codebooks_sha256
FROM coded
"""


ORACLES["op12_vector_codes"] = _vector_codes()

ORACLES["op11_grid_order_join"] = """
WITH RECURSIVE
rows_ AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
         len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good
  FROM embeddings),
good AS (
  SELECT n, vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM rows_
  WHERE good AND len(v) = (SELECT len(v) FROM rows_ WHERE good GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
links AS (
  SELECT a.n AS a, b.n AS b FROM good a JOIN good b ON a.n <> b.n
  WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) / (a.norm * b.norm) >= 0.95),
reached(n, m) AS (
  SELECT n, n FROM rows_ UNION SELECT r.n, l.b FROM reached r JOIN links l ON r.m = l.a),
least AS (SELECT r.n, min(m.vec_id) AS component_id FROM reached r JOIN rows_ m ON r.m = m.n GROUP BY r.n),
degree AS (SELECT a AS n, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows_ JOIN least USING (n) LEFT JOIN degree USING (n)
"""
