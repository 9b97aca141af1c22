"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from . import quality_rules, url_filters, warc


def _case(rules: list[tuple[str, str]], verdict: bool) -> str:
    whens = []
    for what, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, _, rest = rule.partition("/")
        whens.append(f"WHEN (host = '{host}' OR suffix(host, '.{host}')) AND prefix(path, '/{rest}') THEN '{what if verdict else rule}'")
    return "CASE " + " ".join(whens) + " END"


def _parsed(source: str, url: str) -> str:
    rest = f"coalesce(CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END, '')"
    return f"SELECT *, translate(_h, '{url_filters.UPPER}', '{url_filters.LOWER}') AS host, regexp_extract(substr(_rest, length(_h) + 1), '^[^?#]*') AS path FROM (SELECT *, regexp_extract(_rest, '^[^/?#]*') AS _h FROM (SELECT *, {rest} AS _rest FROM {source}))"


def url_filter_sql(a: float = url_filters.FOLLOW) -> str:
    link = url_filters.LINK.replace("'", "''")
    digits, least = url_filters.DIGITS, url_filters.LEAST
    parts = [
        f"parsed AS ({_parsed('pages', 'url')})",
        f"judged AS (SELECT page_id, html, host, path, {_case(url_filters.RULES, False)} AS rule, {_case(url_filters.RULES, True)} AS verdict FROM parsed)",
        f"links AS (SELECT src, CASE WHEN prefix(link, '//') THEN 'http:' || link ELSE link END AS link FROM (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM judged WHERE host <> ''))",
        f"targets AS (SELECT src, CASE WHEN host <> '' THEN host WHEN strpos(link, ':') > 0 THEN NULL ELSE src END AS dst FROM ({_parsed('links', 'link')}))",
        "edges AS (SELECT src, dst, count(*) AS n FROM targets WHERE dst IS NOT NULL AND dst <> src GROUP BY 1, 2)",
        "seeds AS (SELECT host, count(*) FILTER (verdict = 'allow') / count(*) AS s, count(*) FILTER (verdict = 'block') / count(*) AS b FROM judged WHERE host <> '' GROUP BY 1)",
        "hosts AS (SELECT host, coalesce(s, 0.0) AS s, coalesce(b, 0.0) AS b FROM (SELECT DISTINCT dst AS host FROM edges) FULL JOIN seeds USING (host))",
        "weighed AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS wt, n / sum(n) OVER (PARTITION BY dst) AS wd FROM edges)",
        "moves AS (SELECT dst AS host, src AS other, wt, CAST(0 AS DOUBLE) AS wd FROM weighed UNION ALL SELECT src, dst, CAST(0 AS DOUBLE), wd FROM weighed)",
        "state AS (SELECT 0 AS k, host, CAST(s AS DOUBLE) AS s, CAST(b AS DOUBLE) AS b, CAST(s AS DOUBLE) AS t, CAST(b AS DOUBLE) AS d FROM hosts UNION ALL "
        f"SELECT k + 1, host, s, b, s + {a} * dt, b + {a} * dd FROM (SELECT q.host, any_value(q.k) AS k, any_value(q.s) AS s, any_value(q.b) AS b, coalesce(sum(y.t * m.wt), 0.0) AS dt, coalesce(sum(y.d * m.wd), 0.0) AS dd "
        f"FROM state q LEFT JOIN moves m ON m.host = q.host LEFT JOIN state y ON y.host = m.other GROUP BY q.host) WHERE k < {url_filters.rounds(a)})",
    ]
    return (
        "WITH RECURSIVE " + ", ".join(parts) + f" SELECT page_id, j.host, path, rule, coalesce(verdict, CASE WHEN distrust >= {least} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict, trust, distrust "
        f"FROM judged j LEFT JOIN (SELECT host, round(t, {digits}) AS trust, round(d, {digits}) AS distrust FROM state WHERE k = {url_filters.rounds(a)}) r ON r.host = j.host"
    )


WARC = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT digest, max(page_id) AS keep FROM p WHERE n >= {warc.LEAST_REVISIT} GROUP BY 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN n >= {warc.LEAST_REVISIT} AND page_id IS DISTINCT FROM keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.LEAST_REVISIT} AND page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM p LEFT JOIN k ON p.digest = k.digest
"""

ORACLE_SQL = {"op5_url_filters": url_filter_sql(), "op9_warc": WARC, "op13_quality_rules": quality_rules.quality_sql()}
