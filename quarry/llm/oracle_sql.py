"""DuckDB SQL for clustering, phrases and url filters."""

from __future__ import annotations

from quarry.llm import host_reputation as H

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def clustering(k: int = 8, dim: int = 64, rounds: int = 10) -> str:
    """Each round as two common tables: the assignment and the new centroids."""
    parts = [
        f"""v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
        ), c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS INTEGER) AS c, x FROM v QUALIFY c < {k}
        )"""
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
            SELECT r, vec_id, x, c, d FROM (
                SELECT v.r, v.vec_id, v.x, m.c, CAST(list_sum(list_transform(range(1, {dim} + 1), lambda i: (v.x[i] - m.x[i]) * (v.x[i] - m.x[i]))) AS BIGINT) AS d
                FROM v, c{n} m
            ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
        )""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS MATERIALIZED (
                SELECT m.c, coalesce(s.x, m.x) AS x FROM c{n} m LEFT JOIN (
                    SELECT c, list(q ORDER BY i) AS x FROM (
                        SELECT c, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS q FROM a{n}, (SELECT unnest(range(1, {dim} + 1)) AS i) GROUP BY c, i
                    ) GROUP BY c
                ) s ON m.c = s.c
            )""")
    return f"""
        WITH {', '.join(parts)},
        t AS (SELECT c, CAST(sum(d) AS BIGINT) AS own FROM a{rounds} GROUP BY c)
        SELECT a.vec_id, a.c AS cluster, a.d AS distance, t.own AS cluster_inertia, CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia,
               sha256(array_to_string(m.x, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN t ON a.c = t.c JOIN c{rounds} m ON a.c = m.c
    """


def _strength(of: str, key: str) -> str:
    """Strength of a step's prior (moments), from children ``of`` with their parents' key."""
    return f"""(
        SELECT CASE WHEN coalesce(sum(df), 0) = 0 OR sum(room) - sum(df) <= 0 THEN {H.WEAKEST}
                    WHEN sum(z) - sum(df) <= 0 THEN {H.STRONGEST}
                    ELSE least(greatest((sum(room) - sum(df)) / (sum(z) - sum(df)) - 1, {H.WEAKEST}), {H.STRONGEST}) END
        FROM (
            SELECT sum(n * power(k / n - pk / pn, 2) / (pk / pn * (1 - pk / pn))) AS z, count(*) - 1 AS df, max(pn) - sum(n * n / pn) AS room
            FROM (SELECT {key} AS g, CAST(n AS DOUBLE) AS n, CAST(k AS DOUBLE) AS k, CAST(sum(n) OVER (PARTITION BY {key}) AS DOUBLE) AS pn, CAST(sum(k) OVER (PARTITION BY {key}) AS DOUBLE) AS pk FROM {of})
            WHERE pk > 0 AND pk < pn GROUP BY g
        )
    )"""


def url_filter() -> str:
    fit = lambda r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
    rules = sorted(H.RULES, key=lambda r: -len(r.text))
    case = lambda of: "CASE " + " ".join(f"WHEN {fit(r)} THEN '{of(r)}'" for r in rules) + " END"
    z2 = H.Z * H.Z
    return f"""
        WITH p AS (
            SELECT page_id, coalesce({_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), l AS (
            SELECT doc_id AS page_id, bool_or(coalesce(toxic = 1, FALSE) OR coalesce(quality = 0, FALSE)) AS bad
            FROM labels WHERE doc_id IS NOT NULL AND (toxic IS NOT NULL OR quality IS NOT NULL) GROUP BY doc_id
        ), h0 AS (
            SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name, count(bad) AS n, count(*) FILTER (WHERE bad) AS k
            FROM p LEFT JOIN l USING (page_id) GROUP BY host
        ), h AS MATERIALIZED (
            SELECT host, n, k,
                   CASE WHEN regexp_matches(name, '^[0-9.]+$|^\\[') THEN name ELSE regexp_extract(name, '([^.]*)$', 1) END AS suffix,
                   CASE WHEN regexp_matches(name, '^[0-9.]+$|^\\[') OR position('.' IN name) = 0 OR (starts_with(name, '.') AND position('.' IN substr(name, 2)) = 0)
                        THEN name ELSE regexp_extract(name, '([^.]*\\.[^.]*)$', 1) END AS domain
            FROM h0
        ), s AS (SELECT * FROM h WHERE n > 0),
        d AS MATERIALIZED (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM s GROUP BY ALL),
        x AS MATERIALIZED (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
        w AS MATERIALIZED (
            SELECT {_strength("s", "domain")} AS s_host, {_strength("d", "suffix")} AS s_domain, {_strength("x", "1")} AS s_suffix,
                   (SELECT (coalesce(sum(k), 0) + 0.5) / CAST(coalesce(sum(n), 0) + 1 AS DOUBLE) FROM x) AS m
        ), m AS (
            SELECT h.host, h.n + s_host AS size,
                   (h.k + s_host * ((coalesce(d.k, 0) + s_domain * ((coalesce(x.k, 0) + s_suffix * w.m) / (coalesce(x.n, 0) + s_suffix))) / (coalesce(d.n, 0) + s_domain))) / (h.n + s_host) AS m
            FROM h CROSS JOIN w LEFT JOIN d ON h.suffix = d.suffix AND h.domain = d.domain LEFT JOIN x ON h.suffix = x.suffix
        ), b AS (SELECT host, (m + {z2} / (2 * size) - {H.Z} * sqrt(m * (1 - m) / size + {z2} / (4 * size * size))) / (1 + {z2} / size) AS bound FROM m)
        SELECT page_id, host, path, {case(lambda r: r.text)} AS rule,
               coalesce({case(lambda r: r.verdict)}, CASE WHEN bound > {H.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
        FROM p JOIN b USING (host)
    """


def phrases(least: int = 10, inside: int = 50, most: int = 2000) -> str:
    return f"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
        p AS (SELECT row_number() OVER () AS id, lang, piece FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
        e AS (SELECT id, lang, unnest(w) AS u, generate_subscripts(w, 1) AS i FROM (SELECT id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p)),
        g AS MATERIALIZED (SELECT lang, u, lead(u) OVER o AS v, lead(u, 2) OVER o AS w FROM e WINDOW o AS (PARTITION BY id ORDER BY i)),
        f AS MATERIALIZED (
            SELECT lang, 1 AS k, u AS phrase, count(*) AS f FROM g GROUP BY ALL
            UNION ALL SELECT lang, 2, u || ' ' || v, count(*) FROM g WHERE v IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, 3, u || ' ' || v || ' ' || w, count(*) FROM g WHERE w IS NOT NULL GROUP BY ALL
        ), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {least}),
        x AS (
            SELECT c.lang, c.k, c.phrase, c.a, j, array_to_string(list_slice(c.w, 1, j), ' ') AS u, array_to_string(list_slice(c.w, j + 1, c.k), ' ') AS v
            FROM c, unnest(range(1, c.k)) t(j)
        ), q AS MATERIALIZED (SELECT lang, k, phrase, f FROM f WHERE f >= {least}),
        y AS MATERIALIZED (SELECT x.*, q.f AS l FROM x JOIN q ON q.lang = x.lang AND q.phrase = x.u AND q.k = x.j),
        s AS MATERIALIZED (
            SELECT y.*, q.f AS r, CAST(CAST(1000000 AS HUGEINT) * y.a * y.a // (CAST(y.l AS HUGEINT) * q.f) AS BIGINT) AS score
            FROM y JOIN q ON q.lang = y.lang AND q.phrase = y.v AND q.k = y.k - y.j
        ), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        h AS (
            SELECT lang, phrase, max(a) AS a FROM (
                SELECT lang, array_to_string(list_slice(w, i, i + 1), ' ') AS phrase, a FROM c, (SELECT unnest([1, 2]) AS i) y WHERE k = 3
            ) GROUP BY ALL
        ), o AS (
            SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score FROM b LEFT JOIN h ON b.k = 2 AND b.lang = h.lang AND b.phrase = h.phrase
            WHERE h.a IS NULL OR 100 * h.a < {inside} * b.a
        )
        SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY o.score DESC, o.a DESC, o.phrase) AS rank, o.phrase, o.a, o.l, o.r, n.n, o.score
        FROM o JOIN n ON o.lang = n.lang QUALIFY rank <= {most}
    """
