"""SQL (DuckDB) for those operators that SQL can express."""

from __future__ import annotations

from quillspark.llm import url_filters as u

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Components of a table ``links(a, b)`` by reachability.
REACH = """reach(node, seen) AS (SELECT a, a FROM links UNION SELECT b, b FROM links UNION
 SELECT r.node, CASE WHEN l.a = r.seen THEN l.b ELSE l.a END FROM reach r JOIN links l ON l.a = r.seen OR l.b = r.seen),
 comp AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)"""


def near_embeddings_sql(threshold: float) -> str:
    return f"""WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
 good AS (SELECT * FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
 links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= {threshold}),
 {REACH}, n AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY 1)
 SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept FROM e LEFT JOIN n ON n.id = vec_id LEFT JOIN comp ON node = vec_id"""


def near_duplicates_sql(width: int, percent: int) -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - {width - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s FROM w),
 u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
 shared AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
 links AS (SELECT a, b FROM shared WHERE 100 * k >= {percent} * (na + nb - k)), {REACH}
 SELECT doc_id, len(s) AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept FROM s LEFT JOIN comp ON node = doc_id"""


def judge_urls_sql(rules: list[tuple[str, str]]) -> str:
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    fits = lambda rule: f"(host = '{rule.partition('/')[0]}' OR ends_with(host, '.{rule.partition('/')[0]}')) AND starts_with(path, '/{rule.partition('/')[2]}')"
    case = lambda k: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[k]}'" for r in ordered) + " END"
    kind = (
        "CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{num}' WHEN regexp_matches(s, '^[0-9]+\\.[A-Za-z]{1,5}$') THEN '{num}' || regexp_extract(s, '(\\.[A-Za-z]{1,5})$', 1)"
        " WHEN regexp_matches(s, '^[0-9A-Fa-f]{8,}$|^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$') THEN '{hex}'"
        " WHEN regexp_matches(s, '^[0-9A-Za-z_-]{16,}$') AND regexp_matches(s, '[0-9]') AND regexp_matches(s, '[A-Za-z]') THEN '{id}' ELSE s END"
    )
    levels, last = "", "t0"
    for k in range(1, u.DEPTH + 1):
        levels += f""", c{k} AS (SELECT host, template, seg[{k}] AS s, sum(n) AS n FROM {last} WHERE shape <> '' AND len(seg) >= {k} GROUP BY 1, 2, 3),
 v{k} AS (SELECT host, template, count(*) >= {u.MANY} AND count(*) >= {u.VARIED} * sum(n) AS variable FROM c{k} GROUP BY 1, 2),
 t{k} AS (SELECT t.* EXCLUDE (template), CASE WHEN shape = '' OR len(seg) < {k} THEN t.template ELSE t.template || '/' || CASE WHEN variable AND NOT starts_with(seg[{k}], '{{') THEN '*' ELSE seg[{k}] END END AS template FROM {last} t LEFT JOIN v{k} ON v{k}.host = t.host AND v{k}.template = t.template)"""
        last = f"t{k}"
    return f"""WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
 r AS (SELECT *, {case(1)} AS rule, {case(0)} AS ruled, string_split(path, '/') AS parts FROM p),
 q AS (SELECT *, CASE WHEN path = '' THEN '' ELSE '/' || array_to_string(list_transform(parts[2:{u.DEPTH + 1}], lambda s: {kind}), '/') || CASE WHEN len(parts) > {u.DEPTH + 1} THEN '/{{rest}}' ELSE '' END END AS shape FROM r),
 t0 AS (SELECT host, shape, string_split(shape[2:], '/') AS seg, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (WHERE ruled = 'block') AS blocked, '' AS template FROM q GROUP BY host, shape){levels},
 own AS (SELECT host, template, sum(labelled) AS labelled, sum(blocked) AS blocked FROM {last} GROUP BY 1, 2),
 b AS (SELECT host, template, labelled, blocked, pos, x, array_to_string(list_transform(x, lambda s, i: CASE WHEN i = pos THEN '*' ELSE s END), '/') AS wider FROM (SELECT *, string_split(template, '/') AS x, unnest(range(2, len(string_split(template, '/')) + 1)) AS pos FROM own) WHERE x[pos] NOT IN ('*', '') AND NOT starts_with(x[pos], '{{')),
 g AS (SELECT host, wider, sum(labelled) AS tl, sum(blocked) AS tb FROM b GROUP BY 1, 2 HAVING count(*) > 1),
 m AS (SELECT b.* FROM b JOIN g ON g.host = b.host AND g.wider = b.wider WHERE labelled >= {u.COMPARED} AND abs(blocked / labelled - tb / tl) < {u.SIMILAR} * sqrt(greatest(tb / tl * (1 - tb / tl), 1e-9) / labelled)),
 h AS (SELECT host, wider, sum(labelled) AS ml, sum(blocked) AS mb FROM m GROUP BY 1, 2 HAVING count(*) > 1),
 f AS (SELECT m.host, m.template, min_by({{'w': m.wider, 'l': ml, 'b': mb}}, pos) AS f FROM m JOIN h ON h.host = m.host AND h.wider = m.wider GROUP BY 1, 2),
 z AS (SELECT sum(labelled) AS l, sum(blocked) AS b FROM own),
 j AS (SELECT own.host, own.template, coalesce(f.f.w, own.template) AS into_, coalesce(f.f.l, labelled) AS l, coalesce(f.f.b, blocked) AS b FROM own LEFT JOIN f ON f.host = own.host AND f.template = own.template),
 k AS (SELECT t.host, t.shape, into_, j.l::BIGINT AS labelled, (j.b + {u.PRIOR} * coalesce(z.b / nullif(z.l, 0), 0)) / (j.l + {u.PRIOR}) AS purity FROM {last} t JOIN j ON j.host = t.host AND j.template = t.template, z)
 SELECT page_id, q.host, path, rule, coalesce(ruled, CASE WHEN labelled > 0 AND purity >= {u.REJECT} THEN 'block' ELSE 'allow' END) AS verdict, into_ AS template, purity, labelled FROM q JOIN k ON k.host = q.host AND k.shape = q.shape"""


def contamination_sql(width: int) -> str:
    words = lambda t: f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM {t}"
    return f"""WITH d AS (SELECT doc_id, {words('documents')}), b AS (SELECT item_id, {words('benchmark')}),
 i AS (SELECT DISTINCT item_id, least(len(w), {width}) AS k, array_to_string(w[p:p + least(len(w), {width}) - 1], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - least(len(w), {width}) + 2)) AS p FROM b WHERE len(w) > 0)),
 k AS (SELECT DISTINCT k FROM i), spots AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, k WHERE len(w) >= k),
 h AS (SELECT doc_id, p, k, x FROM (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS x FROM spots) SEMI JOIN i USING (k, x)),
 c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY 1),
 f AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM (SELECT DISTINCT doc_id, k, x FROM h) JOIN i USING (k, x)) GROUP BY 1)
 SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN f USING (doc_id)"""


def clusters_sql(k: int, rounds: int, dim: int, scale: int, seed: str) -> str:
    nearest = lambda c: f"""SELECT vec_id, x, min_by(cluster, d * {k} + cluster) AS cluster, min(d) AS distance FROM (SELECT vec_id, r, v.x, {c}.cluster, list_sum(list_transform(list_zip(v.x, {c}.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, {c}) GROUP BY vec_id, r, x"""
    steps = "".join(
        f""", a{t} AS ({nearest(f"c{t}")}),
 m{t} AS (SELECT cluster, list(s ORDER BY p) AS c FROM (SELECT cluster, p, floor(sum(x)::DECIMAL(38, 0) / count(*))::BIGINT AS s FROM (SELECT cluster, unnest(x) AS x, generate_subscripts(x, 1) AS p FROM a{t}) GROUP BY 1, 2) GROUP BY 1),
 c{t + 1} AS (SELECT c{t}.cluster, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (cluster))"""
        for t in range(rounds)
    )
    return f"""WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda y: floor({scale}::DOUBLE * y::DOUBLE)::BIGINT) AS x FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
 c0 AS (SELECT row_number() OVER (ORDER BY sha256('{seed}' || vec_id), x) - 1 AS cluster, x AS c FROM v WHERE vec_id IS NOT NULL ORDER BY sha256('{seed}' || vec_id), x LIMIT {k}){steps}, a{rounds} AS ({nearest(f"c{rounds}")})
 SELECT vec_id, a{rounds}.cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY a{rounds}.cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{rounds}.c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (cluster)"""
