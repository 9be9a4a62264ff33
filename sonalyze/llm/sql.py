"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {words(LOWERED)} AS w FROM documents), b AS (SELECT item_id, {words(LOWERED)} AS w FROM benchmark),
ds AS (SELECT doc_id, greatest(len(w) - 4, 1) AS n, p, array_to_string(w[p + 1:p + 5], ' ') AS s FROM d, unnest(range(0, greatest(len(w) - 4, 1))) r(p) WHERE len(w) > 0),
bs AS (SELECT item_id, len(w) AS length, greatest(len(w) - 4, 1) AS n, array_to_string(w[p + 1:p + 5], ' ') AS s FROM b, unnest(range(0, greatest(len(w) - 4, 1))) r(p) WHERE len(w) > 0),
bc AS (SELECT item_id, length, n, s, count(*) AS c FROM bs GROUP BY ALL),
hits AS (SELECT doc_id, item_id, length, bc.n, least(bc.n, ds.n) AS nw, ds.n AS nd, p, s, c FROM ds JOIN bc USING (s)),
win AS (SELECT doc_id, item_id, length, n, nw, st, s, least(count(*), c) AS common FROM hits, unnest(range(greatest(0, p - nw + 1), least(p, nd - nw) + 1)) r(st) GROUP BY doc_id, item_id, length, n, nw, st, s, c),
sim AS (SELECT doc_id, item_id, length, st, sum(common) AS shared, n + nw - sum(common) AS total FROM win GROUP BY doc_id, item_id, length, n, nw, st)
SELECT doc_id, item_id, CAST(arg_max(st, {{'a': shared / total, 'b': -st}}) AS BIGINT) AS start, CAST(length AS BIGINT) AS n_words, CAST(max(shared / total) AS DOUBLE) AS similarity FROM sim WHERE 100 * shared >= 75 * total GROUP BY doc_id, item_id, length
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, {words("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 20], ' ') AS s FROM d, unnest(range(0, len(w) - 19)) r(p)),
gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, min({{'d': doc_id, 'p': p}}) OVER (PARTITION BY s) AS f FROM win) WHERE f <> {{'d': doc_id, 'p': p}}),
off AS (SELECT DISTINCT doc_id, p + k AS i FROM gone, unnest(range(0, 20)) r(k)),
one AS (SELECT d.doc_id, i, w[i + 1] AS x FROM d, unnest(range(0, len(w))) r(i)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM one ANTI JOIN off USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a),
c AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id), n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {words(LOWERED)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p + 1:p + 5], ' ') AS g FROM d, unnest(range(0, greatest(len(w) - 4, 1))) r(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), k AS (SELECT doc_id, sha256(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY doc_id), rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS r FROM k),
rs AS (SELECT doc_id, g FROM s WHERE doc_id IN (SELECT r FROM rep)),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM rs a JOIN rs b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
half AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT DISTINCT r AS id, r FROM rep UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
c AS (SELECT id, min(r) AS component FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id LEFT JOIN c ON rep.r = c.id
"""


def secrets() -> str:
    """Matches are placed by what lies between them; windows of candidates are counted whole, each by itself."""
    from sonalyze.llm.secrets import ALLOWED, ASSIGN, ASSIGN_VALUE, CLASSES, FORMS

    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = [*FORMS, *((c.name, c.chars + "{" + str(c.window) + ",}") for c in CLASSES)]
    scans = " UNION ALL ".join(f"SELECT id, t, {k} AS k, '{n}' AS kind, string_split_regex(t, {quoted(p)}) AS gaps, regexp_extract_all(t, {quoted(p)}) AS hits FROM d" for k, (n, p) in enumerate(kinds))
    fits = " OR ".join(f"k = {len(FORMS) + i} AND " + " AND ".join([f"regexp_matches(hit, {quoted(p)})" for p in c.holds] + [f"NOT regexp_matches(hit, {quoted(p)})" for p in ALLOWED]) for i, c in enumerate(CLASSES))
    tops = " ".join(f"WHEN {len(FORMS) + i} THEN {c.most}" for i, c in enumerate(CLASSES))
    w = CLASSES[0].window
    values = [sum(CLASSES[0].steps[:c]) for c in range(w + 1)]
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents), scans AS ({scans}),
found AS (SELECT id, k, kind, hits[i] AS hit, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s FROM scans, unnest(range(1, len(hits) + 1)) r(i)),
base AS (SELECT id, k, kind, s, s + length(hit) AS e FROM found WHERE k < {len(FORMS)} AND (k > 0 OR length(regexp_extract(hit, {quoted(ASSIGN)}, 2)) >= {ASSIGN_VALUE})),
wins AS (SELECT id, k, kind, s, s + a AS a, substr(hit, CAST(a AS BIGINT) + 1, {w}) AS win FROM found, unnest(range(0, length(hit) - {w - 1})) r(a) WHERE {fits}),
high AS (SELECT DISTINCT id, k, kind, s, a FROM (SELECT id, k, kind, s, a, c, count(*) AS n FROM (SELECT *, unnest(string_split(win, '')) AS c FROM wins) GROUP BY ALL) GROUP BY id, k, kind, s, a HAVING sum(({values})[n + 1]) <= CASE k {tops} END),
runs AS (SELECT *, sum(CASE WHEN a - p <= {w} THEN 0 ELSE 1 END) OVER (PARTITION BY id, k, s ORDER BY a) AS run FROM (SELECT *, lag(a) OVER (PARTITION BY id, k, s ORDER BY a) AS p FROM high)),
more AS (SELECT id, k, kind, min(a) AS s, max(a) + {w} AS e FROM runs GROUP BY id, k, kind, s, run),
own AS (SELECT * FROM more WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.id = more.id AND b.s <= more.s AND more.e <= b.e)),
b AS (SELECT id, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h, string_agg(concat_ws(':', kind, CAST(s AS BIGINT), CAST(e AS BIGINT)), ',' ORDER BY s, k) AS x FROM base GROUP BY id),
o AS (SELECT id, string_agg(concat_ws(':', kind, CAST(s AS BIGINT), CAST(e AS BIGINT)), ',' ORDER BY s, k) AS x FROM (SELECT * FROM base UNION ALL SELECT * FROM own) GROUP BY id)
SELECT doc_id, coalesce(b.a, 0) AS n_assign, coalesce(b.c, 0) AS n_access, coalesce(b.h, 0) AS n_hex, sha256(coalesce(b.x, '')) AS base_sha256, coalesce(o.x, '') AS spans FROM d LEFT JOIN b USING (id) LEFT JOIN o USING (id)
"""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM d),
kept AS (SELECT lang, w FROM o GROUP BY lang, w HAVING count(DISTINCT id) >= 30), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, w, count(*) AS c FROM o JOIN kept USING (lang, w) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.w, coalesce(c, 0) AS c, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 5) // (n + 5 * v) AS p FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, w)),
q AS (SELECT lang, w, 1 + CAST(1000000000 AS HUGEINT) * (sum(c) + 5) // (any_value(n) + 5 * any_value(v)) AS q FROM c JOIN (SELECT lang, sum(n) AS n FROM g GROUP BY lang) USING (lang) JOIN v USING (lang) GROUP BY lang, w),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.w = b.w AND a.source <> b.source GROUP BY ALL),
both_ AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, w AS item, p - q AS value FROM p JOIN q USING (lang, w) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM both_ UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
