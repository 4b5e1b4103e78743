"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from episodeframe.llm.hostrep import TWO_LABEL_SUFFIXES
from episodeframe.llm.licences import TEMPLATES, Template

_HOSTS = r"""
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
"""


def _strength(table: str) -> str:
    return (f"(SELECT CASE WHEN count(*) = 0 OR sum(n) <= count(*) THEN 4.0 ELSE 1 / least(greatest("
            f"(sum(pow(k - n * parent, 2) / (n * parent * (1 - parent))) - count(*)) / (sum(n) - count(*)), 0.01), 0.9) - 1 END"
            f" FROM {table} WHERE n > 0)")


def urls(rules: list[tuple[str, str]], limit: float = 0.3, z: float = 1.645) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))

    def case(value) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{t.partition('/')[0]}' OR host LIKE '%.{t.partition('/')[0]}') AND starts_with(path, '/{t.partition('/')[2]}') "
            f"THEN '{value(a, t)}'" for a, t in ordered) + " END"

    long = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    return f"""
WITH {_HOSTS},
o AS (SELECT doc_id AS page_id, max(greatest(toxic, 1 - quality)) AS bad FROM labels GROUP BY 1),
counted AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM h LEFT JOIN o USING (page_id) GROUP BY host),
named AS (SELECT *, string_split(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '.') AS p FROM counted),
parts AS (SELECT *, array_to_string(p, '.') AS name, array_to_string(p[-2:], '.') AS two, array_to_string(p[-3:], '.') AS three FROM named),
flags AS (SELECT *, two IN ({long}) AS long, regexp_matches(name, '^[0-9.]+$') OR len(p) = 1 OR (two IN ({long}) AND two = three) AS alone FROM parts),
hosts AS (SELECT host, n, k, CASE WHEN alone THEN name WHEN long THEN three ELSE two END AS domain,
                 CASE WHEN alone THEN '' WHEN long THEN two ELSE p[-1] END AS suffix FROM flags),
l0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) FROM hosts) AS parent FROM hosts GROUP BY 1),
m0 AS (SELECT suffix, ({_strength('l0')} * parent + k) / ({_strength('l0')} + n) AS parent FROM l0),
l1 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY 1, 2),
p1 AS (SELECT domain, n, k, parent FROM l1 JOIN m0 USING (suffix)),
m1 AS (SELECT domain, ({_strength('p1')} * parent + k) / ({_strength('p1')} + n) AS parent FROM p1),
l2 AS (SELECT host, n, k, parent FROM hosts JOIN m1 USING (domain)),
post AS (SELECT host, {_strength('l2')} * parent + k AS alpha, {_strength('l2')} + n AS total FROM l2),
bound AS (SELECT host, alpha / total - {z} * sqrt((alpha / total) * (1 - alpha / total) / (total + 1)) AS bound FROM post)
SELECT page_id, host, path, {case(lambda a, t: t)} AS rule,
       coalesce({case(lambda a, t: a)}, CASE WHEN bound > {limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN bound USING (host)
"""


COVER_TREE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS r FROM v UNION SELECT p.b, reach.r FROM reach JOIN pairs p ON p.a = reach.id),
comp AS (SELECT id, min(r) AS c FROM reach GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM pairs GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(comp.c, e.vec_id) AS component_id,
       coalesce(comp.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN comp ON comp.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> {}) & 31) + 1, 1)"

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(list_transform(range(0, 8), lambda i: ('0x' || substr(hex, (i * 5 + 1)::INT, 5))::INT),
                                      lambda x: {' || '.join(_DIGIT.format(k) for k in (15, 10, 5, 0))}), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


def licences(templates: tuple[Template, ...] = TEMPLATES, least_share: float = 0.7) -> str:
    """Every start of a text is tried for every template."""
    open_ = [t for t in templates if t.key[1] < len(t.words)]
    weighed = sorted({w for t in open_ for w in t.words})
    name = {w: f"idf{k}" for k, w in enumerate(weighed)}

    def places(t: Template) -> str:
        first, n = t.key
        stands = " AND ".join(f"w[s + {first + k + 1}] = '{t.words[first + k]}'" for k in range(n))
        starts = f"list_filter(range({-first}, greatest(len(w) - {first + n - 1}, {-first})), lambda s: {stands})"
        if t not in open_:
            share = "1.0::DOUBLE"
        else:
            hits = " + ".join(name[x] if first <= i < first + n else f"CASE WHEN s + {i} >= 0 AND w[s + {i + 1}] = '{x}' THEN {name[x]} ELSE 0 END"
                              for i, x in enumerate(t.words))
            share = f"round(least(({hits}) / ({' + '.join(name[x] for x in t.words)}), 1.0), 6)"
        return (f"list_filter(list_transform({starts}, lambda s: {{'label': '{t.label}', 'start': s::BIGINT, 'score': {share}, "
                f"'base': {str(t.base).lower()}}}), lambda f: f.score >= {least_share})")

    idf = ", ".join(f"ln((count(*) + 1) / (sum(list_contains(w, '{w}')::INT) + 0.5)) AS {name[w]}" for w in weighed)
    found = places(templates[0])
    for t in templates[1:]:
        found = f"list_concat({found}, {places(t)})"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    labels = "array_to_string(list_sort(list_distinct(list_transform({}, lambda f: f.label))), ',')"
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
k AS (SELECT {idf} FROM d),
f AS (SELECT doc_id, len(w) AS n_words, {found} AS found FROM d CROSS JOIN k),
b AS (SELECT *, list_filter(found, lambda f: f.base) AS base FROM f)
SELECT doc_id, n_words, len(base)::BIGINT AS n_base, list_min(list_transform(base, lambda f: f.start)) AS first_word,
       list_max(list_transform(base, lambda f: f.start)) AS last_word, {labels.format('base')} AS base_labels,
       {labels.format('found')} AS labels, coalesce(list_max(list_transform(found, lambda f: f.score)), 0.0)::DOUBLE AS score
FROM b"""


def collocations(least: int = 30, cover: int = 80, scale: int = 2_000_000, most: int = 2000) -> str:
    return f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1 HAVING sum(len(ws)) > 0),
g AS (SELECT lang, ws[i:i + k - 1] AS ph FROM w, range(1, 5) AS t(k), unnest(range(1, len(ws) - k + 2)) AS u(i)),
f AS (SELECT lang, ph, count(*) AS f FROM g GROUP BY 1, 2 HAVING count(*) >= {least}),
c AS (SELECT lang, ph, f AS a FROM f WHERE len(ph) >= 2),
cuts AS (SELECT lang, ph, a, unnest(range(1, len(ph))) AS k FROM c),
s AS (SELECT cuts.lang, cuts.ph, cuts.a, k, x.f AS l, y.f AS r, ({scale}::HUGEINT * cuts.a) // (x.f + y.f) AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.ph = cuts.ph[:k] JOIN f y ON y.lang = cuts.lang AND y.ph = cuts.ph[k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
inner_ AS (SELECT lang, ph[i:i + z - 1] AS ph, max(a) AS longer FROM c, range(2, 4) AS t(z), unnest(range(1, len(ph) - z + 2)) AS u(i)
           WHERE z < len(ph) GROUP BY 1, 2),
kept AS (SELECT b.*, array_to_string(b.ph, ' ') AS phrase FROM b LEFT JOIN inner_ USING (lang, ph)
         WHERE longer IS NULL OR 100::HUGEINT * longer < {cover}::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::INTEGER AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {most}
"""
