"""DuckDB SQL of the queries on URLs, phrases and the manifest."""

from __future__ import annotations

from collections.abc import Sequence

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def url_filter(rules, strict: Sequence[str], soft: Sequence[str], soft_hits: int) -> str:
    """Rules and vocabulary; each term by a pattern of its own."""
    listed = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)

    def hits(terms):
        quoted = ", ".join(f"'{t}'" for t in terms)
        return f"len(list_filter([{quoted}], lambda t: regexp_matches(words, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"

    soft = [t for t in soft if t not in strict]
    return f"""
WITH rules(verdict, host, path) AS (VALUES {listed}),
cut AS (SELECT row_number() OVER () AS i, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS MATERIALIZED (SELECT i, page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT u.i, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY u.i ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)),
w AS (SELECT i, translate(host || path, {_AZ}) AS words FROM u),
v AS (SELECT i, CASE WHEN {hits(strict)} > 0 OR {hits(soft)} >= {soft_hits} THEN 'block' ELSE 'allow' END AS verdict FROM w)
SELECT page_id, host, path, rule, coalesce(fits.verdict, v.verdict) AS verdict FROM u JOIN v USING (i) LEFT JOIN fits ON fits.i = u.i AND place = 1"""


def phrases(least: int, top: int, inside_percent: int, scale: int) -> str:
    return f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), {_AZ}), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda k: list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: w[i:i + k - 1])))) AS p FROM w),
c AS MATERIALIZED (SELECT lang, p, count(*) AS f FROM g GROUP BY lang, p HAVING count(*) >= {least}),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
inside AS (SELECT lang, q, max(f) AS longer FROM (SELECT lang, f, unnest(flatten(list_transform(range(2, len(p)), lambda k:
  list_transform(range(1, len(p) - k + 2), lambda i: p[i:i + k - 1])))) AS q FROM c WHERE len(p) > 2) GROUP BY lang, q),
kept AS (SELECT c.lang, c.p, c.f AS a FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.q = c.p
  WHERE len(c.p) > 1 AND (longer IS NULL OR 100 * longer < {inside_percent} * c.f)),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM kept),
s AS (SELECT cuts.lang, cuts.p, cuts.a, x.f AS l, y.f AS r, CAST(CAST({scale} AS HUGEINT) * cuts.a // (x.f + y.f) AS BIGINT) AS score, cuts.k
  FROM cuts JOIN c x ON x.lang = cuts.lang AND x.p = cuts.p[1:cuts.k] JOIN c y ON y.lang = cuts.lang AND y.p = cuts.p[cuts.k + 1:len(cuts.p)]),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM s),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, score
  FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit (-1 stands for one step of the division)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: list_concat([ascii(c)], list_transform(range(8), lambda k: -1))))"
    return (f"xor(list_reduce(list_transform({steps}, lambda v: CAST(v AS BIGINT)), lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) "
            "WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, CAST(4294967295 AS BIGINT)), 4294967295)")


def _leaf(text: str) -> str:
    return " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
                       for c in ("doc_id", "source", "lang", "n_chars", f"({text})"))


def merkle() -> str:
    """Both trees level by level; the proof and the fold from each leaf's siblings."""
    return f"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS i, coalesce('s' || source, '') AS g, *, {crc32("CAST(doc_id AS VARCHAR)")} AS crc FROM documents),
leaves AS (SELECT i, g, doc_id, sha256({_leaf("text")}) AS leaf, sha256({_leaf("CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS seen FROM d),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
sub AS (SELECT 0 AS lv, g, pos, leaf AS h, n FROM placed
  UNION ALL SELECT lv + 1, g, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM sub WHERE n > 1 GROUP BY lv, g, pos // 3, n),
heads AS MATERIALIZED (SELECT g, lv AS height, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS top, count(*) OVER () AS n FROM sub WHERE n = 1),
over_ AS (SELECT 0 AS lv, top AS pos, subroot AS h, n FROM heads
  UNION ALL SELECT lv + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM over_ WHERE n > 1 GROUP BY lv, pos // 3, n),
way AS (SELECT i, g, lv, CAST(pos // CAST(pow(3, lv) AS BIGINT) AS BIGINT) AS anc FROM (SELECT i, g, pos, unnest(range(0, height)) AS lv FROM placed JOIN heads USING (g))),
last_level AS (SELECT max(lv) AS lv FROM over_),
way2 AS (SELECT g, height, lv, CAST(top // CAST(pow(3, lv) AS BIGINT) AS BIGINT) AS anc FROM (SELECT g, height, top, unnest(range(0, (SELECT lv FROM last_level))) AS lv FROM heads)),
upper_steps AS MATERIALIZED (SELECT w.g, w.height + w.lv AS step, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < anc), '') AS lhs,
    coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > anc), '') AS rhs
  FROM way2 w JOIN over_ o ON o.lv = w.lv AND o.pos // 3 = w.anc // 3 GROUP BY w.g, w.height, w.lv),
steps AS MATERIALIZED (
  SELECT i, w.lv AS step, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < anc), '') AS lhs, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > anc), '') AS rhs
  FROM way w JOIN sub ON sub.g = w.g AND sub.lv = w.lv AND sub.pos // 3 = w.anc // 3 GROUP BY i, w.lv
  UNION ALL SELECT i, step, lhs, rhs FROM placed JOIN upper_steps USING (g)),
fold AS (SELECT i, CAST(0 AS BIGINT) AS step, seen AS h FROM placed
  UNION ALL SELECT fold.i, fold.step + 1, sha256(lhs || h || rhs) FROM fold JOIN steps ON steps.i = fold.i AND steps.step = fold.step),
ends AS (SELECT i, arg_max(h, step) AS folded_root FROM fold GROUP BY i),
proofs AS (SELECT i, sha256(string_agg(lhs || rhs, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY i)
SELECT doc_id, leaf, subroot, o.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = o.h AS verified
FROM placed JOIN heads USING (g) JOIN ends USING (i) LEFT JOIN proofs USING (i) JOIN over_ o ON o.n = 1"""
