"""DuckDB expressions that restate the name measures, for the statements that queries are compared with."""

from __future__ import annotations


def scored(source: str, a: str, b: str, into: str = "m") -> str:
    """Common table expressions: ``into`` is ``source`` with jw, osa, sx (1: sounds differ), cos, jac and qg of its columns ``a`` and ``b``."""
    window = f"greatest(0, greatest(length({a}), length({b})) // 2 - 1)"
    matched = (
        f"list_reduce(range(1, length({a}) + 1), lambda s, i: list_transform([list_filter(range(greatest(1, i - {window}), least(length({b}), i + {window}) + 1), "
        f"lambda j: {b}[j] = {a}[i] AND NOT list_contains(s.t, j))[1]], lambda j: CASE WHEN j IS NULL THEN s ELSE {{'t': list_append(s.t, j), 'c': s.c || {a}[i]}} END)[1], "
        "{'t': CAST([] AS BIGINT[]), 'c': ''})"
    )
    row = (
        f"list_reduce(range(1, length({b}) + 1), lambda c, j: list_append(c, least(s.r[j + 1] + 1, c[j] + 1, s.r[j] + CASE WHEN {a}[i] = {b}[j] THEN 0 ELSE 1 END, "
        f"CASE WHEN i > 1 AND j > 1 AND {a}[i] = {b}[j - 1] AND {a}[i - 1] = {b}[j] THEN s.o[j - 1] + 1 ELSE 1000000 END)), [i])"
    )
    edits = f"list_reduce(range(1, length({a}) + 1), lambda s, i: {{'o': s.r, 'r': {row}}}, {{'o': CAST([] AS BIGINT[]), 'r': range(0, length({b}) + 1)}}).r[-1]"
    counts = f"list_transform(list_distinct(string_split({a} || {b}, '')), lambda c: {{'x': length({a}) - length(replace({a}, c, '')), 'y': length({b}) - length(replace({b}, c, ''))}})"
    total = lambda f: f"list_sum(list_transform(xy, lambda p: CAST({f} AS DOUBLE)))"
    return f"""{into}_1 AS (SELECT *, {matched} AS jst, {edits} AS osa, {counts} AS xy, {sound(a)} AS sa, {sound(b)} AS sb FROM {source}),
{into}_2 AS (SELECT *, length(jst.c) AS hits, list_sum(list_transform(range(1, length(jst.c) + 1), lambda i: CASE WHEN {b}[list_sort(jst.t)[i]] = jst.c[i] THEN 0 ELSE 1 END)) / 2.0 AS moved,
  CASE WHEN {a}[1] <> {b}[1] THEN 0 WHEN {a}[2] <> {b}[2] THEN 1 WHEN {a}[3] <> {b}[3] THEN 2 WHEN {a}[4] <> {b}[4] THEN 3 ELSE least(4, length({a}), length({b})) END AS same FROM {into}_1),
{into}_3 AS (SELECT *, (hits / length({a}) + hits / length({b}) + (hits - moved) / hits) / 3 AS jaro FROM {into}_2),
{into} AS (SELECT * EXCLUDE (jst, xy, sa, sb, hits, moved, same, jaro), CASE WHEN {a} = '' AND {b} = '' THEN 0.0 WHEN hits = 0 THEN 1.0 ELSE 1 - (jaro + same * 0.1 * (1 - jaro)) END AS jw,
  CASE WHEN {a} <> '' AND {b} <> '' AND sa = sb THEN 0 ELSE 1 END AS sx, greatest(0.0, 1 - {total('p.x * p.y')} / (sqrt({total('p.x * p.x')}) * sqrt({total('p.y * p.y')}))) AS cos,
  1 - {total('least(p.x, p.y)')} / {total('greatest(p.x, p.y)')} AS jac, {total('abs(p.x - p.y)')} AS qg FROM {into}_3)"""


def sound(a: str) -> str:
    """Soundex of a text of letters, blanks and digits: equal codes side by side, or with h or w between them, count once."""
    code = f"translate(upper({a}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202')"
    kept = f"list_reduce(range(2, length({a}) + 1), lambda s, i: CASE WHEN upper({a})[i] IN ('H', 'W') THEN s WHEN c[i] BETWEEN '1' AND '6' AND upper({a})[i] BETWEEN 'A' AND 'Z' THEN {{'o': s.o || CASE WHEN c[i] <> s.l THEN c[i] ELSE '' END, 'l': c[i]}} ELSE {{'o': s.o, 'l': '0'}} END, {{'o': '', 'l': CASE WHEN upper({a})[1] BETWEEN 'A' AND 'Z' THEN c[1] ELSE '0' END}}).o"
    return f"list_transform([{code}], lambda c: left(upper({a})[1] || {kept} || '000', 4))[1]"


def fuzzy(pairs: str, threshold_min: float, threshold: float, exact_at: float) -> str:
    """Matches (id1, id2, jw) of ``pairs`` (id1, id2, a, b, in the same block), one per id1, by the staged rules."""
    return f"""{scored(pairs, 'a', 'b')},
f_low AS (SELECT *, min(jw) OVER (PARTITION BY id1) AS low FROM m),
f_near AS (SELECT *, row_number() OVER (PARTITION BY id1 ORDER BY jw, id2) AS k FROM f_low WHERE low <= {threshold_min} AND
  CASE WHEN low <= {exact_at} THEN jw <= {exact_at} ELSE jw <= {threshold} OR (sx = 0 AND cos <= 0.25) END),
f_graded AS (SELECT *, CASE WHEN low <= {exact_at} THEN 0 WHEN jw < 0.5 AND jac < 0.5 THEN
    CASE WHEN (jac <= 0.05 AND cos <= 0.05) OR jw <= 0.15 OR (sx = 0 AND jw <= 0.3) THEN 1
         WHEN (sx = 0 AND cos <= 0.25) OR (jac <= 0.15 AND cos <= 0.15 AND osa / length(b) <= 0.4) OR jw <= 0.21 THEN 2 END END AS grade FROM f_near WHERE k <= 10 OR low <= {exact_at}),
f_best AS (SELECT *, row_number() OVER (PARTITION BY id1 ORDER BY grade, jw, id2) AS best FROM f_graded WHERE grade IS NOT NULL),
matched AS (SELECT id1, id2, jw FROM f_best WHERE best = 1)"""
