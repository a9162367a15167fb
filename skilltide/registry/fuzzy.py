"""Comparison SQL of the token-set ratio.

It follows the definition: all three ratios in full, the longest common subsequence by its
recurrence, a row of the table per step and the row's running maximum for the left neighbour.
"""

from __future__ import annotations

_PREPARED = (
    r"trim(lower(regexp_replace(regexp_replace({0}, '[\x{{80}}-\x{{ff}}]', '', 'g'),"
    r" '[^\p{{L}}\p{{N}}_]', ' ', 'g')))"
)
_TOKEN_SET = "list_sort(list_distinct(list_filter(string_split({0}, ' '), lambda w: length(w) > 0)))"


def _set_of(column: str) -> str:
    return _TOKEN_SET.format(_PREPARED.format(column))


# From ``score_pairs (l, r)`` to ``pair_scores (l, r, score)``.
PAIR_SCORES = f"""
  token_sets AS (
    SELECT l, r, {_set_of('l')} AS a, {_set_of('r')} AS b FROM (SELECT DISTINCT l, r FROM score_pairs)),
  parts AS (
    SELECT *, array_to_string(list_sort(list_intersect(a, b)), ' ') AS s,
           array_to_string(list_filter(a, lambda w: NOT list_contains(b, w)), ' ') AS rest_a,
           array_to_string(list_filter(b, lambda w: NOT list_contains(a, w)), ' ') AS rest_b
    FROM token_sets WHERE len(a) > 0 AND len(b) > 0),
  texts AS (
    SELECT *, trim(concat(s, ' ', rest_a)) AS c1, trim(concat(s, ' ', rest_b)) AS c2 FROM parts),
  compared AS (
    SELECT s AS x, c1 AS y FROM texts UNION SELECT s, c2 FROM texts UNION SELECT c1, c2 FROM texts),
  steps(x, y, i, t) AS (
    SELECT x, y, 0, list_transform(range(1, length(y) + 1), lambda k: CAST(0 AS BIGINT))
    FROM compared WHERE x <> '' AND y <> ''
    UNION ALL
    SELECT x, y, i + 1, list_transform(range(1, length(y) + 1), lambda j: list_max(c[1:j])) FROM (
      SELECT x, y, i, list_transform(range(1, length(y) + 1), lambda k: greatest(t[k],
               CASE WHEN substr(y, k, 1) = substr(x, i + 1, 1) THEN coalesce(t[k - 1], 0) + 1 ELSE 0 END)) AS c
      FROM steps WHERE i < length(x))),
  ratios AS (
    SELECT x, y, round_even(100 * (CAST(2 * list_max(t) AS DOUBLE) / (length(x) + length(y))), 0) AS ratio
    FROM steps WHERE i = length(x)),
  pair_scores AS (
    SELECT t.l, t.r, CAST(greatest(coalesce(p.ratio, 0), coalesce(q.ratio, 0), coalesce(w.ratio, 0)) AS INT) AS score
    FROM texts t
    LEFT JOIN ratios p ON p.x = t.s AND p.y = t.c1
    LEFT JOIN ratios q ON q.x = t.s AND q.y = t.c2
    LEFT JOIN ratios w ON w.x = t.c1 AND w.y = t.c2)
"""

# From ``keyed (category, raw, key)`` and ``vocab_keys`` to ``fuzzy (category, key, fuzzy, score)``.
BEST_TERMS = f"""
  candidates AS (
    SELECT DISTINCT k.category, k.key, v.key AS term, v.target, v.first_ord
    FROM keyed k JOIN vocab_keys v USING (category) WHERE k.key <> ''),
  score_pairs AS (SELECT key AS l, term AS r FROM candidates),
  {PAIR_SCORES.strip()},
  fuzzy AS (
    SELECT c.category, c.key, c.target AS fuzzy, s.score
    FROM candidates c JOIN pair_scores s ON s.l = c.key AND s.r = c.term WHERE s.score >= 50
    QUALIFY row_number() OVER (PARTITION BY c.category, c.key ORDER BY s.score DESC, c.first_ord) = 1)
"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)
