"""Name similarity from 0 to 100 by longest common subsequences."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a word of bits per column."""
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return (~row & full).bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    shared, one, two = " ".join(both), " ".join(both + left), " ".join(both + right)
    return max(ratio(one, two), ratio(shared, one) if both else 0.0, ratio(shared, two) if both else 0.0)


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with a stretch of the longer, stretches over the ends included."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0 if b else 100.0
    n, letters = len(a), set(a)
    best = 0.0
    for i in range(1 - n, len(b)):
        part = b[max(0, i) : i + n]
        if part and (part[-1] in letters if i < len(b) - n else part[0] in letters):
            best = max(best, ratio(a, part))
            if best == 100.0:
                break
    return best


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(" ".join(sorted(x - y)), " ".join(sorted(y - x))))


def weighted_ratio(a: str | None, b: str | None) -> float:
    """The best of the ratios, each discounted for what it leaves out; 0 if a text is null or empty."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if longer <= 8 else 0.6
    return max(ratio(a, b), scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def score(name: str):
    """An Arrow function of two columns that gives the ratio `name` of this module, rounded to 6 digits."""
    function = globals()[name]

    @F.pandas_udf("double")
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(function(x, y), 6) for x, y in zip(a, b)], dtype="float64")

    return scored


def scores_sql(pairs: str, near: bool = False) -> str:
    """CTEs for SQL: `pairs` is the name of one with columns a and b; the last, `scores`, holds a, b and every ratio of this module.

    Common subsequences are counted as in common_length(), with texts of up to 126 letters. near: partial ratios only
    where the weighted ratio needs them, for lengths that differ by half.
    """
    sort = lambda x: f"array_to_string(list_sort(list_filter(string_split({x}, ' '), lambda t: t <> '')), ' ')"
    ratio = lambda x, y, n: f"(CASE WHEN length({x}) + length({y}) = 0 THEN 100.0 ELSE 200.0 * {n} / (length({x}) + length({y})) END)"
    mask = "CASE WHEN substring(x, i, 1) = c THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END"
    far = "AND greatest(length(a), length(b)) >= 1.5 * least(length(a), length(b))" if near else ""
    ends = lambda x, y: f"CASE WHEN length({x}) > length({y}) THEN {y} ELSE {x} END, CASE WHEN length({x}) > length({y}) THEN {x} ELSE {y} END"
    fold = "((r + (r & s)) | (r - (r & s))) & fu"
    return f"""
w AS (SELECT a, b, {sort('a')} AS sa, {sort('b')} AS sb, list_distinct(list_filter(string_split(a, ' '), lambda t: t <> '')) AS ta, list_distinct(list_filter(string_split(b, ' '), lambda t: t <> '')) AS tb FROM (SELECT DISTINCT a, b FROM {pairs} WHERE a <> '' AND b <> '')),
v AS (SELECT *, array_to_string(list_sort(list_filter(ta, lambda t: list_contains(tb, t))), ' ') AS held, array_to_string(list_sort(list_filter(ta, lambda t: NOT list_contains(tb, t))), ' ') AS la, array_to_string(list_sort(list_filter(tb, lambda t: NOT list_contains(ta, t))), ' ') AS lb FROM w),
part_of AS (SELECT DISTINCT CASE WHEN length(x) > length(y) THEN y ELSE x END AS x, CASE WHEN length(x) > length(y) THEN x ELSE y END AS y FROM (SELECT a AS x, b AS y FROM v WHERE true {far} UNION SELECT sa, sb FROM v WHERE held = '' {far} UNION SELECT la, lb FROM v WHERE held = '' {far})),
windows AS (SELECT x, y, unnest(list_distinct(list_transform(range(1 - length(x), length(y)), lambda i: substring(y, greatest(1, i + 1)::INT, (length(x) + least(0, i))::INT)))) AS part FROM part_of),
need AS (SELECT a AS x, b AS y FROM v UNION SELECT sa, sb FROM v UNION SELECT la, lb FROM v UNION SELECT x, part FROM windows WHERE part <> ''),
masks AS (SELECT x, map_from_entries(list_transform(list_distinct(string_split(x, '')), lambda c: {{'k': c, 'v': list_reduce(list_transform(range(1, length(x) + 1), lambda i: {mask}), lambda p, q: p | q)}})) AS m FROM (SELECT DISTINCT x FROM need WHERE x <> '')),
steps AS (SELECT need.x, y, list_transform(string_split(y, ''), lambda c: coalesce(m[c], 0::HUGEINT)) AS st, (1::HUGEINT << length(need.x)::INT) - 1 AS fu FROM need JOIN masks ON need.x = masks.x WHERE y <> ''),
common AS (SELECT x, y, length(x) - bit_count(list_reduce(st, lambda r, s: {fold}, fu)) AS n FROM steps),
best_part AS (SELECT windows.x, windows.y, max({ratio('windows.x', 'part', 'n')}) AS r FROM windows JOIN common ON common.x = windows.x AND common.y = part GROUP BY ALL),
ratios AS (SELECT v.*, {ratio('a', 'b', 'c1.n')} AS ratio, {ratio('sa', 'sb', 'c2.n')} AS token_sort_ratio, {ratio('la', 'lb', 'coalesce(c3.n, 0)')} AS rest, coalesce(c3.n, 0) AS cr,
  length(held) AS nb, length(held) + length(la) + (held <> '' AND la <> '')::INT AS n1, length(held) + length(lb) + (held <> '' AND lb <> '')::INT AS n2, p1.r AS p1, coalesce(p2.r, 0) AS p2, coalesce(p3.r, 0) AS p3
  FROM v JOIN common c1 ON c1.x = a AND c1.y = b JOIN common c2 ON c2.x = sa AND c2.y = sb LEFT JOIN common c3 ON c3.x = la AND c3.y = lb
  LEFT JOIN best_part p1 ON (p1.x, p1.y) = ({ends('a', 'b')}) LEFT JOIN best_part p2 ON held = '' AND (p2.x, p2.y) = ({ends('sa', 'sb')}) LEFT JOIN best_part p3 ON held = '' AND (p3.x, p3.y) = ({ends('la', 'lb')})),
kinds AS (SELECT *, CASE WHEN held <> '' AND (la = '' OR lb = '') THEN 100.0 ELSE greatest(200.0 * (nb + (held <> '' AND la <> '' AND lb <> '')::INT + cr) / (n1 + n2), CASE WHEN held <> '' THEN greatest(200.0 * nb / (nb + n1), 200.0 * nb / (nb + n2)) ELSE 0 END) END AS token_set_ratio,
  p1 AS partial_ratio, CASE WHEN held <> '' THEN 100.0 ELSE greatest(p2, p3) END AS partial_token_ratio, greatest(length(a), length(b)) / least(length(a), length(b)) AS longer FROM ratios),
scores AS (SELECT a, b, round(ratio, 6) AS ratio, round(token_sort_ratio, 6) AS token_sort_ratio, round(token_set_ratio, 6) AS token_set_ratio, round(partial_ratio, 6) AS partial_ratio, round(partial_token_ratio, 6) AS partial_token_ratio,
  round(CASE WHEN longer < 1.5 THEN greatest(ratio, 0.95 * token_sort_ratio, 0.95 * token_set_ratio) ELSE greatest(ratio, CASE WHEN longer <= 8 THEN 0.9 ELSE 0.6 END * partial_ratio, 0.95 * CASE WHEN longer <= 8 THEN 0.9 ELSE 0.6 END * partial_token_ratio) END, 6) AS weighted_ratio FROM kinds)"""
