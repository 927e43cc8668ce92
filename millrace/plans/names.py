"""Similarity of names in DuckDB's SQL."""

from __future__ import annotations

#: The longest block of ``a`` that ``b`` has, as {length, -start}: the first in ``a`` of the longest; null if there is none.
BLOCK = """list_max(list_filter(flatten(list_transform(range(1, length({a}) + 1), lambda i: list_transform(range(1, length({a}) - i + 2), lambda k: {{'k': k, 'n': -i}}))), lambda s: contains({b}, substr({a}, -s.n, s.k))))"""


def ratios(pairs: str) -> str:
    """Recursive tables ending in ``ratios`` (query, id, score) over the rows (query, id) of ``pairs``."""
    return f"""blocks AS (SELECT query, id, id AS a, query AS b, {BLOCK.format(a="id", b="query")} AS x FROM (SELECT DISTINCT query, id FROM {pairs}) UNION ALL
SELECT query, id, p.a, p.b, {BLOCK.format(a="p.a", b="p.b")} FROM (SELECT query, id, unnest([{{'a': left(a, -x.n - 1), 'b': left(b, instr(b, t) - 1)}}, {{'a': substr(a, x.k - x.n), 'b': substr(b, instr(b, t) + x.k)}}]) AS p
 FROM (SELECT *, substr(a, -x.n, x.k) AS t FROM blocks WHERE x IS NOT NULL))),
ratios AS (SELECT query, id, round(2.0 * coalesce(sum(x.k), 0)::DOUBLE / (length(query) + length(id)), 6) AS score FROM blocks GROUP BY query, id)"""
