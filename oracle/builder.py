"""Tiny helper to assemble one WITH-query from named CTE fragments."""

from __future__ import annotations


class Query:
    def __init__(self) -> None:
        self._ctes: list[tuple[str, str]] = []
        self._names: set[str] = set()

    def add(self, name: str, body: str) -> "Query":
        if name not in self._names:
            self._names.add(name)
            self._ctes.append((name, body))
        return self

    def has(self, name: str) -> bool:
        return name in self._names

    def sql(self, final: str) -> str:
        ctes = ",\n".join(f"{n} AS (\n{b}\n)" for n, b in self._ctes)
        return f"WITH {ctes}\n{final}"


def jv(doc: str, path: str) -> str:
    """Scalar text at ``path`` (NULL for null/object/array)."""
    return f"(json_value({doc}, '{path}') ->> '$')"


def fv(col: str, order: str) -> str:
    """First non-NULL value of ``col`` in ``order``."""
    return f"first({col} ORDER BY {order}) FILTER (WHERE {col} IS NOT NULL)"


def fp64(expr: str) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, 15) AS BIGINT)"
