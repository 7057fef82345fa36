"""Render the shared input adapters as DuckDB CTEs and wrap query bodies with them."""

from __future__ import annotations

import re

from kestrel.sources.fixtures import ADAPTERS
from kestrel.sources.seeds import seed_values_sql


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def adapter_cte(name: str) -> str:
    if name == "cut_scores":
        return f"{name} AS ({seed_values_sql()})"
    a = ADAPTERS[name]
    parts = []
    for br in a.branches:
        cols = ", ".join(f"{e} AS {qi(c)}" for c, e in br.columns)
        where = f" WHERE {br.where}" if br.where else ""
        group = ""
        if br.group_by:
            group = " GROUP BY " + ", ".join(e for c, e in br.columns if c in br.group_by)
        parts.append(f"SELECT {cols} FROM {br.table}{where}{group}")
    return f"{name} AS ({' UNION ALL '.join(parts)})"


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def trim_any_blank(sql: str) -> str:
    """Give every one-argument ``trim(x)`` the set of blanks it removes (DuckDB's own default is spaces only)."""
    out, at = "", 0
    for m in re.finditer(r"(?<![A-Za-z_])trim\(", sql):
        depth, end = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        if m.end() >= at:
            out += sql[at: m.end()] + trim_any_blank(sql[m.end(): end - 1]) + f", {_BLANKS})"
            at = end
    return out + sql[at:]


_ALL = sorted(list(ADAPTERS) + ["cut_scores"], key=len, reverse=True)


def with_inputs(body: str) -> str:
    """Prefix ``body`` (``<ctes> SELECT ...`` or a bare SELECT) with the adapter CTEs it references.

    ``body`` is either ``"SELECT ..."`` or ``"WITH a AS (...), b AS (...) SELECT ..."``.
    """
    body = trim_any_blank(body)
    used = [n for n in _ALL if re.search(rf"\b{re.escape(n)}\b", body)]
    order = [n for n in ADAPTERS if n in used] + (["cut_scores"] if "cut_scores" in used else [])
    ctes = ",\n".join(adapter_cte(n) for n in order)
    stripped = body.strip()
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{stripped}"
