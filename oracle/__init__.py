"""Independent DuckDB SQL oracle for every registered query."""

from __future__ import annotations

from oracle.bindings import with_bindings


def all_sql() -> dict[str, str]:
    from oracle import crosssell_sql, more_sql, reactivation_sql

    out: dict[str, str] = {}
    for mod in (reactivation_sql, crosssell_sql, more_sql):
        out.update(mod.SQL)
    return {k: with_bindings(v) for k, v in out.items()}
