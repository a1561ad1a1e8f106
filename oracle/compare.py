"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_cols, spark_rows, oracle_cols, oracle_rows) -> list[str]:
    msgs = []
    if sorted(spark_cols) != sorted(oracle_cols):
        msgs.append(f"columns differ: spark-only={sorted(set(spark_cols) - set(oracle_cols))} "
                    f"oracle-only={sorted(set(oracle_cols) - set(spark_cols))}")
        return msgs
    if len(spark_rows) != len(oracle_rows):
        msgs.append(f"row counts differ: spark={len(spark_rows)} oracle={len(oracle_rows)}")
        return msgs
    a, b = canonical(spark_cols, spark_rows), canonical(oracle_cols, oracle_rows)
    if a != b:
        sa, sb = set(a), set(b)
        msgs.append(f"values differ: spark-only {sorted(sa - sb, key=str)[:2]} oracle-only {sorted(sb - sa, key=str)[:2]}")
    return msgs
