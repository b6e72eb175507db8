"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _kinds(table) -> dict[str, str]:
    names = {"large_string": "string", "large_binary": "binary"}
    return {f.name: names.get(str(f.type), str(f.type)) for f in table.schema}


def differences(spark_df, con, sql: str, tolerance: float = 0.0) -> list[str]:
    """Human-readable differences in columns, types, row count and values; empty if equal."""
    left = spark_df.toArrow()
    right = con.sql(sql).to_arrow_table()
    out = []
    a, b = _kinds(left), _kinds(right)
    if sorted(a) != sorted(b):
        return [f"columns differ: only here {sorted(set(a) - set(b))}, only there {sorted(set(b) - set(a))}"]
    out += [f"type of {c}: {a[c]} / {b[c]}" for c in sorted(a) if a[c] != b[c]]
    if left.num_rows != right.num_rows:
        return [*out, f"rows: {left.num_rows} / {right.num_rows}"]
    names = sorted(a)
    key = [c for c in names if "double" not in a[c]] + [c for c in names if "double" in a[c]]
    x = left.to_pandas()[names].sort_values(key, na_position="first").reset_index(drop=True)
    y = right.to_pandas()[names].sort_values(key, na_position="first").reset_index(drop=True)
    for c in names:
        if pd.api.types.is_float_dtype(x[c]) and pd.api.types.is_float_dtype(y[c]):
            wrong = ((x[c] - y[c]).abs() > tolerance) | (x[c].isna() != y[c].isna())
            wrong |= np.signbit(x[c]) != np.signbit(y[c])  # also -0.0 against 0.0
        else:
            wrong = (x[c].astype(object) != y[c].astype(object)) & ~(x[c].isna() & y[c].isna())
        if wrong.any():
            i = wrong.idxmax()
            out.append(f"{c}: {int(wrong.sum())} of {len(x)} differ, e.g. {x[c][i]!r} / {y[c][i]!r}")
    return out
