"""Side-by-side check of a Spark query against its DuckDB oracle (same contract as the driver)."""

from __future__ import annotations

import hashlib

import duckdb
import pandas as pd

from claimlens.sources.tables import TABLES


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        col = df[c]
        if pd.api.types.is_numeric_dtype(col) and not pd.api.types.is_bool_dtype(col):
            col = col.astype("float64").round(6)
            df[c] = col.map(lambda v: "NULL" if pd.isna(v) else repr(float(v)))
        else:
            df[c] = col.astype(str).where(col.notna(), "NULL")
    return df


def frame_digest(df: pd.DataFrame) -> str:
    rows = sorted("|".join(r) for r in _norm(df).itertuples(index=False, name=None))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows differ: {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = _norm(spark_pdf), _norm(duck_pdf)
    ra = sorted("|".join(r) for r in a.itertuples(index=False, name=None))
    rb = sorted("|".join(r) for r in b.itertuples(index=False, name=None))
    if ra != rb:
        diff = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, "ok"
