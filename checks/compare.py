"""Run registered queries and their SQL counterparts side by side.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks import oracles, registry
from checks.views import TABLES
from tessera.session import local_session


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)].astype(object)
    plain = pdf.where(pdf.notna(), None)
    return sorted((tuple(repr(v) for v in row) for row in plain.itertuples(index=False)))


def difference(spark, folder: str, name: str) -> str | None:
    """None if both sides agree in columns and rows."""
    mine = registry.queries()[name](spark, folder).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    theirs = con.execute(oracles.oracles()[name]).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} and {sorted(theirs.columns)}"
    for c in mine.columns:
        if pd.api.types.is_numeric_dtype(mine[c]) and pd.api.types.is_numeric_dtype(theirs[c]):
            mine[c], theirs[c] = mine[c].astype("float64"), theirs[c].astype("float64")
    left, right = _rows(mine), _rows(theirs)
    if left == right:
        return None
    extra, lacking = set(left) - set(right), set(right) - set(left)
    return (
        f"{len(left)} and {len(right)} rows; only here: {sorted(extra)[:2]};"
        f" only there: {sorted(lacking)[:2]}"
    )


def main(folder: str, names: list[str]) -> int:
    spark = local_session(8)
    failed = 0
    for name in names or list(registry.queries()):
        started = time.time()
        try:
            found = difference(spark, folder, name)
        except Exception as error:  # a broken query must not hide the others
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok' if found is None else 'DIFF':5}{time.time() - started:6.1f}s {name} {found or ''}", flush=True)
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:]))
