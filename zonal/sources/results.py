"""Result writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_results(df: DataFrame, path: str, fmt: str = "json", files: int | None = None, mode: str = "overwrite") -> None:
    """Write results as JSON or Parquet; map keys become strings in JSON. The result is one
    row per location, so `files=1` is only for short reports."""
    if fmt not in ("json", "parquet"):
        raise ValueError("fmt must be 'json' or 'parquet'")
    out = df if files is None else df.repartition(files)
    out.write.mode(mode).format(fmt).save(path)
