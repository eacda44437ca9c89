"""Input contracts that need no job: required columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(frame: DataFrame, required: Iterable[str], source: str) -> None:
    absent = sorted(set(required) - set(frame.columns))
    if absent:
        raise ValueError(f"{source} is missing required columns: {', '.join(absent)}")
