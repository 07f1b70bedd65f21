"""Column and catalog names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def clean_column_name(name: str) -> str:
    """Snake case: words split at lower-to-upper steps and at other characters."""
    # Where a name is split.
    word_step = r"(?<=[a-z0-9])(?=[A-Z])"
    separators = r"[^a-zA-Z0-9]+"
    return re.sub(separators, "_", re.sub(word_step, "_", name)).lower().strip("_")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column; two names that would become one raise ``ValueError``."""
    names = [clean_column_name(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after cleaning: {', '.join(clashes)}")
    return df.toDF(*names)


def identifier(name: str) -> str:
    """``name`` if it is safe to place in a SQL statement, else ``ValueError``."""
    if not re.fullmatch(r"[a-zA-Z0-9_]+", name):
        raise ValueError(f"invalid identifier: {name!r}")
    return name
