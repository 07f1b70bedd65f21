"""Rows that surely miss a list of ids pass by; only the others meet it in a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.text import mix
from tillroll.llm.vectors import BitSet, bit_set


def type_list(df: DataFrame, columns: list[str]) -> str:
    """Schema text of some columns, for the functions that take batches."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema.fields)


def hashed(ids: pa.Array) -> np.ndarray:
    """Mixed hashes of ids; a missing one counts as 0."""
    return mix(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def id_set(ids: DataFrame, key: str, log_bits: int = 23) -> BitSet:
    """Bit set of fixed size with all values of a long column."""
    return bit_set(ids, key, log_bits, mixed=False)


def passing(wanted: BitSet, key: str):
    """Keep the rows whose key may be in the set."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted.has(hashed(batch.column(key)))))

    return pick


def likely_and_others(docs: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose long ``key`` may be among ``ids``, and those whose key surely is not.

    Only the keys go to Python; the rows stay in the JVM.
    """
    wanted = id_set(ids, key)

    @F.pandas_udf("boolean")
    def may_be_listed(keys: pd.Series) -> pd.Series:
        return pd.Series(wanted.has(mix(keys.to_numpy(np.int64).view(np.uint64))))

    likely = may_be_listed(F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")))
    return docs.filter(likely), docs.filter(~likely)


def row_key(key: str = "doc_id", text: str = "text") -> Column:
    """A long per row from its id and text: only rows with equal ids and equal texts share it."""
    return F.xxhash64(F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text))


def docs_without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose long ``key`` is not in ``gone``; missing keys are equal."""
    likely, others = likely_and_others(docs, gone, key)
    listed = gone.select(F.col(key).alias("_gone"))
    return others.unionByName(likely.join(listed, F.col(key).eqNullSafe(F.col("_gone")), "left_anti"))
