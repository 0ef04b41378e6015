"""User functions over projects and groups."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_to_projects(rows: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A user function over the rows of each project."""
    return rows.groupBy("project_id").applyInPandas(fn, schema)


def apply_to_rows(rows: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A user function over batches of rows, one row a project, without a shuffle."""

    def batches(parts):
        for pdf in parts:
            yield fn(pdf)

    return rows.mapInPandas(batches, schema)


def decode_chunks(refs: DataFrame, meta: DataFrame) -> DataFrame:
    """Numbers of inline chunks by their variable's dtype: (project_id, file_ord, var, coords, values).

    A user hook over a whole group is a function from DataFrame to DataFrame: ``group.transform(hook)``.
    """

    @F.pandas_udf("array<double>")
    def decode(data: pd.Series, dtype: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([None if d is None or t is None else np.frombuffer(d, t).astype("f8") for d, t in zip(data, dtype, strict=True)])

    typed = refs.where("inline is not null").join(meta.select("project_id", "file_ord", "var", "dtype"), ["project_id", "file_ord", "var"])
    return typed.select("project_id", "file_ord", "var", "coords", decode("inline", "dtype").alias("values"))
