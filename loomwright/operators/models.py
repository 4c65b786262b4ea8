"""Scores by a model that the caller plugs in: loaded once a worker, called with batches of a fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Models of this worker by name.
LOADED: dict[str, Callable] = {}


def loaded(name: str, load: Callable[[], Callable]) -> Callable:
    """The model of a name; load() makes it the first time that this worker asks."""
    if name not in LOADED:
        LOADED[name] = load()
    return LOADED[name]


def in_batches(rows: pd.DataFrame, model: Callable[[pd.DataFrame], np.ndarray], size: int) -> np.ndarray:
    """model's answers for all rows, by calls with at most `size` of them; a wrong number of answers is an error."""
    out = []
    for start in range(0, len(rows), size):
        part = rows.iloc[start : start + size].reset_index(drop=True)
        got = np.asarray(model(part), dtype=float)
        if got.shape != (len(part),):
            raise ValueError(f"the model gave {got.shape} answers for {len(part)} rows")
        out.append(got)
    return np.concatenate(out) if out else np.empty(0)


def scored(df: DataFrame, inputs: dict[str, Column], name: str, load: Callable[[], Callable] | None = None, default: Column | None = None, size: int = 32, out: str = "score") -> DataFrame:
    """df, all columns, with `out`: the model's answer about the inputs, whose names are the columns that the model gets.

    load() gives the model: a function of a pandas frame of at most `size` rows that returns as many numbers. It is called once a worker and name.
    Without load, `out` is `default`, or null. A row with a null input isn't shown to the model and gets `default` too.
    """
    fallback = (default if default is not None else F.lit(None)).cast("double")
    if load is None:
        return df.withColumn(out, fallback)
    names = list(inputs)

    @F.pandas_udf("double")
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = loaded(name, load)
        for rows in batches:
            known = rows.notna().all(axis=1).to_numpy()
            found = np.full(len(rows), np.nan)
            found[known] = in_batches(rows[known], model, size)
            yield pd.Series(found)

    row = F.struct(*[c.alias(n) for n, c in inputs.items()])
    known = F.lit(True)
    for n in names:
        known = known & F.col("_in")[n].isNotNull()
    return df.withColumn("_in", row).withColumn(out, F.when(known, F.nanvl(answer("_in"), F.lit(None)))).withColumn(out, F.coalesce(out, fallback)).drop("_in")
