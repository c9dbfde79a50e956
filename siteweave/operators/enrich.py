"""Enrich rows by a text function, such as a call to a text model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describer() -> Callable[[str], str]:
    """Stand-in for a text model: says how long a text is.

    A function made inside a function travels to the Python workers whole, so these
    need not have this package installed.
    """

    def describe(text: str) -> str:
        return f"{len(text)} characters, {len(text.split())} words"

    return describe


def enrich(
    df: DataFrame,
    in_col: str,
    out_col: str,
    fn: Callable[[str], str] | None = None,
    on_error: str = "value",
) -> DataFrame:
    """Add `fn` (by default `describer`) of a text column; null text gives null.

    The result is lazy; `keep` it before several results are made from it, so that
    a function that answers differently each time is asked once. Where `fn` fails, `value` stores the message as the value and `skip` drops the
    row. Only the text goes to the Python workers, in Arrow batches.
    """
    if on_error not in ("value", "skip"):
        raise ValueError(f"unknown error policy: {on_error}")
    tell = fn or describer()

    def call(text):
        if text is None:
            return None, None
        try:
            return tell(text).strip(), None
        except Exception as error:  # any failure of the supplied function is data here
            return None, f"Error: {error}"

    @F.pandas_udf("value string, error string")
    def outcome(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([call(t) for t in texts], columns=["value", "error"], dtype=object)

    # Marked so that the plan calls the function once per row, not once per use.
    done = df.withColumn("_outcome", outcome.asNondeterministic()(F.col(in_col)))
    if on_error == "skip":
        done = done.filter(F.col("_outcome.error").isNull())
    return done.withColumn(out_col, F.coalesce("_outcome.value", "_outcome.error")).drop("_outcome")
