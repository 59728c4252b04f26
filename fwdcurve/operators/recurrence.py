"""Recurrences that no window function expresses: each day's correction depends on corrected days before."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shares of the last two errors and their clamp; share, days and least number of the errors whose mean is
# taken off; bounds of a price.
LAST_SHARES, CLAMP = (0.6, 0.15), 100.0
BIAS_SHARE, BIAS_DAYS, BIAS_LEAST = 0.7, 14, 3
LOWEST, HIGHEST = -500.0, 1000.0


def corrected(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """rows (forecast, actual) with corrected and error (corrected - actual).

    Shares of the errors of the day before and of two days before come off the forecast, and of the mean of the last
    errors; errors are those after correction. A day without an actual has no error: it leaves a gap in the
    last two and adds nothing to the mean. A day without a forecast stays null. One group is one forecast series, as long
    as a backtest has days; groups run in parallel."""

    def walk(pdf):
        pdf = pdf.sort_values(order)
        errors: list[float] = []
        last: list[float | None] = [None, None]
        fixed, found = [], []
        for forecast, actual in zip(pdf["forecast"], pdf["actual"], strict=True):
            value = error = None
            if forecast == forecast and forecast is not None:
                value = forecast - sum(s * min(max(e, -CLAMP), CLAMP) for s, e in zip(LAST_SHARES, last, strict=True) if e is not None)
                if len(errors) >= BIAS_LEAST:
                    recent = errors[-BIAS_DAYS:]
                    value -= BIAS_SHARE * sum(recent) / len(recent)
                value = min(max(value, LOWEST), HIGHEST)
                if actual == actual and actual is not None:
                    error = value - actual
                    errors.append(error)
            last = [error, last[0]]
            fixed.append(value)
            found.append(error)
        return pdf.assign(corrected=pd.Series(fixed, pdf.index, float), error=pd.Series(found, pdf.index, float))

    schema = rows.withColumns({"corrected": F.lit(None).cast("double"), "error": F.lit(None).cast("double")}).schema
    return rows.groupBy(*keys).applyInPandas(walk, schema)
