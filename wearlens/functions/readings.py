"""Rolling features of the last reading of an array, without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wearlens.contract import DEFAULT_WINDOWS, SENSORS, feature_names


def window_features(df: DataFrame, readings: str, sensors=SENSORS, windows=DEFAULT_WINDOWS) -> DataFrame:
    """Add the last reading's sensors and rolling features from ``readings``, an array of structs.

    The array is the whole history, oldest first: the same as replaying it through an empty buffer.
    """
    n = F.size(readings)
    out = df.withColumns({f"__v_{c}": F.transform(readings, (lambda c: lambda r: r[c].cast("double"))(c)) for c in sensors})
    out = out.withColumns(
        {
            f"__w_{c}_{w}": F.slice(f"__v_{c}", F.greatest(n - w + 1, F.lit(1)), w)
            for c in sensors
            for w in windows
        }
    )
    out = out.withColumns(
        {
            f"{c}_rollmean_w{w}": F.aggregate(f"__w_{c}_{w}", F.lit(0.0), lambda a, x: a + x) / F.size(f"__w_{c}_{w}")
            for c in sensors
            for w in windows
        }
    )

    def spread(c, w):
        mean, part = F.col(f"{c}_rollmean_w{w}"), F.col(f"__w_{c}_{w}")
        squares = F.aggregate(part, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
        return F.when(F.size(part) < 2, 0.0).otherwise(F.sqrt(squares / F.nullif(F.size(part) - 1, F.lit(0))))

    out = out.withColumns({f"{c}_rollstd_w{w}": spread(c, w) for c in sensors for w in windows})
    last = {c: F.get(f"__v_{c}", n - 1) for c in sensors}
    out = out.withColumns(
        {
            **{f"{c}_roc": last[c] - F.when(n > 1, F.get(f"__v_{c}", n - 2)).otherwise(last[c]) for c in sensors},
            **last,
        }
    )
    keep = [c for c in df.columns if c not in sensors]
    return out.select(*keep, *sensors, *feature_names(sensors, windows))
