"""The one definition of names, ranges and thresholds every operator shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

# --- fixed values: column names of the raw file and of the working table -----------------
RAW_TO_WORKING = {
    "UDI": "unit_id",
    "Product ID": "product_id",
    "Type": "type",
    "Air temperature [K]": "air_temperature_k",
    "Process temperature [K]": "process_temperature_k",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_min",
    "Machine failure": "machine_failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
    "RNF": "rnf",
}
RAW_SCHEMA = (
    "`UDI` INT, `Product ID` STRING, `Type` STRING, `Air temperature [K]` DOUBLE, "
    "`Process temperature [K]` DOUBLE, `Rotational speed [rpm]` INT, `Torque [Nm]` DOUBLE, "
    "`Tool wear [min]` INT, `Machine failure` INT, `TWF` INT, `HDF` INT, `PWF` INT, "
    "`OSF` INT, `RNF` INT"
)

# --- fixed values: closed plausible range of every sensor ---------------------------------
SENSOR_RANGES = {
    "air_temperature_k": (280.0, 320.0),
    "process_temperature_k": (285.0, 330.0),
    "rotational_speed_rpm": (0.0, 5000.0),
    "torque_nm": (0.0, 150.0),
    "tool_wear_min": (0.0, 400.0),
}
SENSORS = list(SENSOR_RANGES)
MACHINE_TYPES = ["L", "M", "H"]
PRODUCT_ID_PATTERN = r"^[LMH]\d{5}$"
TIMESTAMP_NAMES = ["timestamp", "reading_time", "recorded_at"]
LABEL = "machine_failure"
FAILURE_FLAGS = ["twf", "hdf", "pwf", "osf", "rnf"]
REQUIRED_READING = SENSORS + ["unit_id", "product_id", "type"]

# --- fixed values: operating points -------------------------------------------------------
DEFAULT_WINDOWS = (3, 5)
URGENT_AT = 0.60
SERVICE_AT = 0.27
RECALL_FLOOR = 0.50
FN_COST = 5.0
FP_COST = 1.0
COLUMN_DRIFT_AT = 0.1
DATASET_DRIFT_AT = 0.3
SEED = 42


@dataclass(frozen=True)
class Rule:
    """One contract check; ``holds`` is evaluated only where the column is not null."""

    column: str
    check: str
    holds: Column


def in_range(name: str, lo: float, hi: float) -> Column:
    return F.col(name).between(F.lit(lo), F.lit(hi))


def contract_types() -> dict[str, type[T.DataType] | tuple]:
    whole = (T.IntegerType, T.LongType)
    return {
        "unit_id": whole,
        "product_id": T.StringType,
        "type": T.StringType,
        "air_temperature_k": T.DoubleType,
        "process_temperature_k": T.DoubleType,
        "rotational_speed_rpm": whole,
        "torque_nm": T.DoubleType,
        "tool_wear_min": whole,
        **{c: whole for c in [LABEL, *FAILURE_FLAGS]},
    }


def contract_rules() -> list[Rule]:
    rules = [
        Rule("unit_id", "positive", F.col("unit_id") > 0),
        Rule("product_id", "matches_pattern", F.col("product_id").rlike(PRODUCT_ID_PATTERN)),
        Rule("type", "in_set", F.col("type").isin(MACHINE_TYPES)),
    ]
    rules += [Rule(c, "in_range", in_range(c, lo, hi)) for c, (lo, hi) in SENSOR_RANGES.items()]
    rules += [Rule(c, "in_set", F.col(c).isin(0, 1)) for c in [LABEL, *FAILURE_FLAGS]]
    return rules


def feature_names(sensors=SENSORS, windows=DEFAULT_WINDOWS) -> list[str]:
    """Rolling feature names in their fixed order: per sensor, per window mean and std, then roc."""
    return [
        name
        for c in sensors
        for name in [f"{c}_{s}_w{w}" for w in windows for s in ("rollmean", "rollstd")] + [f"{c}_roc"]
    ]


def require_columns(df, columns) -> None:
    """Raise with the missing names when ``df`` lacks any of ``columns``; runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
