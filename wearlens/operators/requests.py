"""Scoring requests: the contract at the door, and what passes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wearlens.contract import DEFAULT_WINDOWS, MACHINE_TYPES, SENSOR_RANGES
from wearlens.functions.readings import window_features

MAX_READINGS = 500

# fixed values: the error vocabulary clients already handle
MESSAGES = {
    "missing": "Field required",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "enum": "Input should be 'L', 'M' or 'H'",
    "string_type": "Input should be a valid string",
    "string_too_short": "String should have at least 1 character",
    "list_type": "Input should be a valid list",
    "model_type": "Input should be a valid dictionary",
    "datetime_parsing": "Input should be a valid datetime",
    "datetime_type": "Input should be a valid datetime",
    "json_invalid": "JSON decode error",
}


def _error(loc: Column, kind: str, msg: Column | None = None) -> Column:
    return F.struct(
        loc.alias("loc"), F.lit(kind).alias("type"), (F.lit(MESSAGES.get(kind)) if msg is None else msg).alias("msg")
    )


def _at(*parts) -> Column:
    return F.concat_ws(".", F.lit("body"), *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _bound(kind: str, limit: float) -> Column:
    words = kind.replace("_", " ")
    return F.lit(f"Input should be {words} to {limit:g}".replace("than equal", "than or equal"))


def _kind(value: Column) -> Column:
    """JSON type of a variant: STRING, OBJECT, ARRAY, VOID for null, NUMBER, BOOLEAN; null where absent."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(name)


def _number(value: Column) -> Column:
    """A number, or a text that is one."""
    return F.coalesce(F.try_variant_get(value, "$", "double"), F.try_variant_get(value, "$", "string").try_cast("double"))


def _reading_errors(reading: Column, i: Column) -> Column:
    """Errors of one reading, a variant; its map of fields tells an absent key from a null one."""

    def of(fields: Column) -> Column:
        errors = []
        for c, (lo, hi) in SENSOR_RANGES.items():
            loc = _at("telemetry_window", i, c)
            value = F.try_element_at(fields, F.lit(c))
            kind, x = _kind(value), _number(value)
            errors.append(
                F.when(~F.map_contains_key(fields, c), _error(loc, "missing"))
                .when(F.coalesce(kind, F.lit("VOID")).isin("VOID", "OBJECT", "ARRAY"), _error(loc, "float_type"))
                .when(x.isNull(), _error(loc, "float_parsing"))
                .when((x < lo) | F.isnan(x), _error(loc, "greater_than_equal", _bound("greater_than_equal", lo)))
                .when(x > hi, _error(loc, "less_than_equal", _bound("less_than_equal", hi)))
            )
        stamp, loc = F.try_element_at(fields, F.lit("recorded_at")), _at("telemetry_window", i, "recorded_at")
        text = F.try_variant_get(stamp, "$", "string")
        errors.append(
            F.when((_kind(stamp) == "STRING") & F.try_to_timestamp(text).isNull() & text.try_cast("double").isNull(), _error(loc, "datetime_parsing"))
            .when(_kind(stamp).isin("OBJECT", "ARRAY", "BOOLEAN"), _error(loc, "datetime_type"))
        )
        return F.filter(F.array(*errors), lambda e: e.isNotNull())

    fields = F.try_variant_get(reading, "$", "map<string,variant>")
    found = F.get(F.transform(F.array(fields), of), F.lit(0))
    return F.when(F.coalesce(_kind(reading), F.lit("VOID")) == "OBJECT", found).otherwise(F.array(_error(_at("telemetry_window", i), "model_type")))


def check_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Parse JSON requests and add ``errors``: every violation, empty for an acceptable request.

    Values are read as variants, so that a wrong JSON type is reported as such. Each
    step passes through an explode of one element: the optimizer cannot copy a parse or the check
    into the expressions and filters that use them.
    """
    once = lambda c: F.explode(F.array(c))
    parsed = df.withColumn("__top", once(F.from_json(body, "map<string,variant>")))
    field = {k: F.try_element_at("__top", F.lit(k)) for k in ("vehicle_id", "type", "telemetry_window")}
    text = lambda k: F.when(_kind(field[k]) == "STRING", F.try_variant_get(field[k], "$", "string"))
    parsed = parsed.withColumns({"vehicle_id": text("vehicle_id"), "type": text("type")})
    parsed = parsed.withColumn("__window", once(F.try_variant_get(field["telemetry_window"], "$", "array<variant>")))
    has = {k: F.map_contains_key("__top", k) for k in field}
    size = F.size("__window")
    top = [
        F.when(~has["vehicle_id"], _error(_at("vehicle_id"), "missing"))
        .when(F.col("vehicle_id").isNull(), _error(_at("vehicle_id"), "string_type"))
        .when(F.length("vehicle_id") < 1, _error(_at("vehicle_id"), "string_too_short")),
        F.when(~has["type"], _error(_at("type"), "missing")).when(
            ~F.coalesce(F.col("type").isin(MACHINE_TYPES), F.lit(False)), _error(_at("type"), "enum")
        ),
        F.when(~has["telemetry_window"], _error(_at("telemetry_window"), "missing"))
        .when(F.col("__window").isNull(), _error(_at("telemetry_window"), "list_type"))
        .when(
            size < 1,
            _error(
                _at("telemetry_window"), "too_short", F.lit("List should have at least 1 item after validation, not 0")
            ),
        )
        .when(
            size > MAX_READINGS,
            _error(
                _at("telemetry_window"),
                "too_long",
                F.concat(
                    F.lit(f"List should have at most {MAX_READINGS} items after validation, not "), size.cast("string")
                ),
            ),
        ),
    ]
    readable = F.when(size.between(1, MAX_READINGS), F.col("__window")).otherwise(F.array().cast("array<variant>"))
    nested = F.flatten(F.transform(readable, lambda r, i: _reading_errors(r, i.cast("string"))))
    errors = F.when(
        F.col("__top").isNull(), F.array(_error(F.lit("body"), "json_invalid"))
    ).otherwise(F.concat(F.filter(F.array(*top), lambda e: e.isNotNull()), nested))
    return parsed.withColumn("errors", once(errors)).drop("__top")


def rejected(checked: DataFrame) -> DataFrame:
    keep = [c for c in checked.columns if c not in ("__window", "vehicle_id", "type")]
    return checked.filter(F.size("errors") > 0).select(*keep)


def rejection_errors(checked: DataFrame, keep: list[str]) -> DataFrame:
    """One row per violation: ``keep..., loc, error_type, msg``."""
    each = checked.select(*keep, F.explode("errors").alias("e"))
    return each.select(
        *keep, F.col("e.loc").alias("loc"), F.col("e.type").alias("error_type"), F.col("e.msg").alias("msg")
    )


def accepted(checked: DataFrame) -> DataFrame:
    """Requests without errors, their window typed: ``telemetry_window array<struct<sensors>>``."""
    typed = F.transform(
        "__window",
        lambda r: F.struct(*[_number(F.try_variant_get(r, f"$.{c}", "variant")).alias(c) for c in SENSOR_RANGES]),
    )
    return (
        checked.filter(F.size("errors") == 0)
        .withColumn("telemetry_window", typed)
        .drop("__window", "errors", "body")
    )


def request_features(requests: DataFrame, windows=DEFAULT_WINDOWS) -> DataFrame:
    """The last reading's full feature row of each accepted request."""
    used = requests.withColumn("readings_used", F.size("telemetry_window"))
    return window_features(used, "telemetry_window", windows=windows).drop("telemetry_window")
