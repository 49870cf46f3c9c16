"""Rolling features on a stream, equal to the batch features for rows that arrive in order."""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wearlens.contract import DEFAULT_WINDOWS, SENSORS, feature_names, require_columns
from wearlens.operators.ordered import ROWS_PER_SLICE
from wearlens.operators.rolling import STREAM_KEY, STREAM_ORDER, rolling_features
from wearlens.operators.training import with_actions
from wearlens.streaming.run import write_batch


class RollingSink:
    """foreachBatch target for streams with few, hot keys.

    Each micro-batch runs the batch operator over its rows and the last few rows of every key, so a
    hot key is sliced over tasks as in batch. Those last rows are the whole state. They alternate
    between two folders by batch number: a batch that runs again reads the folder it did before.
    Rows at or before the last emitted reading of their key go to ``late`` instead. With ``score``
    every reading is also scored and given its action. Of a reading's own columns the features keep
    ``columns`` beside them, all by default.
    """

    def __init__(
        self, folder: str, keys=STREAM_KEY, order=STREAM_ORDER, sensors=SENSORS, windows=DEFAULT_WINDOWS,
        rows_per_slice: int = ROWS_PER_SLICE, history: DataFrame | None = None, score=None, version: str = "1",
        columns: list[str] | None = None,
    ):
        self.folder, self.keys, self.order = folder, list(keys), list(order)
        self.sensors, self.windows, self.rows_per_slice = list(sensors), tuple(windows), rows_per_slice
        self.features, self.late = os.path.join(folder, "features"), os.path.join(folder, "late")
        self.history = history  # readings before the stream began, for a seeded start
        self.score, self.version = score, version  # adds ``score`` to a feature frame
        self.columns = columns

    def _tail(self, df: DataFrame) -> DataFrame:
        """The rows the next batch can still reach, at least one per key to know what was emitted."""
        newest = Window.partitionBy(*self.keys).orderBy(*[F.desc(c) for c in self.order])
        columns = [*self.keys, *self.order, *[c for c in self.sensors if c not in self.order]]
        keep = max(max(self.windows) - 1, 1)
        return (
            df.select(*columns).withColumn("__r", F.row_number().over(newest)).filter(F.col("__r") <= keep).drop("__r")
        )

    def _state(self, batch: DataFrame, batch_id: int) -> DataFrame:
        if batch_id == 0:
            source = batch.limit(0) if self.history is None else self.history
            return self._tail(source)
        schema = self._tail(batch).schema
        slot = os.path.join(self.folder, f"state-{(batch_id - 1) % 2}")
        return batch.sparkSession.read.schema(schema).parquet(slot)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        require_columns(batch, [*self.keys, *self.order, *self.sensors])
        state = self._state(batch, batch_id)
        at = F.struct(*self.order)
        emitted = state.groupBy(*[F.col(k).alias(f"__k_{k}") for k in self.keys]).agg(F.max(at).alias("__last"))
        same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in self.keys]
        known = batch.join(emitted, same, "left").withColumn("__late", F.coalesce(at <= F.col("__last"), F.lit(False)))
        known = known.drop("__last", *[f"__k_{k}" for k in self.keys]).persist()  # read and joined once for all that follows
        write_batch(known.filter("__late").drop("__late"), self.late, batch_id)
        fresh = known.filter(~F.col("__late")).drop("__late")
        both = fresh.withColumn("__old", F.lit(False)).unionByName(
            state.withColumn("__old", F.lit(True)), allowMissingColumns=True
        )
        out = rolling_features(
            both, self.keys, self.order, self.sensors, self.windows, rows_per_slice=self.rows_per_slice
        )
        out = out.filter(~F.col("__old")).drop("__old")
        if self.score is not None:
            # few slices hold many rows, and a row's score costs more than its features: deal rows to all cores
            spread = 4 * batch.sparkSession.sparkContext.defaultParallelism
            out = with_actions(self.score(out.repartition(spread, *self.order)), self.version)
        unwanted = [] if self.columns is None else [c for c in batch.columns if c not in self.columns]
        write_batch(out.drop(*unwanted), self.features, batch_id)
        self._tail(both).write.mode("overwrite").parquet(os.path.join(self.folder, f"state-{batch_id % 2}"))
        known.unpersist()

    def read(self, spark: SparkSession, what: str = "features") -> DataFrame:
        return spark.read.parquet(os.path.join(self.folder, what)).drop("batch")


#: rows whose features are held in memory together
ROWS_AT_ONCE = 20_000
#: parts that the keys of a keyed stream are dealt to by hash; it stays what it was when the stream began
KEY_PARTS = 1024


def frame_features(
    values: np.ndarray, before: np.ndarray, sensors: list[str], windows: tuple[int, ...]
) -> dict[str, np.ndarray]:
    """Features of rows of which ``before`` earlier ones of their key stand right above; two-pass deviation."""
    reach = max(max(windows), 2) - 1
    padded = np.vstack([np.full((reach, values.shape[1]), np.nan), values])
    out = {}
    for j, c in enumerate(sensors):
        x = padded[:, j]
        for w in windows:
            frames = np.lib.stride_tricks.sliding_window_view(x, w)[reach - w + 1:]
            own = np.arange(w - 1, -1, -1)[None, :] <= before[:, None]
            valid = own & ~np.isnan(frames)
            n = np.sum(valid, axis=1)
            mean = np.sum(np.where(valid, frames, 0.0), axis=1) / n
            squares = np.sum(np.where(valid, (frames - mean[:, None]) ** 2, 0.0), axis=1)
            out[f"{c}_rollmean_w{w}"] = mean
            out[f"{c}_rollstd_w{w}"] = np.sqrt(squares / np.maximum(n - 1, 1))
        previous = np.where(before > 0, x[reach - 1: -1], np.nan)
        out[f"{c}_roc"] = np.where(np.isnan(previous), 0.0, x[reach:] - previous)
    return out


class RollingProcessor(StatefulProcessor):
    """Keeps the last readings of every key of one part in list state; one output row per reading, late ones marked.

    A call's fixed cost, some ten milliseconds, is paid per part instead of per key: all keys of a part are
    sorted and framed together. A key silent for ``idle_ms`` loses its state. Features are made for
    ``ROWS_AT_ONCE`` rows at a time.
    """

    def __init__(self, order: list[str], sensors: list[str], windows: tuple[int, ...], keep: list[str], idle_ms: int | None = None, key_types=()):
        self.order, self.sensors, self.windows, self.keep, self.idle_ms = order, sensors, windows, keep, idle_ms
        self.keys, self.key_types = [c for c in keep if c not in order], list(key_types)  # of ``keep``, what is not order tells keys apart

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField(f"k{i}", t) for i, t in enumerate(self.key_types)] + [T.StructField("seen", T.LongType())]
        fields += [T.StructField(f"o{i}", T.LongType()) for i in range(len(self.order))]
        fields += [T.StructField(c, T.DoubleType()) for c in self.sensors]
        self.past = handle.getListState("past", T.StructType(fields), self.idle_ms)

    def _known(self, batch: pd.DataFrame, clock: int) -> pd.DataFrame:
        """State that has not expired, then the new rows; ``__k`` numbers the keys."""
        state = pd.DataFrame(list(map(tuple, self.past.get())), columns=[*self.keys, "__seen", *self.order, *self.sensors])
        if self.idle_ms is not None:
            state = state[state["__seen"] > clock - self.idle_ms]
        both = batch.assign(__seen=clock, __old=False)
        if len(state):
            both = pd.concat([state.assign(__old=True), both], ignore_index=True)
        both["__k"] = both.groupby(self.keys, dropna=False, sort=False).ngroup() if self.keys else 0
        return both

    def _late(self, both: pd.DataFrame) -> np.ndarray:
        """New rows at or before the newest reading that their key has emitted."""
        code, old = both["__k"].to_numpy(), both["__old"].to_numpy(dtype=bool)
        newest = both[old].sort_values(self.order).groupby("__k").tail(1)
        known = np.zeros(len(both), dtype=bool)  # by key
        known[newest["__k"].to_numpy()] = True
        same, late = ~old & known[code], np.zeros(len(both), dtype=bool)
        for c in self.order:
            last = np.zeros(len(both), dtype=np.int64)
            last[newest["__k"].to_numpy()] = newest[c].to_numpy(dtype=np.int64)
            mine = both[c].to_numpy(dtype=np.int64)
            late |= same & (mine < last[code])
            same &= mine == last[code]
        return late | same

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock = 0 if self.idle_ms is None else int(timerValues.getCurrentProcessingTimeInMs())
        both = self._known(pd.concat(list(rows), ignore_index=True)[[*self.keep, *self.sensors]], clock)
        late = self._late(both)
        fresh = both[~late].sort_values(["__k", *self.order], kind="stable", ignore_index=True)
        seat, new = fresh.groupby("__k").cumcount().to_numpy(), ~fresh["__old"].to_numpy(dtype=bool)
        values, reach = fresh[self.sensors].to_numpy(dtype=float), max(max(self.windows), 2) - 1
        for at in range(0, len(fresh), ROWS_AT_ONCE):
            lead = max(at - reach, 0)  # rows above, for the windows only
            part, wanted = slice(lead, at + ROWS_AT_ONCE), new[lead: at + ROWS_AT_ONCE].copy()
            wanted[: at - lead] = False
            if wanted.any():
                made = frame_features(values[part], seat[part], self.sensors, self.windows)
                out = fresh[self.keep].iloc[part][wanted].reset_index(drop=True)
                yield out.assign(**{n: v[wanted] for n, v in made.items()}, late=False)
        if new.any():
            fresh["__seen"] = fresh.groupby("__k")["__seen"].transform("max")
            tail = fresh[fresh.groupby("__k").cumcount(ascending=False) < reach].astype(object)
            for c in self.keys:
                tail[c] = tail[c].where(tail[c].notna(), None)
            self.past.put(list(tail[[*self.keys, "__seen", *self.order, *self.sensors]].itertuples(index=False, name=None)))
        if late.any():
            out = both.loc[late, self.keep].reset_index(drop=True)
            yield out.assign(**{n: np.nan for n in feature_names(self.sensors, self.windows)}, late=True)

    def close(self) -> None:
        pass


def keyed_rolling(
    stream: DataFrame, key: str, order: list[str], sensors=SENSORS, windows=DEFAULT_WINDOWS, idle_ms: int | None = None,
    parts: int = KEY_PARTS,
) -> DataFrame:
    """Stateful features for many small keys. ``order`` names integer columns, the last one unique.

    Keys are dealt to ``parts`` parts by hash, and a part's rows of one micro-batch are sorted in memory, so bound
    the micro-batch at the source; few hot keys belong to ``RollingSink``. With ``idle_ms`` the state of a key
    leaves the store when no reading has come for that long and its part is next read, or all of its part is
    silent; its next reading starts anew. Such a stream has to run at an interval: timed state asks for another
    batch for ever. Needs the RocksDB state store.
    """
    # executors need not have this package installed: its classes travel with the query
    cloudpickle.register_pickle_by_value(sys.modules[__package__.split(".")[0]])
    keep = [key, *order]
    schema = T.StructType(
        [stream.schema[c] for c in keep]
        + [T.StructField(n, T.DoubleType()) for n in feature_names(sensors, windows)]
        + [T.StructField("late", T.BooleanType())]
    )
    narrow = stream.select(*keep, *[F.col(c).cast("double").alias(c) for c in sensors])
    part = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    dealt = narrow.withColumn("__part", part)
    return dealt.groupBy("__part").transformWithStateInPandas(
        statefulProcessor=RollingProcessor(list(order), list(sensors), tuple(windows), keep, idle_ms, [stream.schema[key].dataType]),
        outputStructType=schema,
        outputMode="append",
        timeMode="none" if idle_ms is None else "processingTime",
    )
