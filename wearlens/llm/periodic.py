"""Periodic run detection by a sparse diagonal dynamic program over the words of a text.

Diagonal p compares every word i with the word at i - p, its earlier occurrence at lag p. As long as
they are the same, the lag is active and its match length grows; when they differ, the diagonal ends,
and if its length suffices, the run is emitted at once. A run of period p has ``TIMES`` * p words or
more, so its diagonal has (``TIMES`` - 1) * p matches in a row.

Sparse: an earlier occurrence counts only where i is a multiple of the lag, and the match length then
grows by whole lags, told by hashes of both stretches. A sufficient diagonal has such an anchor from
which 2 p + 1 words match; the words of an anchor's diagonal are then compared one by one, so hashes
decide no result. There are n ln n anchors in n words instead of n * n / 2 pairs, whatever the words.
Lags are taken in blocks that double, all words and lags of a block at once; an anchor within a run of
a smaller lag is skipped, for two periods p > q cannot share p + q words unless q divides p.

Words are told apart by their bytes, not by hashes. Texts are handled ``words.CHUNK_BYTES`` at a
time, a longer one alone; all work is inside Spark's tasks, without a shuffle.

Defined results. Null text is null, with no words, no runs and a null ``collapsed``; text without
words has an empty one. Rows that repeat are judged each. Columns named ``n_words``, ``runs`` or
``collapsed`` are replaced; others stay, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from wearlens.llm import words as W
from wearlens.llm.store import map_arrow

TIMES = 4  # periods in a run at least
LEAST = 6  # words in a run at least
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
MADE = ("n_words", "runs", "collapsed")


def identities(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number per word, the same for words of the same bytes."""
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    letters = data[np.cumsum(inside[:-1]).astype(bool)]
    at = np.concatenate([[0], np.cumsum(end - start)])
    column = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _anchors(hashes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Lags from low to high - 1 and multiples i of them with words i to i + 2 * lag the same as a lag before."""
    n = len(hashes)
    up, down = W._powers.upto(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    lags = np.arange(low, high)
    times = np.maximum((n - 1) // lags - 2, 0)  # anchors of each lag: lag, 2 * lag, ...
    out_lag, out_at = [], []
    for some in np.array_split(np.arange(len(lags)), max(1, int(times.sum()) >> 20)):
        lag = np.repeat(lags[some], times[some])
        before = np.repeat(np.cumsum(times[some]) - times[some], times[some])
        at = (np.arange(len(lag)) - before + 1) * lag
        same = hashes[at] == hashes[at - lag]
        lag, at = lag[same], at[same]
        same = hashes[at + 2 * lag] == hashes[at + lag]
        lag, at = lag[same], at[same]
        size = 2 * lag + 1
        same = (sums[at + size] - sums[at]) * down[at] == (sums[at - lag + size] - sums[at - lag]) * down[at - lag]
        out_lag.append(lag[same])
        out_at.append(at[same])
    return np.concatenate(out_lag), np.concatenate(out_at)


def find_runs(ids: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of every run in ``ids``, by start and period.

    No run is longer than ``longest``. Different texts must be set apart by numbers that occur once.
    """
    n = len(ids)
    found = np.zeros((0, 3), dtype=np.int64)
    hashes = W.mix((ids + 1).astype(np.uint64))
    low = 1
    while TIMES * low <= longest:
        high = min(2 * low, longest // TIMES + 1)
        lag, at = _anchors(hashes, low, high)
        if len(found) and len(lag):  # within a run of a smaller lag?
            by_start = found[np.argsort(found[:, 0], kind="stable")]
            reach = np.maximum.accumulate(by_start[:, 0] + by_start[:, 1])
            place = np.searchsorted(by_start[:, 0], at - lag, side="right") - 1
            free = (place < 0) | (reach[np.maximum(place, 0)] <= at + 2 * lag)
            lag, at = lag[free], at[free]
        order = np.lexsort((at, lag))
        lag, at = lag[order], at[order]
        edge = np.flatnonzero(np.concatenate([[True], (np.diff(lag) != 0) | (np.diff(at) != lag[1:])])) if len(lag) else []
        new = []
        for a, z in zip(edge, [*edge[1:], len(lag)]):
            p = int(lag[a])
            lo, hi = max(p, int(at[a]) - p + 1), min(n, int(at[z - 1]) + 3 * p)
            match = np.zeros(hi - lo + 2, dtype=np.int8)
            match[1:-1] = ids[lo:hi] == ids[lo - p : hi - p]
            turns = np.flatnonzero(np.diff(match))
            for s, e in zip(turns[::2].tolist(), turns[1::2].tolist()):
                if e - s >= max(LEAST - p, (TIMES - 1) * p):
                    new.append((lo + s - p, e - s + p, p))
        if new:
            found = np.concatenate([found, np.array(sorted(set(new)), dtype=np.int64)])
        low = high
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Words that some run contains after its first ``period`` words."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def _batch(b: pa.RecordBatch):
    column = b.column(0)
    null = np.asarray(column.is_null())
    for row, stop, data, offsets in W.text_chunks(column):
        words = W.split(data, offsets, W.SPACED)
        counts, n, rows = words.counts, len(words.start), stop - row
        ids = identities(data, words.start, words.end)
        # a number of its own before each text's words
        place = np.arange(n) + words.text() + 1
        spaced = np.empty(n + rows, dtype=np.int64)
        spaced[words.ptr[:-1] + np.arange(rows)] = n + np.arange(rows)
        spaced[place] = ids
        runs = find_runs(spaced, int(counts.max()) if rows else 0)
        text = np.searchsorted(words.ptr[:-1] + np.arange(rows), runs[:, 0], side="right") - 1
        runs[:, 0] -= text + 1
        kept = np.flatnonzero(~_dropped(n, runs))
        size = words.end[kept] - words.start[kept] + 1  # each word with a blank
        ends = np.concatenate([[0], np.cumsum(size)])
        letters = np.repeat(words.start[kept] - ends[:-1], size) + np.arange(ends[-1])
        out = np.append(data, np.uint8(32))[np.minimum(letters, len(data))] if len(kept) else np.zeros(0, dtype=np.uint8)
        out[ends[1:] - 1] = 32
        bounds = ends[np.searchsorted(kept, words.ptr)]
        whole = out.tobytes()
        collapsed = [None if null[row + i] else whole[a : max(a, z - 1)].decode("utf-8") for i, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()))]
        runs[:, 0] -= words.ptr[text]
        listed = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], RUN.names)
        listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(rows + 1)).astype(np.int32)), listed)
        rest = [c.slice(row, rows) for c in b.columns[1:]]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(counts.astype(np.int64)), listed, pa.array(collapsed, pa.string())], [*b.schema.names[1:], *MADE])


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; in words) and the text collapsed to one period a run."""
    docs = docs.drop(*MADE)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return map_arrow(docs, ["text", *docs.columns], schema, _batch)
