"""Substring dedup by sliding sentence spans.

A text is cut into sentences (after . ! or ? before white space, and at line ends). From every
sentence a run of consecutive sentences is hashed: at least two, and on until it has 10 words; a
sentence of 25 words is a run by itself. Equal runs anywhere in the corpus are joined by hash; in all
but the first (by doc_id, then place) the sentences covered are removed.

So of a repeated passage all whole sentences go but for a tail of fewer than 10 words.

The global step aggregates each hash to its count and first place, combined before the shuffle, and
joins only hashes that repeat back to the runs, so a run found in a third of all documents costs one
row per task and a join that Spark may split.

Defined results. Null text stays null, an empty one empty. Rows without doc_id stay as they are and
are first for nobody. Rows that repeat a doc_id with the same text count as one. Sentences without
words belong to the one before. Further columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from wearlens.llm import words as W
from wearlens.llm.store import id_blocks, keep, map_arrow, own, set_aside, with_flags

SENTENCES = 2
WORDS = 10
ALONE = 25


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, W.Words]:
    """Byte starts of the sentences with words, first word of each, first sentence of each text, and the words.

    A sentence reaches to the next one's start; what stands before the first belongs to no sentence.
    """
    words = W.split(data, offsets, W.ALNUM)
    n = len(data)
    blank = ~W.SPACED[data]
    ends = np.zeros(n + 1, dtype=np.int64)
    stop = np.isin(data, np.frombuffer(b".!?", dtype=np.uint8))
    broken = data == 10
    broken[: n - 1] |= stop[: n - 1] & blank[1:]
    np.cumsum(broken, out=ends[1:])  # sentence ends before each byte
    # a word opens a sentence if it is its text's first, or a sentence ended since the word before
    opens = np.ones(len(words.start), dtype=bool)
    opens[1:] = ends[words.start[1:]] != ends[words.end[:-1]]
    opens[words.ptr[:-1][words.counts > 0]] = True
    first = np.flatnonzero(opens)
    return words.start[first], np.append(first, len(words.start)), np.searchsorted(first, words.ptr), words


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and end sentence and hash of every run, plus ``sentences``' starts and text bounds."""
    starts, word, bounds, words = sentences(data, offsets)
    n = len(starts)
    at = np.arange(n)
    size = np.diff(word)
    end = np.maximum(at + SENTENCES, np.searchsorted(word, word[:-1] + WORDS))
    end = np.where(size >= ALONE, at + 1, end)
    fits = end <= np.repeat(bounds[1:], np.diff(bounds))
    at, end = at[fits], end[fits]
    return at, end, W.sequence_hashes(words.hashes(), word[at], word[end]), starts, bounds


_RUN = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("at", T.IntegerType())]))


def _run_batch(b: pa.RecordBatch):
    for row, stop, data, offsets in W.text_chunks(b.column("text")):
        at, _, hashes, _, bounds = runs(data, offsets)
        ptr = np.searchsorted(at, bounds)
        inside = at - bounds[np.searchsorted(bounds, at, side="right") - 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column("doc_id").slice(row, stop - row).to_numpy(zero_copy_only=False), np.diff(ptr)), b.column("doc_id").type), pa.array(hashes.view(np.int64)), pa.array(inside, pa.int32())],
            ["doc_id", "h", "at"],
        )


def _cut_batch(names: list[str]):
    """Texts without the sentences of the runs listed in the column ``__gone`` (hash and first sentence)."""

    def batch(b: pa.RecordBatch):
        column, gone = b.column(names.index("text")), b.column(names.index("__gone"))
        for row, stop, data, offsets in W.text_chunks(column):
            at, end, hashes, starts, bounds = runs(data, offsets)
            hashes = hashes.view(np.int64)
            n = len(starts)
            out, counts, removed = [], np.diff(bounds), np.zeros(stop - row, dtype=np.int64)
            where = np.append(starts, 0)
            for i in range(stop - row):
                lo, hi = int(bounds[i]), int(bounds[i + 1])
                cover = np.zeros(hi - lo, dtype=bool)
                for r in gone[row + i].as_py() or []:
                    k = int(np.searchsorted(at, lo + r["at"]))
                    if k < len(at) and at[k] == lo + r["at"] < hi and hashes[k] == r["h"]:
                        cover[at[k] - lo : end[k] - lo] = True
                a, z = int(offsets[i]), int(offsets[i + 1])
                if cover.any():
                    edge = np.concatenate([where[lo:hi] if n else [], [z]]).astype(np.int64)
                    kept = [data[a : edge[0]].tobytes()] + [data[edge[j] : edge[j + 1]].tobytes() for j in np.flatnonzero(~cover)]
                    out.append(b"".join(kept).decode("utf-8"))
                    removed[i] = cover.sum()
                else:
                    out.append(column[row + i].as_py())
            rest = [c.slice(row, stop - row) for name, c in zip(names, b.columns) if name not in ("text", "__gone")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.string()), pa.array(counts, pa.int64()), pa.array(removed)], [n for n in names if n not in ("text", "__gone")] + ["text", "n_sentences", "n_removed"])

    return batch


def drop_repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the text cleaned, and n_sentences and n_removed (replaced if there were such columns)."""
    docs = docs.drop("n_sentences", "n_removed")
    return set_aside(docs, _drop_repeated_spans, "doc_id", "text")


def _drop_repeated_spans(docs: DataFrame) -> DataFrame:
    ids = docs.schema["doc_id"]
    plain = own(docs, "doc_id", "text").filter("doc_id is not null")
    schema = T.StructType([ids, T.StructField("h", T.LongType()), T.StructField("at", T.IntegerType())])
    found = keep(map_arrow(plain, ["doc_id", "text"], schema, _run_batch), "runs")
    repeated = found.groupBy("h").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max(F.struct("doc_id", "at")).alias("last"))
    repeated = keep(repeated.filter("first < last").select("h", "first"), "repeated-runs")
    later = found.join(repeated, "h").filter(F.struct("doc_id", "at") != F.col("first"))
    gone = later.groupBy("doc_id").agg(F.collect_set(F.struct("h", "at")).alias("__gone"))  # as long as the text's own runs
    gone = keep(gone, "gone")
    # only documents that lose something meet their lists in a shuffle
    flagged = with_flags(docs, id_blocks(gone.select("doc_id", F.lit(True).alias("__touched")), "__touched"), "__touched")
    none = F.lit(None).cast(_RUN)
    listed = flagged.filter("__touched").join(gone, "doc_id").select(*docs.columns, "__gone")
    whole = flagged.filter("not __touched").select(*docs.columns, none.alias("__gone"))
    names = [*docs.columns, "__gone"]
    fields = [f for f in docs.schema.fields if f.name != "text"]
    made = T.StructType([*fields, docs.schema["text"], T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())])
    cut = lambda df: map_arrow(df, names, made, _cut_batch(names))
    return cut(whole).unionByName(cut(listed)).select(*docs.columns, "n_sentences", "n_removed")
