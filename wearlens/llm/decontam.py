"""Benchmark decontamination by winnowing.

Both sides keep the minimum k-gram hash of every window of consecutive k-grams (the rightmost on a
tie). A window of 13 words holds six 8-grams, so two texts that share 13 consecutive words select
the same 8-gram of them: no shared span of that length is missed. Equal fingerprints are joined and
each hit is extended word by word to both sides, as far as a shared window could reach; only runs
that hold a whole window count, compared as words, not as hashes.

An item of fewer than 13 words is one window; documents are winnowed once more for each such length.

Before the join a bitmap of the benchmark's fingerprints, of fixed size whatever the benchmark's,
drops document fingerprints that no item can have. The join itself is left to Spark's own choice.

Defined results. Null or empty text: no words, nothing hit. Rows that repeat a doc_id are judged
each by its own text. A null item_id still hits but is not listed. An empty benchmark hits nothing.
Columns beyond doc_id and text (item_id and text) are not read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wearlens.llm import words as W
from wearlens.llm.store import id_blocks, keep, let, map_arrow, own, set_aside, with_flags

WINDOW = 13  # words that an item's window has
GRAM = 8  # words per fingerprint
FILTER_BITS = 1 << 26  # bits of the bitmap every executor gets: 8 MB

_HIT = T.StructType(
    [
        T.StructField("length", T.IntegerType()),
        T.StructField("fingerprint", T.LongType()),
        T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("gram", T.StringType()),
        T.StructField("before", T.ArrayType(T.StringType())),
        T.StructField("after", T.ArrayType(T.StringType())),
    ]
)


def winnow(hashes: np.ndarray, last: np.ndarray, length: int, k: int) -> np.ndarray:
    """Positions of the selected k-grams for windows of ``length`` words inside one text each."""
    at = np.flatnonzero(np.arange(len(hashes)) + length <= last)
    best, chosen = hashes[at], at
    for j in range(1, length - k + 1):
        other = hashes[at + j]
        lower = other <= best
        best = np.where(lower, other, best)
        chosen = np.where(lower, at + j, chosen)
    return np.unique(chosen)


def _fingerprints(words: W.Words, lengths) -> tuple:
    """Yields length, k, selected positions, and their fingerprints."""
    hashes, last = words.hashes(), words.last()
    made = {}
    for length in lengths:
        k = min(GRAM, length)
        if k not in made:
            made[k] = W.grams(hashes, last, k)[0]
        at = winnow(made[k], last, length, k)
        yield length, k, at, W.mix(made[k][at] + np.uint64(length))


def _place(found: dict, words: W.Words, lo: int, hi: int, p: int, length: int, k: int, h: int) -> None:
    """Add word p to the places in ``found`` of its gram with what surrounds it, as far as a window that holds it can reach."""
    left, right = words.strings(max(lo, p - (length - k)), p), words.strings(p + k, min(hi, p + length))
    found.setdefault((length, h, " ".join(words.strings(p, p + k)), tuple(left[::-1]), tuple(right)), []).append(p - lo)


def _hits(found: dict) -> list[dict]:
    return [{"length": length, "fingerprint": h, "at": at, "gram": gram, "before": left, "after": right} for (length, h, gram, left, right), at in found.items()]


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _item_batches(window: int):
    arrow = pa.list_(_arrow_hit())

    def batch(b: pa.RecordBatch):
        for row, stop, data, offsets in W.text_chunks(b.column("text")):
            words = W.split(data, offsets, W.ALNUM)
            texts = words.text()
            found = [{} for _ in range(stop - row)]
            counts = words.counts
            for length in np.unique(np.minimum(counts[counts > 0], window)).tolist():
                fits = counts == length if length < window else counts >= window
                for size, k, at, prints in _fingerprints(words, [length]):
                    for p, h in zip(at.tolist(), _signed(prints).tolist()):
                        i = int(texts[p])
                        if fits[i]:
                            _place(found[i], words, int(words.ptr[i]), int(words.ptr[i + 1]), p, size, k, h)
            yield pa.RecordBatch.from_arrays([b.column("item_id").slice(row, stop - row), pa.array(map(_hits, found), arrow)], ["item_id", "hits"])

    return batch


def _doc_batches(lengths: list[int], bits):
    arrow = pa.list_(_arrow_hit())

    def batch(b: pa.RecordBatch):
        table = bits.value
        mask = np.uint64(len(table) * 8 - 1)
        for row, stop, data, offsets in W.text_chunks(b.column("text")):
            words = W.split(data, offsets, W.ALNUM)
            found = [None] * (stop - row)
            for length, k, at, prints in _fingerprints(words, lengths):
                slot = prints & mask
                hit = np.flatnonzero(table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                texts = np.searchsorted(words.ptr, at[hit], side="right") - 1
                for p, h, i in zip(at[hit].tolist(), _signed(prints[hit]).tolist(), texts.tolist()):
                    found[i] = found[i] or {}
                    _place(found[i], words, int(words.ptr[i]), int(words.ptr[i + 1]), p, length, k, h)
            digest = [int.from_bytes(blake2b(data[a:z], digest_size=8).digest(), "little", signed=True) for a, z in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(row, stop - row), pa.array(digest, pa.int64()), pa.array(words.counts, pa.int64()), pa.array([f and _hits(f) for f in found], arrow)],
                ["doc_id", "digest", "n_words", "hits"],
            )

    return batch


def _arrow_hit() -> pa.DataType:
    text = pa.list_(pa.string())
    return pa.struct([("length", pa.int32()), ("fingerprint", pa.int64()), ("at", pa.list_(pa.int32())), ("gram", pa.string()), ("before", text), ("after", text)])


def _run(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays of words."""
    return let(
        F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)),
        lambda same: F.when(F.array_contains(same, False), F.array_position(same, F.lit(False)) - 1).otherwise(F.size(same)),
    ).cast("int")


def covered(ranges: Column) -> Column:
    """Words inside any of the sorted (start, end) ranges."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        ranges,
        zero,
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(r["start"], s["upto"]))).cast("long").alias("n"),
            F.greatest(s["upto"], r["end"]).cast("long").alias("upto"),
        ),
        lambda s: s["n"],
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (start and end words), items, contaminated."""
    spark = docs.sparkSession
    ids = docs.schema["doc_id"].dataType
    item = T.StructType([benchmark.schema["item_id"], T.StructField("hits", T.ArrayType(_HIT))])
    # equal grams in equal surroundings are one context, whatever the items and places they stand in
    found = map_arrow(own(benchmark, "item_id", "text"), ["item_id", "text"], item, _item_batches(window)).select("item_id", F.explode("hits").alias("h")).select("item_id", "h.*")
    context = F.sha2(F.to_json(F.struct("length", "gram", "before", "after")), 256).alias("context")
    items = keep(found.select("item_id", context, "length", "fingerprint", "gram", "before", "after"), "items")
    contexts = items.drop("item_id").dropDuplicates(["context"])
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most ``window`` rows
    place = contexts.select((F.col("fingerprint").bitwiseAND(F.lit(FILTER_BITS - 1))).alias("place"))
    filled = place.groupBy(F.shiftright("place", 3).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(place & 7 as int))")).alias("bits")).toPandas()
    table = np.zeros(FILTER_BITS // 8, dtype=np.uint8)  # at most as many rows as it has bytes
    table[filled["byte"].to_numpy(dtype=np.int64)] = filled["bits"].to_numpy(dtype=np.uint8)
    shared = spark.sparkContext.broadcast(table)
    passed = T.StructType(
        [T.StructField("doc_id", ids), T.StructField("digest", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(_HIT))]
    )
    scanned = keep(map_arrow(own(docs, "doc_id", "text"), ["doc_id", "text"], passed, _doc_batches(lengths, shared)), "scanned")

    left = scanned.filter(F.col("hits").isNotNull()).select("doc_id", "digest", F.explode("hits").alias("d"))
    right = contexts.select("context", "length", "fingerprint", F.struct("gram", "before", "after").alias("i"))
    same = (F.col("d.length") == right["length"]) & (F.col("d.fingerprint") == right["fingerprint"])
    document = ["doc_id", "digest"]
    k = F.least(F.lit(GRAM), F.col("d.length"))
    runs = (
        left.join(right, same)
        .filter(F.col("d.gram") == F.col("i.gram"))
        .select(*document, "context", "d.at", F.col("d.length").alias("length"), _run(F.col("d.before"), F.col("i.before")).alias("back"), (k + _run(F.col("d.after"), F.col("i.after"))).alias("on"))
    )
    met = keep(runs.filter(F.col("back") + F.col("on") >= F.col("length")).drop("length"), "met")
    # expanded to places only now: a context of n places meets one of m places once, not n * m times
    places = met.select(*document, "at", "back", "on").distinct().select(*document, F.explode("at").alias("p"), "back", "on")
    spans = places.groupBy(*document).agg(F.array_sort(F.collect_set(F.struct((F.col("p") - F.col("back")).alias("start"), (F.col("p") + F.col("on")).alias("end")))).alias("spans"))
    members = items.select("context", F.col("item_id").cast("string").alias("item")).distinct()
    named = met.select(*document, "context").distinct().join(members, "context").groupBy(*document).agg(F.array_sort(F.collect_set("item")).alias("items"))
    there = named.toDF("__id", "__digest", "items")
    both = spans.join(there, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    hits = both.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "spans", "items", covered(F.col("spans")).alias("n_hit"))
    mine = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        scanned.drop("hits")
        .join(hits, mine, "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"), "spans",
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; a row without doc_id is judged as one of its own."""
    return set_aside(docs, lambda plain: _drop_contaminated(plain, benchmark), "doc_id", "text")


def _drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    nameless = docs.filter("doc_id is null")
    if not nameless.isEmpty():
        kind = docs.schema["doc_id"].dataType
        numbered = keep(nameless.withColumn("doc_id", F.monotonically_increasing_id()), "nameless")
        left = _drop_contaminated(numbered, benchmark).withColumn("doc_id", F.lit(None).cast(kind))
        return _drop_contaminated(docs.filter("doc_id is not null"), benchmark).unionByName(left)
    found = find_contamination(docs, benchmark).filter("contaminated and doc_id is not null")
    flag = "__contaminated"
    bad = id_blocks(found.select("doc_id", F.lit(True).alias(flag)), flag)
    return with_flags(docs, bad, flag).filter(~F.col(flag)).drop(flag)
