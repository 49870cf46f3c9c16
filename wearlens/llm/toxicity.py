"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and their beginnings of 3 to 8 characters, and once more
those that make up at least 1 % of its words (and occur twice). A proportional-odds model ``P(grade > k) = sigmoid(w . x - threshold_k)`` shares its weights across ordered
thresholds; the expected severity is the sum of these probabilities.

Grades come from the labels: 0 where not toxic; toxic documents are split at the median density of
evidence (features more frequent in toxic documents) into 1 and 2.

The model is fitted on at most ``SAMPLE`` labelled documents, chosen by hash, copies counted once. Spark counts every
feature of these documents; of those in at least ``LEAST_DOCS`` of
them, those whose frequency differs between toxic and clean documents by ``LEAST_Z`` standard errors,
at most ``MOST_FEATURES``, enter the fit. Every document is
scored whole, in one pass without a shuffle.

Defined results. Null or empty text has no features. Without labelled documents of both kinds the
model is constant: severity 0 everywhere. Null labels are ignored; of repeated labels the most toxic
counts. Rows that repeat are scored each. Further columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from wearlens.llm import words as W
from wearlens.llm.store import id_blocks, keep, map_arrow, own, with_flags

SAMPLE = 20_000
LEAST_Z = 4.0
LEAST_DOCS = 5
MOST_FEATURES = 4096
BEGINNINGS = (3, 4, 5, 6, 7, 8)
GRADES = 3
RIDGE = 1e-5
REJECT = 0.5  # probability of being toxic at all from which a document is rejected


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    present: np.ndarray  # weight of a feature that occurs
    frequent: np.ndarray  # weight added where it is frequent
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """Probability that the grade exceeds 0, 1, ... by column."""
        odds = np.exp(np.clip(score[:, None] - self.thresholds[None, :], -500, 500))
        return np.where(np.isinf(self.thresholds), 0.0, odds / (1 + odds))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text and even hash of every feature occurrence; words of each text."""
    words = W.split(data, offsets, W.ALNUM)
    heads = np.flatnonzero((words.data & 0xC0) != 0x80)
    first = np.searchsorted(heads, words.start)
    heads = np.append(heads, np.full(max(BEGINNINGS), len(words.data)))
    texts = words.text()
    starts, ends, kinds, owners = [words.start], [words.end], [np.zeros(len(texts), dtype=np.uint64)], [texts]
    for n in BEGINNINGS:
        end = heads[first + n]
        fits = end <= words.end
        starts.append(words.start[fits])
        ends.append(end[fits])
        kinds.append(np.full(int(fits.sum()), n, dtype=np.uint64))
        owners.append(texts[fits])
    hashes = W.span_hashes(words.data, np.concatenate(starts), np.concatenate(ends))
    return np.concatenate(owners), W.mix(hashes + np.concatenate(kinds)) & ~np.uint64(1), words.counts


def _frequent(times: np.ndarray, of: np.ndarray) -> np.ndarray:
    return (times >= 2) & (100 * times >= of)


def _distinct_batch(b: pa.RecordBatch):
    """Distinct features of each text, odd where frequent."""
    for row, stop, data, offsets in W.text_chunks(b.column("text")):
        texts, hashes, sizes = features(data, offsets)
        order = np.lexsort((hashes, texts))
        texts, hashes = texts[order], hashes[order]
        fresh = np.ones(len(texts), dtype=bool)
        fresh[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
        times = np.diff(np.append(np.flatnonzero(fresh), len(texts)))
        texts, hashes = texts[fresh], hashes[fresh]
        often = np.flatnonzero(_frequent(times, sizes[texts]))
        texts, hashes = np.concatenate([texts, texts[often]]), np.concatenate([hashes, hashes[often] | np.uint64(1)])
        order = np.argsort(texts, kind="stable")
        ptr = np.searchsorted(texts[order], np.arange(stop - row + 1))
        yield pa.RecordBatch.from_arrays([b.column("toxic").slice(row, stop - row), W.lists(ptr, hashes[order].view(np.int64), pa.int64())], ["toxic", "features"])


def _screen(wanted: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 16, dtype=bool)
    out[(wanted >> np.uint64(48)).astype(np.int64)] = True
    return out


def fit(rows: np.ndarray, columns: np.ndarray, grade: np.ndarray, n_features: int, steps: int = 1200) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest likelihood, with a small ridge; accelerated gradient steps.

    ``rows`` and ``columns`` name the features present. The likelihood of grade k is
    sigmoid(t_k - s) - sigmoid(t_(k-1) - s) with ordered thresholds t and score s.
    """
    n, cuts = len(grade), int(GRADES - 1)
    share = np.array([(grade > k).mean() for k in range(cuts)]).clip(1e-6, 1 - 1e-6)
    z = np.concatenate([np.zeros(n_features), [-np.log(share[0] / (1 - share[0]))], np.zeros(cuts - 1)])

    def unpack(z):
        return z[:n_features], z[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(z[n_features + 1 :]))])

    def loss(z):
        w, t = unpack(z)
        s = np.bincount(rows, weights=w[columns], minlength=n)
        low = np.concatenate([[-np.inf], t])[grade]
        high = np.concatenate([t, [np.inf]])[grade]
        f = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
        a, b = np.where(np.isinf(low), 0.0, f(low - s)), np.where(np.isinf(high), 1.0, f(high - s))
        p = np.maximum(b - a, 1e-12)
        da, db = a * (1 - a), b * (1 - b)
        by_t = np.zeros(cuts)
        np.add.at(by_t, grade[grade < cuts], -(db / p)[grade < cuts])
        np.add.at(by_t, grade[grade > 0] - 1, (da / p)[grade > 0])
        by_s = (db - da) / p
        gw = np.bincount(columns, weights=by_s[rows], minlength=n_features) / n + RIDGE * w
        gaps = np.exp(z[n_features + 1 :])
        later = np.cumsum(by_t[::-1])[::-1] / n
        return -np.log(p).mean() + RIDGE / 2 * (w @ w), np.concatenate([gw, [later[0]], later[1:] * gaps])

    at, ahead, size, momentum = z, z, 1.0, 1.0
    for _ in range(steps):
        value, gradient = loss(ahead)
        while True:
            new = ahead - size * gradient
            if loss(new)[0] <= value - size / 2 * (gradient @ gradient) + 1e-15 or size < 1e-9:
                break
            size /= 2
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        if gradient @ (new - at) > 0:  # overshot: start the momentum anew
            following = 1.0
        ahead, at = new + (momentum - 1) / following * (new - at), new
        momentum, size = following, size * 1.5
    return unpack(at)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    spark = docs.sparkSession
    constant = Model(np.zeros(1, dtype=np.uint64), np.zeros(1), np.zeros(1), np.full(GRADES - 1, np.inf))
    known = own(labels, "doc_id", "toxic").filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    marks = id_blocks(chosen.select("doc_id", F.lit(True).alias("__known"), (F.col("toxic") > 0).alias("__toxic")), "__known", "__toxic")
    texts = with_flags(own(docs, "doc_id", "text"), marks, "__known", "__toxic").filter("__known").select("text", F.col("__toxic").alias("toxic"))
    schema = T.StructType([T.StructField("toxic", T.BooleanType()), T.StructField("features", T.ArrayType(T.LongType()))])
    rows = keep(map_arrow(texts, ["text", "toxic"], schema, _distinct_batch).dropDuplicates(["features"]), "labelled")
    total = rows.agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good")).first()
    bad, good = total["bad"], total["good"]
    if not bad or not good:
        return constant
    seen = rows.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    rate_a, rate_b = (F.col("a") + 0.5) / (bad + 1), (F.col("b") + 0.5) / (good + 1)
    rate = (F.col("a") + F.col("b") + 1) / (bad + good + 2)
    z = (rate_a - rate_b) / F.sqrt(rate * (1 - rate) * (1 / bad + 1 / good))
    top = seen.withColumn("z", z).filter((F.abs("z") >= LEAST_Z) & (F.col("a") + F.col("b") >= LEAST_DOCS)).orderBy(F.abs("z").desc(), "f").limit(MOST_FEATURES).select("f", "z").collect()
    if not top:
        return constant
    wanted = np.array([r["f"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(wanted)
    wanted, evidence = wanted[order], np.array([r["z"] > 0 for r in top])[order]
    lookup = spark.sparkContext.broadcast(wanted.view(np.int64))
    design = T.StructType([T.StructField("toxic", T.BooleanType()), T.StructField("size", T.IntegerType()), T.StructField("present", T.ArrayType(T.IntegerType()))])

    def batch(b: pa.RecordBatch):
        order = np.argsort(lookup.value)
        keys = lookup.value[order]
        lists = b.column("features")
        flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
        hit = keys[at] == flat
        owner = np.repeat(np.arange(len(sizes)), sizes)[hit]
        ptr = np.searchsorted(owner, np.arange(len(sizes) + 1))
        yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(sizes, pa.int32()), W.lists(ptr, order[at[hit]], pa.int32())], ["toxic", "size", "present"])

    # a row for each of at most ``sample`` documents, with its selected features alone
    made = map_arrow(rows, ["toxic", "features"], design, batch).toPandas()
    present = [np.asarray(p, dtype=np.int64) for p in made["present"]]
    toxic = made["toxic"].to_numpy(dtype=bool)
    density = np.array([evidence[p].sum() for p in present]) / np.maximum(made["size"].to_numpy(), 1)
    grade = np.where(toxic, 1 + (density >= np.median(density[toxic])), 0)
    weights, thresholds = fit(np.repeat(np.arange(len(present)), [len(p) for p in present]), np.concatenate(present), grade, len(wanted))
    odd = (wanted & np.uint64(1)).astype(bool)
    base, slot = np.unique(wanted & ~np.uint64(1), return_inverse=True)
    part = lambda some: np.bincount(slot[some], weights=weights[some], minlength=len(base))
    return Model(base, part(~odd), part(odd), thresholds)


def _scores(model: Model, screen: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    texts, hashes, sizes = features(data, offsets)
    maybe = np.flatnonzero(screen[(hashes >> np.uint64(48)).astype(np.int64)])
    texts, hashes = texts[maybe], hashes[maybe]
    at = np.minimum(np.searchsorted(model.features, hashes), len(model.features) - 1)
    hit = model.features[at] == hashes
    pairs, times = np.unique(texts[hit] * len(model.features) + at[hit], return_counts=True)
    texts, at = pairs // len(model.features), pairs % len(model.features)
    weight = model.present[at] + np.where(_frequent(times, sizes[texts]), model.frequent[at], 0.0)
    return model.above(np.bincount(texts, weights=weight, minlength=len(offsets) - 1))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, expected_severity, p_toxic, grade (the likeliest), kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("expected_severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()),
         T.StructField("grade", T.IntegerType()), T.StructField("kept", T.BooleanType())]
    )

    def batch(b: pa.RecordBatch):
        screen = _screen(shared.value.features)
        for row, stop, data, offsets in W.text_chunks(b.column("text")):
            above = _scores(shared.value, screen, data, offsets)
            each = -np.diff(np.column_stack([np.ones(len(above)), above, np.zeros(len(above))]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(row, stop - row), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(each.argmax(axis=1), pa.int32()), pa.array(above[:, 0] < REJECT)],
                schema.names,
            )

    return map_arrow(own(docs, "doc_id", "text"), ["doc_id", "text"], schema, batch)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the model, fitted on ``labels``, rejects."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    at = docs.columns.index("text")

    def batch(b: pa.RecordBatch):
        screen = _screen(shared.value.features)
        for row, stop, data, offsets in W.text_chunks(b.column(at)):
            kept = _scores(shared.value, screen, data, offsets)[:, 0] < REJECT
            yield b.slice(row, stop - row).filter(pa.array(kept))

    return map_arrow(docs, docs.columns, docs.schema, batch)
