"""Near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

1. Every text becomes the set of its distinct 4-word shingles (64-bit hashes). Equal sets collapse
   into one class, named by its smallest doc_id; only that member goes on.
2. 128 MinHash samples give 32 bands of 4. The same samples are folded into an *odd sketch*: each
   sample flips one of 512 bits, so that equal samples cancel in the XOR of two sketches and its
   population count tells how many samples differ.
3. In each band bucket every member is paired with the smallest one. A pair whose odd sketches
   differ in more bits than similarity 0.8 can plausibly cause is dropped; the rest are confirmed on
   their full sets. Pairs are linear in the bucket's size.
4. Confirmed links give components. Buckets whose members are still in several components are
   compared exhaustively between components, block by block inside tasks: first by odd sketch, then,
   among members with close sketches, on full sets. Only links that join two groups leave a task,
   never all pairs.

What can be lost: a pair at exactly 0.8 shares no band with probability (1 - 0.8**4)**32 < 5e-8, and
fails the sketch test, which lies six standard deviations out, with less than 1e-8.

Defined results. Null or empty text: no shingles, linked with nothing. Rows that repeat a doc_id are
one node whatever their texts. A row without doc_id belongs to the component of its exact copies,
if there are any, and is no node itself; else its component is null and it is kept.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wearlens.llm import words as W
from wearlens.llm.store import forget, id_blocks, keep, map_arrow, own, set_aside, ship, with_flags

SHINGLE = 4
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
BITS = 512
BLOCK_MEMBERS = 512  # members of a bucket that one task compares with as many others
_SEEDS = W.mix(np.arange(1, 3 * SAMPLES + 1, dtype=np.uint64) * W.BASE)


def most_bits(similarity: float) -> int:
    """Bits in which two odd sketches differ at most at this similarity: the mean and six deviations."""
    differing = 2 * SAMPLES * (1 - similarity)
    stay = (1 - 2 / BITS) ** differing
    mean = BITS / 2 * (1 - stay)
    by_sketch = BITS / 4 * (1 - stay * stay) * (1 - stay)
    by_samples = (stay * 2) ** 2 * SAMPLES * similarity * (1 - similarity)
    return math.ceil(mean + 6 * math.sqrt(by_sketch + by_samples))


def shingle_sets(words: W.Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and sorted distinct shingle hashes of each text."""
    hashes, last, counts = words.hashes(), words.last(), words.counts
    values, valid = W.grams(hashes, last, size)
    for n in range(1, size):
        first = words.ptr[:-1][counts == n]
        if len(first):
            values[first] = W.grams(hashes, last, n)[0][first]
            valid[first] = True
    texts = words.text()[valid]
    values = values[valid]
    ptr = np.searchsorted(texts, np.arange(len(counts) + 1))
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        values[a:b].sort()
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    return np.searchsorted(texts[fresh], np.arange(len(counts) + 1)), values[fresh]


def minhashes(ptr: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Samples by row, one column per non-empty set."""
    start = ptr[:-1][np.diff(ptr) > 0]
    out = np.empty((SAMPLES, len(start)), dtype=np.uint64)
    work = np.empty_like(values)
    for i in range(SAMPLES if len(start) else 0):
        np.bitwise_xor(values, _SEEDS[i], out=work)
        np.multiply(work, _SEEDS[SAMPLES + i] | np.uint64(1), out=work)
        out[i] = np.minimum.reduceat(work, start)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    out = np.empty((samples.shape[1], BANDS), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(samples.shape[1], b + 1, dtype=np.uint64)
        for r in range(ROWS):
            h = W.mix(h * W.BASE + samples[b * ROWS + r])
        out[:, b] = h
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """One row of BITS / 64 words per set."""
    n = samples.shape[1]
    slot = (W.mix(samples ^ _SEEDS[2 * SAMPLES :, None]) % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount((slot + np.arange(n) * BITS).ravel(), minlength=n * BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, BITS), axis=1, bitorder="little").view(np.uint64)


def _sketch_batch(b: pa.RecordBatch):
    for row, stop, data, offsets in W.text_chunks(b.column("text")):
        ptr, values = shingle_sets(W.split(data, offsets, W.SPACED))
        sizes = np.diff(ptr)
        full = sizes > 0
        samples = minhashes(ptr, values)
        digest = [blake2b(values[a:z].tobytes(), digest_size=16).digest() if z > a else None for a, z in zip(ptr[:-1], ptr[1:])]
        at = np.concatenate([[0], np.cumsum(full)])
        yield pa.RecordBatch.from_arrays(
            [
                b.column("doc_id").slice(row, stop - row),
                pa.array(sizes, pa.int64()),
                pa.array(digest, pa.binary()),
                W.lists(at * BANDS, band_keys(samples).ravel().view(np.int64), pa.int64()),
                W.lists(at * (BITS // 64), odd_sketches(samples).ravel().view(np.int64), pa.int64()),
            ],
            ["doc_id", "n_shingles", "digest", "bands", "sketch"],
        )


def _set_batch(b: pa.RecordBatch):
    for row, stop, data, offsets in W.text_chunks(b.column("text")):
        ptr, values = shingle_sets(W.split(data, offsets, W.SPACED))
        yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(row, stop - row), W.lists(ptr, values.view(np.int64), pa.int64())], ["doc_id", "shingles"])


_LONGS = T.ArrayType(T.LongType())


def sketched(docs: DataFrame) -> DataFrame:
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()),
         T.StructField("bands", _LONGS), T.StructField("sketch", _LONGS)]
    )
    return map_arrow(own(docs, "doc_id", "text"), ["doc_id", "text"], schema, _sketch_batch)


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Shingle sets of the documents whose ids are given."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("shingles", _LONGS)])
    wanted = with_flags(own(docs, "doc_id", "text"), id_blocks(ids.select("doc_id", F.lit(True).alias("wanted")), "wanted"), "wanted")
    return map_arrow(wanted.filter("wanted"), ["doc_id", "text"], schema, _set_batch)


def _differing(a: Column, b: Column) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITS // 64)), F.lit(0))


def _close(common: Column, a: Column, b: Column) -> Column:
    return 100 * common >= 80 * (a + b - common)


def confirmed(pairs: DataFrame, sketches: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets have similarity 0.8 or more."""
    side = sketches.select("doc_id", "n_shingles", "sketch")
    a = side.toDF("a", "size_a", "sketch_a")
    b = side.toDF("b", "size_b", "sketch_b")
    likely = (
        pairs.join(a, "a")
        .join(b, "b")
        .filter(100 * F.least("size_a", "size_b") >= 80 * F.greatest("size_a", "size_b"))
        .filter(_differing(F.col("sketch_a"), F.col("sketch_b")) <= most_bits(0.8))
        .select("a", "b")
        .distinct()
    )
    likely = keep(likely, "likely")
    sets = full_sets(docs, likely.select(F.explode(F.array("a", "b")).alias("doc_id")))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (
        likely.join(sets.toDF("a", "set_a"), "a")
        .join(sets.toDF("b", "set_b"), "b")
        .filter(_close(common, F.size("set_a"), F.size("set_b")))
        .select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) with the smallest node reachable, for every node of an edge (a, b).

    Large-star and small-star steps in turn until no edge changes: a logarithmic number of rounds,
    each a minimum per node with map-side combining and a join. Each round is a table.
    """

    def both(e):
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e, larger: bool):
        around = both(e) if larger else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = around.join(least, "a")
        if larger:
            moved = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return moved.filter("a != b").distinct()

    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = keep(edges.select("a", "b").filter("a != b").distinct(), "edges")
    before = state(current)
    while True:
        following = keep(star(star(current, True), False), "edges")
        now = state(following)
        forget(current)
        current = following
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _blocks(members: DataFrame) -> DataFrame:
    """Members (key, node, component) of mixed groups, dealt to tasks (key, i, j) of two bounded blocks.

    Members of a group's largest component need no comparison with one another. The others, the
    strays, are cut into blocks by hash; each stray block meets each block of the rest once.
    """
    size = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = size.groupBy("key").agg(F.max(F.struct(F.col("n"), (-F.col("component")).alias("c"))).alias("top"), F.sum("n").alias("all"))
    blocks = lambda n: F.ceil(n / BLOCK_MEMBERS).cast("int")
    main = main.select("key", (-F.col("top.c")).alias("main"), blocks(F.col("top.n")).alias("main_blocks"), blocks(F.col("all") - F.col("top.n")).alias("stray_blocks"))
    placed = members.join(keep(main, "groups"), "key")
    stray = F.col("component") != F.col("main")
    block = F.pmod(F.xxhash64("node"), F.when(stray, F.col("stray_blocks")).otherwise(F.col("main_blocks"))).cast("int")
    placed = placed.withColumn("block", block)
    task = lambda i, j, left: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(left).alias("left"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    # j counts the stray blocks first, then those of the main component
    as_left = F.transform(every(F.col("stray_blocks") + F.col("main_blocks")), lambda j: task(F.col("block"), j, True))
    as_left = F.filter(as_left, lambda t: t["j"] >= t["i"])
    as_right = F.transform(F.sequence(F.lit(0), F.col("block")), lambda i: task(i, F.col("block"), False))
    of_main = F.transform(every(F.col("stray_blocks")), lambda i: task(i, F.col("stray_blocks") + F.col("block"), False))
    tasks = F.when(stray, F.concat(as_left, as_right)).otherwise(of_main)
    return placed.select("key", "node", "component", F.explode(tasks).alias("t")).select("key", "node", "component", "t.i", "t.j", "t.left")


def _sides(table: pa.Table):
    left = np.array(table.column("left").to_pylist(), dtype=bool)
    node = np.array(table.column("node").to_pylist(), dtype=object)
    component = np.array(table.column("component").to_pylist(), dtype=object)
    sketch = table.column("sketch").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(left), -1)
    return np.flatnonzero(left), np.flatnonzero(~left), node, component, sketch


def _likely(a, others, component, sketch, limit):
    """Rows of ``others`` in another component than row ``a`` whose sketches are close enough, closest first."""
    differ = np.bitwise_count(sketch[others] ^ sketch[a]).sum(axis=1, dtype=np.int64)
    fit = np.flatnonzero((differ <= limit) & (component[others] != component[a]))
    return others[fit[np.argsort(differ[fit], kind="stable")]]


def _pairs(table: pa.Table, links: list) -> pa.Table:
    kind = table.schema.field("node").type
    return pa.table({"a": pa.array([x for x, _ in links], kind), "b": pa.array([x for _, x in links], kind)})


def _suspects(limit):
    """Enough pairs with close sketches to connect all members that have one: fewer than members."""

    def run(table: pa.Table) -> pa.Table:
        left, right, node, component, sketch = _sides(table)
        label = np.arange(len(node))
        links = []
        for a in left.tolist():
            found = _likely(a, right, component, sketch, limit)
            found = found[label[found] != label[a]]
            if len(found):
                for group, at in zip(*np.unique(label[found], return_index=True)):
                    links.append((node[a], node[found[at]]))
                    label[label == group] = label[a]
        return _pairs(table, links)

    return run


def _joining(limit):
    def run(table: pa.Table) -> pa.Table:
        left, right, node, component, sketch = _sides(table)
        sets = table.column("shingles").combine_chunks()
        label = component.copy()
        links = []
        for a in left.tolist():
            mine = sets[a].values.to_numpy()
            for b in _likely(a, right, component, sketch, limit).tolist():
                if label[a] == label[b]:
                    continue
                other = sets[b].values.to_numpy()
                common = len(np.intersect1d(mine, other, assume_unique=True))
                if 100 * common >= 80 * (len(mine) + len(other) - common):
                    links.append((node[a], node[b]))
                    label[label == label[b]] = label[a]
        return _pairs(table, links)

    return run


def remaining_links(members: DataFrame, labels: DataFrame, sketches: DataFrame, docs: DataFrame) -> DataFrame | None:
    """Links between different components among ``members`` (band, node, component) of a bucket.

    First the odd sketches say who may be linked across components, and these members are grouped
    into clusters. Then each cluster, not each of up to 32 buckets, gets its members' full sets once.
    """
    limit = most_bits(0.8)
    kind = docs.schema["doc_id"].dataType
    pair = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    side = sketches.select(F.col("doc_id").alias("node"), "sketch").dropDuplicates(["node"])
    ship()
    tasks = _blocks(members.select(F.col("band").alias("key"), "node", "component").distinct()).join(side, "node")
    suspects = keep(tasks.groupBy("key", "i", "j").applyInArrow(_suspects(limit), pair).distinct(), "suspects")
    if suspects.isEmpty():
        return None
    clusters = components(suspects).withColumnRenamed("component", "key").join(labels, "node", "left")
    clusters = keep(clusters.select("key", "node", F.coalesce("component", "node").alias("component")), "clusters")
    sets = full_sets(docs, clusters.select(F.col("node").alias("doc_id"))).toDF("node", "shingles").dropDuplicates(["node"])
    tasks = _blocks(clusters).join(side, "node").join(sets, "node")
    return tasks.groupBy("key", "i", "j").applyInArrow(_joining(limit), pair).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sketches = keep(sketched(docs), "sketches")
    known = sketches.filter("n_shingles > 0")
    twins = keep(known.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "twins")
    classed = sketches.select("doc_id", "n_shingles", "digest").join(twins, "digest", "left")
    classed = keep(classed.select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id")), "classed")
    by_id = classed.filter("doc_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
    copies = by_id.filter("high < doc_id").select("doc_id", F.lit(True).alias("copy"))
    several = by_id.filter("low < high").select("doc_id", "low")
    same_id = classed.join(several, "doc_id").select(F.col("low").alias("a"), F.col("class_id").alias("b"))

    nodes = with_flags(known.filter("doc_id is not null"), id_blocks(copies, "copy"), "copy").filter("not copy")
    nodes = keep(nodes.select("doc_id", "n_shingles", "bands", "sketch"), "nodes")
    rows = nodes.select(F.explode("bands").alias("band"), F.col("doc_id").alias("node"))
    pivots = rows.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("top"), F.count(F.lit(1)).alias("n"))
    pivots = keep(pivots.filter("pivot < top").select("band", "pivot", "n"), "pivots")
    members = keep(rows.join(pivots, "band"), "members")
    stars = members.filter("node != pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = keep(confirmed(stars, nodes, docs).union(same_id), "links")
    labels = keep(components(links), "labels")

    labelled = members.filter("n > 2").join(labels, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    mixed = keep(labelled.join(keep(mixed.select("band"), "mixed"), "band"), "mixed-members")
    more = None if mixed.isEmpty() else remaining_links(mixed, labels, nodes, docs)
    if more is not None:
        labels = keep(components(links.union(keep(more, "more-links"))), "labels")
    of_class = labels.select(F.col("node").alias("class_id"), "component")
    found = classed.join(of_class, "class_id", "left")
    component = F.coalesce("component", "class_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component; of rows that repeat a kept doc_id one stays.

    A row without doc_id goes if a row with one has the same words, and stays otherwise.
    """
    return set_aside(docs, _drop_near_duplicates, "doc_id", "text")


def _drop_near_duplicates(docs: DataFrame) -> DataFrame:
    nameless = docs.filter("doc_id is null")
    if not nameless.isEmpty():
        lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        same = F.md5(F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " ")).cast("binary"))
        worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        named = docs.filter("doc_id is not null")
        known = named.filter(worded).select(same.alias("__same")).distinct()
        left = nameless.withColumn("__same", F.when(worded, same)).join(known, "__same", "left_anti").drop("__same")
        return _drop_near_duplicates(named).unionByName(left)
    found = keep(near_duplicates(docs), "verdicts")
    dropped = found.filter("doc_id is not null").groupBy("doc_id").agg(F.bool_and(~F.col("kept")).alias("__copy"), (F.count(F.lit(1)) > 1).alias("__again"))
    flags = id_blocks(dropped.filter("__copy or __again"), "__copy", "__again")
    left = with_flags(docs, flags, "__copy", "__again").filter("not __copy")
    if found.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").isEmpty():
        return left.drop("__copy", "__again")
    once = left.filter("__again").dropDuplicates(["doc_id"])
    return left.filter("not __again").unionByName(once).drop("__copy", "__again")
