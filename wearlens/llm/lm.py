"""Cross-entropy difference of a target and a background n-gram model.

Both are bigram models over all words and word pairs of the corpus, each by its 64-bit hash, so that
the models grow with the corpus. The background counts all documents, the target those marked by a
column; each is smoothed alike, a pair by its second word and a word by the uniform distribution over
the corpus' distinct words and one unseen. A document's score is the mean over its words of the
target's loss minus the background's: the lower, the more the text is like the target. Its own
counts are taken out of both models first (leave-one-out), so that target documents have no advantage.

Documents are dealt into chunks of about ``CHUNK_BYTES`` as they lie. A chunk cuts its distinct words
and pairs, in the order of their hashes, into ranges of the hash space, and sends one packed row per
range: the hashes as differences, the counts as small integers. A task per range adds up what the
chunks have and answers each with a packed row: which of its entries other chunks have too, and their
sums, in the chunk's own order, so hashes don't travel back. So a word costs a few bytes per chunk
however frequent it is, and no key has rows of its own. Three numbers go through the driver: distinct
words and the words of either model; and one before, the bytes of text, which sets the ranges.

Defined results. Null or empty text has no words and null scores. A null mark is false. With no
target document the target model is uniform. Rows that repeat are counted and scored each. Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from wearlens.llm import words as W
from wearlens.llm.store import _arrow, keep, own, ship

STRENGTH = 5.0  # counts that the smoothing distribution weighs
CHUNK_BYTES = 1 << 24
ROW_BYTES = 64  # what a row counts besides its text
START = 0  # stands for the word before a text's first
RANGE_BYTES = 1 << 23  # text whose words and pairs a range holds, about
PACKED = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("range", T.IntegerType()), *[T.StructField(n, T.BinaryType()) for n in ("words", "pairs")]])
SUMS = T.StructType([*PACKED.fields, *[T.StructField(n, T.LongType()) for n in ("distinct", "target", "background")]])


def chunked(docs: DataFrame, target: str) -> DataFrame:
    """doc_id, text, marked, and chunk: neighbouring rows share one."""
    marked = F.coalesce(F.col(target), F.lit(False)).alias("marked")
    rows = own(docs, *dict.fromkeys(("doc_id", "text", target))).select("doc_id", "text", marked)
    schema = T.StructType([*rows.schema.fields, T.StructField("chunk", T.LongType())])
    names = schema.names

    def run(batches):
        first, before = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            size = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES
            upto = before + np.cumsum(size)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first + (upto - size) // CHUNK_BYTES)], names)
            before = int(upto[-1]) if len(upto) else before

    ship()
    return rows.mapInArrow(run, schema)


class Occurrences:
    """The words of a chunk's texts in order; ``runs`` holds rows and words of texts handled together."""

    def __init__(self):
        self.runs, self.rows, self.n = [], 0, 0
        self.word, self.pair, self.mark, self.firsts, self.first_marks = [], [], [], [], []

    def add(self, texts: pa.Array, marked: np.ndarray) -> None:
        for row, stop, data, offsets in W.text_chunks(texts):
            words = W.split(data, offsets, W.ALNUM)
            h, full = words.hashes(), words.counts > 0
            first = words.ptr[:-1][full]
            before = np.empty_like(h)
            before[1:] = h[:-1]
            before[first] = START
            self.word.append(h)
            self.pair.append(W.mix(before * W.BASE + h))
            self.mark.append(marked[row:stop][words.text()])
            self.firsts.append(first + self.n)
            self.first_marks.append(marked[row:stop][full])
            self.runs.append((self.n, self.n + len(h), words.text(), words.counts, marked[row:stop]))
            self.n += len(h)
        self.rows += len(texts)

    def tally(self, pairs: bool) -> tuple[np.ndarray, ...]:
        """Distinct pairs, or words and START; their counts in marked texts and in all; each occurrence's place."""
        keys, marks = (self.pair, self.mark) if pairs else (self.word, self.mark + self.first_marks)
        keys = [*keys] if pairs else [*keys, *[np.full(len(f), START, dtype=np.uint64) for f in self.firsts]]
        if not keys:
            return np.zeros(0, dtype=np.uint64), np.zeros((2, 0)), np.zeros(0, dtype=np.int64)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = len(distinct)
        return distinct, np.stack([np.bincount(at[np.concatenate(marks)], minlength=n), np.bincount(at, minlength=n)]), at


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as bytes: all lowest bytes first, then the next, so that small numbers take little room."""
    n = len(arrays[0])
    planes = b"".join(np.ascontiguousarray(a.astype(np.uint64).view(np.uint8).reshape(n, 8).T).tobytes() for a in arrays)
    return n.to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, arrays: int) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=8 * n * arrays, codec="zstd", asbytes=True), dtype=np.uint8)
    return [np.ascontiguousarray(planes[8 * n * k : 8 * n * (k + 1)].reshape(8, n).T).view(np.uint64).ravel() for k in range(arrays)]


def bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the equal ranges of the hash space starts among sorted keys, and the end."""
    starts = np.array([(k << 64) // ranges for k in range(ranges)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, starts, side="left"), len(keys))


def counted(chunks: DataFrame, ranges: int) -> DataFrame:
    """Rows ``PACKED``: the words and pairs of each chunk in each range, with their counts in marked texts and in all."""

    def rows(chunk: int, held: Occurrences) -> Iterator[pa.RecordBatch]:
        kinds = [held.tally(pairs)[:2] for pairs in (False, True)]
        edges = [bounds(keys, ranges) for keys, _ in kinds]
        out = []
        for r in range(ranges):
            cells = []
            for (keys, counts), edge in zip(kinds, edges):
                some = slice(edge[r], edge[r + 1])
                gaps = keys[some].copy()
                gaps[1:] -= keys[some][:-1]
                cells.append(pack(gaps, *counts[:, some]))
            out.append((chunk, r, *cells))
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], PACKED.names)

    def run(batches):
        chunk, held = None, Occurrences()
        for b in batches:
            chunks, marked = b.column("chunk").to_numpy(), b.column("marked").to_numpy(zero_copy_only=False).astype(bool)
            edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1), len(chunks)]
            for a, z in zip(edges, edges[1:]):
                if a == z:
                    continue
                if chunk != chunks[a]:
                    if chunk is not None:
                        yield from rows(chunk, held)
                    chunk, held = chunks[a], Occurrences()
                held.add(b.column("text").slice(a, z - a), marked[a:z])
        if chunk is not None:
            yield from rows(chunk, held)

    ship()
    return chunks.select("chunk", "text", "marked").mapInArrow(run, PACKED)


def _answers(cells: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Per chunk which of its keys others have and these keys' sums; all distinct keys and their sums."""
    parts = [unpack(c, 3) for c in cells]
    size = [len(p[0]) for p in parts]
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    counts = np.stack([np.concatenate([p[k] for p in parts]) for k in (1, 2)])
    order = np.argsort(keys, kind="stable")
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[order][1:] != keys[order][:-1]
    at = np.flatnonzero(first)
    sums = np.add.reduceat(counts[:, order], at, axis=1) if len(at) else counts
    group = np.empty(len(keys), dtype=np.int64)
    group[order] = np.cumsum(first) - 1
    shared = np.diff(np.append(at, len(keys))) > 1
    out = []
    for a, z in zip(np.cumsum([0, *size[:-1]]), np.cumsum(size)):
        mine = group[a:z]
        known = shared[mine]
        mark, rest = pack(known), pack(*sums[:, mine[known]])
        out.append(len(mark).to_bytes(8, "little") + mark + rest)
    return out, keys[order][at], sums


def _with_sums(counts: np.ndarray, edges: np.ndarray, found: list[tuple[int, bytes]]) -> np.ndarray:
    """A chunk's ``counts`` in the order of its keys, replaced by the sums of all chunks where these came."""
    for r, data in found:
        size = 8 + int.from_bytes(data[:8], "little")
        known = np.flatnonzero(unpack(data[8:size], 1)[0]) + edges[r]
        counts[:, known] = np.stack(unpack(data[size:], 2))
    return counts


def summed(packed: DataFrame) -> DataFrame:
    """Rows ``SUMS``: the answer to each packed row, and per range a row without chunk with its distinct words and totals."""

    def of_range(t: pa.Table) -> pa.Table:
        words, keys, sums = _answers(t["words"].to_pylist())
        pairs, _, _ = _answers(t["pairs"].to_pylist())
        seen = keys != START
        totals = [int(seen.sum()), *[int(x) for x in sums[:, seen].sum(axis=1)]]
        n = len(t)
        columns = [t["chunk"].to_pylist() + [None], t["range"].to_pylist() + [None], words + [None], pairs + [None], *[[None] * n + [x] for x in totals]]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 3))], names=SUMS.names)

    ship()
    return packed.groupBy("range").applyInArrow(lambda t: of_range(t), SUMS)


def losses(of_word, of_previous, of_pair, total: int, vocabulary: int) -> np.ndarray:
    """Negative log probability of each word by one model's counts, which may lack a text's own."""
    of_word, of_previous, of_pair = (np.maximum(x, 0) for x in (of_word, of_previous, of_pair))
    single = (of_word + 1) / (total + vocabulary)
    return -np.log((np.minimum(of_pair, of_previous) + STRENGTH * single) / (of_previous + STRENGTH))


def _own(texts: np.ndarray, place: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """How often each occurrence's text has its word or pair; ``at`` looks others up in the same counts."""
    keys, inverse, times = np.unique((texts << 32) + place, return_inverse=True, return_counts=True)
    if at is None:
        return times[inverse]
    wanted = (texts << 32) + at
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, times[place], 0) if len(keys) else np.zeros(0, dtype=np.int64)


def score(docs: DataFrame, target: str) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (per word) and their difference ``score``."""
    chunks = keep(chunked(docs, target), "chunks")
    text = chunks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = text // RANGE_BYTES + 1
    sums = keep(summed(counted(chunks, ranges)), "sums")
    size, *totals = sums.filter("chunk is null").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("distinct", "target", "background")]).first()
    size += 1  # an unseen word
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n_tokens", T.LongType())] + [T.StructField(n, T.DoubleType()) for n in ("target_loss", "background_loss", "score")]
    )
    to = pa.schema([(f.name, _arrow(f.dataType)) for f in schema.fields])

    def of_chunk(rows: pa.Table, found: pa.Table) -> pa.Table:
        held = Occurrences()
        held.add(rows["text"].combine_chunks(), rows["marked"].to_numpy().astype(bool))
        words, of_words, word = held.tally(False)
        of_words = _with_sums(of_words, bounds(words, ranges), list(zip(found["range"].to_pylist(), found["words"].to_pylist())))
        pairs, of_pairs, pair = held.tally(True)
        of_pairs = _with_sums(of_pairs, bounds(pairs, ranges), list(zip(found["range"].to_pylist(), found["pairs"].to_pylist())))
        word = word[: held.n]
        previous = np.empty_like(word)
        previous[1:] = word[:-1]
        previous[np.concatenate([*held.firsts, np.zeros(0, dtype=np.int64)])] = -1
        start = int(np.searchsorted(words, START))
        out = []
        for a, z, texts, sizes, marked in held.runs:
            w, v, p = word[a:z], previous[a:z], pair[a:z]
            mine, before = marked[texts], np.where(v < 0, start, v)
            own_word, own_pair, own_previous = _own(texts, w), _own(texts, p), np.where(v < 0, 1, _own(texts, w, v))
            per = []
            for k, takes in ((0, mine), (1, np.ones(len(texts), dtype=bool))):
                each = losses(of_words[k][w] - own_word * takes, of_words[k][before] - own_previous * takes, of_pairs[k][p] - own_pair * takes, totals[k], size)
                per.append(np.bincount(texts, weights=each, minlength=len(sizes)) / np.maximum(sizes, 1))
            out.append((sizes, *per, per[0] - per[1]))
        sizes, *values = (np.concatenate(x) for x in zip(*out))
        return pa.table([rows["doc_id"], pa.array(sizes, pa.int64()), *[pa.array(x, mask=sizes == 0) for x in values]], names=to.names).cast(to)

    ship()
    back = sums.filter("chunk is not null").select("chunk", "range", "words", "pairs")
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(of_chunk, schema)
