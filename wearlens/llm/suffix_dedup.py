"""Suffix-array dedup: every byte of a string of ``LENGTH`` bytes that starts anywhere else goes.

A sparse suffix array, dealt by content. Of the ``CORE``-byte strings in a window of ``LENGTH`` bytes
the one of least hash, the leftmost of equals, is the window's anchor; equal windows have equal
anchors at the same distance, so only suffixes that start at anchors, about one byte in 70, are ever
compared, and only with those whose core is the same.

1. Anchors become rows: hash of the core, hash of the span (all windows of the anchor, consecutive).
   Cores that occur once go. A span that occurs twice is repeated whole.
2. Spans that share a core but not their whole are cut out of their texts, one of each kind, and
   dealt to tasks by core. A task sorts the suffixes at the anchors by mergesort. Two suffixes are
   compared by binary search for their common extension, equal stretches told by prefix polynomial
   hashes. Neighbours' extensions and order are then verified on the bytes, which proves the whole
   order; a core where a hash lied is sorted by its bytes. A window is repeated where another has the
   same place in the suffix array to the window's depth and the same bytes before the anchor.
3. A core with more than ``GROUP`` kinds of spans is not sorted in one task: its windows are cut at
   fixed distances from the anchor, halved each time, every piece with the longer core that all its
   windows share, and go through 2 again as anchors of their own; at single windows nothing is left
   to compare. So a passage in a third of all documents costs a row per kind, and no task holds it.

Texts that are the same throughout send one of themselves. Whole spans are told apart by 96 bits of
two unrelated hashes, a polynomial of the core and another of all bytes: a wrong removal needs both to
collide. Rows get numbers of their own in a table in the shared folder, so a lost executor changes
nothing.

Defined results. Null text is empty. Rows that repeat are copies: all their bytes go if there are
``LENGTH``. Columns named ``kept``, ``n_bytes``, ``n_removed`` or ``n_spans`` are replaced; others stay.
``kept`` is binary, for a cut may fall inside a character. Texts longer than 16 MB are scanned in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from wearlens.llm import words as W
from wearlens.llm.store import forget, id_blocks, keep, map_arrow, ship, with_flags

LENGTH = 200
CORE = 64
GROUP = 1000  # kinds of spans with one core that a task sorts together
BUCKET = 4000  # kinds of spans a task sorts, of cores that fit
PIECE = 1 << 23  # bytes scanned together at most
PLACE = np.uint64((1 << 24) - 1)
MADE = ("kept", "n_bytes", "n_removed", "n_spans")


def _schema(**fields: str) -> T.StructType:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "binary": T.BinaryType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in fields.items()])


ANCHOR = _schema(row="long", at="int", size="int", before="int", core="long", span="int")
SPAN = _schema(core="long", span="int", bytes="binary", size="int", before="int")
FOUND = _schema(core="long", span="int", a="int", z="int")
HALF = _schema(core="long", span="int", m="long", skip="int", core2="long", span2="int", bytes="binary", size="int", before="int")


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a polynomial over the bytes, and the factors that bring a difference of two to its start."""
    n = len(data)
    up, down = W._powers.upto(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return sums, down


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows, and bytes from the first window to the core, of each anchor; the core's hash."""
    n, width = len(data), LENGTH - CORE + 1
    if n < LENGTH:
        return (np.zeros(0, dtype=np.int64),) * 4 + (np.zeros(0, dtype=np.uint64),)
    sums, down = prefix_sums(data)
    m = n - CORE + 1
    core = W.mix((sums[CORE:] - sums[:m]) * down[:m])
    least = (core & ~PLACE) | np.arange(m, dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: size - width], least[width - size :])
    at = (least & PLACE).astype(np.int64)  # the anchor of each window
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    inside = np.arange(len(at)) + LENGTH <= offsets[1:][text]
    turn = np.ones(len(at), dtype=bool)
    turn[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(turn & inside)
    ends = np.flatnonzero(turn | ~inside)
    end = np.append(ends, len(at))[np.searchsorted(ends, start) + 1]
    return text[start], start, end - start, at[start] - start, core[at[start]]


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes and offsets of texts handled together, their rows, and where in its text each begins."""
    for row, stop, data, offsets in W.text_chunks(column):
        if len(data) <= PIECE:
            yield data, offsets, np.arange(row, stop), np.zeros(stop - row, dtype=np.int64)
            continue
        for a in range(0, len(data), PIECE):  # each window starts in one piece
            part = data[a : a + PIECE + LENGTH - 1]
            yield part, np.array([0, len(part)]), np.array([row]), np.array([a])


def _anchor_batch(b: pa.RecordBatch):
    rows = b.column(0).to_numpy()
    for data, offsets, row, begin in _pieces(b.column(1)):
        text, start, size, before, core = anchors(data, offsets)
        whole = memoryview(np.ascontiguousarray(data))
        span = np.array([xxhash.xxh32_intdigest(whole[a:z], c) for a, z, c in zip(start.tolist(), (start + size + LENGTH - 1).tolist(), before.tolist())], dtype=np.uint32)
        at = start - offsets[text] + begin[text]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[row[text]]), *[pa.array(x.astype(np.int32)) for x in (at, size, before)], pa.array(core.view(np.int64)), pa.array(span.view(np.int32))], ANCHOR.names
        )


def _span_batch(b: pa.RecordBatch):
    """The bytes of the spans that each row lists."""
    out = []
    for text, wanted in zip(b.column(0), b.column(1).to_pylist()):
        data = memoryview(text.as_buffer())
        out += [(w["core"], w["span"], bytes(data[w["at"] : w["at"] + w["size"] + LENGTH - 1]), w["size"], w["before"]) for w in wanted]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()))], SPAN.names)


class Suffixes:
    """Suffixes of byte strings from a place in each on, in groups; compared by hashes, verified on bytes."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, place: np.ndarray, end: np.ndarray, group: np.ndarray):
        self.data, self.begin, self.place, self.end, self.group = data, begin, place, end, group
        self.sums, self.down = prefix_sums(data)
        self.padded = np.append(data, np.uint8(0))

    def hashes(self, a: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[a + size] - self.sums[a]) * self.down[a]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of suffixes i and j, by binary search."""
        a, b = self.place[i], self.place[j]
        low = np.zeros(len(i), dtype=np.int64)
        high = np.minimum(self.end[i] - a, self.end[j] - b)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.hashes(a, mid) == self.hashes(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Is suffix i before j? A suffix that ends is before those that go on; equals keep their order."""
        n = self.common(i, j)
        a, b = self.place[i] + n, self.place[j] + n
        x = np.where(a < self.end[i], self.padded[np.minimum(a, len(self.data))].astype(np.int16), -1)
        y = np.where(b < self.end[j], self.padded[np.minimum(b, len(self.data))].astype(np.int16), -1)
        return (x < y) | ((x == y) & (i < j))

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes in order within their groups, and each one's common extension with the one before."""
        n = len(self.place)
        order = np.argsort(self.group, kind="stable")
        group = self.group[order]
        first = np.searchsorted(group, group, side="left")
        size = np.searchsorted(group, group, side="right") - first
        width = 1
        while width < size.max(initial=0):
            spot = np.arange(n) - first
            block = spot // (2 * width) * (2 * width)
            left = spot - block < width
            other = np.where(left, block + width, block)  # where the other run starts, and how many it has
            many = np.clip(np.where(left, size - other, width), 0, width)
            who = np.flatnonzero((many > 0) & (size > width) & (left | (block + width < size)))
            low, high = np.zeros(len(who), dtype=np.int64), many[who]
            base = first[who] + other[who]
            while (open_ := low < high).any():  # how many of the other run come before
                w, mid = who[open_], (low[open_] + high[open_]) // 2
                before = self.less(order[base[open_] + mid], order[w])
                low[open_], high[open_] = np.where(before, mid + 1, low[open_]), np.where(before, high[open_], mid)
            to = np.arange(n)
            to[who] = first[who] + block[who] + (spot[who] - np.where(left[who], block[who], block[who] + width)) + low
            merged = np.empty_like(order)
            merged[to] = order
            order, width = merged, 2 * width
        extension = np.zeros(n, dtype=np.int64)
        same = np.flatnonzero(group[1:] == group[:-1]) + 1
        extension[same] = self.common(order[same - 1], order[same])
        self.verify(order, extension, group, same)
        return order, extension

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Are the bytes of each two stretches the same?"""
        out = np.ones(len(a), dtype=bool)
        for some in np.array_split(np.arange(len(a)), int(size.sum()) >> 20 or 1):
            of = np.repeat(some, size[some])
            step = np.arange(len(of)) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
            out[of[self.data[a[of] + step] != self.data[b[of] + step]]] = False
        return out

    def verify(self, order: np.ndarray, extension: np.ndarray, group: np.ndarray, same: np.ndarray) -> None:
        """Bytes equal as far as the extensions say and in order after them prove the order; else sort those groups' bytes."""
        i, j, n = order[same - 1], order[same], extension[same]
        a, b = self.place[i] + n, self.place[j] + n
        x = np.where(a < self.end[i], self.padded[np.minimum(a, len(self.data))].astype(np.int16), -1)
        y = np.where(b < self.end[j], self.padded[np.minimum(b, len(self.data))].astype(np.int16), -1)
        good = self.equal(self.place[i], self.place[j], n) & ((x < y) | ((x == -1) & (y == -1)))
        for g in np.unique(group[same[~good]]):
            members = np.flatnonzero(group == g)
            text = {k: self.data[self.place[k] : self.end[k]].tobytes() for k in order[members].tolist()}
            order[members] = sorted(text, key=lambda k: (text[k], k))
            for p in members[1:].tolist():
                s, t = text[int(order[p - 1])], text[int(order[p])]
                extension[p] = next((k for k, (u, v) in enumerate(zip(s, t)) if u != v), min(len(s), len(t)))


def repeated_windows(bytes_: list[bytes], group: np.ndarray, size: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Span and window of each window that another span of the same group has at the same distance from its anchor."""
    lengths = np.array([len(x) for x in bytes_], dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    s = Suffixes(np.frombuffer(b"".join(bytes_), dtype=np.uint8), begin, begin + before, begin + lengths, group)
    order, extension = s.sort()
    spans, windows = [], []
    rank = np.arange(len(order))
    new = np.concatenate([[True], s.group[order][1:] != s.group[order][:-1]])
    for back in range(int(max(0, (before - size + 1).min())), int(before.max()) + 1):
        has = (before[order] >= back) & (before[order] - back < size[order])
        if has.sum() < 2:
            continue
        node = np.cumsum(new | (extension < LENGTH - back))[has]  # suffixes alike to that depth
        who = order[has]
        left = s.hashes(s.place[who] - back, np.full(len(who), back))
        by = np.lexsort((rank[has], left, node))
        who, node, left = who[by], node[by], left[by]
        pair = np.flatnonzero((node[1:] == node[:-1]) & (left[1:] == left[:-1]))
        a, z = who[pair], who[pair + 1]
        true = s.equal(s.place[a] - back, s.place[z] - back, np.full(len(pair), back))
        hit = np.unique(np.concatenate([a[true], z[true]]))
        spans.append(hit)
        windows.append(before[hit] - back)
    return (np.concatenate(spans), np.concatenate(windows)) if spans else (np.zeros(0, dtype=np.int64),) * 2


def _sort_task(t: pa.Table) -> pa.Table:
    core, span = t["core"].to_numpy(), t["span"].to_numpy()
    s, w = repeated_windows(t["bytes"].to_pylist(), np.unique(core, return_inverse=True)[1], t["size"].to_numpy().astype(np.int64), t["before"].to_numpy().astype(np.int64))
    order = np.lexsort((w, s))
    s, w = s[order], w[order]
    turn = np.ones(len(s), dtype=bool)
    turn[1:] = (s[1:] != s[:-1]) | (w[1:] != w[:-1] + 1)
    a = np.flatnonzero(turn)
    last = np.append(a[1:], len(s)) - 1 if len(a) else a
    return pa.table([pa.array(core[s[a]]), pa.array(span[s[a]]), pa.array(w[a].astype(np.int32)), pa.array(w[last].astype(np.int32))], FOUND.names)


def _half_batch(block: int):
    """Pieces of spans between fixed distances from the anchor, each with the core that all windows there share."""

    def batch(b: pa.RecordBatch):
        names = b.schema.names
        out = []
        for core, span, m, piece, size, before in zip(*[b.column(names.index(n)).to_pylist() for n in ("core", "span", "m", "bytes", "size", "before")]):
            least = before - size + 1
            for k in range(least // block, before // block + 1):
                far, near = min(before, (k + 1) * block - 1), max(least, k * block)
                skip = before - far  # windows left out before
                part = piece[skip : before - near + LENGTH]
                shared = piece[before - k * block : before - (k + 1) * block + 1 + LENGTH]
                core2 = xxhash.xxh3_64_intdigest(shared + core.to_bytes(8, "big", signed=True), k)
                out.append((core, span, m, skip, core2 - (1 << 64) if core2 >> 63 else core2, xxhash.xxh32_intdigest(part, far) - (1 << 31), part, far - near + 1, far))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()))], HALF.names)

    return batch


def resolve(spans: DataFrame, block: int = 64, group: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """Windows a to z of each kind of span that another kind with the same core has too.

    ``spans``: core, span, m (how often), bytes, size, before; one row of a kind.
    """
    cores = keep(spans.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "cores")
    mixed = keep(spans.join(cores, "core"), "mixed-spans")
    total, hot = mixed.agg(F.count(F.lit(1)), F.coalesce(F.max("kinds"), F.lit(0))).first()
    small = mixed.filter(F.col("kinds") <= group).drop("kinds", "m")
    ship()
    found = small.withColumn("bucket", F.pmod(F.xxhash64("core"), F.lit(total // bucket + 1))).groupBy("bucket")
    found = found.applyInArrow(lambda t: _sort_task(t), FOUND)
    if hot > group:
        large = mixed.filter(F.col("kinds") > group)
        halves = keep(map_arrow(large, ["core", "span", "m", "bytes", "size", "before"], HALF, _half_batch(block)), "halves")
        kinds = halves.groupBy("core2", "span2").agg(F.sum("m").alias("m"), F.min("bytes").alias("bytes"), F.max("size").alias("size"), F.max("before").alias("before"))
        kinds = keep(kinds.withColumnsRenamed({"core2": "core", "span2": "span"}), "kinds")
        below = resolve(kinds, block // 2, group, bucket) if block > 1 else kinds.select("core", "span", F.lit(0).alias("a"), F.lit(0).alias("z")).limit(0)
        whole = kinds.filter("m > 1").select("core", "span", F.lit(0).alias("a"), (F.col("size") - 1).alias("z"))
        both = keep(below.unionByName(whole).withColumnsRenamed({"core": "core2", "span": "span2"}), "found-below")
        more = halves.select("core", "span", "skip", "core2", "span2").join(both, ["core2", "span2"])
        found = found.unionByName(more.select("core", "span", (F.col("a") + F.col("skip")).alias("a"), (F.col("z") + F.col("skip")).alias("z")))
    return found


def _cut_batch(names: list[str]):
    def batch(b: pa.RecordBatch):
        text, copied, gone = (b.column(names.index(n)) for n in ("text", "copied", "gone"))
        kept, sizes, removed, spans = [], [], [], []
        for t, c, g in zip(text, copied, gone):
            data = t.as_py().encode() if t.is_valid else b""
            n = len(data)
            if c.as_py() and n >= LENGTH:
                cuts = [(0, n)]
            else:
                cuts = []
                for a, z in sorted((x["a"], x["z"]) for x in g.as_py() or []):
                    if cuts and a <= cuts[-1][1]:
                        cuts[-1] = (cuts[-1][0], max(z, cuts[-1][1]))
                    else:
                        cuts.append((a, z))
            edges = [0, *[e for cut in cuts for e in cut], n]
            kept.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2])))
            sizes.append(n)
            removed.append(n - len(kept[-1]))
            spans.append(len(cuts))
        rest = [c for n, c in zip(names, b.columns) if n not in ("copied", "gone")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)]], [n for n in names if n not in ("copied", "gone")] + list(MADE))

    return batch


def drop_repeats(docs: DataFrame, group: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with ``kept`` (the bytes left), n_bytes, n_removed and n_spans (maximal removed runs)."""
    docs = docs.drop(*MADE)
    given = docs.columns
    # own names inside: doc_id is the row's number, the columns given are numbered
    numbered = docs.select(F.monotonically_increasing_id().alias("doc_id"), F.col("text").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(given) if c != "text"])
    rows = keep(numbered, "rows")
    long = rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest")).filter(F.octet_length("text") >= LENGTH)
    long = keep(long, "digests")
    firsts = keep(long.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "texts")
    copied = long.join(firsts.filter("n > 1"), "digest").select("doc_id", F.lit(True).alias("copied"), F.lit(False).alias("first"))
    first = firsts.select(F.col("first").alias("doc_id"), F.lit(False).alias("copied"), F.lit(True).alias("first"))
    flagged = with_flags(rows, id_blocks(copied.unionByName(first), "copied", "first"), "copied", "first")
    found = keep(map_arrow(flagged.filter("first"), ["doc_id", "text"], ANCHOR, _anchor_batch), "anchors")
    cores = found.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("span").alias("low"), F.max("span").alias("high"))
    cores = keep(cores.filter("n > 1").select("core", (F.col("low") < F.col("high")).alias("mixed")), "shared-cores")
    shared = keep(found.join(cores, "core"), "shared-anchors")
    forget(found)
    place = F.struct(F.col("row"), F.col("at"), F.col("size"), F.col("before"))
    kinds = shared.groupBy("core", "span").agg(F.count(F.lit(1)).alias("m"), F.max("size").alias("size"), F.max("before").alias("before"), F.min(F.when(F.col("mixed"), place)).alias("one"))
    kinds = keep(kinds, "span-kinds")
    whole = kinds.filter("m > 1").select("core", "span", F.lit(0).alias("a"), (F.col("size") - 1).alias("z"))
    wanted = kinds.filter("one is not null").groupBy(F.col("one.row").alias("doc_id"))
    wanted = keep(wanted.agg(F.collect_list(F.struct("core", "span", "one.at", "one.size", "one.before")).alias("wanted")), "wanted")  # a text's own anchors
    touched = with_flags(rows.select("doc_id", "text"), id_blocks(wanted.select("doc_id", F.lit(True).alias("touched")), "touched"), "touched").filter("touched")
    spans = keep(map_arrow(touched.join(wanted, "doc_id"), ["text", "wanted"], SPAN, _span_batch), "spans")
    spans = spans.join(kinds.filter("one is not null").select("core", "span", "m"), ["core", "span"])
    parts = keep(resolve(keep(spans, "kinds-of-spans"), group=group, bucket=bucket), "parts").unionByName(whole)
    gone = shared.join(parts, ["core", "span"]).groupBy(F.col("row").alias("doc_id"))
    cut = F.struct((F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("z") + LENGTH).alias("z"))
    gone = keep(gone.agg(F.collect_list(cut).alias("gone")), "gone")
    marked = with_flags(flagged.drop("first"), id_blocks(gone.select("doc_id", F.lit(True).alias("touched")), "touched"), "touched")
    lost = F.col("touched") & ~F.col("copied")  # only those meet their lists in a shuffle
    listed = marked.filter(lost).join(gone, "doc_id")
    plain = marked.filter(~lost).withColumn("gone", F.lit(None).cast(gone.schema["gone"].dataType))
    names = [*["text" if c == "text" else f"c{i}" for i, c in enumerate(given)], "copied", "gone"]
    made = T.StructType([*docs.schema.fields, T.StructField("kept", T.BinaryType()), *[T.StructField(n, T.LongType()) for n in MADE[1:]]])
    done = lambda df: map_arrow(df, names, made, _cut_batch(names))
    return done(plain).unionByName(done(listed))
