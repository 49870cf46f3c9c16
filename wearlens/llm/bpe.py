"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text there is exactly one token that can end its encoding: a token t
over bytes i..j such that t may follow the token that ends the prefix 0..i. Two tokens may stand side
by side exactly when merging their bytes by rank leaves the border between them, which the splits of
the two tokens decide without merging anything. So one pass over the piece, keeping the *last token*
of each prefix, gives the encoding of all prefixes at once; the whole encoding is read backwards.

``PrefixTable`` keeps that table for one piece: appending extends it, and an edit recomputes it from
the edit on only until it agrees with the old table again. ``encode`` does the same for all distinct
pieces of a batch of documents together, position by position, in NumPy.

Defined results. Null text encodes and decodes as empty. Columns of the input stay; a column named
like an added one is replaced. Memory grows with a batch of texts and with the longest text.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from wearlens.llm import words as W
from wearlens.llm.store import map_arrow

NONE = np.int64(1 << 40)
LONG_PIECE = 96  # bytes from which a piece is encoded on its own
REMEMBERED = 300_000  # distinct pieces a Python worker remembers before it starts anew
BATCH_BYTES = 1 << 19


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id from a rank file (base64 of the bytes, a space, the rank)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens[i] for i in range(len(tokens))]


def _two_parts(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The two tokens whose merge makes ``token``; None where merging by rank never makes it."""
    own, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], own))
        if ranks.get(parts[at] + parts[at + 1], own) >= own:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return ranks[parts[0]], ranks[parts[1]]


class Vocabulary:
    """A rank file's tokens as arrays: bytes, splits, allowed merges, and a trie."""

    def __init__(self, tokens: list[bytes]):
        ranks = {t: i for i, t in enumerate(tokens)}
        n = len(tokens)
        self.left, self.right = np.arange(n, dtype=np.int64), np.arange(n, dtype=np.int64)
        made, edges, token_at = {}, {}, [-1]
        for i, t in enumerate(tokens):
            if len(t) > 1:
                parts = _two_parts(t, ranks)
                if parts is None:
                    continue
                self.left[i], self.right[i] = parts
                made[parts[0] * n + parts[1]] = i
            node = 0
            for byte in t:
                key = node * 256 + byte
                if key not in edges:
                    edges[key] = len(token_at)
                    token_at.append(-1)
                node = edges[key]
            token_at[node] = i
        self.size = n
        self.merge_keys, self.merge_ids = _sorted(made)
        self.edge_keys, self.edge_nodes = _sorted(edges)
        self.token_at = np.array(token_at, dtype=np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.longest = int(self.lengths.max())

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the token that merging a and b makes, NONE if they don't merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == key, self.merge_ids[at], NONE)

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the border between tokens a and b survives merging their bytes by rank.

        Undoes merges from the latest on: at any time no merge across the border may come before
        the earliest merge undone so far.
        """
        ok = np.zeros(len(a), dtype=bool)
        rows = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NONE)
        while len(rows):
            fine = self.merged(a, b) >= limit
            rows, a, b, limit = rows[fine], a[fine], b[fine], limit[fine]
            from_a = a > b
            whole_a, whole_b = self.right[a] == a, self.left[b] == b
            use_a = np.where(from_a, ~whole_a, whole_b & ~whole_a)
            use_b = ~use_a & ~whole_b
            over = ~use_a & ~use_b
            ok[rows[over]] = True
            limit = np.where(use_a, a, b + 1)
            a, b = np.where(use_a, self.right[a], a), np.where(use_b, self.left[b], b)
            go = ~over
            rows, a, b, limit = rows[go], a[go], b[go], limit[go]
        return ok

    def matches(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and id of every token inside ``data``; stop[i] ends the piece that holds byte i."""
        start, node = np.arange(len(data)), np.zeros(len(data), dtype=np.int64)
        found, step = [], 0
        while len(start):
            key = node * 256 + data[start + step]
            at = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            on = self.edge_keys[at] == key
            start, node = start[on], self.edge_nodes[at[on]]
            step += 1
            token = self.token_at[node]
            hit = token >= 0
            found.append((start[hit], start[hit] + step, token[hit]))
            more = start + step < stop[start]
            start, node = start[more], node[more]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 3


def _sorted(table: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.fromiter(table.keys(), dtype=np.int64, count=len(table))
    order = np.argsort(keys)
    return keys[order], np.fromiter(table.values(), dtype=np.int64, count=len(table))[order]


class PrefixTable:
    """The last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Exact for any split of the piece into appended parts."""
        old = len(self.piece)
        self.piece += more
        self.last += [-1] * len(more)
        self._fill(old, lambda at: False)

    def edit(self, at: int, removed: int, inserted: bytes) -> int:
        """Replace bytes and repair the table. Returns for how many prefixes it was computed anew."""
        before, shift = self.last, len(inserted) - removed
        self.piece = self.piece[:at] + inserted + self.piece[at + removed :]
        self.last = before[:at] + [-1] * (len(self.piece) - at)
        reach, same = self.vocabulary.longest, 0
        done = at

        def settled(j: int) -> bool:
            nonlocal same, done
            done = j + 1
            old = j - shift
            same = same + 1 if j >= at + len(inserted) and before[old] == self.last[j] else 0
            if same < reach:
                return False
            self.last[j + 1 :] = before[old + 1 :]
            return True

        self._fill(at, settled)
        return done - at

    def tokens(self) -> list[int]:
        out, end = [], len(self.last)
        while end:
            out.append(self.last[end - 1])
            end -= int(self.vocabulary.lengths[out[-1]])
        return out[::-1]

    def _fill(self, begin: int, settled) -> None:
        v, lo, stride = self.vocabulary, max(0, begin - self.vocabulary.longest + 1), 4096
        lengths = v.lengths
        for a in range(begin, len(self.piece), stride):  # a stretch at a time bounds the memory
            z, lo = min(a + stride, len(self.piece)), max(0, a - v.longest + 1)
            data = np.frombuffer(self.piece[lo:z], dtype=np.uint8)
            _, end, token = v.matches(data, np.full(len(data), len(data)))
            order = np.lexsort((-lengths[token], end))
            end, token = (end[order] + lo - 1).tolist(), token[order].tolist()
            k = 0
            for j in range(a, z):
                while end[k] < j:
                    k += 1
                while k < len(end) and end[k] == j:
                    start = j + 1 - int(lengths[token[k]])
                    if not start or v.may_follow(np.array([self.last[start - 1]]), np.array([token[k]]))[0]:
                        self.last[j] = token[k]
                        break
                    k += 1
                if settled(j):
                    return


def encode_pieces(v: Vocabulary, data: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the pieces data[ptr[i]:ptr[i + 1]] one after the other, and where each piece's begin."""
    size = np.diff(ptr)
    owner = np.repeat(np.arange(len(size)), size)
    start, end, token = v.matches(data, np.repeat(ptr[1:], size))
    inside = end - ptr[owner[start]] if len(start) else end
    # by end position in the piece, then longest token first
    order = np.lexsort((start, end, inside))
    start, end, token, inside = start[order], end[order], token[order], inside[order]
    first = np.ones(len(end), dtype=bool)
    first[1:] = end[1:] != end[:-1]
    turn = np.arange(len(end)) - np.maximum.accumulate(np.where(first, np.arange(len(end)), 0))
    last = np.full(len(data), -1, dtype=np.int64)
    bounds = np.searchsorted(inside, np.arange(1, (int(size.max()) if len(size) else 0) + 2))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        left = np.arange(lo, hi)
        k = 0
        while len(left):
            now = left[turn[left] == k]
            whole = start[now] == ptr[owner[end[now] - 1]]
            ok = whole.copy()
            rest = np.flatnonzero(~whole)
            before = last[start[now[rest]] - 1]
            ok[rest] = v.may_follow(before, token[now[rest]])
            last[end[now[ok]] - 1] = token[now[ok]]
            left = left[(turn[left] > k) & (last[end[left] - 1] < 0)]
            k += 1
    # read backwards
    at, live, got = ptr[1:].copy(), np.flatnonzero(size), []
    while len(live):
        t = last[at[live] - 1]
        got.append((live, t))
        at[live] -= v.lengths[t]
        live = live[at[live] > ptr[live]]
    if not got:
        return np.zeros(0, dtype=np.int32), np.zeros(len(size) + 1, dtype=np.int64)
    piece, ids = np.concatenate([p for p, _ in got]), np.concatenate([t for _, t in got])
    order = np.argsort(piece[::-1], kind="stable")
    counts = np.bincount(piece, minlength=len(size))
    return ids[::-1][order].astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches values[start:start + length] one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]


LETTER, NUMBER, SPACE, OTHER = range(4)


def code_point_classes() -> np.ndarray:
    """For each code point: letter, number, white space (Unicode's property), or other."""
    points = np.delete(np.arange(0x110000), np.arange(0xD800, 0xE000))
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, name in ((LETTER, "L"), (NUMBER, "N"), (SPACE, "White_Space")):
        for m in regex.finditer(rf"\p{{{name}}}+", text):
            out[points[m.start() : m.end()]] = kind
    return out


def split_pieces(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where pieces start in the UTF-8 bytes ``data`` of texts that start at ``offsets``.

    The pieces of the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``:
    runs of one class, each with a space before it; white space before a run gives up its last
    character, which joins the run if it is a space; a run that is an apostrophe takes the ending.
    """
    head = (data & 0xC0) != 0x80
    at = np.flatnonzero(head)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = classes[points]
    begins = np.zeros(n, dtype=bool)
    first = np.searchsorted(at, offsets[:-1])
    begins[first[first < n]] = True
    run = begins.copy()
    run[1:] |= kind[1:] != kind[:-1]
    cut = run.copy()
    p = np.flatnonzero(run & (kind != SPACE) & ~begins)
    p = p[kind[p - 1] == SPACE]
    cut[p - 1] = True
    cut[p[points[p - 1] == 32]] = False
    # an apostrophe that starts a piece, and the ending after it
    q = np.flatnonzero(cut & (points == 39))
    if len(q):
        wide, ends = np.append(points, [0, 0]), np.append(begins, [True, True])
        a, b = wide[q + 1], wide[q + 2]
        one = ~ends[q + 1]
        two = one & ~ends[q + 2]
        short = one & np.isin(a, [ord(c) for c in "stmd"])
        long = two & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        cut[q[short | long] + 1] = False
        for some, length in ((q[short], 2), (q[long], 3)):
            after = some + length
            cut[after[after < n]] = True
    return at[cut]


class Encoder:
    """Encodes texts; remembers the pieces it has met by 64-bit hash.

    Every result is decoded and compared with the text, so that equal hashes of different pieces
    could not go unnoticed; such a batch is encoded once more without the memory of pieces.
    """

    def __init__(self, vocabulary: Vocabulary, classes: np.ndarray):
        self.vocabulary, self.classes = vocabulary, classes
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _encode_all(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given pieces and how many each has; long ones by a table of their own."""
        long = size > LONG_PIECE
        ids, ptr = encode_pieces(self.vocabulary, gather(data, start[~long], size[~long]), np.concatenate([[0], np.cumsum(size[~long])]))
        if not long.any():
            return ids, np.diff(ptr)
        found = np.split(ids, ptr[1:-1]) if (~long).any() else []
        out, short = [], iter(found)
        for is_long, a, n in zip(long.tolist(), start.tolist(), size.tolist()):
            out.append(np.array(PrefixTable(self.vocabulary, data[a : a + n].tobytes()).tokens(), dtype=np.int32) if is_long else next(short))
        return np.concatenate(out), np.array([len(x) for x in out], dtype=np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts data[offsets[i]:offsets[i + 1]] one after the other, and where each text's begin."""
        start = split_pieces(data, offsets, self.classes)
        end = np.append(start[1:], len(data))
        if not len(start):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        keys, where, slots = np.unique(W.span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._reset()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            ids, counts = self._encode_all(data, start[where[new]], (end - start)[where[new]])
            self.starts = np.insert(self.starts, at[new], len(self.ids) + np.cumsum(counts) - counts)
            self.lengths = np.insert(self.lengths, at[new], counts)
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.keys, keys)
        slots = at[slots]
        lengths = self.lengths[slots]
        ids = gather(self.ids, self.starts[slots], lengths)
        ptr = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(start, offsets)]
        if not np.array_equal(decode_ids(self.vocabulary, ids, ptr)[0], data):
            ids, counts = self._encode_all(data, start, end - start)
            ptr = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(start, offsets)]
        return ids, ptr


def decode_ids(v: Vocabulary, ids: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all id lists one after the other, and where each list's begin."""
    lengths = v.lengths[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return gather(v.bytes, v.starts[ids], lengths), ends[ptr]


def _worker_encoder(tables) -> Encoder:
    """One encoder per Python worker and vocabulary: what it remembers serves all of its tasks."""
    memory = sys.modules.setdefault("_wearlens_bpe", types.ModuleType("_wearlens_bpe")).__dict__
    vocabulary, classes, key = tables.value
    if memory.get("key") != key:
        memory["key"], memory["encoder"] = key, Encoder(vocabulary, classes)
    return memory["encoder"]


def _schema(df: DataFrame, added: Iterable[T.StructField]) -> tuple[list[str], T.StructType]:
    added = list(added)
    kept = [f for f in df.schema.fields if f.name not in {a.name for a in added}]
    return [f.name for f in kept], T.StructType([*kept, *added])


_IDS, _DECODED = T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())


def _binary(data: np.ndarray, ptr: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ptr) - 1, [None, pa.py_buffer(ptr.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def encode(docs: DataFrame, tokens: list[bytes], decoded: bool = False) -> DataFrame:
    """``docs`` with the column ids, and with ``decoded``: the bytes that the ids stand for."""
    names, schema = _schema(docs, [_IDS, _DECODED] if decoded else [_IDS])
    key = blake2b(b"".join(tokens)).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((Vocabulary(tokens), code_point_classes(), key))
    text = names.index("text")

    def batch(b: pa.RecordBatch):
        encoder = _worker_encoder(shared)
        for row, stop, data, offsets in W.text_chunks(b.column(text), BATCH_BYTES):
            ids, ptr = encoder.encode(data, offsets)
            out = [c.slice(row, stop - row) for c in b.columns] + [W.lists(ptr, ids, pa.int32())]
            if decoded:
                out.append(_binary(*decode_ids(encoder.vocabulary, ids, ptr)))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return map_arrow(docs, names, schema, batch)


def decode(df: DataFrame, tokens: list[bytes]) -> DataFrame:
    """``df`` with the column decoded: the bytes of its column ids. Null ids decode as empty."""
    names, schema = _schema(df, [_DECODED])
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(tokens))
    at = names.index("ids")

    def batch(b: pa.RecordBatch):
        column = b.column(at)
        ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ptr = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        yield pa.RecordBatch.from_arrays([*b.columns, _binary(*decode_ids(shared.value, ids, ptr.astype(np.int64)))], schema.names)

    return map_arrow(df, names, schema, batch)
