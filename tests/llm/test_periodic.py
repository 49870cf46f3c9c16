import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from wearlens.llm import periodic, queries


def brute(words):
    """Every run, from the contract's words alone."""
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            a = i
            while i < n and words[i] == words[i - q]:
                i += 1
            s, e = a - q, i
            smallest = next(p for p in range(1, q + 1) if all(words[x] == words[x - p] for x in range(s + p, e)))
            if smallest == q and e - s >= max(6, 4 * q):
                out.add((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def online(words):
    """The same by the literal diagonal program: every earlier occurrence lengthens its lag's match."""
    seen, active, out = {}, {}, []

    def end(i, ended):
        for p in sorted(ended):
            run = (i - ended[p] - p, ended[p] + p, p)
            if run[1] >= max(6, 4 * p) and not any(p % q == 0 and (s, n) == run[:2] for s, n, q in out):
                out.append(run)

    for i, w in enumerate(words):
        matched = {i - j: active.get(i - j, 0) + 1 for j in seen.get(w, [])}
        end(i, {p: n for p, n in active.items() if p not in matched})
        active = matched
        seen.setdefault(w, []).append(i)
    end(len(words), active)
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(words):
    ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return [tuple(r) for r in periodic.find_runs(np.array([ids[w] for w in words], dtype=np.int64), len(words)).tolist()]


def samples():
    r = random.Random(7)
    yield from map(list, itertools.product("ab", repeat=11))
    for k in range(400):
        words = []
        for _ in range(r.randrange(1, 6)):
            piece = [r.choice("abc"[: 1 + r.randrange(3)]) for _ in range(r.randrange(1, 9))]
            words += (piece * r.randrange(1, 9))[: r.randrange(1, 60)]
        yield words


def test_runs_equal_brute_force_and_the_literal_program():
    for words in samples():
        assert found(words) == brute(words) == online(words), words


def expected(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (x - a) % p] for x in range(a, n)]
    runs = brute(words)
    gone = {x for s, size, q in runs for x in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for x, w in enumerate(words) if x not in gone)),
    )


def test_query_equals_brute_force(spark, documents, words, tmp_path):
    r = random.Random(3)
    docs = [(k, "  ".join(words(r.randrange(1, 150), k))) for k in range(120)]
    docs += [(200 + k, "\t".join(words(3 + k, k) * 5)[: 200 + 40 * k] + "\nEnd é") for k in range(40)]
    docs += [(300, None), (301, ""), (302, " \n "), (303, "x"), (None, "a a a a a a"), (None, None), (304, "Aa aA " * 9), (304, "Aa aA " * 9), (305, "ab a b " * 4)]
    docs += [(306 + k, (" ".join(words(9, k)) + "\n") * 12) for k in range(12)]
    documents(*docs).write.parquet(str(tmp_path / "documents.parquet"))
    made = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, made))) == sorted(str((i, *expected(i, t))) for i, t in docs)
    assert any(x.n_runs for x in made)


def test_texts_and_columns(spark, documents):
    docs = documents((1, "a b a b a b a b c"), (2, None), (3, "")).withColumns({"runs": F.lit(1), "a.b": F.lit("x"), "__text": F.lit("y")})
    made = periodic.collapse_runs(docs)
    assert made.columns == [*[c for c in docs.columns if c != "runs"], "n_words", "runs", "collapsed"]
    assert {r.doc_id: (r.collapsed, r.n_words, r["a.b"], r["__text"]) for r in made.collect()} == {1: ("a b c", 9, "x", "y"), 2: (None, 0, "x", "y"), 3: ("", 0, "x", "y")}
    assert periodic.collapse_runs(documents()).count() == 0


def test_long_texts_stay_near_linear():
    r = random.Random(1)
    for ids in (np.zeros(300_000, dtype=np.int64), np.array([r.randrange(2) for _ in range(300_000)]), np.arange(300_000) % 5000, np.arange(300_000) % 75_000):
        began = time.process_time()
        got = periodic.find_runs(ids, len(ids))
        assert time.process_time() - began < 20
    assert got.tolist() == [[0, 300_000, 75_000]]
    assert periodic.find_runs(np.zeros(300_000, dtype=np.int64), 300_000).tolist() == [[0, 300_000, 1]]
