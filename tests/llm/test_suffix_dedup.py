import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlens.llm import queries, suffix_dedup as S


def brute(docs):
    """Every window of 200 bytes, counted."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = {}
    for _, b in raw:
        for a in range(len(b) - 199):
            seen[b[a : a + 200]] = seen.get(b[a : a + 200], 0) + 1
    out = []
    for i, b in raw:
        gone = bytearray(len(b) + 1)
        for a in range(len(b) - 199):
            if seen[b[a : a + 200]] > 1:
                gone[a : a + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), len(b) - len(kept), sum(1 for k in range(len(b)) if gone[k] and not gone[k + 1]), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def corpus(words, n=60):
    r = random.Random(11)
    shared = [" ".join(words(70, 900 + k)) for k in range(6)]
    docs = []
    for k in range(n):
        parts = [" ".join(words(r.randrange(1, 60), k * 7 + j)) for j in range(3)]
        for j in range(2):
            s = r.choice(shared)
            a, size = r.randrange(len(s) - 150), r.choice([199, 200, 201, 230, 400])
            parts.insert(r.randrange(4), s[a : a + size])
        docs.append((k, "é".join(parts)))
    docs += [(100, None), (101, ""), (102, "x" * 199), (103, "y" * 200), (104, "z" * 201), (105, "ab" * 400), (106, "ab" * 300 + "c" + "ab" * 150)]
    docs += [(107, docs[3][1]), (107, docs[3][1]), (None, docs[4][1]), (None, None), (108, docs[5][1][:150]), (109, docs[5][1][:150]), (110, docs[6][1] + "!"), (111, "é" * 130)]
    return docs


def result(spark, docs, tmp_path, documents):
    documents(*docs).write.parquet(str(tmp_path / "documents.parquet"))
    return sorted(map(str, map(tuple, queries.op12_suffix_dedup(spark, str(tmp_path)).collect())))


def test_query_equals_brute_force(spark, documents, words, tmp_path):
    docs = corpus(words)
    assert result(spark, docs, tmp_path, documents) == brute(docs)


@pytest.mark.parametrize("group", [0, 3])
def test_hot_cores_are_split_with_the_same_result(spark, documents, words, group):
    passage = " ".join(words(40, 5))
    r = random.Random(2)
    docs = [(k, " ".join(words(9, k)) + passage[r.randrange(20) : len(passage) - r.randrange(20)] + " ".join(words(9, k + 500))) for k in range(60)]
    docs += [(60 + k, "a b " * 90 + str(k)) for k in range(5)]
    made = S.drop_repeats(documents(*docs), group=group, bucket=7)
    got = made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(str, map(tuple, got))) == brute(docs)


def test_suffix_sort_with_lying_hashes():
    r = random.Random(3)
    pieces = [bytes(r.choice(b"ab") for _ in range(r.randrange(3, 40))) for _ in range(200)]
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(sizes) - sizes
    group = np.array([r.randrange(4) for _ in pieces])
    for lie in (False, True):
        s = S.Suffixes(np.frombuffer(b"".join(pieces), dtype=np.uint8), begin, begin, begin + sizes, group)
        if lie:
            s.hashes = lambda a, size: np.zeros(len(a), dtype=np.uint64)
        order, extension = s.sort()
        want = sorted(range(200), key=lambda k: (group[k], pieces[k], k))
        assert [(group[k], pieces[k]) for k in order] == [(group[k], pieces[k]) for k in want]
        for p in range(1, 200):
            x, y = pieces[order[p - 1]], pieces[order[p]]
            assert extension[p] == (next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y))) if group[order[p - 1]] == group[order[p]] else 0)


def test_long_text_columns_and_empty_tables(spark, documents, words, monkeypatch):
    long = " ".join(words(60_000, 1))
    docs = [(1, long), (2, long[1000:1600]), (3, "short"), (4, long[-300:] + "?")]
    made = S.drop_repeats(documents(*docs).withColumns({"copied": F.lit("c"), "gone": F.lit(1), "a.b": F.lit(2), "kept": F.lit(3), "c0": F.lit(4)}))
    got = {x.doc_id: x for x in made.collect()}
    assert [got[k].n_removed for k in (1, 2, 3, 4)] == [900, 600, 0, 300] and got[1]["a.b"] == 2 and got[1].copied == "c" and got[1].text == long
    assert S.drop_repeats(documents()).count() == 0
    monkeypatch.setattr(S, "PIECE", 5000)
    assert {x.doc_id: x.n_removed for x in S.drop_repeats(documents(*docs)).collect()} == {1: 900, 2: 600, 3: 0, 4: 300}
