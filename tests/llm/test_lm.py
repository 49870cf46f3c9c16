import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wearlens.llm import lm


def brute(rows):
    """All counts by exact words."""
    docs = [(i, (t or "").split(), m) for i, t, m in rows]
    models = []
    for only in (True, False):
        word, pair, start = Counter(), Counter(), 0
        for _, w, m in docs:
            if m or not only:
                word.update(w)
                pair.update(zip([None, *w], w))
                start += bool(w)
        models.append((word, pair, start))
    out = {}
    for i, w, m in docs:
        if not w:
            out[i] = None
            continue
        mine, pairs = Counter(w), Counter(zip([None, *w], w))
        losses = []
        for k, (word, pair, start) in enumerate(models):
            take = 1 if k or m else 0
            total, loss = sum(word.values()), 0.0
            for v, x in zip([None, *w], w):
                before = max((start if v is None else word[v]) - take * (1 if v is None else mine[v]), 0)
                both = min(max(pair[v, x] - take * pairs[v, x], 0), before)
                single = (max(word[x] - take * mine[x], 0) + 1) / (total + len(models[1][0]) + 1)
                loss -= math.log((both + lm.STRENGTH * single) / (before + lm.STRENGTH))
            losses.append(loss / len(w))
        out[i] = losses
    return out


def test_equals_brute_force(spark):
    rows = [(k, " ".join(f"{'ab'[k % 2]}{(k * j) % 11}" for j in range(3 + k)), k % 2 == 0) for k in range(30)] + [(100, None, True), (101, "", None), (102, "a1 " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark boolean").withColumns({"bucket": F.lit(1), "score": F.lit("x")})
    got = {r.doc_id: r for r in lm.score(docs, "mark").collect()}
    for i, want in brute(rows).items():
        if want is None:
            assert got[i].score is None and got[i].n_tokens == 0
        else:
            assert got[i].target_loss == pytest.approx(want[0], abs=1e-5) and got[i].background_loss == pytest.approx(want[1], abs=1e-5)


def test_held_out_target_texts_score_lower(spark, words):
    few = lambda k: [x[:3] for x in words(80, k)]  # noqa: E731  a vocabulary that 100 documents cover
    rows = [(k, " ".join(few(k)) if k % 2 else " ".join(f"t{x}" for x in few(k)), k % 2 == 0 and k < 200) for k in range(300)]
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string, mark boolean"), "mark").collect()}
    assert max(got[k] for k in range(200, 300, 2)) < min(got[k] for k in range(201, 300, 2))


def test_no_target_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", None), (None, "a b", False), (1, "a b", None)], "doc_id long, text string, mark boolean")
    assert len({r.score for r in lm.score(docs, "mark").collect()}) == 1
    assert lm.score(docs.limit(0), "mark").count() == 0


def test_more_words_and_pairs_than_any_fixed_table(spark, monkeypatch):
    """A text of words seen nowhere else scores as unseen, however many other words there are; small chunks meet."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 1 << 18)
    monkeypatch.setattr(lm, "RANGE_BYTES", 1 << 16)
    size = 3000
    rows = [(k, " ".join(f"v{k * size + j}" for j in range(size)), k % 2 == 0) for k in range(100)] + [(k, "u1 u2 u3 u1 u2", k == 1000) for k in range(1000, 1003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark boolean").repartition(6)
    got = {r.doc_id: r for r in lm.score(docs, "mark").collect()}
    assert len(got) == len(rows)
    vocabulary, totals = 100 * size + 3 + 1, (50 * size + 5, 100 * size + 15)

    def unseen(total, starts):
        single = 1 / (total + vocabulary)
        return -(math.log(lm.STRENGTH * single / (starts - 1 + lm.STRENGTH)) + (size - 1) * math.log(single)) / size

    for k in range(0, 100, 2):
        assert got[k].target_loss == pytest.approx(unseen(totals[0], 51), abs=1e-9)
        assert got[k].background_loss == pytest.approx(unseen(totals[1], 103), abs=1e-9)
    shared = [r for r in rows if r[0] >= 1000]
    few = {r.doc_id: r for r in lm.score(spark.createDataFrame(shared, "doc_id long, text string, mark boolean").repartition(3), "mark").collect()}
    for i, want in brute(shared).items():
        assert few[i].background_loss == pytest.approx(want[1], abs=1e-9)


def test_a_text_longer_than_a_chunk(spark, words, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 1 << 10)
    monkeypatch.setattr(lm, "RANGE_BYTES", 1 << 12)
    rows = [(1, " ".join(words(20_000, 1)), True), (2, " ".join(words(300, 2)), None), (3, " ".join(words(300, 3)), True), (4, " ".join(words(20_000, 1)), False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark boolean").repartition(2)
    got = {r.doc_id: (r.target_loss, r.background_loss) for r in lm.score(docs, "mark").collect()}
    for i, want in brute(rows).items():
        assert got[i] == pytest.approx(tuple(want), abs=1e-9)


def test_packing_keeps_numbers():
    import numpy as np

    keys = np.array([0, 1, 2**63, 2**64 - 1], dtype=np.uint64)
    assert [x.tolist() for x in lm.unpack(lm.pack(keys, keys[::-1]), 2)] == [keys.tolist(), keys[::-1].tolist()]
    assert lm.unpack(lm.pack(keys[:0]), 1)[0].tolist() == []
    assert lm.bounds(keys, 4).tolist() == [0, 2, 2, 3, 4]
