import numpy as np

from wearlens.llm import near_dedup
from wearlens.llm import words as W


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            a, b = sets[x], sets[y]
            if x < y and a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = sorted((find(x), find(y)))
                root[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def run(documents, docs):
    rows = near_dedup.near_duplicates(documents(*docs)).collect()
    assert len(rows) == len(docs)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}


def changed(words, places, tag):
    out = list(words)
    for p in places:
        out[p] = f"x{tag}y{p}"
    return out


def test_equals_brute_force_on_copies_chains_and_groups(documents, words):
    docs, k = [(0, None), (1, ""), (2, "  \n"), (3, "one two"), (4, "ONE\ttwo"), (5, "one two three")], 6
    for g in range(6):
        base = words(200, g)
        for v in range(12):  # from close to just beyond the threshold, some linked through others only
            docs.append((k, " ".join(changed(base, range(3, 3 + 9 * (v % 7), 9), f"{g}_{v}" if v % 2 else g))))
            k += 1
    chain = words(300, 77)
    for v in range(10):  # neighbours are similar, ends are not
        docs.append((k, " ".join(chain[v * 12 : v * 12 + 180])))
        k += 1
    assert run(documents, docs) == brute(docs)


def test_blocks_compare_strays_with_everything(documents, words, monkeypatch):
    """Small blocks: one bucket is spread over many tasks and the result stays the same."""
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 3)
    base = words(120, 5)
    docs = [(k, " ".join(changed(base, range(k % 5, 118, 19 + k % 4), k))) for k in range(40)]
    assert run(documents, docs) == brute(docs)


def test_repeated_rows_and_missing_ids(documents):
    text = "a b c d e f g"
    rows = near_dedup.near_duplicates(documents((3, text), (3, text), (None, text), (9, text), (None, "p q r s"), (None, None))).collect()
    found = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows)
    assert found == [("3", "3", True), ("3", "3", True), ("9", "3", False), ("None", "3", False), ("None", "None", True), ("None", "None", True)]
    left = near_dedup.drop_near_duplicates(documents((3, text), (3, text), (9, text), (10, "p q r s"), (11, None)))
    assert sorted(r.doc_id for r in left.collect()) == [3, 10, 11]
    assert near_dedup.near_duplicates(documents()).count() == 0


def test_one_id_with_two_texts_joins_their_groups(documents):
    rows = near_dedup.near_duplicates(documents((1, "a b c d e"), (2, "a b c d e"), (2, "v w x y z"), (3, "v w x y z"))).collect()
    assert {r.component_id for r in rows} == {1}


def test_long_text_is_whole(documents, words):
    long = words(60_000, 1)
    docs = [(1, " ".join(long)), (2, " ".join(long[:-1])), (3, " ".join(long[:30_000]))]
    assert run(documents, docs)[2][1:] == (1, False) and run(documents, docs)[3][1] == 3


def test_sketch_bits_follow_similarity():
    """Pairs at similarity 0.8 stay within the limit; unrelated sets do not."""
    limit, r = near_dedup.most_bits(0.8), np.random.default_rng(0)
    for _ in range(200):
        common = r.integers(0, 1 << 63, 160, dtype=np.uint64)
        a, b = (np.concatenate([common, r.integers(0, 1 << 63, 20, dtype=np.uint64)]) for _ in range(2))
        other = r.integers(0, 1 << 63, 180, dtype=np.uint64)
        s = near_dedup.odd_sketches(near_dedup.minhashes(np.array([0, 180, 360, 540]), np.concatenate([a, b, other])))
        bits = lambda x, y: int(np.bitwise_count(x ^ y).sum())
        assert bits(s[0], s[1]) <= limit < bits(s[0], s[2])
    assert W.mix(np.array([1], dtype=np.uint64))[0] != 1
