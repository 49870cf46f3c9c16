import re

import numpy as np

from wearlens.llm import repeated_spans as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text):
    """Sentences with words as (start, end, words); the end is the next one's start."""
    parts, at = [], 0
    for m in [*re.finditer(r"[.!?](?=[ \t-\r])|\n", text), None]:
        end = m.end() if m else len(text)
        found = [x for x in WORD.finditer(text.lower(), at, end)]
        if found:
            parts.append([found[0].start(), [x.group() for x in found]])
        at = end
    return [(s, parts[i + 1][0] if i + 1 < len(parts) else len(text), w) for i, (s, w) in enumerate(parts)]


def brute(docs):
    first, all_runs, parts = {}, {}, {}
    for i, t in sorted((d for d in docs if d[1]), key=lambda d: d[0]):
        parts[i] = cut(t)
        for a in range(len(parts[i])):
            n, words = 0, []
            for _, _, w in parts[i][a:]:
                words += w
                n += 1
                if n == 1 and len(w) >= R.ALONE or n >= R.SENTENCES and len(words) >= R.WORDS:
                    all_runs.setdefault(i, []).append((tuple(words), a, n))
                    first.setdefault(tuple(words), (i, a))
                    break
    out = {}
    for i, t in docs:
        gone = {p for words, a, n in all_runs.get(i, []) if first[words] != (i, a) for p in range(a, a + n)}
        p = parts.get(i, [])
        out[i] = ((t[: p[0][0]] if p else t) + "".join(t[s:e] for k, (s, e, _) in enumerate(p) if k not in gone) if gone else t, len(p), len(gone))
    return out


def passage(words, n, seed):
    w = words(n, seed)
    return " ".join(x.capitalize() + ("." if k % 7 == 6 else "") for k, x in enumerate(w)) + "."


def run(docs):
    return {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in R.drop_repeated_spans(docs).collect()}


def test_equals_brute_force(documents, words):
    shared = [passage(words, n, 900 + n) for n in (8, 11, 26, 60, 70)]
    docs = [(k, f"  {passage(words, 5 + k, k)} {shared[k % 5]} {passage(words, k, k + 50)}\n{shared[(k + 1) % 5]} é. {shared[4] if k % 3 else ''}") for k in range(25)]
    docs += [(30, None), (31, ""), (32, "... !!"), (33, docs[3][1]), (34, "No. Words. Here."), (35, "No. Words. Here.")]
    assert run(documents(*docs)) == brute(docs)


def test_a_long_passage_goes_from_all_but_the_first(documents, words):
    text = passage(words, 64, 1)
    got = run(documents(*[(k, f"{passage(words, 20, k + 10)} {text} {passage(words, 20, k + 90)}") for k in range(30)]))
    assert text in got[0][0] and got[0][2] == 0
    assert all(text[:200] not in got[k][0] and got[k][2] >= 8 for k in range(1, 30))


def test_missing_ids_repeated_rows_and_columns(documents, words):
    text = passage(words, 64, 1)
    docs = documents((None, text), (5, text), (5, text), (7, text))
    made = R.drop_repeated_spans(docs)
    assert made.columns == [*docs.columns, "n_sentences", "n_removed"]
    assert sorted((str(r.doc_id), r.text == text) for r in made.collect()) == [("5", True), ("5", True), ("7", False), ("None", True)]
    assert R.drop_repeated_spans(documents()).count() == 0


def test_long_text(documents, words):
    text = passage(words, 50_000, 1)
    got = run(documents((1, text), (2, text[: len(text) // 2])))
    assert got[1][0] == text and len(got[2][0]) < 100
    assert np.diff(R.sentences(np.frombuffer(b"A b. C\nd! E", dtype=np.uint8), np.array([0, 11]))[1]).tolist() == [2, 1, 1, 1]
