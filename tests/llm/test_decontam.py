import re

from wearlens.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = {}
    for i, text in docs:
        w, hit, found = words_of(text), set(), set()
        for item, t in items:
            v = words_of(t)
            n = min(13, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == v[a : a + n]:
                        hit.update(range(b, b + n))
                        found.add(str(item))
        out[i] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def run(spark, documents, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.find_contamination(documents(*docs), bench).collect()
    assert len(rows) == len(docs)
    return {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in rows}


def test_equals_brute_force(spark, documents, words):
    items = [(k, " ".join(words(n, k))) for k, n in enumerate((5, 7, 8, 12, 13, 14, 40))] + [(10, None), (11, ""), (12, "a a a a a a a a a a a a a a")]
    docs = [(0, None), (1, ""), (2, "a " * 30), (3, " ".join(words(200, 99)))]
    for k in range(4, 24):
        item = items[k % 7][1].split()
        cut = item[: len(item) - (k % 3)] if k > 12 else item
        docs.append((k, " ".join([*words(20, 1000 + k), *cut, *words(15, 2000 + k), *item[k % 5 :]]).upper()))
    assert run(spark, documents, docs, items) == brute(docs, items)


def test_every_shared_window_is_found_at_any_place(spark, documents, words):
    item = words(60, 1)
    docs = [(k, " ".join([*words(k, k + 50), *item[k : k + 13], *words(30, k + 90)])) for k in range(40)]
    found = run(spark, documents, docs, [(1, " ".join(item))])
    assert all(r[1] == 13 and r[2] == ["1"] for r in found.values())
    assert all(not r[2] for r in run(spark, documents, [(k, " ".join([*words(k, k + 50), *item[k : k + 12], "z"])) for k in range(40)], [(1, " ".join(item))]).values())


def test_empty_tables_and_repeated_rows(spark, documents, words):
    text = " ".join(words(20, 3))
    assert run(spark, documents, [(1, text)], [(None, None)]) == {1: (20, 0, [], False)}
    assert decontam.find_contamination(documents(), spark.createDataFrame([(1, text)], "item_id long, text string")).count() == 0
    bench = spark.createDataFrame([(1, text), (1, text), (None, text)], "item_id long, text string")
    rows = decontam.find_contamination(documents((5, text), (5, text), (5, "other words"), (None, text)), bench).collect()
    assert sorted((r.doc_id or -1, r.n_hit) for r in rows) == [(-1, 20), (5, 0), (5, 20), (5, 20)]


def test_contaminated_documents_are_dropped_whole(spark, documents, words):
    text = " ".join(words(20, 3))
    docs = documents((1, text), (2, "clean text"), (None, "kept"), (4, None))
    left = decontam.drop_contaminated(docs, spark.createDataFrame([(1, text)], "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["2", "4", "None"]


def test_one_word_over_and_over_meets_itself_once(spark, documents):
    """Places of one context are joined once: thousands of places on either side stay thousands of rows."""
    items = [(k, "ha " * 3000) for k in range(5)] + [(9, "a b " * 1500), (10, "ha " * 12 + "end")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents((1, "ha " * 4000), (2, "x y " + "a b " * 2000 + "z"), (3, "ha " * 12), (4, "start " + "ha " * 13 + "stop"), (5, "ha " * 12 + "end"))
    rows = {r.doc_id: r for r in decontam.find_contamination(docs, bench).collect()}
    assert [(rows[k].n_words, rows[k].n_hit, list(rows[k]["items"])) for k in range(1, 6)] == [
        (4000, 4000, ["0", "1", "2", "3", "4"]), (4003, 4000, ["9"]), (12, 0, []), (15, 13, ["0", "1", "2", "3", "4"]), (13, 13, ["10"]),
    ]
    assert len(rows[1].spans) < 20 * 4000
