import hashlib

import pytest
import tiktoken

import corpus_pipeline
from wearlens.llm import decontam, near_dedup, queries, secret_scan, toxicity


def write(spark, folder, docs, labels, benchmark):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def corpus(spark, documents, words, tmp_path_factory):
    item = words(40, 999)
    rows, labels = [], []
    for k in range(400):
        w = words(60, k)
        if k % 10 == 0:
            w = [f"vile{p % 5}" if p % 6 == 0 else x for p, x in enumerate(w)]
        rows.append((k, " ".join(w)))
        labels.append((k, 1, int(k % 10 == 0)))
    rows += [
        (500, rows[1][1]), (501, rows[2][1] + " more"), (502, " ".join(words(30, 5000) + item)), (503, "token = abcdef1234 " + " ".join(words(60, 5001))),
        (504, None), (505, ""), (506, "vile1 vile2 vile3 vile1 " * 10), (None, "no id here"), (507, "Clean text, 'tis é."), (507, "Clean text, 'tis é."),
    ]
    return write(spark, tmp_path_factory.mktemp("corpus"), documents(*rows), labels, [(1, " ".join(item))])


def test_stages_take_effect_and_chain(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        if name != "tokens":
            assert docs.columns == columns
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    toxic, near, clean, secrets, tokens = seen
    assert not toxic & set(range(0, 400, 10)) and 506 not in toxic and {1, 2, 502, 503, 504, 505, None} <= toxic
    assert near == toxic - {500, 501} and clean == near - {502} and secrets == clean == tokens
    result = corpus_pipeline.run(spark, corpus).collect()
    assert len(result) == len(tokens) and {r.doc_id for r in result} == tokens


def test_result_equals_a_plain_computation(spark, corpus):
    """Stage by stage with the operators' verdicts, then encoding by another library."""
    import public_tokenizers

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{corpus}/{t}.parquet") for t in ("labels", "benchmark"))
    judged = toxicity.score(docs, toxicity.train(docs, labels)).filter("kept").select("doc_id")
    kept = {r.doc_id for r in judged.collect()}
    left = [r for r in docs.collect() if r.doc_id in kept]
    frame = spark.createDataFrame(left, docs.schema)
    ones = {r.doc_id for r in near_dedup.near_duplicates(frame).collect() if r.kept}
    bad = {r.doc_id for r in decontam.find_contamination(frame, bench).collect() if r.contaminated}
    texts = {r.doc_id: r.text or "" for r in left if r.doc_id in ones and r.doc_id not in bad}
    tokens = queries.tokens()
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    for r in corpus_pipeline.run(spark, corpus).collect():
        text = texts.pop(r.doc_id)
        if r.doc_id == 503:
            assert text.startswith("token = abcdef1234 ")
            text = text.replace("token = abcdef1234", "[assign]")
        assert list(r.ids) == other.encode_ordinary(text)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert not texts


def test_empty_tables(spark, documents, tmp_path):
    folder = write(spark, tmp_path, documents(), [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
    assert secret_scan.redact(documents()).count() == 0


def test_every_operator_has_one_query():
    names = queries.all_queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_ids_that_doubles_merge_keep_their_own_flags(spark):
    from wearlens.llm.store import id_blocks, with_flags

    ids = [base + k for base in (0, -130, (1 << 53) + 7, (1 << 62) + 1) for k in range(0, 1920, 64)]
    docs = spark.createDataFrame([(i, k % 3 == 0) for k, i in enumerate(ids)] + [(None, True)], "doc_id long, want boolean")
    got = with_flags(docs, id_blocks(docs.filter("want").withColumnRenamed("want", "hit"), "hit"), "hit").collect()
    assert len(got) == len(ids) + 1 and all(r.hit == (r.want and r.doc_id is not None) for r in got)
