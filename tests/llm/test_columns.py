"""Every operator and stage with columns of clashing names, names with dots, and rows without doc_id."""

import random

import pytest
from pyspark.sql import functions as F

from wearlens.llm import bpe, decontam, near_dedup, periodic, queries, repeated_spans, secret_scan, suffix_dedup, toxicity

CLASHES = ["ids", "decoded", "__spans", "__block", "a.b", "copied", "gone", "digest", "__copy", "__x0", "h", "row", "runs"]


@pytest.fixture(scope="module")
def given(spark, documents, words):
    passage = " ".join(words(40, 1))
    docs = [(k, " ".join(words(60, k + 10))) for k in range(12)] + [(20, passage + " tail"), (None, passage + " other tail"), (None, "  " + " ".join(words(60, 10)))]
    docs += [(21, "password = abcdef123456"), (None, "password = abcdef123456"), (22, None), (None, None), (23, "")]
    frame = documents(*docs).drop(*CLASHES)
    return frame.select(*[F.lit(i).alias(c) for i, c in enumerate(CLASHES)], *frame.columns)


def texts(df):
    return sorted((str(r.doc_id), str(r.text)) for r in df.collect())


@pytest.mark.parametrize("stage", ["toxicity", "near", "decontam", "secrets", "bpe", "spans", "periodic", "suffix"])
def test_columns_and_rows_without_id(spark, given, words, stage):
    r = random.Random(1)
    if stage == "toxicity":
        labels = spark.createDataFrame([(k, r.randrange(2), k % 2) for k in range(12)], "doc_id long, quality int, toxic int")
        made = toxicity.drop_toxic(given, labels)
    elif stage == "near":
        made = near_dedup.drop_near_duplicates(given)
        want = [(i, t) for i, t in texts(given) if (i, t) != ("None", "password = abcdef123456") and not t.startswith("  ")]
        assert texts(made) == want
    elif stage == "decontam":
        bench = spark.createDataFrame([("x", " ".join(words(40, 1)))], "item_id string, text string")
        made = decontam.drop_contaminated(given, bench)
        assert len(texts(made)) == given.count() - 2 and not any("tail" in t for _, t in texts(made))
    elif stage == "secrets":
        made = secret_scan.redact(given)
        assert sum("abcdef123456" in t for _, t in texts(made)) == 0
    elif stage == "bpe":
        made = bpe.encode(given, queries.tokens(), decoded=True)
        given = given.drop("ids", "decoded")
        assert all(bytes(x.decoded).decode() == (x.text or "") for x in made.collect())
    elif stage == "spans":
        made = repeated_spans.drop_repeated_spans(given)
    elif stage == "periodic":
        made = periodic.collapse_runs(given)
    else:
        made = suffix_dedup.drop_repeats(given)
    rest = [c for c in given.columns if c not in ("text", "n_chars", "runs")]
    assert [c for c in made.columns if c in rest] == rest
    for i, c in enumerate(CLASHES):
        if c in rest:
            assert {x[c] for x in made.select(F.col(f"`{c}`")).collect()} == {i}
