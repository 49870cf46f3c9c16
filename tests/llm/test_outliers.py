import itertools
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wearlens.llm import outliers


def brute(text):
    t = text or ""
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in t).split(" ") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in range(i, i + 3)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\v\f\r")]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def test_statistics_equal_brute_force(documents):
    r = random.Random(4)
    made = [(k, "".join(r.choice(["a", "b", "c ", " ", "\n", "é", "#x ", "b a c ", "\t", "a\n", "\x1c"]) for _ in range(r.randrange(300)))) for k in range(200)]
    made += [(900, None), (901, ""), (902, "x " * 40_000), (903, " ".join(f"w{k}" for k in range(30_000)))]
    rows = outliers.statistics(documents(*made)).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows}
    assert got == {i: brute(t) for i, t in made}


def prose(seed, n, junk=0.0):
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaoinshr") for _ in range(r.randrange(2, 9))) + ("###" if r.random() < junk else "") for _ in range(n))


def test_junk_is_rejected_and_prose_kept(spark):
    rows = [(k, prose(k, 60 + k % 400, 0.9 if k % 20 == 0 else 0.0), "en", "a" if k < 400 else f"s{k % 7}") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judged = outliers.judge(docs)
    assert "Python" not in judged._jdf.queryExecution().toString()
    kept = {r.doc_id: r.kept for r in judged.collect()}
    assert not any(kept[k] for k in range(0, 800, 20))
    assert sum(kept[k] for k in range(800) if k % 20) >= 755


def test_small_groups_nulls_and_repeated_rows(spark):
    text = prose(1, 80)
    rows = [(1, text, None, None), (1, text, None, None), (None, text, "en", None), (4, None, "en", "a"), (5, "short", None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"g": F.lit(1), "d2": F.lit(9.0), "n": F.lit("x")})
    got = sorted((str(r.doc_id), str(r.d2 and round(r.d2, 9)), r.kept) for r in outliers.judge(docs).collect())
    assert got == [("1", "0.0", True), ("1", "0.0", True), ("4", "None", False), ("5", "None", False), ("None", "0.0", True)]
    assert outliers.judge(docs.limit(0)).count() == 0


def test_identical_documents_have_an_estimate(spark):
    rows = [(k, prose(1, 80), "en", "a") for k in range(300)] + [(300, prose(2, 80, 1.0), "en", "a")]
    got = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got.pop(300) is False and all(got.values())


def smallest_determinants(group, target):
    """Least regularized log determinant over all subsets of three quarters of a small group."""
    x, n = np.array(group), math.ceil(outliers.SHARE * len(group))
    found = []
    for some in itertools.combinations(range(len(x)), n):
        cov = n * (outliers.CONSISTENT * np.cov(x[list(some)].T, bias=True) + np.diag(np.square(outliers.FLOOR)))
        found.append(np.linalg.slogdet((cov + outliers.PRIOR * np.diag(target)) / (n + outliers.PRIOR))[1])
    return min(found)


def test_determinant_is_the_least_of_all_subsets(spark):
    r = random.Random(8)
    groups = {}
    for g in range(20):  # a fifth of each group lies far off, in a direction of its own
        off = [r.uniform(4, 8) * r.choice((-1, 1)) for _ in range(outliers.P)]
        groups[f"g{g}"] = [[r.gauss(0, 1) + (off[i] if k < 2 else 0) for i in range(outliers.P)] for k in range(10)]
    rows = spark.createDataFrame([(g, *x) for g, some in groups.items() for x in some], "g string, x0 double, x1 double, x2 double, x3 double")
    target = outliers.scales(rows)[1]
    got = {row.g: row for row in outliers.estimates(rows).collect()}
    best = {g: smallest_determinants(x, target) for g, x in groups.items()}
    assert all(got[g].logdet > best[g] - 1e-9 for g in groups)
    assert sum(got[g].logdet < best[g] + 1e-5 for g in groups) >= 16
    assert len(got) == 20 and {row.k for row in got.values()} <= {0, 1, 2}


def test_small_group_has_its_own_estimate(spark):
    text = lambda k, junk=0.0: prose(k, 80 + k % 50, junk)
    rows = [(k, text(k), "en", "big") for k in range(300)]
    rows += [(1000 + k, text(1000 + k, 1.0 if k < 2 else 0.0), "en", "small") for k in range(16)]
    rows += [(2000 + k, text(2000 + k, 0.5), "en", "marked") for k in range(40)] + [(3000, text(3000, 1.0), "xx", "alone")]
    kept = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[1000] and not kept[1001] and all(kept[1000 + k] for k in range(2, 16))
    assert sum(kept[2000 + k] for k in range(40)) >= 38  # symbols are usual in this source
    assert kept[3000]
