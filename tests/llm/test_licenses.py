import textwrap

import duckdb

from wearlens.llm import licenses, oracles


def scan(spark, docs):
    return licenses.scan_licenses(docs, licenses.known_licenses(spark)).collect()


def test_variants_of_a_text_have_one_digest(spark, documents):
    mit = next(t for i, t in licenses.KNOWN if i == "MIT")
    variants = [
        mit, mit.upper(), mit.replace("\n", " \n  "), "Copyright (c) 2020 Someone\n" + mit, mit.replace(", ", " ,"), mit.replace('"', "“"),
        mit.replace("MIT License", "MIT Licence"), "* (c) 1999\n" + mit + "\n\n© Else", mit.replace("COPYRIGHT HOLDERS", "copyright owners"),
    ]
    rows = scan(spark, documents(*enumerate(variants)))
    assert len({r.digest for r in rows}) == 1
    assert all(list(r.whole_licenses) == ["MIT"] for r in rows)


def test_notices_in_lines_and_paragraphs(spark, documents):
    text = "Some words.\nReleased under the MIT Licence\nmore\n\nLicensed under the Apache License,\nVersion 2.0.\n\nend. All rights reserved."
    (r,) = scan(spark, documents((1, text)))
    assert list(r.licenses) == ["Apache-2.0", "MIT"] and list(r.whole_licenses) == []


def test_nulls_repeated_rows_and_long_texts(spark, documents):
    long = "word " * 100_000 + "\nReleased under the MIT License."
    rows = scan(spark, documents((1, None), (2, ""), (None, long), (3, "All rights reserved."), (3, "All rights reserved."), (3, "none")))
    got = sorted((str(r.doc_id), list(r.whole_licenses), list(r.licenses)) for r in rows)
    assert got == [("1", [], []), ("2", [], []), ("3", [], []), ("3", ["reserved"], ["reserved"]), ("3", ["reserved"], ["reserved"]), ("None", [], ["MIT"])]
    assert scan(spark, documents()) == []
    assert "Python" not in licenses.scan_licenses(documents((1, "x")), licenses.known_licenses(spark))._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]


def test_full_texts_alone_and_inside_documents(spark, documents):
    texts = licenses.full_texts()
    mit = next(t for i, t in licenses.KNOWN if i == "MIT")
    inside = "A note before.\n\n" + mit.replace("License\n\n", "License\n\nCopyright (c) 2020 Someone\n\n", 1) + "\n\nand one after."
    gpl = "x\n\n" + dict(texts)["GPL-3.0"] + "\n\ny"
    rows = {r.doc_id: r for r in scan(spark, documents((100, inside), (101, gpl), (102, inside.replace("free of charge", "at a price")), *[(k, t) for k, (_, t) in enumerate(texts)]))}
    assert {i for i, _ in texts} >= {"Apache-2.0", "GPL-3.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause"}
    assert all(i in rows[k].whole_licenses for k, (i, _) in enumerate(texts))
    assert "MIT" in rows[100].licenses and "GPL-3.0" in rows[101].licenses and "MIT" not in rows[102].licenses


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(p, width) for p in text.replace("\r", "").split("\n\n"))


def test_every_known_text_is_recognised_in_any_wrap(spark, documents):
    given = [(i, t) for i, t in [*licenses.full_texts(), *[k for k in licenses.KNOWN if len(k[1]) > 300]]]
    rows = [(k * 10 + j, wrapped(t, w)) for k, (_, t) in enumerate(given) for j, w in enumerate((60, 80, 100))]
    got = {r.doc_id: list(r.whole_licenses) for r in scan(spark, documents(*rows))}
    assert [(given[i // 10][0], i % 10) for i in got if given[i // 10][0] not in got[i]] == []


def test_a_sentence_that_wraps_before_copyright_stays(spark, documents):
    whole = "You keep every\ncopyright notice that is included, and\n(c) You must retain it."
    one, other, less = scan(spark, documents((1, whole), (2, whole.replace("\n", " ")), (3, whole.replace("copyright notice", "notice"))))
    assert one.digest == other.digest != less.digest


def test_equals_sql_on_full_texts_and_runs(spark, documents):
    texts = dict(licenses.full_texts())
    rows = [
        (1, texts["GPL-2.0"]), (2, "a\n\n" + wrapped(texts["Apache-2.0"], 70) + "\n\nb"), (3, "Copyright (c) 2020 A\n\n" + texts["BSD-2-Clause"]), (4, None), (5, ""), (5, ""),
        (6, "Released under the MIT Licence.\n\nCopyright 2001 B\nAll rights reserved."), (7, wrapped(texts["GPL-3.0"], 100)), (8, "© x\nnon-\ncommercial version\n2"),
    ]
    duck = duckdb.connect()
    duck.execute("create table documents(doc_id bigint, text varchar)")
    duck.executemany("insert into documents values (?, ?)", rows)
    expected = sorted(duck.execute(f"select doc_id, digest, whole_licenses, licenses from ({oracles.oracle_sql()['op7_license_scan']})").fetchall())
    assert sorted((r.doc_id, r.digest, ",".join(r.whole_licenses), ",".join(r.licenses)) for r in scan(spark, documents(*rows))) == expected
    assert dict((r[0], r[2]) for r in expected)[7] == "GPL-3.0"
