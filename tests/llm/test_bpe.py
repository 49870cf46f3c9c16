import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from wearlens.llm import bpe, queries


@pytest.fixture(scope="module")
def tokens():
    return queries.tokens()


@pytest.fixture(scope="module")
def vocabulary(tokens):
    return bpe.Vocabulary(tokens)


@pytest.fixture(scope="module")
def reference(tokens):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def encoded(encoder, texts):
    raw = [t.encode() for t in texts]
    ids, ptr = encoder.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
    return [ids[a:b].tolist() for a, b in zip(ptr[:-1], ptr[1:])]


def texts():
    r = random.Random(5)
    alphabet = "abcdeé ñ\n\t\x1c\x1d\x85\xa0 　 '!?1२ß漢字😀sSdDtTrevml​﻿"
    made = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(3000)]
    return made + ["", "a" * 900, " " * 700, "-" * 1500 + "x", "漢" * 300, "I'll don't we've she's 'sore ''s !'s \n's '", "".join(map(chr, range(0x300)))]


def test_equals_tiktoken(vocabulary, reference):
    some = texts()
    encoder = bpe.Encoder(vocabulary, bpe.code_point_classes())
    for _ in range(2):  # the second time from memory
        assert encoded(encoder, some) == [reference.encode_ordinary(t) for t in some]


def test_forgets_and_survives_equal_hashes(vocabulary, reference, monkeypatch):
    some = texts()[:300]
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(vocabulary, bpe.code_point_classes())
    for k in range(0, 300, 50):
        assert encoded(encoder, some[k : k + 50]) == [reference.encode_ordinary(t) for t in some[k : k + 50]]
    monkeypatch.setattr(bpe.W, "span_hashes", lambda data, start, end: (end - start).astype(np.uint64))
    encoder = bpe.Encoder(vocabulary, bpe.code_point_classes())
    assert encoded(encoder, some) == [reference.encode_ordinary(t) for t in some]


def test_prefix_table_appends_exactly(vocabulary, reference):
    r = random.Random(1)
    for _ in range(60):
        piece = bytes(r.choice(b"theandionesrtlyg \xc3\xa9") for _ in range(r.randrange(1, 60)))
        table = bpe.PrefixTable(vocabulary)
        at = 0
        while at < len(piece):
            step = r.randrange(1, 9)
            table.append(piece[at : at + step])
            at += step
        assert table.tokens() == reference._encode_single_piece(piece)
        for n in range(1, len(piece)):  # the table answers for every prefix
            short = bpe.PrefixTable(vocabulary, piece[:n])
            assert short.last == table.last[:n]


def test_prefix_table_edits_near_the_change_only(vocabulary, reference):
    r = random.Random(2)
    piece = bytes(r.choice(b"theandionesrtlyg ") for _ in range(3000))
    table = bpe.PrefixTable(vocabulary, piece)
    for _ in range(5):
        at, gone = r.randrange(2000), r.randrange(6)
        new = bytes(r.choice(b"theandi") for _ in range(r.randrange(6)))
        again = table.edit(at, gone, new)
        assert table.tokens() == reference._encode_single_piece(table.piece)
        assert again < 600
    table.edit(len(table.piece) - 2, 2, b"")
    assert table.tokens() == reference._encode_single_piece(table.piece)


def test_query_round_trip(spark, documents, tokens, reference):
    import hashlib

    pairs = [(1, "The cat's 12 hats."), (2, None), (3, ""), (3, "again\n\n  x"), (None, "é" * 10_000), (5, " ".join(f"w{k}" for k in range(50_000)))]
    rows = queries.with_digests(bpe.encode(documents(*pairs), tokens, decoded=True)).collect()
    assert len(rows) == len(pairs)
    by = {(r.doc_id, r.n_tokens): r for r in rows}
    for i, t in pairs:
        ids = reference.encode_ordinary(t or "")
        r = by[(i, len(ids))]
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_keeps_columns_and_decode_inverts(spark, documents, tokens):
    docs = documents((1, "some text"), (2, None))
    made = bpe.decode(bpe.encode(docs, tokens), tokens)
    assert made.columns == [*docs.columns, "ids", "decoded"]
    assert {r.doc_id: bytes(r.decoded) for r in made.collect()} == {1: b"some text", 2: b""}
    assert bpe.encode(documents(), tokens).count() == 0
    nothing = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>")
    assert sorted(bytes(r.decoded) for r in bpe.decode(nothing, tokens).collect())[:2] == [b"", b""]
