import base64
import os
import random

import pytest

from lamella.llm import tokenizer as K

PATH = os.path.join(K.FOLDER, K.VOCABULARY)
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="needs the public vocabulary")


@pytest.fixture(scope="module")
def encoder():
    return K.Encoder(K.serialise_model(K.read_vocabulary(PATH)))


def reference(texts):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return [enc.encode_ordinary(t) for t in texts]


def odd_texts():
    rnd = random.Random(1)
    pool = [chr(c) for c in range(0x180)] + list("\u0085  ᠎　﻿​‍�😀é一二ａ１Ⅻ²½\x1c\x1d\x1e\x1f") + ["  ", "'s", "'ll", "the", "<|endoftext|>", "\r\n", "aaaaaaaa", "ſ", "'S"]
    return ["".join(rnd.choice(pool) for _ in range(rnd.randrange(40))) for _ in range(4000)]


def test_same_ids_as_the_rank_file(encoder):
    texts = odd_texts() + ["a" * 20_000, " " * 20_000 + "x", "Hello world's end", "<|endoftext|>"]
    ids = encoder.encode(texts)
    assert ids == reference(texts)
    assert [encoder.decode(i) for i in ids] == texts


def test_rows(spark):
    rows = [(1, None, "l"), (2, "", "l"), (3, "Hi there", "l"), (3, "Hi there", "l"), (None, "x", "l"), (4, "\r\n\t ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = [(r.doc_id, list(r.ids)) for r in K.encode_corpus(docs).collect()]
    want = reference(["", "", "Hi there", "Hi there", "x", "\r\n\t "])
    assert got == list(zip([r[0] for r in rows], want))
    assert [r.n_tokens for r in K.token_counts(docs).collect()] == [len(w) for w in want]
    assert [r.text for r in K.decode_corpus(K.encode_corpus(docs)).collect()] == ["", "", "Hi there", "Hi there", "x", "\r\n\t "]
    assert K.encode_corpus(docs.limit(0)).collect() == []


def test_ranks_must_be_complete(tmp_path):
    bad = tmp_path / "v"
    bad.write_bytes(base64.b64encode(b"a") + b" 1\n")
    with pytest.raises(ValueError):
        K.read_vocabulary(str(bad))
