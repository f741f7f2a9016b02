import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(file.read())


def held(codec, reference, values):
    for value, data in zip(values, codec.encode(values)):
        ids = reference.encode(value or "", add_special_tokens=False).ids
        assert np.frombuffer(data, "<u4").tolist() == ids
        assert codec.decode(np.array(ids)) == reference.decode(ids, skip_special_tokens=False) == (value or "")


def test_equals_the_library(codec, reference):
    rng = random.Random(2)
    held(codec, reference, ["", None, " ", "a", "aaaaaaaaa", "  x  y", "I'll don't 12 345", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "\r\n\t\x1c\x85", "x" * 5000])
    held(codec, reference, ["".join(rng.choice("ab '\n１²é中\U0001e6c0\U000323b1\U00011de0😀‍") for _ in range(rng.randint(0, 80))) for _ in range(300)])
    held(codec, reference, ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(60)) for _ in range(300)])


def test_long_texts_and_a_full_cache(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "STREAM_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 5_000)
    rng = random.Random(3)
    held(codec, reference, ["".join(rng.choice("abcdefg <|> \n") for _ in range(3000)) + "<|endoftext|>" for _ in range(5)] + ["short one"])


def test_spark_round_trip(spark, docs, no_docs, reference):
    vocab = bpe.vocabulary(spark, PATH)
    tokens = bpe.encode(docs, vocab)
    texts = sorted((r.doc_id or -1, r.text or "") for r in docs.select("doc_id", "text").collect())
    assert sorted((r.doc_id or -1, r.text) for r in bpe.decode(tokens, vocab).collect()) == texts
    for row in bpe.digests(tokens, vocab).where("doc_id = 19").collect():
        text = next(t for i, t in texts if i == 19)
        ids = np.array(reference.encode(text, add_special_tokens=False).ids, "<u4")
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.digests(bpe.encode(no_docs, vocab), vocab).count() == 0
