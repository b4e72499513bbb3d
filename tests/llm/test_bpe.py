"""Byte-level BPE against the tokenizers library, word by word and as a query."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from starmart.llm import bpe, queries

PATH = queries.vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def odd_texts():
    r = random.Random(12)
    letters = "aàÀßıİſK ǅ中文字𠀀日本語кирилл١２Ⅷ½²́‍  　\x1c\x85  \t\n\r'!.,<|>end of text'sS've'll\U00010d4fꟜ\U0001ccf0😀👍🏽"
    texts = ["", " ", "  a", "a  ", "\n\n x", "it's they'll I'M", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext"]
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(3000)]
    texts += ["".join(chr(c) for c in r.sample(range(0x110000), 40) if not 0xD800 <= c < 0xE000) for _ in range(500)]
    return texts + ["ab" * 40_000, "x" * 70_000, " " * 5_000 + "word", "".join(r.choice("abc") for _ in range(20_000)), "é" * 300]


def test_ids_and_texts_are_those_of_the_library(library):
    encoder = bpe.Encoder(PATH)
    texts = odd_texts()
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = [int.from_bytes(x, "little") for x in (lambda b: [b[i : i + 4] for i in range(0, len(b), 4)])(encoder.encode(text))]
        assert ids == expected.ids, text[:80]
        assert encoder.vocabulary.decoded(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_any_ids_decode_as_the_library_does(library):
    r, vocabulary = random.Random(3), bpe.Vocabulary(PATH)
    for _ in range(2000):
        ids = [r.randrange(50_260) for _ in range(r.randrange(30))]
        assert vocabulary.decoded(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_take_the_same_merges(monkeypatch):
    r, vocabulary = random.Random(5), bpe.Vocabulary(PATH)
    words = ["".join(r.choice(s) for _ in range(n)).encode() for s in ("ab", "theinga", "aé") for n in range(1, 120)]
    short = [vocabulary.merged(w) for w in words]
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    assert [vocabulary.merged(w) for w in words] == short


def test_words_are_forgotten(monkeypatch):
    text = "one two three four five six one two three"
    whole = bpe.Encoder(PATH).encode(text)
    monkeypatch.setattr(bpe, "MAX_WORDS", 2)
    encoder = bpe.Encoder(PATH)
    assert encoder.encode(text) == encoder.encode(text) == whole and len(encoder.words) <= 2


def test_odd_rows(spark, docs, nothing, library, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_IDS", 10)
    encoded = bpe.encode(docs, PATH)
    rows = [(r.doc_id, r.ids, r.text) for r in bpe.decode(encoded, PATH).collect()]
    expected = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids, r.text or "") for r in docs.collect()]
    key = lambda r: (str(r[0]), r[2])
    assert sorted(rows, key=key) == sorted(expected, key=key)
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [None, 464])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(nulls, PATH).collect()} == {1: "", 2: "The"}


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in queries.op12_bpe(spark, folder).collect()}
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, folder, "documents").select("doc_id", F.col("text")).collect()}
    assert rows.keys() == texts.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for doc, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[doc].n_tokens == len(ids)
        assert rows[doc].ids_sha256 == sha(",".join(map(str, ids)))
        assert rows[doc].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))
