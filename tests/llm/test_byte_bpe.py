"""Byte-level BPE against the tokenizers library."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cargoline.llm import byte_bpe
from tests.llm.conftest import prose

ODD = [
    "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|", "aaaa" * 333, " " * 1001, "\n\n\t  x   y   z  ", "日本語テキスト한국어हिन्दी 👩‍👩‍👧 é é",
    "don't I'LL we've ’s 123456789 ١٢٣", "\0\x01\x7f\x85", "x" * 10001, "ab" * 501, "   a​b\u0085d\x1ce", "",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_rows_equal_the_library(spark, docs, rows, none, library):
    more = spark.createDataFrame([(900 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    got = byte_bpe.digest(byte_bpe.encode(docs.select("doc_id", "text", "fp", "h").unionByName(more, allowMissingColumns=True))).collect()

    def want(doc_id, text):
        ids = ids_of(library, text)
        back = library.decode(ids, skip_special_tokens=False)
        return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    assert Counter(map(tuple, got)) == Counter([want(r[0], r[1]) for r in rows] + [want(900 + i, t) for i, t in enumerate(ODD)])
    assert byte_bpe.encode(none).count() == 0


def test_random_texts_and_round_trip(library):
    rng = random.Random(4)
    letters = "aabbe  \n'st.1é日́<|>"
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(2000)] + [prose(i, 200) for i in range(20)]
    encoder = byte_bpe.Encoder()
    for lo in range(0, len(texts), 500):
        for text, ids in zip(texts[lo : lo + 500], encoder.encode(texts[lo : lo + 500])):
            assert ids.tolist() == ids_of(library, text)
            assert encoder.decode(ids) == text


def test_very_long_texts_and_forgotten_pieces(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "TEXT_BYTES", 1 << 16)
    monkeypatch.setattr(byte_bpe, "PIECES_HELD", 50)
    encoder = byte_bpe.Encoder()
    for text in (prose(5, 4000) * 40, "z" * 300_000, "short words"):
        (ids,) = encoder.encode([text])
        assert ids.tolist() == ids_of(library, text) and encoder.decode(ids) == text


def test_bytes_that_are_no_text(library):
    encoder = byte_bpe.Encoder()
    for ids in ([94], [94, 102], [0, 220, 163], []):
        assert encoder.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
