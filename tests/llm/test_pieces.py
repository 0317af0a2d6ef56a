import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from isobar.llm import pieces
from isobar.llm.queries import QUERIES

from .helpers import ODD_TEXTS, SMALL, documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.vocabulary(PATH))


def agree(encoder, library, texts):
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        wanted = library.encode(text or "")
        assert ids.tolist() == wanted, repr(text)[:200]
        assert pieces.decoded(encoder.vocab, ids) == library.decode(wanted)


def test_odd_texts(encoder, library):
    more = ["▁x ▁▁", " " * 40 + "a" + " " * 700, "<s> </s><unk><0x41>", "日本語のテキスト" * 50, "　\x00\x7f é́", "ab" * 30, "x y" * 999, " \n \t \r\n", "😀😀 👩‍👩‍👧", "1234567 3.14"]
    agree(encoder, library, ODD_TEXTS + more)


def test_random_texts(encoder, library):
    rng = random.Random(5)
    alphabets = ["ab ", "aA eè\n", " tion heanrds", "▁ ▁x", "漢字かな交じり abc", "0 1.,-+()", "".join(map(chr, range(32, 400)))]
    texts = ["".join(rng.choice(rng.choice(alphabets[k : k + 1])) for _ in range(rng.randrange(1, 120))) for k in range(len(alphabets)) for _ in range(150)]
    agree(encoder, library, texts)


def test_long_words_and_rounds_agree(encoder, library):
    rng = random.Random(6)
    text = "".join(rng.choice("aeioutnshr") for _ in range(30_000))
    agree(encoder, library, [text, text[: pieces.LONG_WORD - 5], " " * 5000])


def test_forgetting_words_changes_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    monkeypatch.setattr(pieces, "CHARS_AT_ONCE", 20)
    agree(pieces.Encoder(encoder.vocab), library, [f"word{i % 7} and {i}" for i in range(50)])


def test_wrong_bytes_and_ends(encoder, library):
    byte = encoder.vocab.byte_id
    for ids in ([byte[0xE6], byte[0x97]], [1, byte[0x41], byte[0xFF], 264, 2], [byte[0xC3], byte[0xA9]], [264, byte[0xF0], 264], [2, 1], [28705, 264], [1, 259]):
        ids = [int(i) for i in ids]
        assert pieces.decoded(encoder.vocab, np.array(ids)) == library.decode(ids)


def test_query_equals_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op10_pieces"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_columns_and_empty_table(spark, library):
    frame = documents(spark, more="ids n_tokens")
    made = frame.withColumn("pieces", pieces.encode(spark, F.col("text"), PATH))
    back = made.withColumn("back", pieces.decode(spark, F.col("pieces"), PATH)).collect()
    for r in back:
        assert list(r.pieces) == library.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.back == (r.text or "") and r.ids == "ids"
    empty = documents(spark, [])
    assert empty.select(pieces.digests(spark, F.col("text"), PATH)).count() == 0


def test_coded_is_encoding_and_decoding_at_once(spark):
    frame = documents(spark)
    both = frame.select("doc_id", pieces.coded(spark, F.col("text"), PATH).alias("c"), pieces.encode(spark, F.col("text"), PATH).alias("ids"))
    rows = both.select("c.*", "ids", F.sha2(pieces.decode(spark, F.col("ids"), PATH), 256).alias("digest")).toDF("coded", "decoded_sha256", "ids", "digest").collect()
    assert rows and all(r.coded == r.ids and r.decoded_sha256 == r.digest for r in rows)
