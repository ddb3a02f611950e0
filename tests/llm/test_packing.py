"""Packing: an exact round trip, and first fit against a plain search."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cdcframe.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def random_text(rng):
    parts = ["Hello", "world's", " ", "\n", "\t", "é", "é", "́", "ΣΑΣ", "Σ", " ", "\x1c", " ", "<|endoftext|>",
             "123", "!!", "don't", "<|start", "oftext|>", "日本", "🙂", "İ", "J\u030c", "j\u030c", "T\u0308", "x,", "Straße.", "été,", "ÉTÉ.", "ab.,", "<|ENDOFTEXT|>", ",", "ﬁ", "ǅ", "\x0b", "\x85", "ab" * 40, "≠"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(60)))


def test_word_by_word_equals_whole_texts(tokenizer):
    rng = random.Random(3)
    encoder = packing._encoder(None)
    texts = [random_text(rng) for _ in range(3000)]
    for text, got in zip(texts, encoder.encode(pa.array(texts)).to_pylist()):
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert np.frombuffer(got, "<u2").tolist() == want, repr(text)


def test_memo_is_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "MEMO", 50)
    encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for n in (10, 30, 200, 5):
        text = " ".join(f"w{i}x" for i in range(n))
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert np.frombuffer(encoder.encode(pa.array([text]))[0].as_py(), "<u2").tolist() == want
        assert len(encoder.new) <= 50 + n


def test_given_texts(tokenizer):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    encoder = packing._encoder(None)
    for text, got in zip(texts, encoder.encode(pa.array(texts)).to_pylist()):
        assert np.frombuffer(got, "<u2").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_first_fit_equals_plain_search():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.randrange(1, 101) for _ in range(rng.randrange(60))]
        bins = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            home = next((b for b in bins if sum(sizes[j] for j in b) + sizes[i] <= 100), None)
            home.append(i) if home is not None else bins.append([i])
        assert packing.first_fit_decreasing(sizes, 100) == bins


def check(pieces, capacity):
    """All ids once, sequences gapless, little padding; returns the padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in pieces:
        assert length > 0
        docs[doc].append((start, length))
        sequences[sequence].append((offset, length))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return docs, padding


def test_plans_lose_nothing():
    rng = random.Random(2)
    for _ in range(300):
        lengths = [rng.choice([1, 5, 63, 64, 65, 300, rng.randrange(1, 500)]) for _ in range(rng.randrange(1, 50))]
        plan = packing.plan_group(lengths, 64)
        pieces = []
        for s, parts in enumerate(plan):
            offset = 0
            for doc, start, n in parts:
                pieces.append((doc, start, n, s, offset))
                offset += n
        docs, padding = check(pieces, 64)
        for doc, n in enumerate(lengths):
            at = 0
            for start, length in sorted(docs[doc]):
                assert start == at
                at += length
            assert at == n
        assert padding == 0


def test_round_trip(spark, tokenizer):
    rng = random.Random(5)
    rows = [(i, random_text(rng) * rng.choice([1, 1, 30])) for i in range(400)]
    rows += [(9000, None), (9001, ""), (9002, "long " * 30_000), (9003, "twice"), (9003, "twice"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    packed = packing.digest(packing.pack(df.selectExpr("*", "1 as ids", "2 as number"), group_docs=50)).collect()
    want = {id: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1] for id, text in rows}
    docs, padding = check([(r["doc_id"], r["start"], r["length"], r["sequence_id"], r["offset"]) for r in packed], 2048)
    assert padding == 0 and len({r["sequence_id"] >> 32 for r in packed}) > 3
    for row in packed:
        ids = want[row["doc_id"]]
        part = np.array(ids[row["start"] : row["start"] + row["length"]], "<u4")
        assert (row["ids_crc32"], row["doc_tokens"]) == (zlib.crc32(part.tobytes()), len(ids))
    for id, ids in want.items():
        copies = sum(1 for other, _ in rows if other == id)
        assert sum(length for _, length in docs[id]) == copies * len(ids)


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
