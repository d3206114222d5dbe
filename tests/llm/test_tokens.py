"""Word-piece encoding, the length histogram and the direct codes against the tokenizer itself."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from marginalia.llm import direct_codes as dc
from marginalia.llm import length_histogram as lh
from marginalia.llm.common import public_tokenizer
from marginalia.llm.tokens import VOCABULARY, WordEncoder

TOKENIZER = Tokenizer.from_file(public_tokenizer(VOCABULARY))
TEXTS = ["One two,  three.\n\nFour", "", None, "été à  la\tmer 😀", "one " * 5000, "One two,  three.\n\nFour", " x\n", "　a \x1cb"]


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_whole_texts():
    encoder, r = WordEncoder(public_tokenizer(VOCABULARY)), random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\x85", "\xa0", "\x1c", "'s", "!", "é", "中", "1", "word", "don't", "<|endoftext|>", "²"]
    for text in TEXTS + ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(3000)]:
        ids = encoder.ids(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == whole(text), text


def test_codes_round_trip_and_random_access():
    r = random.Random(5)
    ids = np.array([r.choice([0, 3, 255, 256, 50256, 70000, 2**31]) for _ in range(5000)], "<u4")
    codes = dc.DirectCodes(pa.BufferReader(dc.encode_file([4, None], [ids[:10].tobytes(), ids[10:].tobytes()])))
    assert codes.slice(0, 5000).tolist() == ids.tolist()
    for i in (0, 511, 512, 513, 4095, 4999):
        assert codes.token(i) == ids[i]
    docs, starts = codes.docs(0, 2)
    assert docs == [4, None] and starts.tolist() == [0, 10, 5000]


def test_digest_of_files(make_docs):
    got = sorted((tuple(x) for x in dc.token_codes(make_docs(TEXTS)).collect()))
    start = 0
    for i, text in enumerate(TEXTS):
        ids = np.array([*whole(text), 0], "<u4")
        assert got[i] == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert dc.token_codes(make_docs([])).count() == 0


def test_histogram(make_docs):
    lengths = sorted(len(whole(t)) for t in TEXTS)
    hist = lh.length_histogram(make_docs(TEXTS))
    for row in hist.collect():
        n = row["n_tokens"]
        assert row["n_docs"] == lengths.count(n)
        assert row["docs_longer"] == sum(x > n for x in lengths)
        assert row["tokens_longer"] == sum(x for x in lengths if x > n)
        assert row["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert (row["rank_low"], row["total_tokens"]) == (lengths.index(n), sum(lengths))
    limits = [0, 1, 7, 10**6]
    assert [r["truncated_tokens"] for r in lh.truncated_totals(hist, limits).collect()] == [
        sum(min(x, c) for x in lengths) for c in limits]
    assert hist.agg(lh.length_quantile(hist, 0.5)).first()[0] == lengths[3]
    assert lh.length_histogram(make_docs([])).count() == 0
