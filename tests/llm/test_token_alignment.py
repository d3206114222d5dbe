"""Alignment against whole-text encoding; fragments against whole texts."""

import hashlib
import random
from collections import Counter
from functools import reduce

import pytest
import public_tokenizers

from marginalia.llm import token_alignment as ta
from marginalia.llm.tokens import _byte_letters

POOL = [" ", "  ", "\n", "\n\n", " \n", "\t", "\r", "\r\n", "a", "word", "Word", "don't", "123", "4567", "é", "中文字", "😀", "▁",
        "<s>", "<|endoftext|>", "<0x41>", " ", "　", "...", ";\r", "\x00", "\x1c", "ﬁ", "x" * 40, "end.", "Über,"]


def plain(docs):
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    letters = {c: k for k, c in _byte_letters().items()}
    vocabulary = {i: s for s, i in a.get_vocab().items()}

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    rows, count = [], Counter()
    for i, text in docs:
        groups, links, x, y = [], [], [], []
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            xs, ys = [bytes(letters[c] for c in vocabulary[k]) for k in x], [b_bytes(k) for k in y]
            if not b"".join(xs) == b"".join(ys) == (" " + text).encode():
                x, y = [], []
            else:
                sx, sy = spans(xs), spans(ys)
                cuts = [0, *sorted({e for _, e in sx} & {e for _, e in sy})]
                for s, e in zip(cuts, cuts[1:]):
                    groups.append(",".join(str(k) for k, (p, q) in zip(x, sx) if s <= p and q <= e) + "|"
                                  + ",".join(str(k) for k, (p, q) in zip(y, sy) if s <= p and q <= e))
                links = [(k, m) for k, (p, q) in zip(x, sx) for m, (u, v) in zip(y, sy) if p < v and u < q]
        count.update(links)
        rows.append((i, len(x), len(y), groups, links))
    top = {}
    for (_, m), n in count.items():
        top[m] = max(top.get(m, 0), n)
    return sorted([(i, nx, ny, len(g), len(k), sum(count[z] == top[z[1]] for z in k), sum(count[z] for z in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, nx, ny, g, k in rows], key=str)


@pytest.fixture(scope="module")
def docs():
    r = random.Random(2)
    rows = [(i if i % 17 else None, None if i % 50 == 0 else "".join(r.choices(POOL, k=r.randrange(40)))) for i in range(250)]
    fixed = [" ", "\n", "a ", " a", "", "x" * 700, "中文" * 300, "one two.\nThree "]
    return rows + rows[:20] + [(1000 + i, t) for i, t in enumerate(fixed)] * 2


@pytest.mark.parametrize("sizes", [{}, {"chunk": 13, "fan": 8, "block": 300}])
def test_against_whole_texts(spark, docs, sizes):
    df = spark.createDataFrame([(*d, "g", 3) for d in docs], "doc_id long, text string, groups string, n_a int")
    got = ta.alignment_scores(df, **sizes).collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted([tuple(x[c] for c in names) for x in got], key=str) == plain(docs)


def test_composition_is_associative():
    own = ta.Aligner(ta.public_tokenizer(ta.A_VOCABULARY), ta.public_tokenizer(ta.B_VOCABULARY))
    r = random.Random(5)
    for _ in range(200):
        text = " " + "".join(r.choices(POOL, k=r.randrange(1, 12)))
        cuts = sorted({0, len(text), *(r.randrange(len(text)) for _ in range(3))})
        parts = [own.fragment(text[a:b]) for a, b in zip(cuts, cuts[1:])]
        left, right = reduce(own.compose, parts), reduce(lambda y, x: own.compose(x, y), reversed(parts))
        assert left == right and own.whole(left) == own.whole(own.fragment(text))


def test_nothing(spark):
    assert ta.alignment_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
