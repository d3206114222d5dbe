"""What the n-gram join posts, compares and moves; every similar pair meets."""

import random

import numpy as np

from marginalia.llm import ngram_join as nj

from .test_search import brute, near_copies


def posted(docs, size, percent):
    levels, heavy = nj.frequency_levels(docs, size)
    return nj.shingle_table(docs, levels, size, percent).where("n > 0"), heavy


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(3)
    level = r.integers(0, 40, 1 << 20).astype(np.uint64)
    posts = lambda own, percent: set(nj.signatures(
        own, level[(own >> np.uint64(64 - nj.SKETCH_BITS)).astype(np.int64)], percent).tolist())
    for percent in (50, 80, 90, 97):
        for n in [*range(1, 60), *r.integers(60, 3000, 60)]:
            own = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1))
            for gone in {0, int(r.integers(0, n)), n * (100 - percent) // (100 + percent), n * (100 - percent) // 100}:
                kept = r.permutation(own)[gone:]
                # the most that may be added
                added = max(0, (100 * len(kept) - percent * n) // percent)
                other = np.unique(np.concatenate([kept, r.integers(0, 1 << 63, added, dtype=np.uint64)]))
                common = len(np.intersect1d(own, other))
                if gone + added and 100 * common >= percent * (n + len(other) - common):
                    assert posts(own, percent) & posts(other, percent), (percent, n, gone, added)


def test_unlike_texts_of_common_shingles_are_not_compared(make_docs):
    r = random.Random(5)
    words = [f"w{k}" for k in range(12)]
    docs = make_docs([" ".join(r.choices(words, k=120)) for _ in range(400)])  # a shingle is in 27 texts
    classes, heavy = posted(docs, 3, 90)
    assert nj.candidate_chains(classes, heavy, 90).count() < 100


def test_a_common_phrase_joins_nothing(make_docs):
    r = random.Random(6)
    phrase = " ".join(f"p{k}" for k in range(60))
    docs = make_docs([phrase + " " + " ".join(f"w{r.randint(0, 10**6)}" for _ in range(60)) for _ in range(400)])
    classes, heavy = posted(docs, 3, 90)
    assert nj.candidate_chains(classes, heavy, 90).count() < 100


def test_texts_that_stay_are_not_shuffled(make_docs, monkeypatch):
    texts, plan = near_copies(), lambda df: df._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan(nj.keep_one(make_docs(texts)))
    wanted = sorted({c for _, c in brute(texts, 3, 90).values()})
    monkeypatch.setattr(nj, "KEYS_SENT", 0)
    assert sorted(r["doc_id"] for r in nj.keep_one(make_docs(texts)).collect()) == wanted


def test_repeated_rows_stay_once(make_docs):
    texts, ids = ["a b c d e", "a b c d e", "a b c d e", "", "", "x y", None, None], [4, 4, 3, 7, 7, 8, 9, 9]
    kept = nj.keep_one(make_docs(texts, ids=ids)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["text"] is not None) == [(3, "a b c d e"), (7, ""), (8, "x y")]
    assert [r["doc_id"] for r in kept if r["text"] is None] == [9]
