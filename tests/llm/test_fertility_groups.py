"""Quality rules: a rare language among thousands of documents of another."""

import random

import pytest

from marginalia.llm import fertility


@pytest.mark.parametrize("rare", [5, 29, 30])
def test_rare_language_keeps_clean_documents(make_docs, rare):
    r = random.Random(rare)
    english = "the house stands near a river and people walk along its green bank every day before they go home".split()
    finnish = "talo seisoo joen lähellä ja ihmiset kävelevät pitkin vihreää rantaa joka päivä ennen kuin menevät kotiin".split()
    write = lambda words: " ".join(r.choice(words) for _ in range(150))
    texts = [write(english) for _ in range(2000)] + [write(finnish) for _ in range(rare)]
    langs = ["en"] * 2000 + ["fi"] * rare
    texts.append(" ".join(w + "%$%" for w in texts[0].split()))
    langs.append("en")
    rows = {x["doc_id"]: x for x in fertility.fertility_rules(make_docs(texts, langs)).collect()}
    assert all(rows[2000 + k]["kept"] for k in range(rare))
    assert not rows[len(texts) - 1]["kept"]


def test_bands_are_exact_and_equal_in_every_order(spark):
    """Against numpy, and the same to the last bit however the rows lie."""
    import numpy as np
    r = random.Random(5)
    rows = [("en" if r.random() < 0.9 else "fi", r.randint(50, 3000), r.gauss(4, 0.5), r.gauss(3, 0.4), r.random() ** 8, r.random())
            for _ in range(6000)]
    names = ["piece_chars", "byte_chars", "fallback_share", "entropy"]
    df = spark.createDataFrame([(g, n, 0, *m) for g, n, *m in rows],
                               "grp string, n_words long, n_repeat_words long, " + ", ".join(f"{m} double" for m in names))
    found = [sorted(map(str, fertility.fertility_bands(df.repartition(n, *by)).select(
        "grp", "n_group", *[f"{m}_{x}" for m in names for x in ("median", "spread")]).collect())) for n, by in ((1, ()), (7, ()), (5, ("entropy",)))]
    assert found[0] == found[1] == found[2]
    for band in fertility.fertility_bands(df).collect():
        own = [x for x in rows if x[0] == band["grp"]]
        assert band["n_group"] == len(own)
        for k, m in enumerate(names):
            scaled, _, _, least = fertility.BANDS[m]
            v = np.array([x[k + 2] for x in own])
            off = (v - np.median(v)) * (np.sqrt([x[1] for x in own]) if scaled else 1)
            low, high = np.quantile(off, [0.25, 0.75])
            assert abs(band[f"{m}_median"] - np.median(v)) < 1e-4
            assert abs(band[f"{m}_spread"] - max((high - low) / 1.349, least)) < 2e-3
