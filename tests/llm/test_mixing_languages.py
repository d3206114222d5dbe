"""Mixing: words that mark a domain in one language only."""

import random

from pyspark.sql import functions as F

from marginalia.llm import soft_mixing


def test_markers_of_a_rare_language(spark, make_docs):
    """Toxic words of a language with a fiftieth of the toxic labels are found, also as endings change."""
    r = random.Random(4)
    plain = {"en": "the house stands near a river and people walk along".split(),
             "sv": "huset ligger nära en flod och folk går längs den".split()}
    rude = {"en": ["trash", "scum", "idiot"], "sv": ["skräp" + e for e in ("et", "en", "ar", "ig", "igt", "iga")]}
    langs = ["en"] * 1600 + ["sv"] * 200
    bad = [r.random() < (0.5 if g == "en" else 0.12) for g in langs]
    texts = [" ".join([r.choice(plain[g]) for _ in range(30)] + [r.choice(rude[g]) for _ in range(2 * b)])
             for g, b in zip(langs, bad)]
    held = [i % 4 == 0 for i in range(len(texts))]
    labels = spark.createDataFrame([(i, 1, int(b)) for i, (b, h) in enumerate(zip(bad, held)) if not h],
                                   "doc_id long, quality int, toxic int")
    docs = make_docs(texts, langs)
    members = soft_mixing.memberships(docs, soft_mixing.quality_domains(labels), ["clean", "toxic"])
    p = {x["doc_id"]: x["p"][1] for x in members.collect()}
    for g in ("en", "sv"):
        found = [p[i] > 0.5 for i in p if held[i] and bad[i] and langs[i] == g]
        wrong = [p[i] > 0.5 for i in p if held[i] and not bad[i] and langs[i] == g]
        assert sum(found) > 0.8 * len(found) > 0 and not any(wrong)
    # the language column is optional
    bare = soft_mixing.memberships(docs.select("doc_id", "text"), soft_mixing.quality_domains(labels), ["clean", "toxic"])
    assert bare.where(F.size("p") != 2).count() == 0 and bare.count() == len(texts)


def test_languages_without_a_domain(spark, make_docs):
    """One language has one domain only, one a single label, one word is in every document: no division by zero."""
    langs = ["en"] * 60 + ["de"] * 30 + ["fr"]
    bad = [i < 60 and i % 3 == 0 for i in range(91)]
    r = random.Random(5)
    texts = ["always " + " ".join(r.choices("abcdefghijklmnopqrst", k=20)) + " scum" * b for b in bad]
    rows = [(i, 1, int(b)) for i, b in enumerate(bad)]
    docs = make_docs(texts, langs)
    schema = "doc_id long, quality int, toxic int"
    for part in (rows, rows[60:], rows[90:], rows[:1], []):
        labels = soft_mixing.quality_domains(spark.createDataFrame(part, schema))
        members = soft_mixing.memberships(docs, labels, ["clean", "low", "toxic"]).collect()
        assert len(members) == 91 and all(abs(sum(m["p"]) - 1) < 1e-9 for m in members)
        if part is rows:
            assert all((m["p"][2] > 0.5) == bad[m["doc_id"]] for m in members)
