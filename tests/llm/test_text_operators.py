"""Extraction, quality rules, line spread, language ID and mixing."""

import random

from pyspark.sql import functions as F

from marginalia.llm import fertility, html_blocks, line_spread, soft_mixing, string_kernel_lang

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header><ul class="menu"><li><a href="/">Home</a></ul></header>
<div id="cookie-notice">We use cookies, agree please.</div><div class="sidebar"><p>Words beside the text.</div>
<article><h1>A &amp; B</h1><p>First <b>par</b>t&nbsp;of
 it.<p>Last.<div class="ad">Buy</div><form><label>Mail</label></form></article>
<section id="comments"><p>I disagree with all of this.</section><script>var a="</p>";</script><footer>&copy; me</footer>"""


def test_main_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (1, "u", PAGE, "x")],
                                  "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_blocks.extract_main_text(pages).collect())
    text = "A & B\nFirst part of it.\nLast."
    assert got == [(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0)]
    assert html_blocks.extract_main_text(pages.limit(0)).count() == 0


def prose(r, vocabulary, n):
    return " ".join(r.choice(vocabulary) for _ in range(n))


def test_fertility_counts_and_bands(make_docs):
    r = random.Random(1)
    words = "the house stands near a river and people walk along its green bank every day before they go home again".split()
    clean = [prose(r, words, 80) for _ in range(60)]
    texts = clean + [None, "", "a b c a b c", "x # y\nx # y\n\n\n z|", " ".join(w + "%$%" for w in clean[0].split()), clean[0]]
    rows = {x["doc_id"]: x for x in fertility.fertility_rules(make_docs(texts)).collect()}
    assert (rows[62]["n_words"], rows[62]["n_repeat_words"], rows[62]["base_failed"]) == (6, 6, True)
    assert (rows[63]["n_words"], rows[63]["word_chars"], rows[63]["n_symbols"], rows[63]["n_dup_lines"]) == (7, 8, 3, 1)
    assert rows[60]["n_words"] == rows[61]["n_words"] == 0 and rows[60]["base_failed"]
    assert all(rows[k]["kept"] for k in range(60)) and rows[65]["kept"]
    assert not rows[64]["kept"] and "low" in rows[64]["reasons"]
    docs = make_docs(texts)
    assert fertility.keep_fertile(docs).columns == docs.columns and fertility.keep_fertile(docs).count() == 61
    assert fertility.fertility_rules(make_docs([])).count() == 0


def test_line_spread(make_docs):
    texts = [f"own line {i}\n  shared line \n\nleft over" for i in range(12)] + [None, "", "shared line"]
    rows = {x["doc_id"]: x for x in line_spread.remove_boilerplate(make_docs(texts)).collect()}
    assert rows[0]["text"] == texts[0] and rows[0]["n_removed"] == 0
    assert rows[3]["text"] == "own line 3\n" and (rows[3]["n_lines"], rows[3]["n_removed"]) == (4, 2)
    assert rows[12]["text"] is None and rows[13]["text"] == "" and rows[14]["text"] == ""
    assert line_spread.remove_boilerplate(make_docs([])).count() == 0


def test_language_held_out(make_docs):
    r = random.Random(2)
    bags = {"en": "the and with from this that house water".split(), "de": "der und nicht mit straße haus wasser für".split(),
            "fr": "les avec dans été maison leur eau où".split()}
    langs = [r.choice(list(bags)) for _ in range(300)]
    texts = [prose(r, bags[g], r.randint(2, 30)) for g in langs] + [None, "", "12 34 !", texts_long(bags["de"])]
    langs += [None, "en", None, None]
    rows = string_kernel_lang.identify_language(make_docs(texts, langs)).collect()
    held = [x for x in rows if x["held_out"] and x["doc_id"] < 300]
    assert len(held) > 40 and sum(x["lang_pred"] == langs[x["doc_id"]] for x in held) / len(held) > 0.95
    by = {x["doc_id"]: x for x in rows}
    assert [by[k]["lang_pred"] for k in (300, 301, 302, 303)] == ["und", "und", "und", "de"]
    assert all(0 <= x["score"] <= 1 for x in rows)
    assert string_kernel_lang.identify_language(make_docs([])).count() == 0


def texts_long(bag):
    return " ".join(bag) * 20000


def test_mixing_meets_targets(spark, make_docs):
    r = random.Random(3)
    plain, rude = "the house stands near a river".split(), "trash scum idiot".split()
    bad = [r.random() < 0.3 for _ in range(200)]
    texts = [prose(r, plain, 40) + (" " + " ".join(rude) if b else "") for b in bad] + [None, ""]
    labels = spark.createDataFrame([(i, 1, int(b)) for i, b in enumerate(bad[:120])] + [(None, 1, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    rates = soft_mixing.mix(make_docs(texts), soft_mixing.quality_domains(labels), {"clean": 0.9, "toxic": 0.1})
    total = rates.agg(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col("p")[k]) for k in (0, 1)], F.sum("n_tokens")).first()
    assert abs(total[0] / total[2] - 0.9) < 0.01 and abs(total[1] / total[2] - 0.1) < 0.01
    assert rates.where("rate < 0").count() == 0 and rates.count() == 202
    docs = make_docs(texts)
    assert soft_mixing.apply_rates(docs, rates, most=1).columns == docs.columns
    assert soft_mixing.mix(make_docs([]), soft_mixing.quality_domains(labels), {"clean": 0.9, "toxic": 0.1}).count() == 0
