"""HTML extraction: held-out accuracy, marks, and pages whose text is known by construction."""

import random
from html import escape

import numpy as np

from marginalia.llm import html_blocks as hb


def held_out(marks: bool, folds: int = 5) -> float:
    """Share of the labelled blocks that trees grown on the other pages get right."""
    pages = hb.labelled_pages()
    right = total = 0
    for k in range(folds):
        rest = [p for i, p in enumerate(pages) if i % folds != k]
        if marks:
            tree = hb.grow_tree(*hb.labelled_blocks(rest))
        else:
            tree = hb.grow_tree(np.concatenate([p[0] for p in rest]), np.concatenate([p[1] for p in rest]),
                                marks_from=99, depth=6)
        for x, y in pages[k::folds]:
            right += sum(hb.is_main(tuple(f), tree) == bool(label) for f, label in zip(x, y))
            total += len(y)
    return right / total


def test_held_out_accuracy():
    assert held_out(marks=True) > 0.95
    assert held_out(marks=False) > 0.85  # words, links and places alone


def test_tree_asks_for_block_features_first():
    def walk(node, level=0):
        if isinstance(node, tuple):
            yield level, hb.FEATURES[node[0]]
            yield from walk(node[2], level + 1)
            yield from walk(node[3], level + 1)
    asked = list(walk(hb.tree()))
    assert all(f in hb.BLOCK_FEATURES for level, f in asked if level < 2)
    assert {"words", "links"} <= {f for _, f in asked}
    assert {f for _, f in asked} & {"prev_words", "prev_links", "next_words", "next_links"}


def test_marks_hold_whatever_the_block_looks_like():
    rng = np.random.default_rng(1)
    share = lambda: float(rng.choice([0.0, rng.random(), 1.0]))
    for _ in range(3000):
        own = (rng.integers(1, 200), share(), rng.integers(0, 200), share(), rng.integers(0, 200), share(),
               rng.random(), rng.random(), bool(rng.integers(2)))
        for marks, label in hb.MARKED:
            assert hb.is_main(own + marks) == bool(label)


def test_pages_without_marks():
    words = lambda n, w="word": " ".join([w] * n)
    assert hb.main_text("<div><p>Short page.</p></div>")[0] == "Short page."
    three = [words(30), words(25), words(18, "last")]
    assert hb.main_text("".join(f"<p>{p}</p>" for p in three))[0] == "\n".join(three)
    menu = "".join(f"<li><a href='/{k}'>Link {k}</a></li>" for k in range(6))
    body = [words(40), words(3, "yes"), words(60), words(35)]
    page = f"<div><ul>{menu}</ul></div><div>" + "".join(f"<p>{p}</p>" for p in body) + f"</div><ul>{menu}</ul>"
    assert hb.main_text(page)[0] == "\n".join(body)
    assert hb.main_text(f"<ul>{menu}</ul>")[0] == ""


def test_attribute_words_are_whole():
    page = ("<article><p class='share-price'>The price fell.</p><div id='notice-of-appeal'>A notice was filed.</div>"
            "<div class='comment-list'><p>me too</p></div><div class='left-sidebar'>more</div>"
            "<p class='social-share'>Tweet</p></article><div id='cookie_banner'>We use cookies.</div>")
    assert hb.main_text(page)[0] == "The price fell.\nA notice was filed."


def test_open_controls_keep_the_page():
    for control in ("button", "select", "textarea"):
        page = f"<article><p>one two three</p><{control}><p>four five six seven</p></article>"
        assert "four five six seven" in hb.main_text(page)[0], control
    assert hb.main_text("<article><p>one two</p><script>var x = '<p>no</p>'")[0] == "one two"


def test_generated_pages(spark):
    random.seed(7)
    word = lambda: random.choice(["alpha", "Bêta", "x < y", "R&D", "\"q\"", "日本", "don't", "42"])
    text = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], {}
    for page_id in range(60):
        blocks = [text(random.choice([1, 3, 20, 90])) for _ in range(random.randint(1, 8))]
        inner = []
        for b in blocks:
            tag = random.choice(["p", "h2", "li", "blockquote", "td"])
            inner.append(f"<{tag}>\n " + escape(b).replace(" ", random.choice([" ", "\n", "\t ", " <b>", "&#32;"])) + f" </{tag}>")
            if random.random() < 0.3:
                inner.append(random.choice(["<aside>aside words</aside>", "<form><p>Name</p><input></form>",
                                            "<div class='ad'>buy this now</div>", "<style>p{}</style>", "<!-- <p>no</p> -->",
                                            "<section id='comments'><p>a reader writes</p></section>"]))
        rows.append((page_id, f"u{page_id}", "<nav><a href='/'>Home</a></nav><header>Site name</header><article>"
                     + "".join(inner) + "</article><footer>&copy; us</footer>"))
        want[page_id] = "\n".join(blocks)
    long = "very long " * 200_000
    rows += [(100, "u", f"<main><p>{long}</p></main>"), (101, None, None), (102, "u", ""), (0, "u0", rows[0][2])]
    want |= {100: long.strip(), 101: "", 102: ""}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = hb.extract_main_text(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text), r.page_id
