"""N-gram join, decontamination and secret scan against brute force."""

import hashlib
import random
import re

from marginalia.llm import ngram_join as nj
from marginalia.llm import pigeonhole as ph
from marginalia.llm import secret_markov as sm
from marginalia.llm.graph import connected_components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(zip(*[words[k:] for k in range(size)])) if len(words) >= size else frozenset([tuple(words)])


def brute(texts, size, percent):
    sets, root = [shingles(t, size) for t in texts], list(range(len(texts)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in range(len(sets))}


def near_copies():
    r = random.Random(2)
    base = [[f"w{r.randint(0, 400)}" for _ in range(r.choice([3, 30, 90, 200]))] for _ in range(25)]
    texts = [None, "", " \n ", "one", "One", "one two", "same line\n" * 50]
    for words in base:
        for _ in range(r.randint(1, 9)):
            own = list(words)
            for _ in range(r.randint(0, 4)):
                own[r.randrange(len(own))] = f"e{r.randint(0, 9999)}"
            texts.append(" ".join(own))
    return texts + texts[7:17]


def test_join_equals_brute_force(make_docs, monkeypatch):
    texts = near_copies()
    for size, percent in ((3, 90), (5, 80)):
        for cells in ((1 << 18, 256), (300, 3)):  # the second splits every blob over cells
            monkeypatch.setattr(nj, "CELL_SHINGLES", cells[0])
            monkeypatch.setattr(nj, "CELL_SETS", cells[1])
            got = nj.jaccard_groups(make_docs(texts), size, percent).collect()
            assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(texts, size, percent)


def test_keep_one(make_docs):
    docs = make_docs(near_copies())
    kept = nj.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in brute(near_copies(), 3, 90).values()})
    assert nj.keep_one(make_docs([])).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (7, 9), (3, 3), (5, 6)], "u long, v long")
    assert sorted(map(tuple, connected_components(links).collect())) == [
        (1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (7, 7), (8, 7), (9, 7)]


def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers():
    r = random.Random(1)
    for _ in range(300):
        p, t = ("".join(r.choice("abc ") for _ in range(r.randint(1, n))) for n in (80, 120))
        assert ph.myers(p, t)[0] == min(len(p), edit_distance(p, t))


def test_leaks(spark, make_docs):
    r = random.Random(4)
    items = [" ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(12)) for _ in range(6)]
    edited = items[1][:30] + "X" + items[1][31:50] + items[1][52:]
    far = "".join(c if k % 4 else "z" for k, c in enumerate(items[2]))
    texts = ["pre " + items[0].upper().replace(" ", ",\n") + " post", edited, far, None, "", items[3] + " " + items[4], items[5][:40]]
    bench = spark.createDataFrame([*enumerate(items), (6, None), (7, "short"), (0, items[0])], "item_id long, text string")
    for block in (10**6, 100):
        found = {(x["doc_id"], x["item_id"]): x["distance"] for x in ph.find_leaks(make_docs(texts), bench, block_chars=block).collect()}
        assert found == {(0, 0): 0, (1, 1): 3, (5, 3): 0, (5, 4): 0}
    assert [x["doc_id"] for x in ph.drop_leaks(make_docs(texts), bench).orderBy("doc_id").collect()] == [2, 3, 4, 6]
    assert ph.find_leaks(make_docs([]), bench).count() == 0


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def test_secret_spans(make_docs):
    texts = [None, "", 'é "Api_Key": "abcdef123" password = short token=abc secret: token: zzzzzzzz', "AKIA" + "A1" * 8 + " AKIAZ",
             "x" + "0af" * 9 + "z 0123abcd", "kX9fQ2LmZt7RbW4sPq1V and getUserAccountByEmailAddress", "PASSWD='" + "q" * 300 + "'", "no secrets here"]
    for row in sm.scan_secrets(make_docs(texts)).collect():
        text = texts[row["doc_id"]] or ""
        base = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        base += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        base += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        written = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(base))
        assert row["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in base) for k in range(3)]
        if row["doc_id"] == 5:
            assert row["spans"] == "markov:0:20"
    assert sm.scan_secrets(make_docs([])).count() == 0


def test_short_items(spark, make_docs):
    items = ["Why is it so?", "光合作用在植物的哪个部分进行？", "?!", "cat", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = ["He asked: why is it so? Nobody knew.", "why is it solved", "请问光合作用在植物的哪个部分进行？谢谢", "a concatenated list of cats", "The CAT.", "why, is it SO", "?!", None]
    found = {(r["doc_id"], r["item_id"], r["distance"]) for r in ph.find_leaks(make_docs(texts), bench).collect()}
    assert found == {(0, 0, 0), (2, 1, 0), (4, 3, 0), (5, 0, 0)}
