"""Cross-tokenizer alignment as an associative monoid of byte-range fragments.

Two public vocabularies, A (byte-level) and B (pieces with byte fallback), cut
the same bytes into tokens; where both end, a group ends. A chunk of a text,
cut at any place, is a fragment: an open prefix (what comes before the first
place where neither tokenizer can look across), closed groups, an open suffix.
Fragments compose: the left suffix and the right prefix together close groups
of their own. Composition is associative, so fragments of a very long document,
made by different tasks, are reduced as a tree.

Both tokenizers always cut before a blank or newline that follows something else
than white space: B has no piece with a blank after another character and
none with a newline. The units between such places repeat, and a bounded memo
per Python worker holds their groups.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, _arrow_schema, held, map_rows, materialize, public_tokenizer, row_key
from .tokens import _CUT, _UNUSUAL, _byte_letters

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Characters of a chunk, and fragments that one step of the tree composes.
CHUNK, FAN = 1 << 16, 8
# Id pairs held by a task at a time; more pairs are looked up in further passes.
PAIR_BLOCK = 2_000_000
# A pair is one number: the id of A above the bits of B's.
B_BITS = 15

# A unit of letters and marks: neither tokenizer joins a letter and a mark that follows it.
_PLAIN = re.compile(r"(?:(\n)|(?= ))( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)")
# Groups as text; the numbers of A's tokens, B's tokens and groups in one number; the id pairs of the links.
Found = tuple[str, int, bytes]
# The number of a unit whose bytes a tokenizer changes.
_CHANGED = 1 << 120


class Closed(NamedTuple):
    """Groups in order as text, the numbers of A's tokens, B's tokens and groups, the id pair of each link; ``ok`` false
    if a tokenizer's bytes aren't the text's."""

    groups: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    pairs: bytes = b""
    ok: bool = True

    def __add__(self, other: Closed) -> Closed:
        if not (self.ok and other.ok):
            return Closed(ok=False)
        both = f"{self.groups};{other.groups}" if self.groups and other.groups else self.groups or other.groups
        return Closed(both, self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups,
                      self.pairs + other.pairs)


class Fragment(NamedTuple):
    """``closed`` is None where nothing is closed: then all of it is ``prefix``."""

    prefix: str
    closed: Closed | None = None
    suffix: str = ""


class Aligner:
    """Groups of units, and the monoid of fragments over them."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.tokenize = self.a.model.tokenize
        letters = {c: b for b, c in _byte_letters().items()}
        self.letters = str.maketrans({chr(b): c for c, b in letters.items()})
        self.a_bytes = {i: bytes(map(letters.__getitem__, s)) for s, i in self.a.get_vocab().items()
                        if all(c in letters for c in s)}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.names = [str(i) for i in range(max(max(self.a_bytes), len(self.b_bytes)) + 1)]
        self.blank = self.b.piece_to_id("▁")
        self.units = Remembered(self._unit, 200_000)

    def _unit(self, unit: str) -> Found:
        """Groups of a unit, which starts with a blank or newline and is cut off at both ends, or of a part of a plain one."""
        plain = _PLAIN.fullmatch(unit)
        if plain is None:
            if unit[0] == " ":
                b = self.b.encode(unit[1:]) if len(unit) > 1 else [self.blank]
            elif unit[0] == "\n":
                b = self.b.encode(unit)[1:]  # B adds a blank, which never joins a newline
            else:  # letters after a newline, or marks
                b = self.b.encode("\n" + unit)[2:]
            return self._groups(unit, self.a.encode(unit, add_special_tokens=False).ids, b)
        newline, stem, marks = plain.groups()
        if not newline and not marks:
            a = [t.id for t in self.tokenize(stem.encode().decode("latin-1").translate(self.letters))]
            return self._groups(stem, a, self.b.encode(stem[1:]))
        # no token of either goes beyond its part
        found = [self.units["\n"], self.units[stem]] if newline else [self.units[stem]]
        if marks:
            found.append(self.units[marks])
        groups, counts, pairs = zip(*found)
        return ";".join(groups), sum(counts), b"".join(pairs)

    def _groups(self, text: str, a: list[int], b: list[int]) -> Found:
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if not b"".join(a_parts) == b"".join(b_parts) == text.encode("utf-8", "surrogatepass"):
            return "", _CHANGED, b""
        names, last, groups, pairs, i, j, a_from, b_from = self.names, len(a) - 1, [], [], 0, 0, 0, 0
        a_end, b_end = len(a_parts[0]), len(b_parts[0])
        while True:
            # the bytes up to the nearer end are one link
            pairs.append(a[i] << B_BITS | b[j])
            if a_end < b_end:
                i += 1
                a_end += len(a_parts[i])
            elif b_end < a_end:
                j += 1
                b_end += len(b_parts[j])
            else:
                left = names[a[i]] if i == a_from else ",".join([names[k] for k in a[a_from:i + 1]])
                right = names[b[j]] if j == b_from else ",".join([names[k] for k in b[b_from:j + 1]])
                groups.append(f"{left}|{right}")
                if i == last:
                    break
                a_from, b_from = i, j = i + 1, j + 1
                a_end += len(a_parts[i])
                b_end += len(b_parts[j])
        return (";".join(groups), len(a) | len(b) << 40 | len(groups) << 80, struct.pack(f"<{len(pairs)}i", *pairs))

    def closed(self, text: str) -> Closed:
        """Groups of a stretch that starts with a blank or newline and is cut off at both ends."""
        if not text:
            return Closed()
        if any(map(text.__contains__, _UNUSUAL)):
            units = _CUT.split(text)
        else:
            units = [u if u[:1] == "\n" else " " + u for u in text.replace("\n", " \n").split(" ")[1:]]
        groups, counts, pairs = zip(*map(self.units.__getitem__, units))
        low = (1 << 40) - 1
        total = sum(counts)
        if total >= _CHANGED:
            return Closed(ok=False)
        return Closed(";".join(groups), total & low, total >> 40 & low, total >> 80 & low, b"".join(pairs))

    def fragment(self, chunk: str) -> Fragment:
        first = _CUT.search(chunk)
        if first is None:
            return Fragment(chunk)
        # the last cut: whatever is white space before it is tried from the end
        last = first.start()
        at = len(chunk)
        while (at := max(chunk.rfind(" ", 0, at), chunk.rfind("\n", 0, at))) > last:
            if not chunk[at - 1].isspace():
                last = at
                break
        return Fragment(chunk[:first.start()], self.closed(chunk[first.start():last]), chunk[last:])

    def compose(self, x: Fragment, y: Fragment) -> Fragment:
        if x.closed is None and y.closed is None:
            return self.fragment(x.prefix + y.prefix)
        if x.closed is None:
            whole = self.fragment(x.prefix + y.prefix)
            if whole.closed is None:
                return Fragment(whole.prefix, y.closed, y.suffix)
            return Fragment(whole.prefix, whole.closed + self.closed(whole.suffix) + y.closed, y.suffix)
        if y.closed is None:
            whole = self.fragment(x.suffix + y.prefix)
            if whole.closed is None:
                return Fragment(x.prefix, x.closed, whole.prefix)
            return Fragment(x.prefix, x.closed + self.closed(whole.prefix) + whole.closed, whole.suffix)
        return Fragment(x.prefix, x.closed + self.closed(x.suffix + y.prefix) + y.closed, y.suffix)

    def whole(self, f: Fragment) -> Closed:
        """Groups of a text from its fragment; the blank before the text is part of it."""
        if f.closed is None:
            return self.closed(f.prefix)
        return self.closed(f.prefix) + f.closed + self.closed(f.suffix)


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker, kept between tasks."""
    return held(("alignment", a_path, b_path), lambda: Aligner(a_path, b_path))


_COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, times array<int>"


def _columns(found: list[Closed | None]) -> dict[str, list]:
    """Columns of whole texts; None and what isn't ok have no tokens."""
    out: dict[str, list] = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")}
    for c in found:
        c = c if c is not None and c.ok else Closed()
        pairs, times = np.unique(np.frombuffer(c.pairs, "<i4"), return_counts=True)
        for name, value in zip(out, (c.n_a, c.n_b, c.n_groups, len(c.pairs) // 4, c.groups, pairs, times.astype(np.int32))):
            out[name].append(value)
    return out


def align(docs: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every row of ``docs`` (doc_id, text).

    ``groups`` names the ids of each group, ``pairs`` the distinct id pairs of
    the document's links (A's id above ``B_BITS`` bits of B's), ``times`` how many links hold
    each. Null and empty texts, and texts whose bytes a tokenizer changes, have
    zeros and an empty ``groups``. Texts over ``chunk`` characters are cut anywhere and
    composed as a tree, ``fan`` fragments a step; repeated rows among them are
    aligned once and returned as often as they occur. Extra columns aren't
    read; an empty table gives no rows.
    """
    paths = public_tokenizer(A_VOCABULARY), public_tokenizer(B_VOCABULARY)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.length("text") > chunk, F.lit(False))

    def make() -> Callable[[dict], dict]:
        own = aligner(*paths)

        def run(part: dict[str, list]) -> dict[str, list]:
            return {"doc_id": part["doc_id"]} | _columns([own.closed(" " + t) if t else None for t in part["text"]])

        return run

    short = map_rows(slim.where(~long), f"doc_id {id_type}, {_COUNTS}", make)
    longest = slim.agg(F.max(F.length("text"))).first()[0] or 0
    if longest <= chunk:
        return short
    # very long texts: chunks to all tasks, fragments back by document
    keyed = slim.where(long).groupBy("doc_id", row_key("doc_id", "text").alias("k1"), F.md5("text").alias("k2")).agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    pieces = keyed.select("doc_id", "k1", "k2", "copies", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk)),
        lambda i: F.substring(F.col("text"), (i * chunk + 1).cast("int"), F.lit(chunk)))).alias("part", "text"))
    schema = (f"doc_id {id_type}, k1 long, k2 string, copies long, part long, prefix string, open boolean, suffix string, "
              "groups string, n_a long, n_b long, n_groups long, pairs binary, ok boolean")
    keys = ("doc_id", "k1", "k2", "copies")
    arrow = _arrow_schema(docs.sparkSession, schema)

    def row(head: tuple, part: int, f: Fragment) -> tuple:
        c = f.closed or Closed()
        return (*head, part, f.prefix, f.closed is None, f.suffix, c.groups, c.n_a, c.n_b, c.n_groups, c.pairs, c.ok)

    def make_fragments() -> Callable[[dict], dict]:
        own = aligner(*paths)

        def run(part: dict[str, list]) -> dict[str, list]:
            out = []
            for *head, i, text in zip(*(part[c] for c in (*keys, "part", "text"))):
                out.append(row(head, i, own.fragment(text if i else " " + text)))
            return {c: [r[k] for r in out] for k, c in enumerate(arrow.names)}

        return run

    fragments = map_rows(pieces.repartition("k1", "part"), schema, make_fragments)

    def compose(t: pa.Table) -> pa.Table:
        own = aligner(*paths)
        rows = sorted(t.to_pylist(), key=lambda r: r["part"])
        read = [Fragment(r["prefix"], None if r["open"] else Closed(r["groups"], r["n_a"], r["n_b"], r["n_groups"], r["pairs"],
                                                                    r["ok"]), r["suffix"]) for r in rows]
        r = rows[0]
        out = row([r[c] for c in keys], r["part"] // fan, reduce(own.compose, read))
        return pa.Table.from_pylist([dict(zip(arrow.names, out))], schema=arrow)

    for _ in range(math.ceil(math.log(-(-longest // chunk), fan) - 1e-9)):
        fragments = fragments.groupBy("k1", "k2", "doc_id", F.floor(F.col("part") / fan).alias("group")).applyInArrow(
            compose, schema)

    def make_whole() -> Callable[[dict], dict]:
        own = aligner(*paths)

        def run(part: dict[str, list]) -> dict[str, list]:
            found = [own.whole(Fragment(p, None if o else Closed(g, a, b, n, x, ok), s)) for p, o, s, g, a, b, n, x, ok in zip(
                *(part[c] for c in ("prefix", "open", "suffix", "groups", "n_a", "n_b", "n_groups", "pairs", "ok")))]
            return {"doc_id": part["doc_id"], "copies": part["copies"]} | _columns(found)

        return run

    composed = map_rows(fragments, f"doc_id {id_type}, copies long, {_COUNTS}", make_whole)
    repeated = composed.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
    return short.unionByName(repeated)


def pair_table(aligned: DataFrame) -> DataFrame:
    """(pair, links, best): links of all documents that hold an id pair, and whether no pair of its B id has more."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(
        F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.times").cast("long")).alias("links"))
    links = links.withColumn("b", F.col("pair").bitwiseAND((1 << B_BITS) - 1))
    most = links.groupBy("b").agg(F.max("links").alias("most"))
    return links.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def score(aligned: DataFrame, pairs: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """``aligned`` with n_best and count_sum for ``pairs`` and ``times``.

    The table of pairs is bounded by the vocabularies, but not by what fits a
    task: it is dealt into blocks of about ``block`` pairs, each sent to all
    tasks and added up in a pass of its own.
    """
    spark = aligned.sparkSession
    n_blocks = -(-pairs.count() // block) or 1
    out = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for k in range(n_blocks):
        own = pairs.where(F.pmod(F.xxhash64("pair"), F.lit(n_blocks)) == k) if n_blocks > 1 else pairs
        got = own.toArrow()
        order = np.argsort(name := got["pair"].to_numpy())
        shared = spark.sparkContext.broadcast((name[order], got["links"].to_numpy()[order],
                                               got["best"].to_numpy(zero_copy_only=False)[order]))

        def add(batches, shared=shared):
            names, links, best = shared.value
            for batch in batches:
                found, times = batch["pairs"], batch["times"]
                value, n = found.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(names, value), max(0, len(names) - 1))
                hit = names[at] == value if len(names) else np.zeros(len(value), bool)
                size = np.diff(found.offsets.to_numpy())
                sums = []
                for each in (np.where(hit & (best[at] if len(names) else hit), n, 0), np.where(hit, n * (links[at] if len(names) else n), 0)):
                    total = np.r_[0, np.cumsum(each.astype(np.int64))]
                    ends = np.cumsum(size)
                    sums.append(total[ends] - total[ends - size])
                cols = {name: batch[name] for name in batch.schema.names}
                for name, extra in zip(("n_best", "count_sum"), sums):
                    cols[name] = pa.array(batch[name].to_numpy() + extra)
                yield pa.RecordBatch.from_arrays([pa.array(c) if not isinstance(c, pa.Array) else c for c in cols.values()],
                                                 names=list(cols))

        out = out.mapInArrow(add, out.schema)
    return out


def alignment_scores(docs: DataFrame, chunk: int = CHUNK, fan: int = FAN, block: int = PAIR_BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row of ``docs``; see ``align``.

    ``n_best`` counts the links whose id pair is, over all documents, among the
    most frequent ones of its B id; ``count_sum`` adds up the pairs' counts over links.
    """
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups"), 256))
    aligned = materialize(align(docs, chunk, fan).withColumn("groups_sha256", digest).drop("groups"), "aligned")
    pairs = materialize(pair_table(aligned), "pairs")
    return score(aligned, pairs, block).drop("pairs", "times")
