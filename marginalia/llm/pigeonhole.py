"""Benchmark decontamination by edit distance.

Items and documents are compared as lower-case words with one blank between. An
item with an error budget of k is split into k + 1 pieces: if a document holds
the item with at most k edits, at least one piece is in it unchanged. All
pieces of a bounded block of items make one automaton; a hit is verified with
Myers' bit-parallel distance on the surrounding text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, rows

# Edits allowed per character of an item, and the shortest piece worth looking up.
ERROR_RATE, MIN_PIECE = 0.08, 14
# Items shorter than this (in normalised characters) match whole words only.
SHORT_ITEM = 24
# Characters of items in one automaton; more items are scanned for in further passes.
BLOCK_CHARS = 16_000_000

_OTHER = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def budget(item: str, rate: float = ERROR_RATE, min_piece: int = MIN_PIECE) -> int:
    """Edits allowed: a share of the length, but few enough that pieces stay long."""
    return max(0, min(int(rate * len(item)), len(item) // min_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length and where they start."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any part of the text, where the first such part ends)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = mask, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, j + 1
        ph = ph << 1 & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return best, end


def splits_word(text: str, at: int) -> bool:
    """Whether a word goes on over ``at``; scripts from Thai on are written without blanks and have no such words."""
    return 0 < at < len(text) and all(c.isalnum() and c < "\u0e00" for c in text[at - 1:at + 1])


class ItemIndex:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_piece: int):
        import ahocorasick
        self.items = {}
        at = defaultdict(list)
        for item_id, text in items:
            if text:
                k = budget(text, rate, min_piece)
                self.items.setdefault((item_id, text), k)
        for (item_id, text), k in self.items.items():
            for start, piece in pieces(text, k):
                at[piece].append((item_id, text, k, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, budget) of each item that the text holds within its budget."""
        if self.empty or not text:
            return []
        windows: dict[tuple[int, str, int], list[list[int]]] = defaultdict(list)
        for last, (n, places) in self.automaton.iter(text):
            for item_id, item, k, start in places:
                a = last + 1 - n - start - k
                b = a + len(item) + 2 * k
                if len(item) < SHORT_ITEM and (splits_word(text, a) or splits_word(text, b)):
                    continue
                own = windows[item_id, item, k]
                # neighbouring hits share a window, so a text of many hits is verified once
                if own and a <= own[-1][1] and b >= own[-1][0]:
                    own[-1] = [min(a, own[-1][0]), max(b, own[-1][1])]
                else:
                    own.append([a, b])
        found: dict[int, tuple[int, int]] = {}
        for (item_id, item, k), spans in windows.items():
            best = k + 1
            for a, b in spans:
                part = text[max(0, a):b]
                best = min(best, 0 if item in part else myers(item, part)[0])
                if not best:
                    break
            if best <= k and (item_id not in found or best < found[item_id][0]):
                found[item_id] = (best, k)
        return [(i, d, k) for i, (d, k) in found.items()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, min_piece: int = MIN_PIECE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, budget): documents that hold a test item within its error budget.

    Reads doc_id and text, and item_id and text. Null or empty texts hold
    nothing; items under ``SHORT_ITEM`` characters are found unchanged and on word
    bounds, items without a letter or digit not at all; a doc_id or item_id
    that occurs several times gives one row per pair with the least distance;
    empty tables give no rows. The items of one automaton are bounded by
    ``block_chars``; a larger benchmark is split into blocks by a hash of the
    item, each scanned for in a pass of its own over all documents.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
                             ).where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-int(total) // block_chars) or 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "text is not null")
    schema = "doc_id long, item_id long, distance long, budget long"
    arrow = _arrow_schema(spark, schema)

    def scan(block: int) -> DataFrame:
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == block) if n_blocks > 1 else items
        shared = spark.sparkContext.broadcast([(r["item_id"], normalise(r["text"])) for r in own.collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(shared.value, rate, min_piece)
            for part in rows(batches):
                found = [(doc, *hit) for doc, text in zip(part["doc_id"], part["text"])
                         for hit in index.search(normalise(text))]
                if found:
                    yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, map(list, zip(*found)))), schema=arrow)

        return texts.mapInArrow(run, schema)

    hits = scan(0)
    for block in range(1, n_blocks):
        hits = hits.unionByName(scan(block))
    best = F.min(F.struct("distance", "budget")).alias("best")
    return hits.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.distance", "best.budget")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns as they are; rows without an id are kept."""
    leaked = find_leaks(docs, benchmark).select(F.col("doc_id").alias("__leaked")).distinct()
    return docs.join(leaked, docs["doc_id"].cast("long") == F.col("__leaked"), "left_anti")
