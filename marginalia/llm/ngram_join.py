"""Exact n-gram Jaccard join by T-occurrence search.

A document's set holds the hashes of its distinct word shingles. Equal sets
form a class; only classes are compared.

1. The range of the hashes is cut into k parts. Two sets that reach the
   similarity differ in at most h shingles, so in at most h parts; of the parts
   that are equal, the first in any order of contents is among the first h + 1
   of both sets. So a set posts a signature for each of its first h + 1 parts,
   those with the rarest shingles by a count sketch of the whole table (one
   bounded array), then those with the most. A signature holds several shingles:
   unlike a single shingle's its list doesn't grow with the table.
2. Classes that stand next to each other by size in a list are joined into
   blobs: every link lies within one. Sizes that rule out the similarity are
   left out on the way.
3. Blobs are dealt out in cells of bounded size; a task gets one cell or two.
   It searches each set against an inverted index of its cell: short lists are
   heap-merged, long ones binary-probed (DivideSkip), and sets that reach the
   required overlap are linked. A set already joined to the query's component
   isn't probed: the component can't change.
"""

from __future__ import annotations

import heapq
import itertools
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, held, materialize, rows
from .graph import Union, connected_components

SKETCH_BITS = 20
# A list is salted when its rarest shingle is so many times as frequent as the sketch's mean.
HEAVY, SALTS = 16, 32
# So many keys at most are sent to all tasks; by more of them rows are shuffled.
KEYS_SENT = 1 << 20
# A cell holds at most about so many shingles and sets.
CELL_SHINGLES, CELL_SETS = 1 << 18, 256
# Weight of DivideSkip's choice of how many lists are long.
MU = 0.002

_P = np.uint64(0x9E3779B97F4A7C15)


def _mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ code >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return code ^ code >> np.uint64(32)


class Shingler:
    """Sorted distinct shingle hashes of a text, over words of A-Z lower-cased bytes."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # at blanks of ASCII only
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.size:
            # the whole sequence is one shingle, apart from all shingles of full size
            return np.array([xxhash.xxh3_64_intdigest(b"\x20".join(words), seed=len(words))], np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        n = len(words) - self.size + 1
        code = h[:n].copy()
        for k in range(1, self.size):
            code = code * _P + h[k:n + k]
        code = np.sort(_mixed(code))
        return code[np.concatenate([[True], code[1:] != code[:-1]])]


def shingler_of(size: int) -> Shingler:
    """The shingler of this Python worker, kept between tasks."""
    return held(("shingles", size), lambda: Shingler(size))


def set_class(shingles: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(shingles.tobytes()), "<i8")[0])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text"))


def frequency_levels(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """(level of each bucket of the sketch, level from which a shingle is heavy), over all documents.

    Levels grow with the logarithm of the count. They order shingles and so
    decide how much is posted, never what is found.
    """
    width, chunk = 1 << SKETCH_BITS, 1 << 12
    arrow = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = shingler_of(size), np.zeros(width, np.uint64)
        for part in rows(batches):
            found = np.concatenate([shingler(t) for t in part["text"]] or [np.zeros(0, np.uint64)])
            at, n = np.unique((found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
            total[at] += n.astype(np.uint64)
        for k, own in enumerate(total.reshape(-1, chunk)):
            if own.any():
                yield pa.RecordBatch.from_pydict({"chunk": [k], "counts": [own.astype("<u8").tobytes()]}, schema=arrow)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for part in rows(batches):
            for k, own in zip(part["chunk"], part["counts"]):
                total[k] = total.get(k, 0) + np.frombuffer(own, "<u8")
        for k, own in total.items():
            yield pa.RecordBatch.from_pydict({"chunk": [k], "counts": [own.tobytes()]}, schema=arrow)

    schema = "chunk int, counts binary"
    merged = _texts(docs).select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(merge, schema)
    counts = np.zeros(width, np.uint64)
    for r in merged.collect():  # a sketch of fixed size
        counts[r["chunk"] * chunk:(r["chunk"] + 1) * chunk] = np.frombuffer(r["counts"], "<u8")

    def level(x):
        return np.minimum(127, (4 * np.log2(1 + x.astype(float))).astype(np.int64))

    heavy = int(level(np.array([max(64.0, HEAVY * float(counts.mean()))]))[0])
    return level(counts).astype(np.uint8), heavy


def most_apart(n: int, percent: int) -> int:
    """h: in how many shingles a set of n differs at most from any set that reaches the similarity."""
    return n * (100 - percent) // percent


def part_bits(n: int, percent: int) -> int:
    """The logarithm of the number of parts for sets of n; it grows by two, so that sets of most sizes have one number."""
    least = 5 * (most_apart(n, percent) + 1) // 4 + 6
    bits = (least - 1).bit_length()
    return bits + bits % 2


def signatures(own: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """What a set posts: the level of a part's rarest shingle leads, 56 bits name the part and all shingles in it.

    ``own``: sorted hashes, ``level``: their levels. Two sets use the number of parts of the smaller one, so a set near
    a step of that number posts for both. The order of parts rests on what they hold, so it is the same in all sets.
    """
    n, apart = len(own), most_apart(len(own), percent)
    if not apart:  # only an equal set reaches the similarity
        return np.zeros(0, np.int64)
    posted = []
    for bits in range(part_bits(-(-percent * n // 100), percent), part_bits(n, percent) + 1, 2):
        part = own >> np.uint64(64 - bits)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        name = _mixed(np.add.reduceat(own, first) + _P * (part[first] * np.uint64(64) + np.uint64(bits)))
        rarest = np.minimum.reduceat(level, first)
        held = np.minimum(np.add.reduceat(np.uint64(128) - level, first), np.uint64(4095))
        asked = min(1 << bits, apart + 1)
        rank = ((np.uint64(127) - rarest) >> np.uint64(3)) << np.uint64(60) | held << np.uint64(48) | name >> np.uint64(16)
        kept = np.argsort(rank, kind="stable")[-asked:]
        posted.append(rarest[kept] << np.uint64(56) | name[kept] >> np.uint64(8))
        if len(first) < asked:  # empty parts come last
            empty = np.setdiff1d(np.arange(min(1 << bits, asked + len(first)), dtype=np.uint64), part[first])[:asked - len(first)]
            posted.append(np.uint64(127 << 56) | _mixed(_P * (empty * np.uint64(64) + np.uint64(bits))) >> np.uint64(8))
    return np.concatenate(posted).astype(np.int64)


def shingle_table(docs: DataFrame, levels: np.ndarray, size: int, percent: int) -> DataFrame:
    """(doc_id, key, n, cls, posts) of every row; cls is null and posts empty for an empty set."""
    slim = _texts(docs)
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, key long, n long, cls long, posts array<long>"
    spark = docs.sparkSession
    arrow, shared = _arrow_schema(spark, schema), spark.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, level = shingler_of(size), shared.value.astype(np.uint64)
        for part in rows(batches):
            ns, classes, posts = [], [], []
            for text in part["text"]:
                own = shingler(text)
                ns.append(len(own))
                classes.append(set_class(own) if len(own) else None)
                posts.append(signatures(own, level[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], percent))
            yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "key": part["key"], "n": ns, "cls": classes,
                                              "posts": posts}, schema=arrow)

    return slim.mapInArrow(run, schema)


def candidate_chains(classes: DataFrame, heavy: int, percent: int) -> DataFrame:
    """(u, v) pairs of classes whose components hold every pair that reaches the similarity.

    A list of heavy shingles only is dealt over ``SALTS`` lists; the least class of each size band of
    each of them is chained in a second, small list.
    """
    is_heavy = F.shiftright("s", 56) >= heavy
    salt = F.when(is_heavy, F.pmod("cls", F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    posted = classes.select(F.explode("posts").alias("s"), "cls", "n").withColumn("salt", salt)
    by_size = Window.partitionBy("s", "salt").orderBy("n", "cls")
    own = (posted.withColumns({"u": F.lag("cls").over(by_size), "b": F.lag("n").over(by_size)})
           .where(F.col("b") * 100 >= F.col("n") * percent).select("u", F.col("cls").alias("v")))
    # bands narrower than the size ratio: compatible sizes are at most two bands apart
    narrow = 0.5 * (1 + percent / 100) if percent < 90 else percent / 100 + 0.02
    reach = math.ceil(math.log(percent / 100) / math.log(narrow))
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log(narrow))
    tops = posted.where(is_heavy).withColumn("band", band).groupBy("s", "salt", "band").agg(
        F.min("cls").alias("cls"))
    over = Window.partitionBy("s").orderBy("band", "salt")
    second = tops.withColumns({"u": F.lag("cls").over(over), "b": F.lag("band").over(over)})
    across = second.where(F.col("band") - F.col("b") <= reach).select("u", F.col("cls").alias("v"))
    return own.union(across).where("u <> v")


def blob_tasks(classes: DataFrame, blobs: DataFrame, percent: int) -> DataFrame:
    """(task, side, cls, key): which classes each search task gets; two cells of a large blob meet in one task."""
    members = classes.select("cls", "key", "n").join(blobs.select(F.col("node").alias("cls"), F.col("root").alias("blob")), "cls")
    sizes = members.groupBy("blob").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("sets"))
    small = (F.col("shingles") <= CELL_SHINGLES) & (F.col("sets") <= CELL_SETS)
    step = -math.log(percent / 100)
    placed = members.join(sizes, "blob").withColumns({
        "whole": small, "band": F.when(small, F.lit(0)).otherwise(F.floor(F.log(F.col("n").cast("double")) / step)).cast("int")})
    whole = placed.where("whole").select(F.col("blob").alias("task"), F.lit(0).alias("side"), "cls", "key")
    # large blobs: cells by size band, as many as their content asks for
    rest = materialize(placed.where("not whole").select("blob", "band", "cls", "key", "n"), "blob-members")
    cells = rest.groupBy("blob", "band").agg(F.greatest(
        F.ceil(F.sum("n") / CELL_SHINGLES), F.ceil(F.count(F.lit(1)) / CELL_SETS)).cast("int").alias("k"))
    dealt = rest.join(cells, ["blob", "band"]).withColumn("h", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int"))
    cell = cells.select("blob", "band", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("h"))
    other = cell.toDF("blob", "band2", "h2")
    # floor of a logarithm: compatible sizes are at most one band apart, two allow for rounding
    meets = cell.join(other, "blob").where(
        (F.col("band2") - F.col("band")).between(0, 2) & ((F.col("band") < F.col("band2")) | (F.col("h") <= F.col("h2"))))
    meets = meets.withColumn("task", F.xxhash64("blob", "band", "h", "band2", "h2"))
    same = (F.col("band") == F.col("band2")) & (F.col("h") == F.col("h2"))
    sides = meets.select("blob", "task", F.explode(F.when(same, F.array(F.struct("band", "h", F.lit(0).alias("side")))).otherwise(
        F.array(F.struct("band", "h", F.lit(1).alias("side")), F.struct(
            F.col("band2").alias("band"), F.col("h2").alias("h"), F.lit(2).alias("side"))))).alias("c")).select(
        "blob", "task", "c.*")
    return whole.union(dealt.join(sides, ["blob", "band", "h"]).select("task", "side", "cls", "key"))


def search(sets: list[np.ndarray], sides: list[int], percent: int) -> Iterator[tuple[int, int]]:
    """Links between sets (indices) that reach the similarity; those that an earlier link implies are left out.

    With sides 1 and 2 only sets of different sides are compared.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = [len(sets[i]) for i in order]
    if len(sets) < 2:
        return
    every = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(order), dtype=np.int64), sizes)
    _, name, count = np.unique(every, return_inverse=True, return_counts=True)
    by_name = np.argsort(name, kind="stable")
    lists, start = owner[by_name], np.concatenate([[0], np.cumsum(count)])
    ends = np.cumsum(sizes)
    joined = Union()
    for q, n in enumerate(sizes):
        need = -(-percent * n // 100)  # overlap with any set that isn't larger
        own = name[ends[q] - n:ends[q]]
        own = own[count[own] > 1]
        if len(own) < need:
            continue
        own = own[np.argsort(count[own], kind="stable")]
        longest = int(count[own[-1]])
        n_long = min(need - 1, int(need / (MU * math.log2(longest) + 1)))
        cut = len(own) - n_long
        short = [lists[start[s]:start[s] + count[s]].tolist() for s in own[:cut]]
        long = [lists[start[s]:start[s] + count[s]] for s in own[cut:]]
        probes: list[list[int]] | None = None
        for c, group in itertools.groupby(heapq.merge(*short)):
            if c >= q:
                break
            seen = sum(1 for _ in group)
            m = sizes[c]
            wanted = -(-percent * (n + m) // (100 + percent))
            if (seen < need - n_long or m * 100 < n * percent or sides[order[c]] and sides[order[c]] == sides[order[q]]
                    or joined.find(c) == joined.find(q)):
                continue
            if probes is None:
                probes = [x.tolist() for x in long]
            left = len(probes)
            for x in probes:
                if seen >= wanted or seen + left < wanted:
                    break
                at = bisect_left(x, c)
                seen += at < len(x) and x[at] == c
                left -= 1
            if seen >= wanted:
                joined.join(c, q)
                yield order[c], order[q]


def few(keys: DataFrame, kind: str) -> tuple[DataFrame, bool]:
    """The keys, written, and whether they are few enough to be sent to all tasks."""
    keys = materialize(keys, kind)
    return keys, keys.count() <= KEYS_SENT


def one_each(df: DataFrame, kept: DataFrame, counts: DataFrame, by: list[str]) -> DataFrame:
    """One row of ``df`` for each of the distinct keys ``kept``; ``counts``: the keys of all its rows and their number ``c``.

    If the keys left out or repeated are few, the other rows stay where they are.
    """
    odd, sent = few(counts.join(kept.select(*by, F.lit(True).alias("again")), by, "left").where("again is null or c > 1")
                    .select(*by, "again"), "odd-keys")
    if not sent:
        return df.join(kept, by, "left_semi").dropDuplicates(by)
    rest, again = df.join(F.broadcast(odd.drop("again")), by, "left_anti"), odd.where("again").drop("again")
    if again.isEmpty():
        return rest
    return rest.unionByName(df.join(F.broadcast(again), by, "left_semi").dropDuplicates(by))


def verified_links(docs: DataFrame, tasks: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v) classes linked by the search tasks; a task's sets are made from the whole texts again."""
    texts = _texts(docs).select("key", "text")
    keys, sent = few(tasks.select("key").distinct(), "task-keys")
    if sent:  # texts outside of blobs aren't shuffled
        texts = texts.join(F.broadcast(keys), "key", "left_semi")
    dealt = (tasks.join(texts, "key").select("task", "side", "cls", "text")
             .repartition("task").sortWithinPartitions("task"))
    arrow = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = shingler_of(size)

        def members():
            for part in rows(batches):
                yield from zip(part["task"], part["side"], part["cls"], part["text"])

        for _, group in itertools.groupby(members(), key=lambda m: m[0]):
            sets, sides, names = [], [], {}
            for _, side, cls, text in group:
                own = shingler(text)
                # a class is searched once, however many rows its document has
                if len(own) and set_class(own) == cls and (cls, side) not in names:
                    names[cls, side] = len(sets)
                    sets.append(own)
                    sides.append(side)
            at = [cls for cls, _ in names]
            found = [(at[a], at[b]) for a, b in search(sets, sides, percent)]
            if found:
                yield pa.RecordBatch.from_pydict({"u": [f[0] for f in found], "v": [f[1] for f in found]}, schema=arrow)

    return dealt.mapInArrow(run, "u long, v long")


def jaccard_groups(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, key, n_shingles, grp, component_id) of every row of ``docs`` (doc_id, text).

    Documents link when 100 x intersection >= percent x union of their sets of
    ``size``-word shingles (A-Z lower-cased; with fewer words the whole
    sequence is one shingle). ``component_id`` is the least doc_id reachable by
    links, ``grp`` names the component. Null, empty and blank texts have no set and
    link with nothing: their component is their own id. Rows of equal sets
    are one class, however many; an empty table gives no rows; extra columns
    aren't read; ``key`` hashes doc_id and text.
    """
    levels, heavy = frequency_levels(docs, size)
    table = materialize(shingle_table(docs, levels, size, percent), "shingles")
    # rows of one key are repeated rows, apart from clashing hashes
    own = materialize(table.where("n > 0").groupBy("cls", "key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("d"), F.min("n").alias("n"),
        F.count(F.lit(1)).alias("c")), "class-keys")
    first = F.min(F.struct("d.none", "d.doc_id", "key")).alias("f")
    classes = materialize(own.groupBy("cls").agg(first, F.min("n").alias("n")).select(
        "cls", F.col("f.doc_id").alias("rep"), F.col("f.key").alias("key"), "n"), "classes")
    posting = one_each(table.where("n > 0").select("cls", "key", "n", "posts"), classes.select("cls", "key"),
                       own.select("cls", "key", "c"), ["cls", "key"])
    blobs = connected_components(candidate_chains(posting, heavy, percent))
    tasks = materialize(blob_tasks(classes, blobs, percent), "tasks")
    links = connected_components(verified_links(docs, tasks, size, percent))
    roots = classes.select("cls", "rep").join(links.select(F.col("node").alias("cls"), "root"), "cls", "left").select(
        "cls", "rep", F.coalesce("root", "cls").alias("grp"))
    least = roots.groupBy("grp").agg(F.min("rep").alias("component_id"))
    named = roots.join(least, "grp").select("cls", "grp", "component_id")
    joined = table.drop("posts").join(named, "cls", "left")
    return joined.select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("grp", "key").alias("grp"),
                         F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """One row of each group: that of the least doc_id (ids before null); all columns as they are.

    Rows without a set stay, one for repeated rows.
    """
    groups = materialize(jaccard_groups(docs, size, percent).select("doc_id", "key", "grp"), "groups")
    first = groups.groupBy("grp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("f"))
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    counts = groups.groupBy(F.col("key").alias("__key")).agg(F.count(F.lit(1)).alias("c"))
    return one_each(keyed, first.select(F.col("f.key").alias("__key")).distinct(), counts, ["__key"]).select(*docs.columns)
