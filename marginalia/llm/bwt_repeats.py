"""Suffix-array dedup: sampled Burrows-Wheeler transforms of shards, merged by interleave refinement.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id.

1. Suffixes are sampled: the window of ``LENGTH`` bytes at any place owns the
   suffix at its anchor, the leftmost least hash of its ``GRAM``-byte strings.
   Equal windows have equal anchors, and neighbouring windows mostly share one,
   so a suffix in about 18 is enough.
2. Anchors' strings that occur in one document only are left out: shards send
   short names of their strings to buckets and get back those seen elsewhere.
3. A shard sorts the sampled suffixes that are left, repeats taken together.
   What precedes each of them, in that order, is the column of its sampled
   Burrows-Wheeler transform (up to ``REACH`` bytes each, as suffixes are sampled).
4. A bucket merges the transforms of all shards. The interleave starts as one
   block and is refined a byte at a time: blocks whose next byte differs are
   split in place, everything else stays as it was; a split at depth h is a
   common prefix of h bytes. The column refines the blocks to the left in the
   same way. Blocks of ``LENGTH`` bytes (d to the left of the anchor, the rest
   to its right) are the repeated intervals; their least doc_id decides.

Hashes only deal strings out; all decisions compare the bytes themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _arrow_schema, constant, materialize, shared_path

LENGTH, GRAM = 50, 16
REACH = LENGTH - GRAM
# Bytes of text in a shard and in one block of a shard's work.
SHARD_BYTES, BLOCK_BYTES = 32 << 20, 1 << 20
# A string with more places than this is taken apart into its windows, each with a place of its own in the buckets.
HOT_PLACES = 50_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)
_R29, _R32 = np.uint64(29), np.uint64(32)


def _words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    n = len(buf) - 7
    out, raw = np.empty(n, np.uint64), buf.tobytes()
    for k in range(8):
        out[k::8] = np.frombuffer(raw, "<u8", len(out[k::8]), k)
    return out


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _A + (b ^ (b >> _R29)) * _B
    h ^= h >> _R32
    h *= _C
    h ^= h >> _R29
    return h


class Anchors(NamedTuple):
    """Sampled suffixes of a block: place, windows from ``place - most`` to ``place - least``, hash of the string there."""

    buf: np.ndarray
    at: np.ndarray
    least: np.ndarray
    most: np.ndarray
    name: np.ndarray
    text: np.ndarray
    base: np.ndarray


def _blocks(texts: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
    """Pieces (text, from, to) of about BLOCK_BYTES together; long texts are cut with an overlap of a window less a byte."""
    block, size = [], 0
    for t, text in enumerate(texts):
        for at in range(0, max(0, len(text) - LENGTH + 1), BLOCK_BYTES):
            piece = (t, at, min(len(text), at + BLOCK_BYTES + LENGTH - 1))
            block.append(piece)
            size += piece[2] - piece[1]
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
    if block:
        yield block


def anchors(texts: list[bytes]) -> Iterator[Anchors]:
    """The sampled suffixes of all windows of ``texts``, by blocks."""
    for block in _blocks(texts):
        buf = np.frombuffer(b"".join([texts[t][a:b] for t, a, b in block]), np.uint8)
        w = _words(buf)
        least = name = _mix(w[:-8], w[8:])
        at = np.arange(len(name), dtype=np.int32)
        for step in (1, 2, 4, 8, 16, REACH + 1 - 32):
            later = least[step:] < least[:-step]  # the leftmost of equals
            at = np.where(later, at[step:], at[:-step])
            least = np.where(later, least[step:], least[:-step])
        ends = np.cumsum([b - a for _, a, b in block])
        inside = np.ones(len(at), bool)
        for e in ends[:-1]:
            inside[max(0, e - LENGTH + 1):e] = False
        first = np.flatnonzero(inside)
        own = at[first]
        new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        last = np.r_[new[1:], len(own)] - 1
        place = own[new].astype(np.int64)
        piece = np.searchsorted(ends, place, "right")
        texts_of = np.array([t for t, _, _ in block])[piece]
        base = np.array([a for _, a, _ in block])[piece] - np.r_[0, ends[:-1]][piece]
        # the least hashes are small: hashed again, they spread evenly over the buckets
        again = _mix(name[place], name[place] >> _R32)
        yield Anchors(buf, place, place - first[last], place - first[new], again, texts_of, base)


def _bucket(name: np.ndarray, n: int) -> np.ndarray:
    return ((name >> _R32) * np.uint64(n) >> _R32).astype(np.int64)


def _known(name: np.ndarray, n: int) -> np.ndarray:
    """Bucket and short name in one number."""
    return _bucket(name, n).astype(np.uint64) << _R32 | name & np.uint64(0xFFFFFFFF)


def _slices(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, from, to) of runs."""
    if len(sorted_keys):
        starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(sorted_keys)]):
            yield int(sorted_keys[a]), int(a), int(b)


def short_names(texts: list[bytes], ids: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, short names and counts) of a shard; the high bit of a count tells of several documents."""
    found = [(a.name, ids[a.text]) for a in anchors(texts)]
    if not found:
        return
    name, doc = (np.concatenate(x) for x in zip(*found))
    known = _known(name, n)
    order = np.argsort(known)
    known, doc = known[order], doc[order]
    start = np.flatnonzero(np.r_[True, known[1:] != known[:-1]])
    several = np.minimum.reduceat(doc, start) != np.maximum.reduceat(doc, start)
    count = np.minimum(np.diff(np.r_[start, len(known)]), 127).astype(np.uint8) | several.astype(np.uint8) << 7
    known = known[start]
    for bucket, a, b in _slices((known >> _R32).astype(np.int64)):
        yield bucket, known[a:b].astype("<u4").tobytes() + count[a:b].tobytes()


def shared_names(parts: list[tuple[int, bytes]], hot_places: int) -> Iterator[tuple[int, bytes]]:
    """(shard, short names that occur in other documents too, whether hot) of a bucket."""
    sizes = [len(blob) // 5 for _, blob in parts]
    name = np.concatenate([np.frombuffer(blob, "<u4", k) for (_, blob), k in zip(parts, sizes)])
    count = np.concatenate([np.frombuffer(blob, np.uint8, k, 4 * k) for (_, blob), k in zip(parts, sizes)])
    _, group, shards = np.unique(name, return_inverse=True, return_counts=True)
    several = np.bincount(group, count >> 7) > 0
    kept = ((shards > 1) | several)[group]
    hot = (np.bincount(group, count & 127) > hot_places)[group]
    at = 0
    for (shard, _), k in zip(parts, sizes):
        own = kept[at:at + k]
        if own.any():
            yield shard, name[at:at + k][own].astype("<u4").tobytes() + hot[at:at + k][own].tobytes()
        at += k


class Suffixes(NamedTuple):
    """A shard's distinct sampled suffixes in order of bucket and content, and the places of each."""

    bucket: np.ndarray
    right: np.ndarray  # LENGTH bytes from the anchor on, 0 beyond what its windows use
    left: np.ndarray   # REACH bytes before it, the nearest first
    least: np.ndarray
    most: np.ndarray
    doc: np.ndarray    # the least doc_id that has it
    entry: np.ndarray  # of each place: its suffix, text, offset in it
    text: np.ndarray
    at: np.ndarray


def _numbers(m: np.ndarray) -> list[np.ndarray]:
    """Columns of eight bytes each that sort as the rows do."""
    wide = np.zeros((len(m), -(-m.shape[1] // 8) * 8), np.uint8)
    wide[:, :m.shape[1]] = m
    return list(wide.view(">u8").astype(np.uint64).T)


def sampled_suffixes(texts: list[bytes], ids: np.ndarray, n: int, known: np.ndarray, hot: np.ndarray) -> Suffixes | None:
    """The suffixes whose short names are ``known`` (sorted); the hot ones window by window."""
    found = []
    for block in anchors(texts):
        key = _known(block.name, n)
        where = np.minimum(np.searchsorted(known, key), len(known) - 1) if len(known) else np.zeros(len(key), int)
        shared = known[where] == key if len(known) else np.zeros(len(key), bool)
        is_hot = shared & hot[where] if len(known) else shared
        for rows, single in ((np.flatnonzero(shared & ~is_hot), False), (np.flatnonzero(is_hot), True)):
            if not len(rows):
                continue
            at, least, most, name = block.at[rows], block.least[rows], block.most[rows], block.name[rows]
            if single:
                n_windows = most - least + 1
                rows = np.repeat(rows, n_windows)
                ramp = np.arange(len(rows)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
                at = np.repeat(at - most, n_windows) + ramp
                least = most = np.zeros(len(at), np.int64)
            reach = at[:, None] + np.arange(LENGTH)
            right = block.buf[np.minimum(reach, len(block.buf) - 1)]
            right[np.arange(LENGTH) >= LENGTH - least[:, None]] = 0
            left = block.buf[np.maximum(at[:, None] - 1 - np.arange(REACH), 0)]
            left[np.arange(REACH) >= most[:, None]] = 0
            if single:
                name = np.zeros(len(at), np.uint64)
                for x in _numbers(right):
                    name = _mix(name, x)
            found.append((_bucket(name, n), right, left, least, most, block.text[rows], at + block.base[rows]))
    if not found:
        return None
    bucket, right, left, least, most, text, at = (np.concatenate(x) for x in zip(*found))
    keys = [bucket, *_numbers(right), *_numbers(left), least, most]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    start = np.flatnonzero(new)
    one = order[start]
    text, at = text[order], at[order]
    return Suffixes(bucket[one], right[one], left[one], least[one], most[one], np.minimum.reduceat(ids[text], start),
                    np.cumsum(new) - 1, text, at)


def pack(s: Suffixes, a: int, b: int) -> bytes:
    """A shard's transform for one bucket."""
    least, most = s.least[a:b], s.most[a:b]
    used_right, used_left = np.arange(LENGTH) < LENGTH - least[:, None], np.arange(REACH) < most[:, None]
    raw = b"".join([s.doc[a:b].astype("<i8").tobytes(), least.astype(np.uint8).tobytes(), most.astype(np.uint8).tobytes(),
                    s.right[a:b][used_right].tobytes(), s.left[a:b][used_left].tobytes()])
    return (b - a).to_bytes(4, "little") + zstandard.ZstdCompressor(level=3).compress(raw)


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    """(doc, least, most, right, left) of a packed transform."""
    n, raw = int.from_bytes(blob[:4], "little"), zstandard.ZstdDecompressor().decompress(blob[4:])
    doc, least, most = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n), np.frombuffer(raw, np.uint8, n, 9 * n)
    rest = np.frombuffer(raw, np.uint8, offset=10 * n)
    right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, REACH), np.uint8)
    used = np.arange(LENGTH) < LENGTH - least.astype(int)[:, None]
    right[used] = rest[:used.sum()]
    left[np.arange(REACH) < most[:, None]] = rest[used.sum():]
    return doc, least.astype(np.int64), most.astype(np.int64), right, left


def interleave(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the one before) of strings given by columns, by refinement one byte at a time.

    Blocks are split stably where their next byte differs; all others keep
    their order, whichever shard they came from.
    """
    depth, n = columns.shape
    order, common = np.arange(n), np.full(n, depth)
    common[:1] = 0
    new = np.zeros(n, bool)
    new[:1] = True
    for h in range(depth):
        start = np.flatnonzero(new)
        if len(start) == n:
            break
        block = np.cumsum(new) - 1
        byte = columns[h][order]
        split = np.zeros(len(start), bool)
        split[block[byte != byte[start[block]]]] = True
        rows = np.flatnonzero(split[block])
        if not len(rows):
            continue
        key = block[rows] << 8 | byte[rows]
        by = np.argsort(key, kind="stable")
        order[rows] = order[rows[by]]
        key = key[by]
        cut = rows[1:][(key[1:] != key[:-1]) & (key[1:] >> 8 == key[:-1] >> 8)]
        new[cut] = True
        common[cut] = h
    return order, common


def _depth_blocks(order: np.ndarray, common: np.ndarray, h: int) -> np.ndarray:
    """Number of the block of common prefixes of ``h`` bytes of each string."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < h)
    return out


def merge(parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """(shard, suffixes and their windows that start in a smaller document too) of a bucket's transforms.

    Bit d of a suffix's mask stands for the window that begins d bytes before it.
    """
    read = [unpack(blob) for _, blob in parts]
    doc, least, most, right, left = (np.concatenate(x) for x in zip(*read))
    after, before = interleave(np.ascontiguousarray(right.T)), interleave(np.ascontiguousarray(left.T))
    mask = np.zeros(len(doc), np.uint64)
    for d in range(REACH + 1):
        rows = np.flatnonzero((least <= d) & (d <= most))
        if len(rows) < 2:
            continue
        key = _depth_blocks(*after, LENGTH - d)[rows] * (len(doc) + 1) + _depth_blocks(*before, d)[rows]
        by = np.argsort(key)
        key, rows = key[by], rows[by]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        first = np.repeat(np.minimum.reduceat(doc[rows], start), np.diff(np.r_[start, len(rows)]))
        mask[rows[first < doc[rows]]] |= np.uint64(1 << d)
    at = 0
    for (shard, _), part in zip(parts, read):
        own = mask[at:at + len(part[0])]
        hit = np.flatnonzero(own)
        if len(hit):
            yield shard, hit.astype("<i4").tobytes() + own[hit].astype("<u8").tobytes()
        at += len(own)


def removed_windows(s: Suffixes, ids: np.ndarray, masks: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of the windows that go, of a shard."""
    mask = np.zeros(len(s.doc), np.uint64)
    for bucket, a, _ in _slices(s.bucket):
        if bucket in masks:
            k = len(masks[bucket]) // 12
            mask[a + np.frombuffer(masks[bucket], "<i4", k)] = np.frombuffer(masks[bucket], "<u8", k, 4 * k)
    # a later document of the shard itself loses all windows of the suffix
    every = (np.uint64(1) << (s.most + 1).astype(np.uint64)) - (np.uint64(1) << s.least.astype(np.uint64))
    own = np.where(ids[s.text] > s.doc[s.entry], every[s.entry], mask[s.entry])
    texts, starts = [], []
    for d in range(REACH + 1):
        rows = np.flatnonzero(own >> np.uint64(d) & np.uint64(1))
        texts.append(s.text[rows])
        starts.append(s.at[rows] - d)
    return np.concatenate(texts), np.concatenate(starts)


def without(text: bytes, starts: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """(what is left, where removed runs begin, where they end)."""
    n = len(text)
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + LENGTH, minlength=n + 1)
    gone = np.cumsum(change)[:n] > 0
    edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), edge[::2].tolist(), edge[1::2].tolist()


def _shards(docs: DataFrame, key: Column, n: int) -> DataFrame:
    """``docs`` with ``shard``, as a table of ``n`` buckets in the shared folder: what is grouped by shard needs no shuffle."""
    spark = docs.sparkSession
    # numbers that Spark's hash deals one to a bucket
    dealt = spark.range(64 * n + 64).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("b")).agg(F.min("id").alias("id"))
    names = [r["id"] for r in dealt.orderBy("b").collect()]
    shard = F.element_at(constant(names, "bigint"), (F.pmod(key, F.lit(len(names))) + 1).cast("int"))
    name = f"shards_{uuid.uuid4().hex}"
    (docs.withColumn("shard", shard).repartition(n, "shard").write.format("parquet").bucketBy(n, "shard").sortBy("shard")
     .option("path", shared_path(spark, "shards")).saveAsTable(name))
    return spark.table(name)


def _texts(t: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """(bytes of the texts, ids) of a shard; a row without an id takes no part in the search."""
    ids = t["doc_id"]
    texts = t["text"].cast(pa.binary()).to_pylist()
    none = ids.is_null().to_pylist()
    return [b"" if x is None or no else x for x, no in zip(texts, none)], ids.fill_null(0).to_numpy().astype(np.int64)


def _record(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _received(t: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[int, bytes]]:
    """(names known elsewhere, whether hot, masks by bucket) that a shard got back."""
    known, hot, masks = [np.zeros(0, np.uint64)], [np.zeros(0, bool)], {}
    for kind, bucket, blob in zip(*(t[c].to_pylist() for c in ("kind", "bucket", "blob"))):
        if kind:
            masks[bucket] = blob
        else:
            k = len(blob) // 5
            known.append(np.uint64(bucket) << _R32 | np.frombuffer(blob, "<u4", k).astype(np.uint64))
            hot.append(np.frombuffer(blob, bool, k, 4 * k))
    known, hot = np.concatenate(known), np.concatenate(hot)
    order = np.argsort(known)
    return known[order], hot[order], masks


def remove_repeats(docs: DataFrame, hot_places: int = HOT_PLACES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, kept binary, starts array, ends array) of every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes. ``kept`` lacks each byte covered by a ``LENGTH``-byte
    string that also starts in a document with a smaller doc_id; ``starts`` and
    ``ends`` are the maximal removed runs. Null texts count as empty; shorter
    texts stay whole. Rows of one doc_id, repeated or not, remove nothing from
    each other; a row without an id stays whole and removes nothing. Extra
    columns aren't read; an empty table gives no rows. A text is held whole by
    one task; shards hold about ``shard_bytes`` of texts.
    """
    spark: SparkSession = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // shard_bytes), 1)
    table = _shards(slim, F.xxhash64("doc_id", "text"), n)

    to_bucket, to_shard = "bucket int, shard long, blob binary", "shard long, kind int, bucket int, blob binary"
    bucket_schema, shard_schema = _arrow_schema(spark, to_bucket), _arrow_schema(spark, to_shard)

    def name(t: pa.Table) -> pa.Table:
        shard = t["shard"][0].as_py()
        return _record(bucket_schema, [(b, shard, blob) for b, blob in short_names(*_texts(t), n)])

    def share(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        parts = list(zip(t["shard"].to_pylist(), t["blob"].to_pylist()))
        return _record(shard_schema, [(s, 0, bucket, blob) for s, blob in shared_names(parts, hot_places)])

    names = table.groupBy("shard").applyInArrow(name, to_bucket)
    shared = materialize(names.groupBy("bucket").applyInArrow(share, to_shard), "shared-names")

    def sort(own: pa.Table, got: pa.Table) -> pa.Table:
        if not own.num_rows or not got.num_rows:
            return _record(bucket_schema, [])
        texts, ids = _texts(own)
        known, hot, _ = _received(got)
        found = sampled_suffixes(texts, ids, n, known, hot)
        shard = own["shard"][0].as_py()
        return _record(bucket_schema, [(k, shard, pack(found, a, b)) for k, a, b in _slices(found.bucket)] if found else [])

    def join(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        parts = sorted(zip(t["shard"].to_pylist(), t["blob"].to_pylist()))
        return _record(shard_schema, [(s, 1, bucket, blob) for s, blob in merge(parts)])

    by_shard = table.groupBy("shard")
    transforms = by_shard.cogroup(shared.groupBy("shard")).applyInArrow(sort, to_bucket)
    masks = materialize(transforms.groupBy("bucket").applyInArrow(join, to_shard), "repeated-windows")

    out = "doc_id long, n_bytes long, kept binary, starts array<long>, ends array<long>"
    out_schema = _arrow_schema(spark, out)

    def cut(own: pa.Table, got: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _record(out_schema, [])
        texts, ids = _texts(own)
        known, hot, masks = _received(got)
        found = sampled_suffixes(texts, ids, n, known, hot)
        gone: dict[int, np.ndarray] = {}
        if found:
            text, start = removed_windows(found, ids, masks)
            order = np.argsort(text, kind="stable")
            start = start[order]
            gone = {t: start[a:b] for t, a, b in _slices(text[order])}
        whole = own["text"].cast(pa.binary()).to_pylist()
        rows = []
        for k, (doc, text) in enumerate(zip(own["doc_id"].to_pylist(), whole)):
            text = text or b""
            rows.append((doc, len(text), *(without(text, gone[k]) if k in gone else (text, [], []))))
        return _record(out_schema, rows)

    return by_shard.cogroup(shared.union(masks).groupBy("shard")).applyInArrow(cut, out)
