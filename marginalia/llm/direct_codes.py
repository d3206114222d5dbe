"""Token ids as directly addressable codes.

Each id is split into 8-bit chunks. Level k holds chunk k of those ids that
have one, in order; a continuation bitmap beside it marks the ids that go on to
level k + 1, and a rank directory (marks before every 512 positions) gives the
position there. Any token is found by one look per level, without decoding a
block. All numbers in a file are little-endian.

    magic "DACODES1" | n_docs u64 | n_tokens u64 | n_levels u64
    | per section: offset u64, length u64 | sections
    sections: doc ids i64[n_docs], null flags u8[n_docs], starts u64[n_docs + 1],
              then per level: chunks u8[n], bitmap bits[n], directory u64[ceil(n / 512) + 1]

Files are written by the tasks of a range-partitioned sort. A task that is
repeated writes files of another name; only those named by the manifest, which
Spark commits with the tasks that succeeded, are ever read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, public_tokenizer, rows, shared_path
from .tokens import VOCABULARY, word_encoder

MAGIC, WIDTH, STEP = b"DACODES1", 8, 512
END_ID = 0
# A task starts another file at so many tokens: bounds its memory.
FILE_TOKENS = 8_000_000
# Tokens read at once when a file is read in order.
READ_TOKENS = 1_000_000
MANIFEST = ("file string, first_doc long, first_null boolean, first_tie long, seq int, n_docs long, n_tokens long, "
            "bytes long")


def encode_levels(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """(chunks, bitmap, directory) of each level."""
    left, levels = ids.astype("<u4"), []
    while True:
        more = left >= 1 << WIDTH
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), STEP), dtype="<u8") if len(more) else np.zeros(0, "<u8")
        directory = np.concatenate([np.zeros(1, "<u8"), np.cumsum(counts, dtype="<u8")]).astype("<u8")
        levels.append(((left & 0xFF).astype("u1").tobytes(), bits.tobytes(), directory.tobytes()))
        if not more.any():
            return levels
        left = left[more] >> WIDTH


def encode_file(doc_ids: list[int | None], parts: list[bytes]) -> bytes:
    """One file of documents: ``parts`` are their ids as little-endian unsigned 32-bit."""
    ids = np.frombuffer(b"".join(parts), dtype="<u4")
    starts = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype("<u8")
    levels = encode_levels(ids)
    sections = [np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
                np.array([d is None for d in doc_ids], dtype="u1").tobytes(), starts.tobytes(),
                *[s for level in levels for s in level]]
    at, index = len(MAGIC) + 24 + 16 * len(sections), []
    for s in sections:
        index += [at, len(s)]
        at += len(s)
    head = MAGIC + struct.pack("<3Q", len(doc_ids), len(ids), len(levels)) + struct.pack(f"<{len(index)}Q", *index)
    return b"".join([head, *sections])


class DirectCodes:
    """Random access to a file of codes; reads only the bytes that an answer needs."""

    def __init__(self, source):
        self.source = source
        head = self._read(0, len(MAGIC) + 24)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.n_docs, self.n_tokens, n_levels = struct.unpack("<3Q", head[len(MAGIC):])
        n = 3 + 3 * n_levels
        index = struct.unpack(f"<{2 * n}Q", self._read(len(head), 16 * n))
        self.at = list(zip(index[::2], index[1::2]))
        self.n_levels = n_levels

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _part(self, section: int, at: int, n: int) -> bytes:
        base, size = self.at[section]
        return self._read(base + at, max(0, min(n, size - at)))

    def docs(self, a: int, b: int) -> tuple[list[int | None], np.ndarray]:
        """Ids of documents a to b, and where their tokens start and end."""
        ids = np.frombuffer(self._part(0, 8 * a, 8 * (b - a)), "<i8").tolist()
        null = self._part(1, a, b - a)
        return [None if z else i for i, z in zip(ids, null)], np.frombuffer(self._part(2, 8 * a, 8 * (b - a + 1)), "<u8")

    def _marks(self, level: int, a: int, b: int) -> np.ndarray:
        raw = np.frombuffer(self._part(4 + 3 * level, a // 8, (b + 7) // 8 - a // 8), "u1")
        return np.unpackbits(raw, bitorder="little")[a % 8:a % 8 + b - a].astype(bool)

    def rank(self, level: int, i: int) -> int:
        """Marks before position i of a level: a directory entry and less than a step of the bitmap."""
        block = i // STEP
        (known,) = struct.unpack("<Q", self._part(5 + 3 * level, 8 * block, 8))
        return known + int(self._marks(level, block * STEP, i).sum()) if i % STEP else known

    def slice(self, a: int, b: int) -> np.ndarray:
        """Tokens a to b of the file."""
        out = np.zeros(b - a, dtype="<u4")
        where = None
        for level in range(self.n_levels):
            chunk = np.frombuffer(self._part(3 + 3 * level, a, b - a), "u1").astype("<u4") << (WIDTH * level)
            where = np.arange(len(out)) if where is None else where
            out[where] |= chunk
            marks = self._marks(level, a, b)
            if not marks.any():
                break
            a, b = (lambda start: (start, start + int(marks.sum())))(self.rank(level, a))
            where = where[marks]
        return out

    def token(self, i: int) -> int:
        return int(self.slice(i, i + 1)[0])


def _open(path: str):
    files, name = pafs.FileSystem.from_uri(path)
    return files, name


def write_codes(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order; returns the manifest of files.

    ``docs`` needs doc_id and text; null texts are empty, null ids come first,
    rows that share an id are ordered by a hash of the text, and other columns
    are not read. An empty table writes an empty manifest.
    """
    spark = docs.sparkSession
    arrow = _arrow_schema(spark, MANIFEST)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(public_tokenizer(vocabulary)).ids
        end = struct.pack("<I", end_id)
        files, base = _open(path)
        files.create_dir(base, recursive=True)
        name, seq = uuid.uuid4().hex, 0
        ids: list[int | None] = []
        parts: list[bytes] = []
        n, first = 0, None

        def flush() -> pa.RecordBatch:
            blob = encode_file(ids, parts)
            file = f"{name}-{seq:05d}.dac"
            with files.open_output_stream(f"{base}/{file}") as out:
                out.write(blob)
            return pa.RecordBatch.from_pylist(
                [{"file": file, "first_doc": first[0], "first_null": first[0] is None, "first_tie": first[1],
                  "seq": seq, "n_docs": len(ids), "n_tokens": n // 4, "bytes": len(blob)}], schema=arrow)

        for part in rows(batches):
            for doc, text, tie in zip(part["doc_id"], part["text"], part["tie"]):
                if n >= 4 * FILE_TOKENS:
                    yield flush()
                    ids, parts, n, first, seq = [], [], 0, None, seq + 1
                first = first or (doc, tie)
                ids.append(doc)
                parts.append(encode(text) + end)
                n += len(parts[-1])
        if ids:
            yield flush()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_codes(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document of the files, ids as little-endian unsigned 32-bit.

    ``start`` counts the ids of all documents before it, over all files.
    """
    schema = "doc_id long, start long, n_tokens long, ids binary"
    return _read(manifest, path, schema, lambda doc, start, ids: (doc, start, len(ids), ids.tobytes()))


def codes_digest(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _read(manifest, path, schema, lambda doc, start, ids: (doc, start, len(ids), zlib.crc32(ids.tobytes())))


def _read(manifest: DataFrame, path: str, schema: str, make) -> DataFrame:
    arrow = _arrow_schema(manifest.sparkSession, schema)
    # one small row per file
    before = (Window.orderBy(F.col("first_null").desc(), "first_doc", "first_tie", "seq")
              .rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    n_files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows(batches):
            for file, base in zip(part["file"], part["base"]):
                store, folder = _open(path)
                with store.open_input_file(f"{folder}/{file}") as source:
                    codes = DirectCodes(source)
                    docs, starts = codes.docs(0, codes.n_docs)
                    a = 0
                    while a < len(docs):
                        b = max(a + 1, int(np.searchsorted(starts, starts[a] + READ_TOKENS, "right")) - 1)
                        b = min(b, len(docs))
                        ids, at = codes.slice(int(starts[a]), int(starts[b])), starts[a:b + 1] - starts[a]
                        out = [make(docs[k], base + int(starts[k]), ids[int(at[k - a]):int(at[k - a + 1])])
                               for k in range(a, b)]
                        yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, map(list, zip(*out)))), schema=arrow)
                        a = b

    # a file a task: rows here name files, so their number, not their size, has to spread the work
    return files.repartition(n_files, "file").mapInArrow(read, schema)


def token_codes(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as codes under the shared folder and return the digest read back from the files."""
    path = shared_path(docs.sparkSession, "codes")
    return codes_digest(write_codes(docs, path, vocabulary, end_id), path)
