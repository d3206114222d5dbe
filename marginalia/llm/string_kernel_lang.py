"""Language identification with a string kernel.

The blended-spectrum presence kernel counts the character n-grams (n = 1 to 3)
that two texts share, normalised by the geometric mean of their numbers of
n-grams. Nystroem landmarks (bounded per language) stand for the kernel; one
kernel ridge regression per language is fitted on the landmark features of a
bounded labelled sample. Texts are scored in batches: the presence matrix of a
batch times the landmark matrix times the ridge weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _arrow_schema, map_rows, rows

ORDERS = (1, 2, 3)
BITS = 15
# Bounds of the fit: labelled rows and landmarks per language.
SAMPLE_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 400, 64
RIDGE = 1e-2
SHARPNESS = 6.0
# Documents of a matrix product; characters of a text looked at together.
BATCH, SPAN = 128, 1 << 20


def mark(text: str, row: np.ndarray) -> None:
    """Set the presence of each n-gram of the whole text, hashed to 2**BITS columns."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    reach = max(ORDERS) - 1
    for at in range(0, len(points), SPAN):
        part = points[at:at + SPAN + reach]
        code = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if len(part) < n:
                break
            code = code[:len(part) - n + 1] * np.uint64(0x110000) + part[n - 1:]
            if n in ORDERS:
                mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                row[(mixed >> np.uint64(64 - BITS)).astype(np.int64)] = 1


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """crc32 of the id as text falls on the held-out part; a null id is never held out and never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(lang, ord, grams): at most ``per_language`` learnable rows of each language, in the order of a hash.

    Learnable rows have an id that isn't held out, a language and a text with a
    letter. ``grams`` are the packed presence bits of the whole text.
    """
    usable = (F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
              & F.col("text").rlike(r"\p{L}"))
    rows_in = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (rows_in.where(usable).select("lang", "doc_id").withColumn("ord", F.row_number().over(order))
           .where(F.col("ord") <= per_language))
    chosen = rows_in.where(usable).join(F.broadcast(ids), ["lang", "doc_id"])

    def make():
        def f(part):
            grams = []
            for text in part["text"]:
                row = np.zeros(1 << BITS, dtype=np.uint8)
                mark(text, row)
                grams.append(np.packbits(row).tobytes())
            return {"lang": part["lang"], "ord": part["ord"], "grams": grams}
        return f

    return map_rows(chosen.select("lang", "ord", "text"), "lang string, ord int, grams binary", make)


def fit(sample: DataFrame, landmarks_per_language: int = LANDMARKS_PER_LANGUAGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, landmark matrix, weights) of the one-versus-rest ridge regressions.

    The sample is bounded (see ``training_sample``), so its packed bits fit the driver.
    """
    got = sorted((r["lang"], r["ord"], bytes(r["grams"])) for r in sample.collect())
    if not got:
        return [], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0), np.float32)
    langs = sorted({g[0] for g in got})
    x = np.unpackbits(np.frombuffer(b"".join(g[2] for g in got), np.uint8).reshape(len(got), -1), axis=1).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    chosen, count = [], dict.fromkeys(langs, 0)
    for k, g in enumerate(got):
        if count[g[0]] < landmarks_per_language:
            count[g[0]] += 1
            chosen.append(k)
    marks = x[chosen]
    kernel = (x @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[chosen])
    ok = values > 1e-6 * values.max()
    half = vectors[:, ok] / np.sqrt(values[ok])
    z = np.hstack([kernel @ half, np.ones((len(got), 1))])
    y = np.where(np.array([[g[0] == lang for lang in langs] for g in got]), 1.0, -1.0)
    # each language weighs the same, however many rows it has
    weight = np.array([1.0 / sum(g[0] == h[0] for h in got) for g in got]) * len(got) / len(langs)
    gram = z.T @ (z * weight[:, None]) + RIDGE * len(got) * np.eye(z.shape[1]) / len(langs)
    w = np.linalg.solve(gram, z.T @ (y * weight[:, None]))
    return langs, marks.T.astype(np.float32), np.vstack([half @ w[:-1], w[-1:]]).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row from its whole text; ``und`` and 0 without a letter."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, lang_pred string, score double"
    spark = docs.sparkSession
    arrow, shared = _arrow_schema(spark, schema), spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, marks, weights = shared.value
        # the product of landmarks and weights is the same for every batch
        linear = marks @ weights[:-1] if langs else None
        presence = np.zeros((BATCH, 1 << BITS), np.float32)
        for part in rows(batches):
            for at in range(0, len(part["doc_id"]), BATCH):
                texts = part["text"][at:at + BATCH]
                known = [k for k, t in enumerate(texts) if langs and has_letter(t)]
                out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
                if known:
                    batch = presence[:len(known)]
                    batch[:] = 0
                    for j, k in enumerate(known):
                        mark(texts[k], batch[j])
                    size = np.sqrt(np.maximum(batch.sum(axis=1, keepdims=True), 1))
                    margins = (batch @ linear) / size + weights[-1]
                    e = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
                    p = e / e.sum(axis=1, keepdims=True)
                    for j, k in enumerate(known):
                        best = int(p[j].argmax())
                        out[k] = (langs[best], float(p[j, best]))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part["doc_id"][at:at + BATCH], "lang_pred": [o[0] for o in out],
                     "score": [o[1] for o in out]}, schema=arrow)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def identify_language(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from the rows that aren't held out.

    Null texts and texts without a letter are ``und`` with score 0; so is
    everything if nothing can be learned. Repeated rows get equal answers; an
    empty table gives no rows; extra columns aren't read.
    """
    slim = docs.select("doc_id", "lang", "text")
    model = fit(training_sample(slim))
    return predict(slim, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
