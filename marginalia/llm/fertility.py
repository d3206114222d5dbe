"""Quality rules by tokeniser fertility.

Each word is encoded by public vocabularies: a piece vocabulary with byte
fallback and a byte-level one for many languages. A document's characters per
token, share of byte-fallback tokens and token entropy are held against bands
of its language (of its script where the language isn't known). The bands are
robust statistics (median and quartiles) over the documents of the language
that pass the base rules, widened for their number.
"""

from __future__ import annotations

import base64
import math
import re
import struct
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, held, map_rows, materialize, public_tokenizer

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
# Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# Rejection bands: measure -> (scaled, deviations below, deviations above, least spread). A scaled
# measure is a mean over the document's words, so its deviation from the median is multiplied by
# sqrt(n_words) before it is compared with the group's spread.
BANDS = {"byte_chars": (True, 3.5, 8.0, 0.3), "piece_chars": (True, 6.0, 9.0, 0.3),
         "fallback_share": (False, None, 6.0, 0.01), "entropy": (False, 6.0, None, 0.02)}
# Quantiles are taken on these grids, fine against the least spreads.
MEDIAN_STEPS, DEVIATION_STEPS = 1 << 16, 1 << 11
# The distance of the quartiles of n documents tells the spread as well as the standard deviation of this many of n does.
QUARTILES_WORTH = 0.37

_WORD = re.compile(r"[^ \t-\r]+")
_SYMBOLS = "#*$%&|<>"
# First code points of script blocks and their names.
_SCRIPTS = [(0x41, "Latin"), (0x250, "Other"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"),
            (0x590, "Hebrew"), (0x600, "Arabic"), (0x780, "Other"), (0x900, "Devanagari"), (0x980, "Bengali"),
            (0xA00, "Other"), (0xB80, "Tamil"), (0xC00, "Other"), (0xE00, "Thai"), (0xE80, "Other"),
            (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
            (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x4E00, "Han"), (0xA000, "Other"),
            (0xAC00, "Hangul"), (0xD800, "Other")]
_STARTS = np.array([s for s, _ in _SCRIPTS])

FEATURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "script string, piece_chars double, byte_chars double, fallback_share double, entropy double")


# A word's entry in the memo is its piece ids and two counts, each a 32-bit number with one of these bits.
_FALLBACK, _LEVEL = 1 << 30, 1 << 31


class Vocabularies:
    """Per word, packed: its piece ids, how many of them are byte fallback, its number of byte-level tokens."""

    def __init__(self, pieces: str, byte_level: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.is_byte = [self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())]
        with open(byte_level, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self.words = Remembered(self._word, 200_000)

    def _word(self, word: str) -> bytes:
        ids = self.pieces.encode(word)
        return struct.pack(f"<{len(ids) + 2}I", *ids, _FALLBACK | sum(map(self.is_byte.__getitem__, ids)),
                           _LEVEL | len(self.bytes.encode_ordinary(" " + word)))

    def __call__(self, words: list[str]) -> tuple[np.ndarray, int, int]:
        """(piece ids, byte-fallback pieces, byte-level tokens) of the words."""
        packed = np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype="<u4")
        ids, fallback, level = packed[packed < _FALLBACK], packed[packed & _FALLBACK > 0], packed[packed >= _LEVEL]
        return ids, int((fallback & (_FALLBACK - 1)).sum()), int((level & (_LEVEL - 1)).sum())


def vocabularies(pieces: str, byte_level: str) -> Vocabularies:
    """The vocabularies of this Python worker, kept between tasks."""
    return held(("fertility", pieces, byte_level), lambda: Vocabularies(pieces, byte_level))


def repeat_words(words: list[str]) -> int:
    """Words in windows of three that occur twice or more, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    marked = bytearray(len(words))
    for i, w in enumerate(windows):
        if w in often:
            marked[i:i + 3] = b"\x01\x01\x01"
    return sum(marked)


def dup_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if n > 1 and _WORD.search(line))


def dominant_script(words: list[str]) -> str:
    """The script with the most letters; ``None`` without letters, ties go to the name that sorts first."""
    letters = "".join(c for w in words for c in w if c.isalpha())
    if not letters:
        return "None"
    if letters.isascii():
        return "Latin"
    points = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    counts: Counter = Counter()
    for k, n in enumerate(np.bincount(np.searchsorted(_STARTS, points, "right") - 1, minlength=len(_SCRIPTS))):
        counts[_SCRIPTS[k][1]] += int(n)
    return min(counts, key=lambda s: (-counts[s], s))


def entropy_share(ids: np.ndarray) -> float:
    """Entropy of the tokens over the most that so many tokens could have; 0 to 1, 1 for a single token."""
    if len(ids) < 2:
        return 1.0
    _, n = np.unique(ids, return_counts=True)
    p = n / len(ids)
    return float(-(p * np.log2(p)).sum() / np.log2(len(ids))) + 0.0


def measure(text: str | None, voc: Vocabularies, need_script: bool) -> tuple:
    text = text or ""
    words = _WORD.findall(text)
    if not words:
        return (0, 0, 0, 0, 0, "None", None, None, None, None)
    chars = sum(map(len, words))
    ids, n_fallback, n_bytes = voc(words)
    return (len(words), chars, sum(map(text.count, _SYMBOLS)), dup_lines(text), repeat_words(words),
            dominant_script(words) if need_script else "Known", chars / max(1, len(ids)), chars / max(1, n_bytes),
            n_fallback / max(1, len(ids)), entropy_share(ids))


def fertility_features(docs: DataFrame) -> DataFrame:
    """(doc_id, key, grp, features...) of every row; ``key`` is a hash of doc_id, lang and text.

    ``grp`` is the language, or ``script:<name>`` where it is null or blank.
    """
    slim = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    slim = slim.withColumn("key", F.xxhash64("doc_id", "lang", "text")).withColumn(
        "lang", F.expr("nullif(trim(lang), '')"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    names = [c.split()[0] for c in FEATURES.split(", ")]

    def make():
        voc = vocabularies(public_tokenizer(PIECES), public_tokenizer(BYTES))

        def f(part):
            found = [measure(t, voc, g is None) for t, g in zip(part["text"], part["lang"])]
            out = dict(zip(names, map(list, zip(*found))))
            grp = [g if g is not None else f"script:{s}" for g, s in zip(part["lang"], out.pop("script"))]
            return {"doc_id": part["doc_id"], "key": part["key"], "grp": grp} | out
        return f

    schema = f"doc_id {id_type}, key long, grp string, " + FEATURES.replace("script string, ", "")
    return map_rows(slim, schema, make)


def _base_failed():
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def _off(measure: str):
    """Deviation of a document from the median of its group."""
    off = F.col(measure) - F.col(f"{measure}_median")
    return off * F.sqrt("n_words") if BANDS[measure][0] else off


def _quantiles(rows: DataFrame, values: dict, steps: int, at: list[float]) -> DataFrame:
    """(grp, n_group, <measure>) with the quantiles of each measure per group, of values on a grid of 1 / ``steps``.

    Exact on the grid, so equal in every run whatever the order of partial
    results; the grid bounds what a group's quantiles are taken from.
    """
    points = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.round(v * steps).cast("long").alias("v"))
                                 for m, v in values.items()])).alias("x")
    counts = rows.select("grp", points).groupBy("grp", "x.m", "x.v").count()
    found = counts.groupBy("grp", "m").agg(F.sum("count").alias("n"), F.percentile(
        "v", F.array(*map(F.lit, at)), F.col("count")).alias("q"))
    own = [F.max(F.when(F.col("m") == m, F.transform("q", lambda x: x / steps))).alias(m) for m in values]
    return found.groupBy("grp").agg(F.max("n").alias("n_group"), *own)


def fertility_bands(features: DataFrame) -> DataFrame:
    """Bands per language or script: n_group, <measure>_median and _spread.

    They cover every document that passes the base rules; all aggregates are
    partial, so a language that holds most rows doesn't gather in one task.
    The spread is the distance of the quartiles of the deviations from the
    median, in standard deviations of a normal law.
    """
    passed = features.where(~_base_failed())
    centre = _quantiles(passed, {m: F.col(m) for m in BANDS}, MEDIAN_STEPS, [0.5])
    centre = centre.select("grp", "n_group", *[F.col(m)[0].alias(f"{m}_median") for m in BANDS])
    # a written table has a known size: a few languages are broadcast, very many aren't
    centre = materialize(centre, "fertility-centres")
    around = _quantiles(passed.join(centre, "grp"), {m: _off(m) for m in BANDS}, DEVIATION_STEPS, [0.25, 0.75])
    spreads = [F.greatest((F.col(m)[1] - F.col(m)[0]) / 1.349, F.lit(least)).alias(f"{m}_spread")
               for m, (_, _, _, least) in BANDS.items()]
    return materialize(around.select("grp", *spreads).join(centre, "grp"), "fertility-bands")


def _limit(deviations: float):
    """Deviations that a document may be off where median and spread come from n_group documents.

    The value of Student's law (Wallace's approximation) that is as rare as
    ``deviations`` of a normal law, times the uncertainty of the median: as
    given for large groups, wider without a jump the fewer documents tell.
    """
    free = QUARTILES_WORTH * F.col("n_group")
    return F.sqrt(free * F.expm1(deviations ** 2 / free)) * F.sqrt(1 + math.pi / 2 / F.col("n_group"))


def judge(features: DataFrame, bands: DataFrame) -> DataFrame:
    """Features with base_failed, kept and the reasons of a rejection."""
    limits = [c for c in bands.columns if c != "grp"]
    joined = features.join(bands, "grp", "left")
    rules = []
    for m, (_, low, high, _) in BANDS.items():
        z = _off(m) / F.col(f"{m}_spread")
        rules += [F.when(z < -_limit(low), F.lit(f"{m}_low"))] if low else []
        rules += [F.when(z > _limit(high), F.lit(f"{m}_high"))] if high else []
    reasons = F.array_join(F.array_compact(F.array(*rules)), ",")
    return (joined.withColumn("base_failed", _base_failed()).withColumn("reasons", reasons)
            .withColumn("kept", ~F.col("base_failed") & (F.col("reasons") == "")).drop(*limits))


def fertility_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text): counts, measures, base_failed, kept, reasons.

    Null or blank texts have no words and fail the base rules. Repeated rows
    get equal verdicts, an empty table gives no rows, extra columns aren't
    read. Every language has bands of its own, wider the fewer its documents; if
    none passes the base rules there are no bands and the base rules alone decide.
    """
    features = materialize(fertility_features(docs), "fertility")
    return judge(features, fertility_bands(features))


def keep_fertile(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are."""
    verdicts = fertility_rules(docs).where("kept").select(F.col("key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", F.col("lang").cast("string"), F.col("text").cast("string")))
    return keyed.join(verdicts, "__key", "left_semi").select(*docs.columns)
