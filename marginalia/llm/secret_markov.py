"""Secret scans with character Markov models, in DataFrame functions only.

Fixed patterns find assigned secrets, access keys and long hexadecimal runs.
Other long runs of key characters are scored by two first-order Markov models
of characters, one of random strings and one of ordinary identifiers, trained
from labelled samples: a run whose log-likelihood ratio per transition is above
a threshold becomes a further span. The model is one array indexed by character
pair (6,561 numbers, whatever the input) that reaches the scan as a constant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import constant

# The base patterns, in the order of the result.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ["assign", "access", "hex", "markov"]
# Runs the models look at: whole runs of key characters.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
RUN_LEAST = 20
# Log-likelihood ratio per transition (natural log) from which a run counts as random.
THRESHOLD = 0.35
# Labelled samples: so many random strings of each alphabet and identifiers of each style, by rule.
SAMPLES = 1500
SMOOTHING = 0.5
# Key characters lie between '+' and 'z': code 1 to 80; every other character is 0.
_FIRST, _CHARS = 43, 81

# Parts of ordinary identifiers and words of several languages.
PARTS = (
    "get set is has make build create update delete remove insert append find search select order group index count "
    "value values name names user users account customer address email phone number date time start finish begin end "
    "first last next previous current default global local public private static final abstract interface class "
    "method function module package library version release config configuration setting option parameter argument "
    "result response request message error warning exception handler listener manager service client server session "
    "connection database table column record field string integer boolean object array list queue stack buffer "
    "stream reader writer parser formatter serializer content document page section header footer image picture "
    "color width height length position offset window screen button action event process thread worker schedule "
    "information international communication administration responsibility understanding development environment "
    "government education organization application transaction authentication authorization implementation "
    "verantwortung gesellschaft entwicklung wirtschaft beziehung einrichtung geschwindigkeit wissenschaft freiheit "
    "sprache zeitung nachricht verbindung schule strasse beispiel entscheidung veranstaltung "
    "gouvernement developpement connaissance administration environnement responsable appartement naissance "
    "ensemble toujours maintenant beaucoup questionnaire representation "
    "gobierno desarrollo conocimiento administracion ciudadano responsabilidad universidad informacion "
    "nacimiento siempre ahora escuela mensaje representacion")


def labelled_samples(spark: SparkSession, per_kind: int = SAMPLES) -> DataFrame:
    """(sample, random): random strings of several alphabets, and identifiers and plain numbers made by rule."""
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    b64 = F.base64(F.unhex(digest))
    random = spark.range(per_kind).select(F.explode(F.array(
        digest, F.substring(digest, 1, 32), F.upper(F.substring(digest, 1, 40)), F.substring(b64, 1, 40),
        F.upper(F.regexp_replace(b64, "[+/=]", "")),
        F.lower(F.regexp_replace(b64, "[+/=]", "")), F.regexp_replace(b64, "[+/=]", ""))).alias("sample"),
        F.lit(True).alias("random"))
    words = F.split(F.lit(PARTS), " ")
    pick = lambda k: F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(k)), F.size(words)) + 1).cast("int"))
    four = [pick(k) for k in range(4)]
    number = F.pmod(F.xxhash64("id"), F.lit(100)).cast("string")
    ordinary = spark.range(per_kind).select(F.explode(F.array(
        F.concat_ws("_", *four), F.concat(four[0], *[F.initcap(w) for w in four[1:]]), F.concat_ws("-", *four),
        F.concat_ws("/", *four), F.upper(F.concat_ws("_", *four)), F.concat(*four),
        F.concat(F.concat_ws("_", *four[:3]), F.lit("_"), number), F.upper(F.concat(*four)),
        F.concat(F.lit("2024-0"), number, F.lit("-"), number, F.lit("/"), F.concat_ws("-", *four[:2])),
        F.rpad(F.lit("="), 24, "="), F.rpad(F.lit("-"), 24, "-"), F.rpad(F.lit("_"), 24, "_"),
        F.lpad(number, 20, "0"), F.concat(*[F.lpad(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10000)).cast("string"), 4, "0")
                                             for k in range(5)]))).alias("sample"),
        F.lit(False).alias("random"))
    return random.unionByName(ordinary)


def _codes(text: Column) -> Column:
    """Character codes from 0 to 80."""
    def code(c):
        a = F.ascii(c) - (_FIRST - 1)
        return F.when(a.between(1, _CHARS - 1), a).otherwise(F.lit(0))
    return F.transform(F.split(text, ""), code)


def _pairs(codes: Column) -> Column:
    """Index of each transition in the model's array, from 1."""
    return F.zip_with(F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))),
                      F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0))),
                      lambda a, b: a * _CHARS + b + 1)


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of each character pair, smoothed; index a * 81 + b + 1.

    Null samples and labels are left out; without samples every ratio is 0.
    """
    spark = samples.sparkSession
    pairs = (samples.where("sample is not null and random is not null")
             .select("random", F.explode(_pairs(_codes(F.col("sample")))).alias("pair"))
             .groupBy("pair").agg(F.sum(F.col("random").cast("long")).alias("r"),
                                  F.sum((~F.col("random")).cast("long")).alias("o")))
    grid = spark.range(1, _CHARS * _CHARS + 1).select(F.col("id").alias("pair"))
    every = grid.join(pairs, "pair", "left").na.fill(0).withColumn("a", F.floor((F.col("pair") - 1) / _CHARS))
    first = every.groupBy("a").agg(F.sum("r").alias("ra"), F.sum("o").alias("oa"))
    smooth, alphabet = F.lit(SMOOTHING), 64
    ratio = (F.log((F.col("r") + smooth) / (F.col("ra") + smooth * alphabet))
             - F.log((F.col("o") + smooth) / (F.col("oa") + smooth * alphabet)))
    table = every.join(first, "a").select(F.struct("pair", ratio.alias("v")).alias("x"))
    return [round(r["x"]["v"], 6) for r in table.orderBy("x.pair").collect()]  # one number per pair of characters


def ratio_per_transition(run: Column, model: Column) -> Column:
    pairs = _pairs(_codes(run))
    total = F.aggregate(pairs, F.lit(0.0), lambda s, i: s + F.element_at(model, i))
    return F.when(F.size(pairs) > 0, total / F.size(pairs)).otherwise(F.lit(0.0))


def _spans(text: Column, matches: Column, pattern: str, kind: int) -> Column:
    """Array of (start, kind, end, match): a split at the matches gives the gaps between them."""
    gaps = F.split(text, pattern, -1)
    zero = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    start = F.struct(F.lit(0).alias("at"), zero.alias("out"))

    def step(acc, pair):
        begin = acc["at"] + pair["g"]
        end = begin + F.length(pair["m"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["m"].alias("match"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(zero)


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, model: list[float] | None = None, threshold: float = THRESHOLD,
                 run_least: int = RUN_LEAST) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans, base, added) of every row.

    ``base`` and ``added`` are arrays of (start, kind, end, match) in code
    points, end exclusive; a run that overlaps a base span isn't added. Null
    and empty texts have no spans (the digest is that of the empty string);
    repeated rows get equal answers; extra columns aren't read.
    """
    spark = docs.sparkSession
    if model is None:
        model = train(labelled_samples(spark))
    text = F.col("t")
    hex_runs = HEX.replace("+", "{%d,}" % HEX_LEAST)  # a maximal run either way
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t")).select(
        "doc_id", "t", F.regexp_extract_all("t", F.lit(ASSIGN), 0).alias("m1"),
        F.regexp_extract_all("t", F.lit(ACCESS), 0).alias("m2"),
        F.regexp_extract_all("t", F.lit(hex_runs), 0).alias("m3"),
        F.regexp_extract_all("t", F.lit(RUN % run_least), 0).alias("m4"))
    spans = found.select(
        "doc_id",
        F.filter(_spans(text, F.col("m1"), ASSIGN, 1),
                 lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LEAST).alias("s1"),
        F.filter(_spans(text, F.col("m2"), ACCESS, 2), lambda s: F.length(s["match"]) >= ACCESS_LEAST).alias("s2"),
        _spans(text, F.col("m3"), hex_runs, 3).alias("s3"),
        _spans(text, F.col("m4"), RUN % run_least, 4).alias("s4"))
    spans = spans.withColumn("base", F.array_sort(F.concat("s1", "s2", "s3")))
    apart = F.filter(F.col("s4"), lambda s: ~F.exists(
        F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    added = F.when(F.size("s4") == 0, F.col("s4")).otherwise(
        F.filter(apart, lambda s: ratio_per_transition(s["match"], constant(model, "double")) > threshold))
    done = spans.withColumn("added", added)
    return done.select(
        "doc_id", F.size("s1").cast("long").alias("n_assign"), F.size("s2").cast("long").alias("n_access"),
        F.size("s3").cast("long").alias("n_hex"), F.size("added").cast("long").alias("n_markov"),
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "added"))).alias("spans"), "base", "added")
