"""Skew-safe ordered scans within a group.

A plain ``Window.partitionBy(page).orderBy(pos)`` puts every row of a page in
one task; if one page holds a third of the corpus, one task sorts a third of
the corpus. The scans here are prefix scans over ranges of ``(group, pos)``:

1. the ordered key space is cut into ranges of about equal row counts, by
   bounds read off an even sample of the keys (a hash decides, so every
   evaluation of the plan cuts alike);
2. a window over ``(group, range)`` scans each range on its own;
3. one summary row per range holds the last group of the range with its value
   so far. Only that group can go on in the next range;
4. a window over the summaries (one row per range) gives the first group of
   each range its carry-in, which is broadcast back: its rows are at most
   ``MAX_RANGES`` whatever the input.

A small group lies in one range, a hot one is spread over many ranges of equal
size. Results equal the unbounded window exactly; groups of a null key count
as one group. ``order`` must be unique within a group (it is a position).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANGE = "__range"
# Bounds of what the driver reads: ranges, and sampled keys for each of them.
MAX_RANGES = 1 << 15
SAMPLED_PER_RANGE = 16
_HASHES = 1 << 40


def range_bounds(df: DataFrame, keys: Sequence[str], rows_per_range: int) -> list[str]:
    """Lower bounds (JSON, ascending) of all ranges but the first.

    There are as many ranges as shuffle partitions, more where those would hold
    over ``rows_per_range`` rows. The cut points decide only which task scans a
    row, never a result.
    """
    slim = df.select(*keys)
    n = slim.count()
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, n, max(shuffles, -(-n // rows_per_range)))
    if ranges <= 1:
        return []
    share = min(_HASHES, -(-_HASHES * ranges * SAMPLED_PER_RANGE // n))
    sample = slim.filter(F.pmod(F.xxhash64(*keys), F.lit(_HASHES)) < F.lit(share))
    found = [r[0] for r in sample.orderBy(*keys).select(F.to_json(F.struct(*keys))).collect()]
    picked = [found[k * len(found) // ranges] for k in range(1, ranges)] if found else []
    return list(dict.fromkeys(picked))


def range_index(df: DataFrame, keys: Sequence[str], bounds: Sequence[str]) -> Column:
    """Number of bounds at or below the row's key, by binary search in a constant array."""
    if not bounds:
        return F.lit(0)
    fields = ", ".join(f"`{k}`: {df.schema[k].dataType.simpleString()}" for k in keys)
    table = F.from_json(F.lit("[" + ",".join(bounds) + "]"), f"array<struct<{fields}>>")
    key = F.struct(*keys)
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(table, at + step - F.lit(1)) <= key, at + step).otherwise(at))


def _ranged(df: DataFrame, by: list[str], order: str, rows_per_range: int) -> tuple[DataFrame, bool]:
    """(rows with their range, more than one range or not); a range that is there already is kept."""
    if _RANGE in df.columns:
        return df, True
    keys = [*by, order]
    bounds = range_bounds(df, keys, rows_per_range)
    return df.withColumn(_RANGE, range_index(df, keys, bounds)), bool(bounds)


def range_tails(b: DataFrame, by: list[str], order: str, values: Sequence[str]) -> DataFrame:
    """One summary row per range: its first group, and its last group with ``values`` of that group's last row."""
    return b.groupBy(_RANGE).agg(
        F.min(F.struct(*by)).alias("head"),
        F.max_by(F.struct(*by, *values), F.struct(*by, order)).alias("tail"))


def _carry_in(b: DataFrame, by: list[str], order: str, carried: dict[str, Column]) -> DataFrame:
    """Add, for the first group of each range, ``carried`` folded over that group's earlier ranges (null without)."""
    types = {f.name: f.dataType for f in b.schema.fields}
    values = list(carried)
    head = F.struct(F.lit(0).alias("kind"), *[F.col("head")[g].alias(g) for g in by],
                    *[F.lit(None).cast(types[v]).alias(v) for v in values])
    tail = F.struct(F.lit(1).alias("kind"), *[F.col("tail")[g].alias(g) for g in by],
                    *[F.col("tail")[v].alias(v) for v in values])
    ends = range_tails(b, by, order, values).select(_RANGE, F.inline(F.array(head, tail)))
    earlier = (Window.partitionBy(*by).orderBy(_RANGE, "kind")
               .rowsBetween(Window.unboundedPreceding, -1))
    heads = ends.select("kind", F.col(_RANGE).alias("__at"), *[F.col(g).alias(f"__by{i}") for i, g in enumerate(by)],
                        *[fold.over(earlier).alias(v + "__prev") for v, fold in carried.items()]).filter("kind = 0")
    same = F.col(_RANGE) == F.col("__at")
    for i, g in enumerate(by):
        same = same & F.col(g).eqNullSafe(F.col(f"__by{i}"))
    # at most MAX_RANGES rows
    return (b.join(F.broadcast(heads.drop("kind")), same, "left")
            .drop("__at", *[f"__by{i}" for i in range(len(by))]))


def ordered_carry(df: DataFrame, by: Sequence[str], order: str, carry: Sequence[str],
                  bucket_width: int = 1 << 20, first: Sequence[str] = ()) -> DataFrame:
    """For each ``c`` in ``carry`` add ``c + "_carry"``: the last non-null ``c``
    at or before the row (ordered by ``order`` within ``by``).

    For each ``c`` in ``first`` add ``c + "_first"``: ``c`` of the row with the
    lowest ``order`` in the whole group. ``bucket_width`` is the number of rows
    a range holds at most, about.
    """
    by = list(by)
    b, several = _ranged(df, by, order, bucket_width)
    so_far = (Window.partitionBy(*by, _RANGE).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for c in carry:
        b = b.withColumn(c + "__in", F.last(c, ignorenulls=True).over(so_far))
    for c in first:  # in a struct, so that a null value is told from none
        b = b.withColumn(c + "__one", F.first(F.struct(F.col(c).alias("v"))).over(so_far))
    if several:
        b = _carry_in(b, by, order, {
            **{c + "__in": F.last(c + "__in", ignorenulls=True) for c in carry},
            **{c + "__one": F.first(c + "__one", ignorenulls=True) for c in first}})
    for c in carry:
        b = b.withColumn(c + "_carry", F.coalesce(c + "__in", c + "__in__prev") if several else F.col(c + "__in"))
    for c in first:
        b = b.withColumn(c + "_first", (F.coalesce(c + "__one__prev", c + "__one") if several
                                        else F.col(c + "__one")).getField("v"))
    made = [c + "__in" for c in carry] + [c + "__one" for c in first]
    return b.drop(_RANGE, *made, *[m + "__prev" for m in made])


def ordered_running_sum(df: DataFrame, by: Sequence[str], order: str, value: str, out: str,
                        bucket_width: int = 1 << 20, keep_ranges: bool = False) -> DataFrame:
    """``out`` = sum of ``value`` over rows at or before this one (by ``order``
    within ``by``), as a prefix scan over ranges. ``keep_ranges`` leaves the
    range column in place, so that a second scan over the same order shares the
    ranges and the exchange."""
    by = list(by)
    b, several = _ranged(df, by, order, bucket_width)
    so_far = (Window.partitionBy(*by, _RANGE).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    b = b.withColumn("__sum", F.sum(value).over(so_far))
    if several:
        b = _carry_in(b, by, order, {"__sum": F.sum("__sum")})
        b = b.withColumn(out, F.col("__sum") + F.coalesce("__sum__prev", F.lit(0)))
    else:
        b = b.withColumn(out, F.col("__sum"))
    return b.drop("__sum", "__sum__prev", *([] if keep_ranges else [_RANGE]))
