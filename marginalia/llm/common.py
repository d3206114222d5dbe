"""Helpers shared by the operators of this sub-package."""

from __future__ import annotations

import gc
import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Rows taken from an Arrow batch at a time: keeps the Python copies of long
# texts small whatever the size of the batch that Spark sends.
SLICE = 256


def public_tokenizer(name: str) -> str:
    """Path of a public vocabulary file on this machine (driver or executor)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread of shared files, and the
    Python work that made the rows isn't repeated by later consumers.
    """
    spark = df.sparkSession
    path = shared_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Python columns of at most ``SLICE`` rows, whatever the batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE).to_pydict()


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]]) -> DataFrame:
    """``mapInArrow`` with a function of column slices.

    ``make`` runs once per task and returns the function, so models and caches
    are built on the executor.
    """
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for part in rows(batches):
            yield pa.RecordBatch.from_pydict(f(part), schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def row_key(*cols: str) -> Column:
    """A key of the row's content, equal for repeated rows."""
    return F.xxhash64(*[F.col(c) for c in cols])


def runs(keys: Iterable) -> Iterator[tuple[object, int, int]]:
    """(key, from, to) of equal neighbours."""
    at = 0
    for key, group in itertools.groupby(keys):
        n = sum(1 for _ in group)
        yield key, at, at + n
        at += n


_HELD: dict = {}


def held(kind: tuple, make: Callable):
    """What a Python worker keeps between tasks: one model with its memo, that of the operator now at work.

    The one before is freed at once: model and memo refer to each other, and
    a full collection may not come by itself for the rest of a job.
    """
    if kind not in _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _HELD[kind] = make()
    return _HELD[kind]


class Remembered(dict):
    """Bounded memo: two generations, the older is dropped when the newer is full."""

    def __init__(self, make: Callable, limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


def constant(values: list, kind: str) -> Column:
    """A bounded list as one array constant: the optimizer folds it, so lambdas look elements up in place."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")
