"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from snapfold.session import scratch_path

# rows, and bytes of text unless a single one has more, handed to Python code at once, so
# that a batch of very long texts is turned into Python strings a few at a time
SLICE_ROWS = 128
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: later
    steps and lost executors re-read files instead of recomputing."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; null text is empty.
    Other columns of ``docs``, whatever their names, never reach the operator."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _text_bytes(column: pa.Array, n: int) -> np.ndarray:
    """Bytes of text in each row, fields of structs included."""
    if pa.types.is_struct(column.type):
        return sum((_text_bytes(c, n) for c in column.flatten()), np.zeros(n, dtype=np.int64))
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.zeros(n, dtype=np.int64)


def slices(batch: pa.RecordBatch):
    """The batch in slices of SLICE_ROWS rows and SLICE_BYTES of text at most, or of one row."""
    n, at = batch.num_rows, 0
    ends = np.cumsum(sum((_text_bytes(c, n) for c in batch.columns), np.zeros(n, dtype=np.int64)))
    while at < n:
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right"))
        to = min(n, at + SLICE_ROWS, max(full, at + 1))
        yield batch.slice(at, to - at)
        at = to


def map_slices(df: DataFrame, make, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` in slices. ``make()`` runs once per task and returns
    ``f(slice: RecordBatch) -> RecordBatch | None``."""
    def run(batches):
        f = make()
        for batch in batches:
            for some in slices(batch):
                out = f(some)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


# ---- vectors

def finite(vec: Column) -> Column:
    """True for an array without null or non-finite entries; false for a null one."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(fine, F.lit(False))


def commonest_length(rows: DataFrame, vec: str, parts: int = 1) -> int:
    """Of the lengths that divide into ``parts`` equal parts, the one that most vectors have,
    the longest of several; 0 without any."""
    n = (rows.groupBy(F.size(vec).alias("dim")).agg(F.count(F.lit(1)).alias("n"))
         .filter((F.col("dim") > 0) & (F.col("dim") % parts == 0)).orderBy(F.desc("n"), F.desc("dim")).first())
    return n["dim"] if n else 0


def matrix_of(column: pa.ListArray, dim: int) -> np.ndarray:
    """The rows of a batch's column of vectors of one length, as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


# ---- a table's own columns, whatever their names

OWN = "own"


def named(c: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + c.replace("`", "``") + "`")


def boxed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no column that an operator adds can
    meet one of theirs."""
    return F.struct(*[named(c).alias(c) for c in docs.columns]).alias(OWN)


def unboxed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``boxed`` put into OWN."""
    return df.select(*[F.col(OWN)[c].alias(c) for c in columns])


def with_score(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The columns of OWN, and column score under ``name``, which should be none of theirs."""
    return df.select(*[F.col(OWN)[c].alias(c) for c in columns], F.col("score").alias(name))


def hashable(c: Column, kind: DataType) -> Column:
    """``c`` in a form that hashes and compares: maps become their entries by key."""
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            hashable(e["key"], kind.keyType).alias("key"), hashable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: hashable(x, kind.elementType))
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[hashable(c[f.name], f.dataType).alias(f"f{k}")
                                                for k, f in enumerate(kind.fields)], F.lit(0)))
    return c


def batch_of(columns: dict[str, tuple[list, pa.DataType] | pa.Array]) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c[0], c[1]) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


class RunCache(dict):
    """Results of ``make(run)`` in two generations: once ``limit`` runs are held, ``turn``
    makes them the old generation, whose runs come back when they are met again. So
    memory is bounded and frequent runs stay. Runs over ``longest`` aren't kept."""

    def __init__(self, make, limit: int, longest: int = 48):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.old: dict = {}

    def __missing__(self, run):
        got = self.old.get(run)
        if got is None:
            got = self.make(run)
            if len(run) > self.longest:
                return got
        self[run] = got
        return got

    def knows(self, run) -> bool:
        return run in self or run in self.old

    def update_all(self, got: dict) -> None:
        self.update((k, v) for k, v in got.items() if len(k) <= self.longest)

    def turn(self) -> None:
        """To be called between texts."""
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
