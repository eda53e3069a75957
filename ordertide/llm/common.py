"""Helpers shared by the operators: input columns, Arrow batches, hashing."""

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Words are separated by the six ASCII white-space characters only.
WORD = r"[^\x20\x09-\x0D]+"
SLICE = 512
#: Rows that Spark hands to a Python worker at once, and the setting for it.
BATCH, BATCH_SETTING = 1024, "spark.sql.execution.arrow.maxRecordsPerBatch"


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pairs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns ``id`` and ``text``; other columns, however named, stay out."""
    return docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that only few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


_kept: dict[tuple, object] = {}


def kept(build: Callable) -> Callable:
    """``build`` with its result kept for the next task that asks for the same.

    Python workers outlive their stages, so they keep a single result among all
    functions: what one stage has loaded goes before the next one builds its own.
    """
    @wraps(build)
    def found(*given):
        key = build.__module__, build.__qualname__, given
        if key not in _kept:
            _kept.clear()
            _kept[key] = build(*given)
        return _kept[key]

    return found


def give_back() -> None:
    """Return freed memory to the system; a worker would hold it for as long as it lives."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim is not None:
        trim(0)


def short_batches(spark: SparkSession) -> None:
    """Hand rows to Python by BATCH, unless the session has a size of its own.

    A batch is whole in the executor and once more in the worker, outside the heap; with
    whole texts, Spark's default of 10,000 rows takes tens of MB of each for every task.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH)


def map_rows(df: DataFrame, make: Callable, schema: str, size: int = SLICE) -> DataFrame:
    """``make()`` runs once per task and gives a function from batch to arrays.

    The function returns one array (or list) per column of ``schema``.
    """
    short_batches(df.sparkSession)
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        give_back()  # what other kinds of tasks left in the worker
        step = make()
        for batch in slices(batches, size):
            columns = step(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                 for c, f in zip(columns, fields)], schema=fields)
        step = batch = columns = None
        give_back()

    return df.mapInArrow(run, schema)


def few_files(df: DataFrame, rows: int, per_file: int = 100_000) -> DataFrame:
    """``df`` in no more partitions than its about ``rows`` rows need, for writing it."""
    return df.coalesce(max(1, -(-rows // per_file)))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hashes of words, kept for at most ``bound`` words at a time."""

    def __init__(self, bound: int = 200_000):
        super().__init__()
        import xxhash

        self.bound, self.digest = bound, xxhash.xxh3_64_intdigest

    def __missing__(self, word):
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = self.digest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def held_out(id_col: str) -> Column:
    """Rows set aside for testing: crc32 of the id as text leaves remainder 1 of 3."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string")) % 3 == 1, F.lit(False))
