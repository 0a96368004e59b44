"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import ctypes
import glob
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(os.path.dirname(here))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="wayfare-"))  # on the driver, which hands the file out
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "wayfare_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name in [os.path.join(os.path.dirname(here), "__init__.py"), *sorted(glob.glob(os.path.join(here, "*.py")))]:
            z.write(name, os.path.relpath(name, top))
    sc.addPyFile(path)


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the folder named by ``spark.checkpoint.dir``, which all executors share.

    The shuffle files behind it are of no more use, but Spark deletes them only when the driver collects garbage, so it is asked to.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(named)
    kept = df.checkpoint()
    spark.sparkContext._jvm.System.gc()
    return kept


def stored_at(df: DataFrame, name: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """``df`` written once as Parquet into the folder all executors share and read from there, and its path."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = os.path.join(folder, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("parquet.block.size", 8 << 20).parquet(path, compression=compression)  # a writer holds a block in memory
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored_at` for tables that stay."""
    return stored_at(df, name)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`stored_at` that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut_narrow(df: DataFrame) -> DataFrame:
    """:func:`cut` for tables of a few numbers a row: an eighth of the shuffle partitions hold them."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.coalesce(max(1, parts // 8)))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so that no other column can clash."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


ARROW = {
    "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()),
}


def give_back() -> None:
    """Return what is freed to the system. Spark keeps Python workers from stage to stage, and with them what their allocators hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def map_texts(df: DataFrame, make: Callable[[list[str | None]], tuple[dict, np.ndarray | None]], fields: str, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Apply ``make`` to the texts of each Arrow batch of ``text`` and the ``carried`` long columns.

    ``make`` returns the columns named in ``fields`` ("name type, ..."), and for each row the
    number of its text in the batch (None: one row for each text, in order). Carried columns
    pass through unread, so that nulls and large values stay as they are.
    """
    ship(df.sparkSession)
    kinds = [f.split() for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns, owner = make(batch.column("text").to_pylist())
            kept = [batch.column(c) for c in carried]
            kept = kept if owner is None else [c.take(pa.array(owner, pa.int64())) for c in kept]
            arrays = [c if isinstance(c := columns[n], pa.Array) else pa.array(c, ARROW[k]) for n, k in kinds]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], names=[*carried, *[n for n, _ in kinds]])
            del batch, columns, owner, kept, arrays
        give_back()

    return df.select(*carried, "text").mapInArrow(run, ", ".join([*[f"{c} long" for c in carried], fields]))


def pieces(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs ``[a, b)`` of consecutive items whose sizes add to at most ``limit`` (one item at least)."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if i >= 0:
        yield start, i + 1


def crc_mod(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 where the id is null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(-1))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values evenly (in place on a fresh array)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_WEIGHTS = [np.ones(0, np.uint64)]


def _weights(n: int) -> np.ndarray:
    """Fixed pseudo-random numbers, one for each place of a slice."""
    if len(_WEIGHTS[0]) < n:
        _WEIGHTS[0] = mix(np.arange(1, 1 + (1 << max(16, (n - 1).bit_length())), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _WEIGHTS[0]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices ``codes[start:end]`` (bytes or code points), all at once.

    Slices follow each other and do not overlap. Each code is multiplied by the number of its place in its
    slice, and these have no structure (powers of a base do: modulo 2**64 some words then meet under any base).
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    weights, n = _weights(int(size.max())), len(codes)
    begin = np.zeros(n, np.int32)
    begin[starts] = starts
    place = np.arange(n, dtype=np.int32)  # not kept: as long as the batch
    place -= np.maximum.accumulate(begin, out=begin)
    total = np.zeros(n + 1, np.uint64)
    part = weights.take(place, mode="clip")  # what lies between slices may be farther than any place in one
    np.multiply(part, codes, out=part, casting="unsafe")
    np.cumsum(part, out=total[1:])
    return mix(total[ends] - total[starts] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
