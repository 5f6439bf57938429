"""What the operators share: reading tables, shared written tables, text columns as numpy arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine (tests) a new temporary one where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder: it cuts the lineage and survives lost executors."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def remove(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables of `written` that nothing will read any more: all that came from them is written."""
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), a null text being empty. Other columns, whatever their names, stay out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or with as many _ behind it as make it a name that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids that no model may learn from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes as one array, and where each row begins (one more entry for the end). Null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def blocks(at: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes, of one row at least."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j
        i = j


def splitmix(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class SpanHash:
    """64-bit hashes of byte spans from prefix sums of byte values times powers of an odd base (modulo 2^64).

    The byte values are mixed first and the sums after, so that equal hashes mean equal spans but for one pair in about 2^64. That
    holds for spans of up to SHORT bytes; some constructed longer ones have equal sums under any odd base.
    """

    BASE, SHORT = 0x9E3779B97F4A7C15 | 1, 256
    VALUES = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(0xA5A5))

    def __init__(self, most: int = 1 << 16):
        self.grow(most)

    def grow(self, most: int) -> None:
        def powers(b: int) -> np.ndarray:
            out = np.full(most + 1, np.uint64(b), np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self.up, self.down = powers(self.BASE), powers(pow(self.BASE, -1, 1 << 64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Sums before each byte of `data`; one entry more than bytes."""
        if len(data) >= len(self.up):
            self.grow(max(len(data), 2 * len(self.up)))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.VALUES[data] * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return splitmix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
