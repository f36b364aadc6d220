"""What the operators share: reading, text rules and intermediate tables."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The letters that lower-casing touches, the bytes that part words.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORD = r"[^\x20\x09-\x0D]+"

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def folded(text: str | None) -> bytes:
    """UTF-8 of a text with A-Z lower-cased and nothing else; null is empty."""
    return (text or "").encode().translate(_FOLD)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words; bytes.split() parts at exactly 0x20 and 0x09-0x0D."""
    return folded(text).split()


def entries(column: pa.BinaryArray) -> list[bytes]:
    """The values of an Arrow column without nulls."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset :][: len(column) + 1].tolist()
    raw = data.to_pybytes() if data else b""
    return [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def text_id(column: str) -> Column:
    """An integer id on its way through pandas, which holds longs beside nulls as doubles."""
    return F.col(column).cast("long").cast("string").alias("id")


def with_row_key(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc, row): each row as one struct, with a key that only equal rows share.

    Inside the struct no column of the documents can clash with one of an operator.
    """
    named = [F.col(f"`{c}`") for c in docs.columns]
    parts = [x for c in named for x in (c, F.isnull(c))]
    body = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(
        F.struct(*named).alias("doc"), F.concat(body, F.hex(F.xxhash64(*parts))).alias("row")
    )


def fields(keyed: DataFrame, *names: str) -> DataFrame:
    """The row key and these columns of the documents."""
    return keyed.select("row", *[F.col(f"doc.{c}").alias(c) for c in names])


def without_rows(keyed: DataFrame, gone: DataFrame, twins: DataFrame) -> DataFrame:
    """The documents less those ``gone`` and all but one of the equal rows ``twins``."""
    rest = keyed.join(gone.union(twins), "row", "left_anti")
    one = keyed.join(twins, "row", "left_semi").dropDuplicates(["row"])
    return rest.unionByName(one).select("doc.*")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# Texts are long: batches for Python workers are bounded by size, not only rows.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker gets at once, unless the session has its own."""
    chosen = spark._jsparkSession.sessionState().conf()
    for key, value in BATCHES.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Where all executors can write: the checkpoint folder the session names.

    Where none is named, as in tests, the warehouse folder, which is shared too.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = named or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return root.rstrip("/") + "/clickstrata-llm"


# Tells Spark to remove a query's shuffle files as soon as the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_passing: ContextVar[tuple[list[Scratch], ...]] = ContextVar("passing", default=())


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What operators store and shuffle inside the block is removed with it.

    For callers that store what they need in a ``Scratch`` made before the block.
    """
    made: list[Scratch] = []
    token = _passing.set((*_passing.get(), made))
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
        _passing.reset(token)
        for scratch in made:
            scratch.drop("")


class Scratch:
    """Intermediate Parquet tables of one operator call.

    A stored table is computed once, outlives lost executors and has a known
    size, by which Spark picks the join.  ``drop`` removes those that nothing
    lazy reads any more; the others stay in the shared folder, to be removed by
    age like checkpoints.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = small_batches(spark)
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        for made in _passing.get():
            made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        df.write.options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            conf = self.spark._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


def range_numbered(
    scratch: Scratch, rows: DataFrame, order: list, name: str
) -> DataFrame:
    """The rows with their place in ``order``, from 1, in column ``name``.

    A range sort gives every task a stretch of the order; the stretches' lengths
    are summed up, one row a task.  Rows that agree in all of the order are dealt
    out by the place they were read from, so that even they fill several tasks.
    """
    read = rows.withColumn("_read", F.monotonically_increasing_id())
    sorted_ = read.repartitionByRange(*order, "_read").sortWithinPartitions(*order, "_read")
    placed = sorted_.drop("_read").withColumn("_at", F.monotonically_increasing_id())
    placed = scratch.store(placed, f"{name}-sorted").withColumns(
        {"_part": F.shiftright("_at", 33), "_in": F.col("_at").bitwiseAND((1 << 33) - 1)}
    )
    lengths = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = lengths.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts = F.broadcast(scratch.store(starts, f"{name}-starts"))  # one row a task
    place = (F.col("_start") + F.col("_in") + 1).alias(name)
    return placed.join(starts, "_part").select(*rows.columns, place)


def batches(rows: Iterator, limit: int, size) -> Iterator[list]:
    """Lists of rows of at most ``limit`` in all (or a single larger row)."""
    held, total = [], 0
    for row in rows:
        n = size(row)
        if held and total + n > limit:
            yield held
            held, total = [], 0
        held.append(row)
        total += n
    if held:
        yield held


def worker_store() -> dict:
    """What a Python worker keeps between tasks, such as tokenizers and caches."""
    kept = sys.modules.setdefault("clickstrata_worker", ModuleType("clickstrata_worker"))
    return vars(kept)


def file_uri(spark: SparkSession, path: str) -> str:
    """The path with its file system, in the form that pyarrow reads."""
    conf = spark._jsc.hadoopConfiguration()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(conf).makeQualified(hadoop).toString()
    return re.sub(r"^file:/+", "file:///", full)


def write_bytes(uri: str, parts: Iterable[bytes]) -> None:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        for part in parts:
            out.write(part)


def read_bytes(uri: str) -> bytes:
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path, compression=None) as source:
        return source.read()
