"""What the operators share: shipping code, shared tables, size-checked broadcasts, text columns."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table, in rows, that a join may broadcast; larger ones are shuffled.
BROADCAST_ROWS = 20_000

#: Rows and bytes that go to a Python worker at once, at most.
BATCH_ROWS, BATCH_BYTES = 2_000, "16m"

_shipped: set[str] = set()
_own_dir: list[str] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that workers import it from anywhere."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)  # texts may be very long
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    at = os.path.join(tempfile.mkdtemp(), "pagelake_llm.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "pagelake")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(at)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or our own where it is unset and all run on one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: there is no folder that all machines share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="pagelake-"))
    return "file://" + _own_dir[0]


#: Whether the shuffle files of a query go as soon as it is done; what is written needs them no more.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors, frees its shuffles."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(at, compression=codec)
    finally:
        spark.conf.set(CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(at)
    out._saved_at = at
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that save() wrote, once nothing reads it any more."""
    spark, at = df.sparkSession, getattr(df, "_saved_at", None)
    if at:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has no more than so many rows, else as it is (a shuffle join follows)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def frequent(df: DataFrame, rows: int) -> DataFrame:
    """The rows of df of largest `n` (a count), so many at most: from a bound that a histogram of n, 4,096 rows at most, tells.

    No sort, and no task sees more than its own rows. Rows alike in n are all in or all out, as far as buckets go.
    """
    bucket = F.floor(F.log2("n") * 64)
    held, bound = 0, None
    for r in df.filter("n > 0").groupBy(bucket.alias("b")).agg(F.count("*").alias("k")).orderBy(F.desc("b")).collect():
        held += r["k"]
        if held > rows:
            break
        bound = r["b"]
    return df.filter(bucket >= bound) if bound is not None else df.limit(0)


def column(df: DataFrame, name: str, kind: str) -> Column:
    """A column of df by its exact name, cast; null where df has none."""
    return (df[name].cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name)


def texts(df: DataFrame) -> DataFrame:
    """doc_id and the text's UTF-8 bytes (null text: empty), whatever other columns df has."""
    return df.select(column(df, "doc_id", "bigint"), F.coalesce(column(df, "text", "string"), F.lit("")).cast("binary").alias("raw"))


def per_text(df: DataFrame, measure: Callable[[bytes], tuple], schema: str) -> DataFrame:
    """One row per row of df: doc_id, then what measure(bytes) returns. schema: of the latter."""
    ship(df.sparkSession)
    names = [x.split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = arrow_types(schema)
        for batch in batches:
            got = [measure(x.as_py()) for x in batch["raw"]]
            cols = list(zip(*got, strict=True)) if got else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["doc_id", *names])

    return texts(df).mapInArrow(run, f"doc_id long, {schema}")


@functools.lru_cache
def arrow_types(schema: str) -> list[pa.DataType]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    return [kinds[x.split()[1]] for x in schema.split(",")]


def lists(cuts: list[int], **columns: pa.Array) -> pa.ListArray:
    """A list of structs for each row, from the columns of all and the places where rows end."""
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
