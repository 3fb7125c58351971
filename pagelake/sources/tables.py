"""Tables by name under a folder, tab-separated rule files, and schema checks that refuse rather than guess."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Refused(ValueError):
    """The input is not what was agreed."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt by a key to a fixed number of tasks, which adaptive execution doesn't put together again.

    A table of a few megabytes is one task however much is done with each row; and small shuffled rows, put together to
    64 MB of compressed blocks, are gigabytes once they are sorted or hashed.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *by)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated file with a header line and # comments; every field is text until the schema types it."""
    return spark.read.csv(path, sep="\t", comment="#", header=True, schema=schema, quote="", mode="FAILFAST")


MANIFEST = "year INT, leg INT, num INT, vol STRING, file STRING, pages INT, url STRING"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Volumes of the archive. The verifier reads the same file by `volumes.verifier_manifest`."""
    return spark.read.csv(path, sep="\t", comment="#", schema=MANIFEST)


def volume_ordinal(stem: "F.Column") -> "F.Column":
    """1 to 5 from a file's stem: VOLUME or TOMO with a roman or arabic number, DOCUMENTO UNICO is 1, else null."""
    s = F.upper(stem)
    found = F.regexp_extract(s, r"(?:VOLUME|TOMO)[\s_-]*([IVX]+|\d+)", 1)
    roman = F.create_map(*[F.lit(x) for pair in {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5}.items() for x in pair])
    return F.when(s.contains("DOCUMENTO UNICO"), F.lit(1)).when(found == "", F.lit(None).cast("int")).otherwise(F.coalesce(F.try_element_at(roman, found), found.try_cast("int")))


def path_year(path: "F.Column") -> "F.Column":
    return F.regexp_extract(path, r"/((?:19|20)\d{2})/", 1).try_cast("int")


def agreed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df if it has exactly the agreed columns, in order; otherwise Refused."""
    if df.columns != schema.names:
        raise Refused(f"columns {df.columns}, agreed {schema.names}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def union_years(parts: list[DataFrame]) -> DataFrame:
    """Years one under the other; a year with other columns is refused."""
    first, *rest = parts
    for p in rest:
        if p.columns != first.columns:
            raise Refused(f"columns {p.columns} against {first.columns}")
        first = first.unionByName(p)
    return first


def one_file_each(volumes: DataFrame) -> DataFrame:
    """volumes (year, volume, file) if no pair has several files; otherwise Refused."""
    twice = volumes.groupBy("year", "volume").count().filter("count > 1").limit(1).collect()
    if twice:
        raise Refused(f"several files for {twice[0]['year']}, volume {twice[0]['volume']}")
    return volumes
