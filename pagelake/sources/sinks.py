"""Writers: text tables without stray tabs, tables by key, and provenance records."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def neutral(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "[\t\r\n]", " ")


def write_tsv(df: DataFrame, path: str) -> None:
    df.select([neutral(F.col(c)).alias(c) for c in df.columns]).write.mode("overwrite").csv(path, sep="\t", header=True, quote="")


def write_csv(df: DataFrame, path: str, source: Column | None = None) -> None:
    """Comma-separated with doubled quotes; the address of each row's source as last column, if given."""
    out = df if source is None else df.withColumn("source", source)
    out.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def csv_line(df: DataFrame, source: Column | None = None) -> Column:
    """A row as RFC 4180 text: fields in quotes where they need them, quotes doubled, null empty; the source's address last."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    quoted = lambda c: F.when(text(c).rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text(c), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text(c))
    return F.concat_ws(",", *[quoted(F.col(c)) for c in df.columns], *([] if source is None else [quoted(source)]))


def write_client_csv(df: DataFrame, path: str, order: list, source: Column | None = None) -> None:
    """Shown rows in their order as one file for spreadsheets: byte order mark, header, lines that end in CR LF."""
    title = "\ufeff" + ",".join([*df.columns, *(["source"] if source is not None else [])])
    head = df.sparkSession.createDataFrame([(title, 0)], "_line string, _rows int")
    lines = df.withColumns({"_line": csv_line(df, source), "_rows": F.lit(1)}).unionByName(head, allowMissingColumns=True)
    one = lines.repartition(1).sortWithinPartitions("_rows", *order).select(F.col("_line").alias("value"))
    one.write.mode("overwrite").option("lineSep", "\r\n").text(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the table and put it in its place when all is there, so that no reader sees half of it."""
    spark = df.sparkSession
    to, new = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, f"{path}.tmp-{uuid.uuid4().hex}"))
    df.write.parquet(new.toString())
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(to, True)
    if not fs.rename(new, to):
        raise OSError(f"could not put {new} in the place of {to}")


def write_years(df: DataFrame, path: str) -> None:
    """One folder a year; years that df has are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new, and what old has under other keys; null keys are keys like others."""
    o, n = old.alias("o"), new.select(keys).distinct().alias("n")
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return o.join(n, cond, "left_anti").unionByName(new)


def provenance(*fields: Column) -> Column:
    """A JSON record of where a row comes from, fields in alphabetical order."""
    return F.to_json(F.struct(*fields))
