"""Made pages for queries: every row of a driver's table carries one of a few written-out cases, by its key.

What an operator must give for each case is written out beside it, from the archive's rules and not from the code; the
SQL says just that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.sources.tables import spread, table


def dealt(spark: SparkSession, d: str, cases: dict[str, list], source: str = "part", key: str = "p_partkey") -> DataFrame:
    """Every row of a table: its key, its kind (key modulo the number of cases) and the case's columns. Rows are dealt to
    many tasks first, as a table of a few megabytes would be read, and every case worked out, by one.
    """
    n = len(next(iter(cases.values())))
    kind = (F.col(key) % n).cast("int")
    cols = []
    for name, values in cases.items():
        made = [F.array(*map(F.lit, v)) if isinstance(v, list) and v else F.array().cast("array<string>") if isinstance(v, list) else F.lit(v) for v in values]
        cols.append(F.element_at(F.array(*made), kind + 1).alias(name))
    return spread(table(spark, d, source).select(key), key).select(key, kind.alias("kind"), *cols)


def literal(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def told(expected: dict[str, list], source: str = "part", key: str = "p_partkey") -> str:
    """The SQL of what is expected of every row."""
    n = len(next(iter(expected.values())))
    cast = lambda vs: "::BOOLEAN" if any(isinstance(v, bool) for v in vs) else "::BIGINT" if any(isinstance(v, int) for v in vs) else "::DOUBLE" if any(isinstance(v, float) for v in vs) else "::VARCHAR"
    cols = [f"(CASE {key} % {n} " + " ".join(f"WHEN {k} THEN {literal(v)}" for k, v in enumerate(vs)) + f" END){cast(vs)} AS {name}" for name, vs in expected.items()]
    return f"SELECT {key}, {', '.join(cols)} FROM {source}"
