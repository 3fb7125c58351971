"""The query surface: one read-only SELECT, where rows come from, and the dictionary."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a free query shows at most.
SHOWN = 10_000


class NotAllowed(ValueError):
    """More than one statement, or one that is not a query."""


def guarded(spark: SparkSession, sql: str, limit: int | None = None, **args) -> DataFrame:
    """One SELECT over registered views, as parsed by Spark; commands, several statements and other relations are refused.

    A limit cuts the rows; `shown` tells whether there were more. Without one all rows come.
    """
    text = sql.strip().rstrip(";").strip()
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)  # refuses two statements by itself
    nodes = _nodes(plan)
    if any(re.search(r"Command|Insert|Create|Drop|Delete|Update|Merge|Truncate|Alter|Set|Cache|Analyze|Script", k) for k, _ in nodes):
        raise NotAllowed(f"not a query: {nodes[0][0]}")
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    known = views | {n for _, n in nodes if n.startswith("CTE:")}
    for kind, name in nodes:
        if kind == "UnresolvedRelation" and name not in views and f"CTE:{name}" not in known:
            raise NotAllowed(f"no registered view: {name}")
        if kind == "UnresolvedTableValuedFunction":
            raise NotAllowed(f"not a view: {name}")
    out = spark.sql(text, args=args or None)
    return out if limit is None else out.limit(limit)


def shown(spark: SparkSession, sql: str, limit: int = SHOWN, **args) -> tuple[DataFrame, bool]:
    """The first rows of a guarded query, and whether it has more than these."""
    some = guarded(spark, sql, limit + 1, **args)
    return some.limit(limit), some.count() > limit


def page(df: DataFrame, order: list, number: int, size: int = 500) -> DataFrame:
    """The n-th page of rows in a total order, counted from 0."""
    return df.orderBy(*order).offset(number * size).limit(size)


def sorted_rows(df: DataFrame, column: str, key: list[str], descending: bool = False) -> DataFrame:
    """Rows by a column, rows without a value last either way; numbers by value, ties by key."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), *key)


def bars(df: DataFrame, label: str, value: str, n: int = 15) -> DataFrame:
    """The first n rows with a value of zero or more, as they stand in the query's order."""
    return df.filter(F.col(value) >= 0).select(label, value).limit(n)


def _nodes(plan) -> list[tuple[str, str]]:  # noqa: ANN001
    """(kind, name) of every node of a parsed plan, subqueries and common table expressions included."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        name = node.name() if kind in ("UnresolvedRelation", "UnresolvedTableValuedFunction") else ""
        out.append((kind, str(name).strip("`").replace("`.`", ".")))
        if kind == "UnresolvedWith":
            rel = node.cteRelations().iterator()
            while rel.hasNext():
                r = rel.next()
                out.append(("CTE", f"CTE:{r._1()}"))
                todo.append(r._2())
        for parts in (node.children(), node.innerChildren(), node.subqueries()):
            it = parts.iterator()
            while it.hasNext():
                x = it.next()
                if hasattr(x, "children"):
                    todo.append(x)
    return out


def source_link(url: Column, page: Column) -> Column:
    return F.concat(url, F.lit("#page="), page.cast("string"))


def dictionary(df: DataFrame, name: str) -> DataFrame:
    """Columns of a table with type and place."""
    return df.sparkSession.createDataFrame([(name, k, c, t) for k, (c, t) in enumerate(df.dtypes)], "table_name string, ordinal int, column_name string, data_type string")


def contains_anywhere(df: DataFrame, text: str) -> DataFrame:
    """Rows that have a text in some column, whatever the case."""
    cells = F.array(*[F.lower(F.col(c).cast("string")) for c in df.columns])
    return df.filter(F.exists(cells, lambda x: F.coalesce(F.contains(x, F.lit(text.lower())), F.lit(False))))
