"""Ad-hoc SQL over the lifecycle tables (Z1) and table info.

Catalyst parses the statement; its plan tells whether it only reads. The text
itself is never edited, so literals may hold anything. Statements that write,
define or configure are refused before anything runs (the reference passes any
statement through to its database).
"""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from ..functions.sql import register


class NotAQuery(ValueError):
    """Only read-only queries are accepted."""


# Logical operators of a parsed plan that do more than read.
_COMMANDS = "org.apache.spark.sql.catalyst.plans.logical.Command"
_PARSED = "org.apache.spark.sql.catalyst.plans.logical.ParsedStatement"


def check_query(spark: SparkSession, sql: str) -> None:
    """Raise ``NotAQuery`` unless the statement parses as one plan without a
    command, an insert or another statement anywhere in it."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except ParseException as e:
        raise NotAQuery(str(e).splitlines()[0]) from None
    loader = spark._jvm.Thread.currentThread().getContextClassLoader()
    writes = [loader.loadClass(name) for name in (_COMMANDS, _PARSED)]
    todo = [plan]
    while todo:
        node = todo.pop()
        if any(kind.isInstance(node) for kind in writes):
            raise NotAQuery(f"only queries are accepted, not {node.nodeName()}")
        for group in (node.children(), node.innerChildren()):
            parts = group.iterator()
            while parts.hasNext():
                child = parts.next()
                if loader.loadClass("org.apache.spark.sql.catalyst.plans.logical.LogicalPlan").isInstance(child):
                    todo.append(child)


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None, args: dict | None = None,
            with_functions: bool = False) -> DataFrame:
    """Run one read-only query over the given views. ``args`` are the
    values of its named parameter markers (``:name``), which never become
    part of the text; ``with_functions`` lets it call F1-F17 (Z3)."""
    check_query(spark, sql)
    register_views(views or {})
    if with_functions:
        register(spark)
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """The column list of a table or view (name, type, nullable)."""
    fields = spark.table(name).schema.fields
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in fields],
                                 "column_name string, data_type string, nullable boolean")
