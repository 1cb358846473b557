"""Read-only SQL and schema listing.

A statement is judged twice: by its words, before anything is done with it, and by its analysed plan, which says what the names in it
stand for. Only relations of the catalogue may be read, or those of a given list; files named by a path, table functions
that run code, calls into the JVM by name, and functions written in Python or Scala are refused.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from siltstone import vocab

_LITERALS = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)
_LITERALS_ONLY = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/", re.S)
_QUOTES = re.compile("`")
_CALLED = re.compile(r"\b(\w+)\s*\(")
_CALLS = frozenset(("reflect", "java_method", "try_reflect"))
_VERBS = re.compile(rf"\b(?:{'|'.join(vocab.WRITE_VERBS)})\b", re.I)
_START = re.compile(r"^\s*\(*\s*(?:SELECT|WITH)\b", re.I)
_CAPPED = re.compile(r"\bLIMIT\s+\d+(?:\s+OFFSET\s+\d+)?\s*$", re.I)


class ForbiddenQuery(ValueError):
    """The statement is not a plain read."""


def check_read_only(query: str) -> str:
    """The statement without its closing semicolon, or ForbiddenQuery.

    Whole words count, outside text literals, quoted names and comments: `updated_at` is no UPDATE.
    """
    bare = _LITERALS.sub(" ", query).strip().rstrip(";")
    if ";" in bare:
        raise ForbiddenQuery("one statement at a time")
    if not _START.match(bare):
        raise ForbiddenQuery("only SELECT or WITH statements are allowed")
    verb = _VERBS.search(bare)
    if verb:
        raise ForbiddenQuery(f"forbidden keyword {verb.group(0).upper()}")
    call = next((c for c in _CALLED.findall(_QUOTES.sub("", _LITERALS_ONLY.sub(" ", query))) if c.lower() in _CALLS), None)
    if call:
        raise ForbiddenQuery(f"forbidden function {call}")
    return query.strip().rstrip(";")


#: Leaves of a plan that hold no stored data, and relations that are judged by their name.
_FREE_LEAVES = frozenset(("OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "EmptyRelation"))
#: Expressions that run code of their own.
_CODE = frozenset((
    "CallMethodViaReflection", "TryReflect", "StaticInvoke", "Invoke", "NewInstance", "PythonUDF", "PythonUDAF", "PythonUDTF", "ScalaUDF",
    "ScalaUDAF", "ScalaAggregator", "PolymorphicPythonUDTF", "UnresolvedPythonUDTF", "UnresolvedPolymorphicPythonUDTF"))


def _items(found) -> Iterator:
    each = found.iterator()
    while each.hasNext():
        yield each.next()


def _kind(node) -> str:
    return str(node.getClass().getSimpleName()).rstrip("$")


def _unquoted(identifier) -> str:
    return str(identifier.unquotedString())


def _check_expressions(node) -> None:
    waiting = list(_items(node.expressions()))
    while waiting:
        e = waiting.pop()
        if _kind(e) in _CODE:
            raise ForbiddenQuery(f"forbidden function {e.prettyName()}")
        waiting += _items(e.children())


def _check_plan(plan, tables: Collection[str] | None) -> None:
    """Raises unless all that the plan reads are named relations, those in `tables` if given, and it runs no code of its own."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        _check_expressions(node)
        waiting += _items(node.subqueries())
        kind, name = _kind(node), None
        if kind == "View":
            name = _unquoted(node.desc().identifier())
        elif kind in ("LogicalRelation", "HiveTableRelation"):
            table = node.tableMeta() if kind == "HiveTableRelation" else node.catalogTable()
            if kind == "HiveTableRelation" or table.isDefined():
                name = _unquoted((table if kind == "HiveTableRelation" else table.get()).identifier())
        elif kind == "DataSourceV2Relation" and node.identifier().isDefined():
            name = str(node.identifier().get().toString())
        if name is not None:
            if tables is not None and name.removeprefix("spark_catalog.") not in tables and name.split(".")[-1] not in tables:
                raise ForbiddenQuery(f"{name} is not one of the allowed tables")
            continue  # what a view is made of is its owner's choice
        children = list(_items(node.children()))
        if not children and kind not in _FREE_LEAVES:
            raise ForbiddenQuery(f"only named tables may be read, not {kind}")
        waiting += children


def guarded_sql(
    spark: SparkSession, query: str, max_rows: int = vocab.SQL_ROW_CAP, tables: Collection[str] | None = None,
) -> DataFrame:
    """X1. Result of a read-only statement, at most `max_rows` rows unless it ends in its own LIMIT.

    A LIMIT inside a subquery does not lift the cap. With `tables` (names, with their database or without) only these may be read,
    else all tables and views of the catalogue. The plan is analysed, not run, before it is judged.
    """
    statement = check_read_only(query)
    result = spark.sql(statement)
    _check_plan(result._jdf.queryExecution().analyzed(), tables)
    if _CAPPED.search(_LITERALS.sub(" ", statement)):
        return result
    return result.limit(max_rows)


def describe_schema(spark: SparkSession, database: str | None = None, tables: Sequence[str] | None = None) -> DataFrame:
    """X2. `(table_name, column_name, data_type, nullable)` of the allowed tables."""
    database = database or spark.catalog.currentDatabase()
    rows = []
    for table in spark.catalog.listTables(database):
        if tables is not None and table.name not in tables:
            continue
        # Temporary views are listed with every database but belong to none.
        frame = spark.table(f"`{table.name}`" if table.isTemporary else f"`{database}`.`{table.name}`")
        rows += [(table.name, f.name, f.dataType.simpleString(), f.nullable) for f in frame.schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean")
