"""Database tables through any DB-API connection that the executors can open.

``scan_connection`` reads a table or query split into ranges of one column, each range by the task that needs it, over a
connection of its own.  ``append_connection`` writes in two phases, so that a lost executor leaves no row twice.
The connection is named by an import path and keyword arguments; nothing but those travels to the executors.

Statements use what SQL has had since 1992: quoted names, comparisons, IN, IS NULL, and one parameter per value.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import closing
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from sluicemark.session import package_on_workers

FETCH_ROWS = 10_000
ATTEMPT = "load_attempt"
_COMPARISONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
# Types whose order and equality are the same in every database; a text's depend on its collation.
_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampNTZType)
_MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s"}

Clause = tuple[str, list[Any]]


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def clause_of(condition: Filter, schema: T.StructType, mark: str = "?") -> tuple[Clause | None, bool]:
    """The condition in SQL, if the database can help with it, and whether Spark need not look at it again.

    Equality of texts is only a help: a collation may let more rows through, never fewer.  Texts are not compared
    otherwise, and floating-point numbers not at all, for Spark orders NaN.
    """
    if isinstance(condition, Not):
        inner, whole = clause_of(condition.child, schema, mark)
        # Unknown stays unknown under NOT, in Spark as in SQL.
        return ((f"NOT ({inner[0]})", inner[1]), True) if inner is not None and whole else (None, False)
    path = condition.attribute
    if len(path) != 1 or path[0] not in schema.names:
        return None, False
    column, kind = quoted(path[0]), schema[path[0]].dataType
    if isinstance(condition, IsNull):
        return (f"{column} IS NULL", []), True
    if isinstance(condition, IsNotNull):
        return (f"{column} IS NOT NULL", []), True
    exact = isinstance(kind, _ORDERED)
    if not exact and not isinstance(kind, T.StringType):
        return None, False
    if isinstance(condition, In):
        values = [v for v in condition.value if v is not None]
        if len(values) < len(condition.value) or not values:
            return None, False
        return (f"{column} IN ({', '.join([mark] * len(values))})", list(values)), exact
    if isinstance(condition, EqualNullSafe):
        return ((f"{column} IS NULL", []), True) if condition.value is None else ((f"{column} = {mark}", [condition.value]), False)
    sign = _COMPARISONS.get(type(condition))
    if sign is None or condition.value is None or (not exact and sign != "="):
        return None, False
    return (f"{column} {sign} {mark}", [condition.value]), exact


def _between(low: Any, high: Any, parts: int) -> list[Any]:
    """Inner bounds of ``parts`` even ranges from low to high; fewer if there are not that many values."""
    if isinstance(low, dt.datetime):
        unit, back = dt.timedelta(microseconds=1), lambda n: low + n * dt.timedelta(microseconds=1)
    elif isinstance(low, dt.date):
        unit, back = dt.timedelta(days=1), lambda n: low + dt.timedelta(days=n)
    else:
        unit, back = 1, lambda n: low + n
    span = int((high - low) // unit)
    return [back(n) for n in sorted({span * i // parts for i in range(1, parts)} - {0})]


def ranges(column: str | None, low: Any, high: Any, parts: int, mark: str = "?") -> list[Clause | None]:
    """Conditions that take every row exactly once: nulls with the first range, what lies outside the bounds with the outer ones."""
    inner = _between(low, high, parts) if column is not None and low is not None and high is not None and low < high else []
    if not inner:
        return [None]
    name = quoted(column)
    found: list[Clause | None] = [(f"({name} < {mark} OR {name} IS NULL)", [inner[0]])]
    found += [(f"({name} >= {mark} AND {name} < {mark})", [a, b]) for a, b in zip(inner, inner[1:])]
    return [*found, (f"{name} >= {mark}", [inner[-1]])]


@dataclass(frozen=True)
class Connection:
    """How to open a connection: ``path`` is ``module:callable``."""

    path: str
    arguments: str  # JSON object
    paramstyle: str = "qmark"

    def open(self) -> Any:
        module, _, name = self.path.partition(":")
        return getattr(importlib.import_module(module), name)(**json.loads(self.arguments))

    @property
    def mark(self) -> str:
        if self.paramstyle not in _MARKS:
            raise ValueError(f"paramstyle must be one of {sorted(_MARKS)}, not {self.paramstyle!r}")
        return _MARKS[self.paramstyle]


@dataclass
class Range(InputPartition):
    """One task's part of the read."""

    statement: str
    values: list[Any]


def _typed(text: str | None, kind: T.DataType) -> Any:
    """A bound given as text, as a value of the split column."""
    if text is None:
        return None
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(text)
    if isinstance(kind, T.TimestampNTZType):
        return dt.datetime.fromisoformat(text)
    return Decimal(text) if isinstance(kind, T.DecimalType) else int(text)


class DatabaseReader(DataSourceReader):
    """Plans one statement per range; every statement names the columns asked for and the conditions taken over."""

    def __init__(self, connection: Connection, source: str, schema: T.StructType, options: dict[str, str]):
        self.connection, self.source, self.schema, self.options = connection, source, schema, options
        self.taken: list[Clause] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            clause, whole = clause_of(condition, self.schema, self.connection.mark)
            if clause is not None:
                self.taken.append(clause)
            if not whole:
                yield condition

    def _statement(self, columns: str, also: Clause | None = None) -> Range:
        clauses = [*self.taken, *([also] if also is not None else [])]
        where = f" WHERE {' AND '.join(text for text, _ in clauses)}" if clauses else ""
        return Range(f"SELECT {columns} FROM {self.source}{where}", [v for _, values in clauses for v in values])

    def _bounds(self, column: str) -> tuple[Any, Any]:
        kind = self.schema[column].dataType
        if not isinstance(kind, _ORDERED):
            raise ValueError(f"cannot split by {column} of type {kind.simpleString()}")
        if "lower" in self.options and "upper" in self.options:
            return _typed(self.options["lower"], kind), _typed(self.options["upper"], kind)
        asked = self._statement(f"MIN({quoted(column)}), MAX({quoted(column)})")
        with closing(self.connection.open()) as opened, closing(opened.cursor()) as cursor:
            cursor.execute(asked.statement, asked.values)
            low, high = cursor.fetchone()
        return low, high

    def partitions(self) -> list[Range]:
        columns = ", ".join(quoted(n) for n in self.schema.names)
        column, parts = self.options.get("split_column"), int(self.options.get("partitions", 1))
        low, high = self._bounds(column) if column is not None and parts > 1 else (None, None)
        return [self._statement(columns, clause) for clause in ranges(column, low, high, parts, self.connection.mark)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        with closing(self.connection.open()) as opened, closing(opened.cursor()) as cursor:
            cursor.execute(partition.statement, partition.values)
            while rows := cursor.fetchmany(int(self.options.get("fetch_rows", FETCH_ROWS))):
                columns = [pa.array(values, f.type, from_pandas=False) for values, f in zip(zip(*rows, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)


@dataclass
class Attempt(WriterCommitMessage):
    """The name under which a task's rows lie in the staging table."""

    name: str
    rows: int


class DatabaseWriter(DataSourceWriter):
    """Tasks write to a staging table, each attempt under its own name; one transaction moves what the finished attempts wrote.

    A task that is repeated leaves rows of an attempt nobody commits; they go with the staging table.
    """

    def __init__(self, connection: Connection, table: str, schema: T.StructType, options: dict[str, str]):
        self.connection, self.table, self.names = connection, table, schema.names
        self.stage = f"{table}_stage_{options['run']}"
        self.batch_rows = int(options.get("fetch_rows", FETCH_ROWS))

    def prepare(self) -> None:
        """Make the staging table; called before the job, from the driver."""
        columns = ", ".join(quoted(n) for n in self.names)
        self._run([(f"CREATE TABLE {self.stage} AS SELECT {columns}, CAST(NULL AS VARCHAR(64)) AS {ATTEMPT} FROM {self.table} WHERE 1 = 0", [])])

    def _run(self, statements: list[Clause]) -> None:
        """All statements in one transaction."""
        with closing(self.connection.open()) as opened:
            try:
                with closing(opened.cursor()) as cursor:
                    for text, values in statements:
                        cursor.execute(text, values)
                opened.commit()
            except BaseException:
                opened.rollback()
                raise

    def write(self, iterator: Iterator[T.Row]) -> Attempt:
        context = TaskContext.get()
        name, rows = f"{context.partitionId()}-{context.taskAttemptId()}", 0
        columns = ", ".join([*map(quoted, self.names), ATTEMPT])
        statement = f"INSERT INTO {self.stage} ({columns}) VALUES ({', '.join([self.connection.mark] * (len(self.names) + 1))})"
        with closing(self.connection.open()) as opened, closing(opened.cursor()) as cursor:
            batch: list[tuple] = []

            def flush() -> None:
                if batch:
                    cursor.executemany(statement, batch)
                    opened.commit()
                    batch.clear()

            for row in iterator:
                batch.append((*row, name))
                rows += 1
                if len(batch) == self.batch_rows:
                    flush()
            flush()
        return Attempt(name, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        columns = ", ".join(quoted(n) for n in self.names)
        move = f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {self.stage} WHERE {ATTEMPT} = {self.connection.mark}"
        self._run([(move, [m.name]) for m in messages if m is not None and m.rows])
        self._drop()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        self._run([(f"DROP TABLE {self.stage}", [])])


class DatabaseSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sluicemark_connection"

    def _connection(self) -> Connection:
        return Connection(self.options["connect"], self.options["arguments"], self.options["paramstyle"])

    def reader(self, schema: T.StructType) -> DatabaseReader:
        return DatabaseReader(self._connection(), self.options["source"], schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DatabaseWriter:
        if overwrite:
            raise ValueError("only appending is supported")
        writer = DatabaseWriter(self._connection(), self.options["table"], schema, dict(self.options))
        writer.prepare()
        return writer


def _path(connect: Callable[..., Any] | str) -> str:
    if isinstance(connect, str):
        return connect
    if "." in connect.__qualname__:
        raise ValueError("connect must be a function of a module, so that executors can import it")
    return f"{connect.__module__}:{connect.__qualname__}"


def _options(spark: SparkSession, connect: Callable[..., Any] | str, arguments: dict[str, Any] | None, paramstyle: str) -> dict[str, str]:
    package_on_workers(spark)
    spark.dataSource.register(DatabaseSource)
    return {"connect": _path(connect), "arguments": json.dumps(arguments or {}), "paramstyle": paramstyle}


def scan_connection(
    spark: SparkSession,
    connect: Callable[..., Any] | str,
    source: str,
    schema: str | T.StructType,
    arguments: dict[str, Any] | None = None,
    split_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int = 1,
    paramstyle: str = "qmark",
    fetch_rows: int = FETCH_ROWS,
    is_query: bool = False,
) -> DataFrame:
    """Rows of a table (or query) in the declared schema, whose columns are the ones read.

    ``connect`` is a function, or ``"module:function"``, that executors can import; it is called with ``arguments``.  With a
    split column the read is that many range statements over even ranges between the bounds, by default the smallest and largest value.  The
    bounds only place the splits.  Conditions on columns of fixed order run in the database; filter pushdown for Python sources is
    turned on in the session for that.
    """
    options = _options(spark, connect, arguments, paramstyle) | {
        "source": f"({source}) q" if is_query else source, "partitions": str(partitions), "fetch_rows": str(fetch_rows),
    }
    if split_column is not None:
        options["split_column"] = split_column
    if bounds is not None:
        options |= {"lower": str(bounds[0]), "upper": str(bounds[1])}
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    return spark.read.format(DatabaseSource.name()).schema(schema).options(**options).load()


def append_connection(
    df: DataFrame,
    connect: Callable[..., Any] | str,
    table: str,
    arguments: dict[str, Any] | None = None,
    paramstyle: str = "qmark",
    fetch_rows: int = FETCH_ROWS,
) -> None:
    """Append the rows to a database table, all or none, each once however often a task is repeated."""
    options = _options(df.sparkSession, connect, arguments, paramstyle) | {"table": table, "run": uuid.uuid4().hex[:12], "fetch_rows": str(fetch_rows)}
    df.write.format(DatabaseSource.name()).options(**options).mode("append").save()
