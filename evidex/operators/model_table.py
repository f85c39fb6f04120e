"""Models as table functions of SQL: `SELECT ... FROM name(TABLE(rows))`.

A registered function reads any table with the columns its model needs; its result has the table's own columns and the
typed answer, as `generate_table` has. With `PARTITION BY` and `ORDER BY` a reader sees each group in order, row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from evidex.operators.generate import Model, ask_model

MAX_BATCH = 64


class Reader(Protocol):
    """Reads the rows of one group, one after another, and tells what it has found."""

    def read(self, record: dict[str, Any]) -> None: ...

    def result(self) -> Sequence[dict[str, Any]]: ...


def _columns(rows: AnalyzeArgument, wanted: Sequence[str]) -> T.StructType:
    """The columns of a table argument, checked when the statement is planned."""
    if not rows.isTable:
        raise ValueError("the first argument must be TABLE(...)")
    missing = [c for c in wanted if c not in rows.dataType.fieldNames()]
    if missing:
        raise ValueError(f"the table has no columns {missing}")
    return rows.dataType


def register_model(
    spark: SparkSession, name: str, make_model: Callable[[], Model], input_cols: Sequence[str], schema: str, out: str = "out", batch_size: int = MAX_BATCH
) -> None:
    """Make `name(TABLE(rows) [, on_error => 'null'])` a function of the session: the rows plus `out` and `<out>_error`.

    The model is made once per task, or once per group with PARTITION BY, and asked for a batch of rows at a time. Errors
    are as in `generate_table`. Repeated rows are asked again; an empty table gives no rows.
    """
    answer = T.StructType.fromDDL(schema)
    fields, error, wanted = answer.fieldNames(), f"{out}_error", list(input_cols)

    class ModelTable:
        def __init__(self) -> None:
            self.model = make_model()
            self.held: list[Row] = []
            self.on_error = "raise"

        @staticmethod
        def analyze(rows: AnalyzeArgument, on_error: AnalyzeArgument | None = None) -> AnalyzeResult:
            columns = _columns(rows, wanted)
            clash = {out, error} & set(columns.fieldNames())
            if clash:
                raise ValueError(f"columns {sorted(clash)} exist already")
            if on_error is not None and on_error.value not in ("raise", "null"):
                raise ValueError("on_error must be 'raise' or 'null'")
            return AnalyzeResult(schema=T.StructType([*columns.fields, T.StructField(out, answer), T.StructField(error, T.StringType())]))

        def eval(self, rows: Row, on_error: str = "raise") -> Iterator[tuple]:
            self.held.append(rows)
            self.on_error = on_error
            if len(self.held) >= batch_size:
                yield from self.flush()

        def terminate(self) -> Iterator[tuple]:
            if self.held:
                yield from self.flush()

        def flush(self) -> Iterator[tuple]:
            rows, self.held = self.held, []
            made = ask_model(self.model, [{c: r[c] for c in wanted} for r in rows], self.on_error)
            for row, (found, failed) in zip(rows, made):
                yield (*row, None if found is None else Row(**{f: found.get(f) for f in fields}), failed)

    spark.udtf.register(name, udtf(ModelTable, useArrow=True))


def register_reader(spark: SparkSession, name: str, make_reader: Callable[[], Reader], input_cols: Sequence[str], schema: str) -> None:
    """Make `name(TABLE(rows) PARTITION BY ... ORDER BY ...)` a function of the session: what a reader finds in each group.

    A group's rows stream through its reader in their order; nothing but what the reader keeps is held. The rows of its
    result have the columns of `schema`, which name the group if they are to be told apart.
    """
    answer = T.StructType.fromDDL(schema)
    fields, wanted = answer.fieldNames(), list(input_cols)

    class ReaderTable:
        def __init__(self) -> None:
            self.reader: Reader | None = None

        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            _columns(rows, wanted)
            return AnalyzeResult(schema=answer)

        def eval(self, rows: Row) -> None:
            if self.reader is None:
                self.reader = make_reader()
            self.reader.read({c: rows[c] for c in wanted})

        def terminate(self) -> Iterator[tuple]:
            if self.reader is not None:
                for found in self.reader.result():
                    yield tuple(found.get(f) for f in fields)

    spark.udtf.register(name, udtf(ReaderTable, useArrow=True))


__all__ = ["Reader", "register_model", "register_reader"]
