"""Model calls over tables: a batch model with a typed output, plugged in by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# A model maps a batch of input records to one output record (a dict) or None per input.
Model = Callable[[list[dict[str, Any]]], Sequence[dict[str, Any] | None]]


def ask_model(model: Model, records: list[dict[str, Any]], on_error: str = "raise") -> list[tuple[dict[str, Any] | None, str | None]]:
    """(answer, error) per record. With `on_error="null"` a failing batch is asked one by one."""
    try:
        answers = list(model(records))
        if len(answers) != len(records):
            raise ValueError(f"{len(answers)} answers for {len(records)} records")
        return [(a, None) for a in answers]
    except Exception as e:
        if on_error == "raise":
            raise
        if len(records) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
    return [ask_model(model, [r], on_error)[0] for r in records]


def generate_table(
    df: DataFrame,
    make_model: Callable[[], Model],
    input_cols: Sequence[str],
    schema: str,
    out: str = "out",
    batch_size: int = 64,
    on_error: str = "raise",
) -> DataFrame:
    """All columns of `df` plus the struct `out` with the model's answer and the text `<out>_error`.

    `make_model` runs once per task, so a model is loaded once per partition. A failing model stops the job. With
    `on_error="null"` the rows of a failing batch are asked one by one; a row that fails gets a NULL struct and the error
    in `<out>_error`, so that it can be told from a row the model had no answer for (NULL struct, NULL error). The
    columns of `df` pass through untouched. `schema` is a DDL string and may nest arrays and structs.
    """
    answer_type = T.StructType.fromDDL(schema)
    fields = answer_type.fieldNames()
    error = f"{out}_error"
    clash = {out, error} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    out_type = T.StructType([*df.schema.fields, T.StructField(out, answer_type, True), T.StructField(error, T.StringType(), True)])
    arrow_type = to_arrow_type(answer_type)
    places = [df.columns.index(c) for c in input_cols]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for whole in batches:
            for start in range(0, whole.num_rows, batch_size):
                part = whole.slice(start, batch_size)
                inputs = zip(*[part.column(i).to_pylist() for i in places])
                made = ask_model(model, [dict(zip(input_cols, values)) for values in inputs], on_error)
                shaped = [None if a is None else {f: a.get(f) for f in fields} for a, _ in made]
                answers, errors = pa.array(shaped, arrow_type), pa.array([e for _, e in made], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, answers, errors], names=[*part.schema.names, out, error])

    return df.mapInArrow(run, out_type)


def generate_bool(df: DataFrame, make_model: Callable[[], Model], input_cols: Sequence[str], out: str = "result"):
    """One yes/no answer per row; the model's record has a `result` field."""
    made = generate_table(df, make_model, input_cols, "result boolean", "_answer")
    return made.withColumn(out, F.col("_answer.result")).drop("_answer", "_answer_error")


def generate_double(df: DataFrame, make_model: Callable[[], Model], input_cols: Sequence[str], out: str = "result"):
    """One number per row, asked for once; the model's record has a `result` field."""
    made = generate_table(df, make_model, input_cols, "result double", "_answer")
    return made.withColumn(out, F.col("_answer.result")).drop("_answer", "_answer_error")
