"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans.lineage import scope, staged, unstaged, work_dir  # noqa: F401  re-exported

#: Fixed value: the word pattern of the contracts, in Java and DuckDB syntax.
WORD = r"[^\x20\x09-\x0D]+"


def packed(df: DataFrame, *inputs: str, keep: Sequence[str] | None = None) -> DataFrame:
    """``(row, in_<input>...)``: the row (its columns ``keep``, default all) as one
    struct, so that added columns never clash with the table's; inputs that are
    not among the kept columns stand beside it."""
    kept = list(df.columns if keep is None else keep)
    return df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
                     *[F.col(f"`{c}`").alias(f"in_{c}") for c in inputs if c not in kept])


#: Bytes of one Arrow batch between Spark and Python; bounds a worker's memory when rows are long.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session already has a smaller bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def map_columns(df: DataFrame, inputs: Sequence[str], fields: Sequence[T.StructField],
                make: Callable[[], Callable[..., list[pa.Array]]], keep: Sequence[str] | None = None) -> DataFrame:
    """Append columns computed batch by batch in Arrow; row-local, no shuffle.

    ``make()`` runs once per task and returns ``fn(*input_arrays) -> arrays``.
    ``keep`` names the columns passed through (default: all that are not inputs).
    An input ``in_<column>`` that the table lacks is taken from its ``row`` struct.
    """
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in inputs] if keep is None else list(keep)
    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    names, columns = schema.fieldNames(), set(df.columns)

    def run(batches):
        fn = make()
        for b in batches:
            if not b.num_rows:
                continue
            out = fn(*[b.column(c) if c in columns else b.column("row").field(c[3:]) for c in inputs])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *out], names=names)

    return df.mapInArrow(run, schema)


def strings(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null becomes the empty string."""
    return [t or "" for t in column.to_pylist()]
