"""Readers for the original jobs' input shapes, all through ``spark.read``.

Text inputs become typed DataFrames with built-in string functions; no line
ever passes through Python.  Casts are ANSI ``cast`` (a bad value fails the
job, as the original parsing did) unless ``lenient=True`` (``try_cast``).

The ``*_checked`` readers fail for no line: what cannot be parsed goes to a table of
rejects (:class:`Checked`).  ``input_order`` adds the place of a line in the input, by which the
last of several ratings can be told.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Checked:
    """Parsed rows and the lines that could not be parsed, ``(value)``."""
    rows: DataFrame
    rejects: DataFrame

    def counts(self) -> tuple[int, int]:
        return self.rows.count(), self.rejects.count()


def input_order() -> Column:
    """Where a row of a file scan stands: file, start of the split in it, place in the split.

    Has to be selected from the scan itself.  A split is read by one task from its start to its end, so places compare inside a split;
    files come in the order of their names.
    """
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def _cast(c, to: str, lenient: bool):
    return c.try_cast(to) if lenient else c.cast(to)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: one row per text line."""
    return spark.read.text(path)


def read_edges(spark: SparkSession, path: str, sep: str = r"\s+", nodes: bool = False) -> DataFrame:
    """``(src, dst)`` from text lines.

    ``sep`` is a regular expression: ``r"\\s+"`` splits on whitespace runs,
    ``" "`` on single spaces (double spaces then give empty fields), ``","``
    on commas.  ``\\s`` covers Unicode white space.  Fields beyond the second are ignored for the edge, and a
    line with fewer than two fields fails the job; with
    ``nodes=True`` the result is instead ``(node)``, every field of every line.
    """
    parts = F.split(F.col("value"), "(?U)" + sep)
    lines = spark.read.text(path)
    if nodes:
        return lines.select(F.explode(parts).alias("node")).distinct()
    short = F.raise_error(F.concat(F.lit("edge line with fewer than two fields: "), F.col("value")))
    dst = F.when(F.size(parts) < 2, short.cast("string")).otherwise(F.get(parts, 1))
    return lines.select(F.get(parts, 0).alias("src"), dst.alias("dst"))


def read_ratings(spark: SparkSession, path: str, user: str = "userId", item: str = "movieId",
                 rating: str = "rating", lenient: bool = False, with_order: bool = False) -> DataFrame:
    """``(user, item, rating)`` from a CSV with a header row (other columns pruned); a line that
    repeats the header is dropped wherever it stands.  ``with_order`` adds ``input_order``."""
    df = spark.read.option("header", True).csv(path)
    if with_order:
        df = df.select("*", input_order().alias("input_order"))
    repeated = F.col(user).eqNullSafe(user) & F.col(item).eqNullSafe(item) & F.col(rating).eqNullSafe(rating)
    df = df.where(~repeated)
    return df.select(_cast(F.col(user), "bigint", lenient).alias("user"),
                     _cast(F.col(item), "bigint", lenient).alias("item"),
                     _cast(F.col(rating), "double", lenient).alias("rating"), *(["input_order"] if with_order else []))


def _csv_checked(spark: SparkSession, path: str, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The columns ``types`` of a CSV with a header, and ``(value)`` of the lines that do not fit it: with another
    number of fields, or with a field that is empty or does not cast.  Lines that repeat the header are neither."""
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in types if c not in header]
    if missing:
        raise ValueError(f"no column {missing} in the header {header}")
    fields = ", ".join(f"`{c}` string" for c in [*header, "_corrupt"])
    lines = spark.read.text(path).where(F.col("value") != ",".join(header))
    record = F.from_csv("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = lines.withColumn("_record", record).select(
        "value", F.col("_record._corrupt").isNull().alias("_whole"), *[F.col(f"_record.`{c}`").try_cast(t).alias(c) for c, t in types.items()])
    good = F.col("_whole")
    for c in types:
        good = good & F.col(f"`{c}`").isNotNull()
    return parsed.where(good).select(*types), parsed.where(~good).select("value")


def read_ratings_checked(spark: SparkSession, path: str, user: str = "userId", item: str = "movieId", rating: str = "rating") -> Checked:
    """``(user, item, rating)`` and the lines that hold none: short, long or with a field that is no number."""
    rows, rejects = _csv_checked(spark, path, {user: "bigint", item: "bigint", rating: "double"})
    return Checked(rows.toDF("user", "item", "rating"), rejects)


def read_basket_rows_checked(spark: SparkSession, path: str, key: str, item: str) -> Checked:
    """``(basket, item)`` and the lines without a basket or with an item that is no number."""
    rows, rejects = _csv_checked(spark, path, {key: "string", item: "bigint"})
    return Checked(rows.toDF("basket", "item"), rejects)


def read_records_checked(spark: SparkSession, path: str, name: str, extra: str) -> Checked:
    """``(id, name, extra)``, equal records once, and the lines without one of the two."""
    rows, rejects = _csv_checked(spark, path, {name: "string", extra: "string"})
    return Checked(rows.toDF("name", "extra").distinct().select(F.xxhash64("name", "extra").alias("id"), "name", "extra"), rejects)


def read_edges_checked(spark: SparkSession, path: str, sep: str = r"\s+") -> Checked:
    """``(src, dst)`` and the lines with fewer than two fields (see :func:`read_edges`)."""
    parts = F.split(F.col("value"), "(?U)" + sep)
    lines = spark.read.text(path).withColumn("_parts", parts)
    return Checked(lines.where(F.size("_parts") >= 2).select(F.get("_parts", 0).alias("src"), F.get("_parts", 1).alias("dst")),
                   lines.where(F.size("_parts") < 2).select("value"))


def read_vectors_checked(spark: SparkSession, path: str, sep: str = " ", dims: int | None = None) -> Checked:
    """``(id, vec)`` and the lines with a field that is no number, or with another number of fields than ``dims``."""
    lines = spark.read.text(path).withColumn("_vec", F.transform(F.split(F.col("value"), sep), lambda x: x.try_cast("double")))
    good = ~F.exists("_vec", lambda x: x.isNull()) & (F.lit(True) if dims is None else F.size("_vec") == dims)
    return Checked(lines.where(good).select(F.xxhash64("value").alias("id"), F.col("_vec").alias("vec")),
                   lines.where(~good).select("value"))


def read_vectors(spark: SparkSession, path: str, sep: str = " ", lenient: bool = False) -> DataFrame:
    """``(id, vec array<double>)`` from lines of separated floats; ``id`` is a hash of the line, so equal lines share it."""
    lines = spark.read.text(path)
    vec = F.transform(F.split(F.col("value"), sep), lambda x: _cast(x, "double", lenient))
    return lines.select(F.xxhash64("value").alias("id"), vec.alias("vec"))


def read_records(spark: SparkSession, path: str, name: str, extra: str) -> DataFrame:
    """``(id, name, extra)`` from a CSV with a header; rows with a NULL field are dropped."""
    df = spark.read.option("header", True).csv(path).select(F.col(name).alias("name"), F.col(extra).alias("extra"))
    df = df.dropna().distinct()
    return df.select(F.xxhash64("name", "extra").alias("id"), "name", "extra")


def read_basket_rows(spark: SparkSession, path: str, key: str | None = None, item: str | None = None) -> DataFrame:
    """``(basket, item)`` rows from a CSV with a header (first two columns by default)."""
    df = spark.read.option("header", True).csv(path)
    k = key or df.columns[0]
    i = item or df.columns[1]
    return df.select(F.col(k).alias("basket"), F.col(i).cast("bigint").alias("item"))
