"""Readers with declared schemas (no inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callstats.schema import CDR_SCHEMA
from callstats.sinks.publish import current

# Fixed value: how NULL is written in a result of one column, so that it still
# writes a line. Results of several columns leave the field empty, which is
# told apart from an empty text, written as two quotes.
NULL_TEXT = "NULL"


def null_text(schema: T.StructType) -> str:
    """How NULL is written in a result CSV with this schema."""
    return NULL_TEXT if len(schema.fields) == 1 else ""


def header_schema(spark: SparkSession, path: str | list[str], schema: T.StructType = CDR_SCHEMA) -> T.StructType:
    """``schema``'s types laid out in the order of the input's header line.

    Spark reads only the first line for this (no type inference). Columns the
    schema does not know are read as strings; an input without a header line
    keeps ``schema`` as is.
    """
    names = spark.read.option("header", True).csv(path).columns
    if not names:
        return schema
    # Names match regardless of case, as Spark resolves columns by default;
    # the declared name is kept.
    known = {f.name.lower(): f for f in schema.fields}
    return T.StructType([known.get(n.lower(), T.StructField(n, T.StringType(), True)) for n in names])


def read_cdr(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = CDR_SCHEMA,
    corrupt_column: str | None = None,
    by_header: bool = True,
) -> DataFrame:
    """CDR CSV with a header line, read with declared types.

    Columns are matched by header name, as a header-driven read would: the
    types of ``schema`` are laid out in the order of the first file's header,
    and every other file's header is checked against that order
    (``enforceSchema=false``), so a file with its columns in another order
    fails the job instead of being read into the wrong columns. PERMISSIVE
    mode: a cell that does not fit its type becomes NULL instead of failing
    the job. With ``corrupt_column`` the raw text of such rows is kept in that
    extra string column.

    Reading the header lists the input files once more; on an object store
    with very many files, ``by_header=False`` skips that and expects the
    declared order (still checked on every file).
    """
    if by_header:
        schema = header_schema(spark, path, schema)
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | None = None,
    by_header: bool = True,
) -> DataFrame:
    """Any input table: Parquet by default, CSV (CDR layout) or JSON by name.

    CSV and JSON get the declared CDR schema unless one is given: inferring a
    JSON schema would read the whole input once more. Parquet brings its own.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "json" if path.endswith(".json") else "parquet")
    if fmt == "csv":
        return read_cdr(spark, path, schema or CDR_SCHEMA, by_header=by_header)
    if fmt == "json":
        schema = schema or CDR_SCHEMA
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(fmt).load(path)


def read_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headerless result CSV written by ``write_result``; texts may hold line
    breaks. A run's folder is read as the result its pointer names."""
    path = current(spark, path) or path
    reader = spark.read.schema(schema).option("header", False).option("multiLine", True)
    # An empty field is NULL whatever nullValue says; a value of "" would also
    # turn the two quotes of an empty text into NULL.
    return reader.option("nullValue", null_text(schema) or "\0").csv(path)
