"""Scans and relational plumbing around them."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorage.sources import sinks


def table(spark, name, cols=None):
    """Catalog table or parquet path, projected at the scan."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df.select(*cols) if cols else df


def read_csv(spark, path, schema=None, quote='"', sampling=1.0):
    """CSV with a header.

    Without a schema the types are inferred, at the price of one more pass over a
    ``sampling`` share of the rows.
    """
    reader = spark.read.option("header", True).option("quote", quote)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).option("samplingRatio", sampling).csv(path)


def read_csv_rejects(spark, path, schema, quote='"', header=True):
    """(good, rejected) rows of a typed CSV: lines that do not fit the schema are kept, not nulled.

    ``rejected`` has the ``line`` as it stands and its ``file``: too many or too few fields, or
    a value that is not of its type. The file is parsed once and stored, so that both frames
    are of the same reading; good and rejected rows together are all lines.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*fields, T.StructField("_line", T.StringType())])
    reader = spark.read.option("header", header).option("quote", quote).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).schema(wide).csv(path)
    rows = sinks.materialize(rows.withColumn("_file", F.input_file_name()))
    good = rows.where("_line is null").drop("_line", "_file")
    return good, rows.where("_line is not null").select(F.col("_line").alias("line"), F.col("_file").alias("file"))


def cast_key_rejects(df, col, dtype):
    """(good, rejected) rows: ``cast_key`` of those it can read, and those with another value as they are.

    A null key is good: it is absent, not wrong.
    """
    fits = F.col(col).isNull() | F.col(col).try_cast(dtype).isNotNull()
    return cast_key(df.where(fits), col, dtype), df.where(~fits)


def sql(spark, text, **frames):
    """SQL over DataFrames named in the text as ``{name}``."""
    return spark.sql(text, **frames)


def cast_key(df, col, dtype):
    """Give a join key its type once, at the source, so the join itself stays a plain equi-join.

    A value that is not of the type becomes null, which joins with nothing; text such as
    "007" is read as the number 7.
    """
    return df.withColumn(col, F.col(col).try_cast(dtype))


def left_join(a, b, on):
    """Left join keeping ``a``'s copy of every column both sides have."""
    on = [on] if isinstance(on, str) else list(on)
    shared = [c for c in b.columns if c in a.columns and c not in on]
    return a.join(b.drop(*shared), on, "left")


def list_tables(spark, database=None):
    """(database, table) rows of the catalog."""
    names = [(t.namespace[0] if t.namespace else "", t.name) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(names, "database string, name string")
