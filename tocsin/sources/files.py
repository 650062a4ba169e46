"""File sources and sinks. A path may be on any file system Hadoop knows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.session import together

# Outer spaces survive a round trip; quotes are doubled as most CSV tools do.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Written with microseconds. Reading needs no pattern: ISO times parse faster without.
_CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}
# Texts that data tools write for a missing field, besides the empty one.
MISSING_TEXTS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    missing: list[str] | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """CSV with a header. Give the schema: inferring one reads the file twice.

    Values are read as they stand. ``missing`` names texts of string columns that
    become null, for example ``MISSING_TEXTS``, and with it NaN does too. A field that
    does not fit the schema is null; ``corrupt`` names a column for the text of such rows.
    """
    reader = spark.read.options(**_CSV)
    if schema and corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(path)
    if missing is None:
        return df
    fixed = {}
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            fixed[field.name] = F.when(~c.isin(missing), c)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            fixed[field.name] = F.when(~F.isnan(c), c)
    return df.withColumns(fixed) if fixed else df


def write_csv(df: DataFrame, path: str) -> None:
    """CSV as the new content of ``path``, published like ``replace_table``."""
    _replace(df.sparkSession, path, lambda fresh: df.write.options(**_CSV, **_CSV_TIMES).csv(fresh))


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as the new content of ``path`` and return the stored table."""
    _replace(df.sparkSession, path, df.write.parquet)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write beside the old content, which is there until the new is complete, then
    swap the folders. A write that fails leaves the old content and nothing else."""
    fresh, old = f"{path}-{uuid.uuid4().hex}", f"{path}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(fresh)
    except Exception:
        system.delete(hadoop(fresh), True)
        raise
    moved = system.exists(hadoop(path)) and system.rename(hadoop(path), hadoop(old))
    if not system.rename(hadoop(fresh), hadoop(path)):
        if moved:
            system.rename(hadoop(old), hadoop(path))
        system.delete(hadoop(fresh), True)
        raise OSError(f"cannot publish {path}")
    if moved:
        system.delete(hadoop(old), True)


def replace_tables(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``replace_table`` for several independent paths at once."""
    spark = next(iter(frames.values())).sparkSession
    stored = together(spark, *[partial(replace_table, df, path) for path, df in frames.items()])
    return dict(zip(frames, stored))


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Append the rows of one run. Running it again replaces that run's rows only,
    so a retried job never duplicates what it loaded."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All appended runs, with the run a row came from in ``run_id``."""
    with_run = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(with_run).parquet(path)


def append_json_log(df: DataFrame, path: str) -> None:
    """One JSON object per line, null fields kept so that every line has all keys."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_json_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def first_available(
    spark: SparkSession, paths: Iterable[str], fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame | None:
    """The first path that exists, or None when there is none."""
    for path in paths:
        if exists(spark, path):
            if fmt == "csv":
                return read_csv(spark, path, schema)
            reader = spark.read.schema(schema) if schema else spark.read
            return reader.format(fmt).load(path)
    return None
