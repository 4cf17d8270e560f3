"""Readers. Every one takes an explicit schema and turns NaN into NULL."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyworks.functions.nulls import nan_to_null


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    rename: Mapping[str, str] | None = None,
    mode: str = "FAILFAST",
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV with a header line; a byte order mark and CRLF line ends are accepted.

    Columns are taken by the names in the header, in any order; case does not count, and blanks or
    other odd characters stand for ``_``. Other columns of the file are left out, a missing
    one is an error. All files under ``path`` have the same header, which is checked when they
    are read. ``rename`` gives other names to headers; without a schema the types are
    inferred, at the price of one more pass over the files.
    """
    reader = spark.read.option("header", True).option("mode", mode).option("encoding", encoding)
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        # the header alone is read here: types come from the schema
        header = reader.csv(path).columns
        plain = {_plain_name((rename or {}).get(n, n)): n for n in header}
        missing = [n for n in schema.fieldNames() if _plain_name(n) not in plain]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {path}")
        kinds = {plain[_plain_name(f.name)]: f.dataType for f in schema}
        laid = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in header])
        df = reader.schema(laid).option("enforceSchema", False).csv(path)
        return nan_to_null(df.select([F.col(f"`{plain[_plain_name(n)]}`").alias(n) for n in schema.fieldNames()]))
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    return nan_to_null(df)


def _plain_name(name: str) -> str:
    return re.sub(r"\W+", "_", name.strip()).lower()


@contextmanager
def windows_charsets(spark: SparkSession) -> Iterator[None]:
    """Let the session read Windows code pages; jobs must run inside the block."""
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_csv_cp1252(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """CSV in Windows-1252; use inside :func:`windows_charsets`."""
    return read_csv(spark, path, schema, encoding="windows-1252", **options)


def open_file(path: str, buffer_bytes: int = 4 << 20) -> BinaryIO:
    """A file of the local disk, or of a store that Arrow knows (HDFS, S3, GCS, ABFS), for reading at any place in it.

    ``path`` is written as Spark writes it, blanks and all.
    """
    scheme, _, rest = path.partition(":")
    if path.startswith("/"):
        raw = fs.LocalFileSystem().open_input_file(path)
    elif scheme == "file":
        raw = fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    else:
        host, _, inside = rest.removeprefix("//").partition("/")
        store = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme)
        system, root = fs.FileSystem.from_uri(f"{store}://{host}/")
        raw = system.open_input_file(f"{root.rstrip('/')}/{inside}")
    return io.BufferedReader(raw, buffer_bytes)


def read_zipped_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rows_per_batch: int = 50_000,
    opened: Callable[[str], BinaryIO] = open_file,
) -> DataFrame:
    """The ``.csv`` member of every zip archive under ``path``; the last one wins, an archive without any has no rows.

    Spark lists the archives and deals them to tasks by their sizes, without
    their contents. A task opens an archive where it lies (``opened`` does so, for
    stores that :func:`open_file` does not know), reads its directory at the end and inflates the member as a stream, so it
    holds one batch of rows, however large the archive. A zip archive cannot be split: one task reads it.
    """
    names = schema.fieldNames()
    floats = {f.name for f in schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                yield from member_rows(opened, archive, names, rows_per_batch)

    text = spark.read.format("binaryFile").load(path).select("path").mapInPandas(rows, text_schema)
    typed = text.select(
        [
            (F.col(f"`{f.name}`").cast(f.dataType) if f.name not in floats else F.col(f"`{f.name}`").try_cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
    return nan_to_null(typed)


def member_rows(opened: Callable[[str], BinaryIO], path: str, names: list[str], rows_per_batch: int) -> Iterator[pd.DataFrame]:
    """The named columns, as text, of the last ``.csv`` member of one archive, a batch of rows at a time."""
    with opened(path) as file, zipfile.ZipFile(file) as archive:
        members = [m for m in archive.infolist() if m.filename.endswith(".csv")]
        if not members:
            return
        with archive.open(members[-1]) as member:
            chunks = pd.read_csv(
                member, dtype=str, encoding="utf-8-sig", chunksize=rows_per_batch, keep_default_na=False, na_values=[""],
            )
            for chunk in chunks:
                yield chunk.reindex(columns=names).astype(object).where(lambda c: c.notna(), None)


def read_parquet(spark: SparkSession, *paths: str, nan_as_null: bool = True) -> DataFrame:
    """Parquet. ``nan_as_null=False`` keeps number filters in the file scan, for
    data known to hold no NaN, such as files this library has written."""
    df = spark.read.parquet(*paths)
    return nan_to_null(df) if nan_as_null else df


def read_json_pages(spark: SparkSession, path: str, page: T.StructType, items: str) -> DataFrame:
    """Landed API responses, each one JSON object with a list of records.

    Returns one row per record. Pages are files, so they are read in parallel.
    """
    pages = spark.read.schema(page).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return explode_records(pages, items)


def explode_records(pages: DataFrame, items: str) -> DataFrame:
    """One row per element of the list column; an empty list gives no row."""
    return nan_to_null(pages.select(F.explode(items).alias("record")).select("record.*"))


def read_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A database table over JDBC.

    For a large table pass ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions``, otherwise one connection reads all of it.
    """
    return nan_to_null(spark.read.format("jdbc").options(url=url, dbtable=name, **options).load())
