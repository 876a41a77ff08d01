"""Staged inputs, mappers, logs and outputs."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import CONFIGURATION, SCANNER_STAGED, WEB_STAGED


def read_staged(spark: SparkSession, root: str, selection: Mapping, schemas: Mapping[str, str] | None = None) -> dict:
    """data source -> supplier -> (item ->) table. Web-scraped data lies in one parquet per item, other data in one per supplier.

    ``selection`` has the same shape (leaves are ignored) and isn't changed. Schemas are given, so nothing is inferred.
    """
    schemas = schemas or {"web_scraped": WEB_STAGED, "scanner": SCANNER_STAGED}
    out: dict = {}
    for source, suppliers in selection.items():
        reader = spark.read.schema(schemas[source]) if source in schemas else spark.read
        if source == "web_scraped":
            out[source] = {s: {item: reader.parquet(f"{root}/{source}/{s}/{item}.parquet") for item in items} for s, items in suppliers.items()}
        else:
            out[source] = {s: reader.parquet(f"{root}/{source}/{s}") for s in suppliers}
    return out


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """(item, keyword) from a CSV with a column per item whose cells are keywords; empty cells are padding."""
    wide = spark.read.csv(path, header=True)
    return wide.unpivot([], wide.columns, "item", "keyword").where("keyword IS NOT NULL AND trim(keyword) <> ''")


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """(retailer_category_id, item), all text."""
    return spark.read.csv(path, header=True).select("retailer_category_id", "item").dropna().dropDuplicates()


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """(product_id, group_id)."""
    return spark.read.parquet(path).select("product_id", "group_id").dropna()


def read_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """A CSV with header, all columns text, quoting understood; None if it has no rows."""
    df = spark.read.csv(path, header=True)
    return df if df.take(1) else None


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file as ``value``, without line ends."""
    return spark.read.text(path).select(F.regexp_replace("value", "[\r\n]", "").alias("value"))


def rows_to_pandas(lines: Sequence[Sequence[str]], names: Sequence[str], converters: Mapping[str, type | Callable] | None = None) -> pd.DataFrame:
    """A frame of rows of text. Empty rows go; if the first row's width differs from ``names`` there are no rows.

    A converter that is a type casts its column, another is applied to each cell.
    """
    rows = [list(x) for x in lines if list(x) != [""]]
    if rows and len(rows[0]) != len(names):
        rows = []
    df = pd.DataFrame(rows, columns=list(names))
    for name, convert in (converters or {}).items():
        df[name] = df[name].astype(convert) if isinstance(convert, type) else df[name].apply(convert)
    return df


def log_to_csv(spark: SparkSession, infile: str, outfile: str) -> None:
    """A text log as one CSV with the column msg; the log is deleted."""
    spark.read.text(infile).withColumnRenamed("value", "msg").coalesce(1).write.mode("overwrite").csv(outfile, header=True)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(infile)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


def list_files(spark: SparkSession, folder: str, strings: Sequence[str] = (), recursive: bool = False) -> list[str]:
    """Paths under ``folder`` on any Hadoop file system whose text has all ``strings``, in any case; sorted."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    todo, found = [root], []
    while todo:
        for status in fs.listStatus(todo.pop()):
            found.append(status.getPath().toUri().getPath())
            if recursive and status.isDirectory():
                todo.append(status.getPath())
    return sorted(p for p in found if all(s.lower() in p.lower() for s in strings))


def configuration_table(spark: SparkSession, params: Mapping) -> DataFrame:
    """(stage, params as JSON) for the record."""
    return spark.createDataFrame([(k, json.dumps(v, default=str, sort_keys=True)) for k, v in params.items()], CONFIGURATION)


def run_id(user: str, now: datetime | None = None) -> str:
    return f"{now or datetime.now():%Y%m%d_%H%M%S}_{user}"


def write_outputs(tables: Mapping[str, DataFrame], root: str, run: str) -> str:
    """The analysis as one CSV with header, the others as parquet, under root/run; ``tables`` isn't changed."""
    path = f"{root}/{run}"
    for name, df in tables.items():
        if name == "analysis":
            df.coalesce(1).write.mode("overwrite").csv(f"{path}/analysis", header=True)
        else:
            df.write.parquet(f"{path}/{name}")
    return path


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_series(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A series stored as CSV with header, or None if there is none."""
    fs, p = _file_system(spark, path)
    return spark.read.csv(path, header=True, schema=schema) if fs.exists(p) else None


def replace_series(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Writes ``df`` (which may read ``path``) as CSV beside ``path`` and moves it there."""
    df.write.mode("overwrite").csv(f"{path}.next", header=True)
    fs, p = _file_system(spark, path)
    fs.delete(p, True)
    if not fs.rename(_file_system(spark, f"{path}.next")[1], p):
        raise OSError(f"can't move {path}.next to {path}")
