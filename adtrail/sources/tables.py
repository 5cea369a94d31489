"""Curated and dead-letter tables, read by path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adtrail.registry import CURATED_TABLES


FILE_FORMATS = ("parquet", "orc", "json", "csv")


@dataclass(frozen=True)
class Tables:
    """All tables of one warehouse: one root, so writers and readers agree.

    For formats of files the root is a folder. For others, such as Iceberg, it is
    a catalog and namespace (``local.ads``), and ``side_root`` the folder for
    checkpoints and metrics.
    """

    root: str
    fmt: str = "parquet"
    side_root: str | None = None

    @property
    def in_catalog(self) -> bool:
        return self.fmt not in FILE_FORMATS

    def path(self, table: str) -> str:
        """The folder of a table, or its name in the catalog."""
        return f"{self.root}.{table}" if self.in_catalog else f"{self.root.rstrip('/')}/{table}"

    def side_folder(self, name: str) -> str:
        if self.in_catalog and self.side_root is None:
            raise ValueError("tables of a catalog need a side_root for checkpoints")
        return f"{(self.side_root or self.root).rstrip('/')}/{name}"

    def checkpoint(self, query: str) -> str:
        return self.side_folder(f"_checkpoints/{query}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if self.in_catalog:
            return spark.read.table(self.path(table))
        return spark.read.format(self.fmt).load(self.path(table))

    def stream(
        self,
        spark: SparkSession,
        table: str,
        schema: T.StructType,
        max_files_per_trigger: int | None = None,
    ) -> DataFrame:
        """A table as a stream of its appends; the limit bounds what one micro-batch reads."""
        if self.in_catalog:
            return spark.readStream.table(self.path(table))
        reader = spark.readStream.format(self.fmt).schema(schema)
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(self.path(table))

    def exists(self, spark: SparkSession, table: str) -> bool:
        """Whether the table holds data; a folder an empty append left does not count."""
        if self.in_catalog:
            return spark.catalog.tableExists(self.path(table))
        if not path_exists(spark, self.path(table)):
            return False
        try:
            self.read(spark, table)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True


def path_exists(spark: SparkSession, path: str) -> bool:
    """Look a path up in whichever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder a stream can start on before the first write to it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def files_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The data files right below a folder, and their sizes."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    files = [(f.getPath().getName(), f.getLen()) for f in found if f.isFile()]
    return [(f"{path}/{name}", size) for name, size in files if not name.startswith(("_", "."))]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of one of that name."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def keep_text(spark: SparkSession, path: str, line: str) -> None:
    """Replace a line of text; a run that dies meanwhile leaves the old or the new one."""
    write_text(spark, f"{path}.old", kept_text(spark, path) + "\n")
    write_text(spark, path, line + "\n")


def kept_text(spark: SparkSession, path: str) -> str:
    """The line that was kept last, empty before the first."""
    for name in (path, f"{path}.old"):
        text = read_text(spark, name) if path_exists(spark, name) else ""
        if text.endswith("\n"):
            return text.removesuffix("\n")
    return ""


def read_curated(spark: SparkSession, tables: Tables) -> dict[str, DataFrame]:
    """The four curated tables."""
    return {name: tables.read(spark, name) for name in CURATED_TABLES}


def preview(df: DataFrame, order_by: list[str], rows: int = 20) -> DataFrame:
    """The first rows in a fixed order: each task keeps only its own first ``rows``."""
    return df.orderBy(*order_by).limit(rows)
