"""File listing and removal through Spark's own file access."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Codec of the layers' files. A digest as text takes half its letters under it; Spark's default codec leaves it as it is.
CODEC = "zstd"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jvm_path).isDirectory()


def parts_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and bytes of a file, or of the files of a folder in the order of their names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
    parts = [(status.getPath().toString(), status.getLen()) for status in found if status.isFile()]
    return sorted(p for p in parts if not p[0].rsplit("/", 1)[1].startswith(("_", ".")))


def head_of(spark: SparkSession, path: str, size: int) -> str:
    """The first *size* bytes of a file as text; no more is read."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(jvm_path)
    try:
        io = spark._jvm.org.apache.commons.io
        return io.IOUtils.toString(io.input.BoundedInputStream(stream, size), "UTF-8")
    finally:
        stream.close()


def partition_values(spark: SparkSession, folder: str, name: str) -> list[str]:
    """Values of the partition column *name* below *folder*, in order, from folder names alone."""
    if not path_exists(spark, folder):
        return []
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
    names = [status.getPath().getName() for status in found]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{name}="))


def touch(spark: SparkSession, path: str) -> None:
    """An empty folder as a mark."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jvm_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Paths below *folder* as rows; no file is opened."""
    try:
        found = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(folder)
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, length bigint")
    return found.select("path", "length")


def parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet rows under *schema*; none while the folder does not exist."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)
