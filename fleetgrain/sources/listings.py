"""Folder listings as DataFrames; file contents are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the SHA-256 of no bytes. File readers leave out files without any.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(name, path, bytes, modified) of the files directly in a folder, empty ones too.

    Names only, a few per calendar day, so the driver asks the file system.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(folder, glob)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    rows = [
        (s.getPath().getName(), s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found if s.isFile()
    ]
    listed = spark.createDataFrame(rows, "name string, path string, bytes long, millis long")
    return listed.select("name", "path", "bytes", F.timestamp_millis("millis").alias("modified"))


def file_contents(spark: SparkSession, paths: list[str] | str, glob: str = "*") -> DataFrame:
    """(path, content) of whole files, for jobs that need their bytes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
