"""Every delivery below a landing folder, files of zero bytes too, listed in parallel.

Spark's own file sources pass over empty files, and list a folder tree from the driver. This source lists the first
level in one place and every folder below it as a partition of its own, by Arrow's file systems (local and
mounted folders, S3, GCS, HDFS).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.sources.landing import PARTS, describe_files

FORMAT = "quipu_listing"
SCHEMA = "path string, bytes long, modificationTime timestamp"
#: Stores the source can list; for others there is ``landing.landed_files``, without empty files.
STORES = ("file", "s3", "s3a", "gs", "gcs", "hdfs")


def store_of(root: str) -> str:
    return root.split(":", 1)[0] if ":" in root.split("/", 1)[0] else "file"


def full(root: str) -> str:
    """A root as the names of its files begin."""
    root = root.rstrip("/")
    return "file:/" + root.removeprefix("file:").lstrip("/") if store_of(root) == "file" else root.replace("s3a://", "s3://", 1)


def _source() -> type:
    """The data source; made in a function so that workers get it whole, whatever they can import."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Folder(InputPartition):
        def __init__(self, path: str, deep: bool):
            self.path, self.deep = path, deep

    class Lister(DataSourceReader):
        def __init__(self, root: str, pattern: str, hidden: bool):
            self.root, self.pattern, self.marks = root.rstrip("/") or "/", pattern, "" if hidden else "_."

        def _store(self):
            """The file system, the root in it, and what stands before its paths in full names."""
            from pyarrow import fs

            name = self.root.split(":", 1)[0] if ":" in self.root.split("/", 1)[0] else "file"
            if name == "file":
                path = "/" + self.root.removeprefix("file:").lstrip("/")
                return fs.LocalFileSystem(), path, "file:"
            store, path = fs.FileSystem.from_uri(self.root.replace("s3a://", "s3://", 1))
            return store, path, self.root.replace("s3a://", "s3://", 1).removesuffix(path)

        def partitions(self):
            from pyarrow import fs

            store, root, _ = self._store()
            found = store.get_file_info(fs.FileSelector(root))
            folders = [f.path for f in found if f.type == fs.FileType.Directory and f.base_name[0] not in self.marks]
            return [Folder(root, False), *[Folder(p, True) for p in sorted(folders)]]

        def read(self, partition):
            from fnmatch import fnmatchcase

            from pyarrow import fs

            store, root, before = self._store()
            for f in store.get_file_info(fs.FileSelector(partition.path, recursive=partition.deep)):
                inside = f.path[len(root) :].strip("/").split("/")
                if f.type != fs.FileType.File or any(p[0] in self.marks for p in inside):
                    continue
                named = any(fnmatchcase(p, self.pattern) for p in inside)  # the file, or a folder of its parts
                if named:
                    yield before + f.path, f.size, f.mtime

    class Listing(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            hidden = self.options.get("hidden", "false") == "true"
            return Lister(self.options["path"], self.options.get("pattern", "*"), hidden)

    return Listing


def listed(spark: SparkSession, root: str, pattern: str = "*.csv", hidden: bool = False) -> DataFrame:
    """(path, bytes, modificationTime) of every file below ``root`` that matches, or lies in a folder that does.

    Names that begin with a dot or an underscore are left out, as Spark does, unless ``hidden``.
    """
    spark.dataSource.register(_source())
    options = {"pattern": pattern, "hidden": str(hidden).lower()}
    return spark.read.format(FORMAT).options(**options).load(root)


def inventory(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """As ``landing.landed_files``, with the files of zero bytes and a column that tells them."""
    files = listed(spark, root, pattern).withColumn("path", F.regexp_replace("path", PARTS, "$1"))
    whole = files.groupBy("path").agg(F.sum("bytes").alias("bytes"), F.max("modificationTime").alias("modificationTime"))
    named = describe_files(whole, "path").withColumn("vacio", F.col("bytes") == 0)
    return named.select("PAIS", "archivo", "path", "bytes", "modificationTime", "vacio")
