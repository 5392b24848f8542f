"""Folders of files as tables, listed, read and written by tasks.

Spark's own file listing keeps the status of every file on the driver, and its binary
reader needs a whole file in one row. Here a task lists one shard folder, and a large
file is read by ranges of bytes in many tasks. Stores are reached through pyarrow: local
folders, HDFS, S3, GCS and others that it knows.
"""

import fnmatch
import hashlib

import pyarrow as pa
from pyarrow import fs as stores_of
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from anchorage.sources import stores

RANGE = 64 << 20  # bytes hashed by one row of work
PIECE = 4 << 20  # bytes held at a time
FORMAT = "folder_files"


def opened(root):
    """(store, path within it) of a folder."""
    return stores_of.FileSystem.from_uri(root)


class Shard(InputPartition):
    """Folders under the root; the empty name is the root itself, without its folders."""


class Lister(DataSourceReader):
    def __init__(self, options):
        self.root, self.pattern = options["path"], options.get("pattern", "*")
        self.shards, self.tasks = options.get("shards", "").split("\n"), int(options.get("tasks", 1))

    def partitions(self):
        return [Shard(self.shards[k :: self.tasks]) for k in range(min(self.tasks, len(self.shards)))]

    def read(self, shard):
        store, base = opened(self.root)
        for name in shard.value:
            yield from self.folder(store, base.rstrip("/"), name)

    def folder(self, store, base, name):
        selector = stores_of.FileSelector(f"{base}/{name}" if name else base, allow_not_found=True, recursive=bool(name))
        found = [
            (name, f.path[len(base) + 1 :], f.size)
            for f in store.get_file_info(selector)
            if f.type == stores_of.FileType.File and not f.base_name.startswith((".", "_")) and fnmatch.fnmatch(f.base_name, self.pattern)
        ]
        for k in range(0, len(found), 10_000):
            shards, paths, sizes = zip(*found[k : k + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array(paths), pa.array(sizes, pa.int64())], ["shard", "path", "length"])


class Putter(DataSourceWriter):
    """Each row (path, content) becomes a file; a task that runs again puts the same files again."""

    def __init__(self, options):
        self.root = options["path"]

    def write(self, rows):
        store, base = opened(self.root)
        folders = set()
        for row in rows:
            path = f"{base.rstrip('/')}/{row[0]}"
            folder = path.rpartition("/")[0]
            if folder not in folders:
                store.create_dir(folder, recursive=True)
                folders.add(folder)
            with store.open_output_stream(path) as out:
                out.write(bytes(row[1]))
        return WriterCommitMessage()


class FolderFiles(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "shard string, path string, length long"

    def reader(self, schema):
        return Lister(self.options)

    def writer(self, schema, overwrite):
        return Putter(self.options)


def listing(spark, root, pattern="*", shards=None):
    """(shard, path, length) of the files under a folder; ``path`` is relative to it.

    Each folder directly under the root is a shard, and the root's own files are another;
    a task lists some shards. Only the names of the shards are on the driver; they are
    looked up unless given. Names that begin with a dot or an underscore are left out, as
    Spark's readers do.
    """
    spark.dataSource.register(FolderFiles)
    if shards is None:
        shards = ["", *(c for c in stores.children(spark, root, folders=True) if not c.startswith((".", "_")))]
    reader = spark.read.format(FORMAT).option("pattern", pattern).option("shards", "\n".join(shards))
    return reader.option("tasks", 2 * spark.sparkContext.defaultParallelism).load(root)


def write_files(df, root, path="path", content="content"):
    """Write each row as a file of its own, at a path relative to the root."""
    df.sparkSession.dataSource.register(FolderFiles)
    rows = df.select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content"))
    rows.write.format(FORMAT).mode("append").save(root)
    return root


def _hashed(root):
    def run(batches):
        store, base = opened(root)
        base = base.rstrip("/")
        for batch in batches:
            out = []
            for path, at, size in zip(batch["path"], batch["at"], batch["size"]):
                state = hashlib.sha256()
                with store.open_input_file(f"{base}/{path}") as file:
                    for begin in range(at, at + size, PIECE):
                        state.update(file.read_at(min(PIECE, at + size - begin), begin))
                out.append(state.hexdigest())
            yield batch.assign(sha256=out)

    return run


def hashes(spark, root, pattern="*", shards=None, size=RANGE):
    """(path, length, ranges, sha256) of the files under a folder, whatever their size.

    The ranges of ``size`` bytes of all files are dealt out to all tasks, each hashed on its
    own; a file's hash is the SHA-256 of its ranges' hex digests in a row, so it depends on
    ``size``. An empty file is one empty range.
    """
    found = listing(spark, root, pattern, shards)
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long")))
    ranges = found.select("path", "length", at.alias("at"))
    ranges = ranges.withColumn("size", F.least(F.lit(size), F.col("length") - F.col("at"))).repartition("path", "at")
    digests = ranges.mapInPandas(_hashed(root), "path string, length long, at long, size long, sha256 string")
    in_order = F.array_sort(F.collect_list(F.struct("at", "sha256")))
    return digests.groupBy("path", "length").agg(
        F.count(F.lit(1)).alias("ranges"), F.sha2(F.array_join(in_order["sha256"], ""), 256).alias("sha256")
    )
