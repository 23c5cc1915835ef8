"""Small control files and atomic publication on any Hadoop file system.

Tables are written by Spark. Only manifests, pointers and directory renames go through
here, so the same code runs on a laptop, HDFS or an object store.
"""

from __future__ import annotations

from contextlib import contextmanager
import hashlib
import json
import os
import re
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that is unset, the context's checkpoint folder serves; a session of one process sets its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="folioweave-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/work-{uuid.uuid4().hex}"


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._systems: dict = {}

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        """An instance of its own: Spark's shared one keeps its checksums.

        Control files carry their own hashes and get no checksum files on local disks.
        """
        uri = self._path(path).toUri()
        key = f"{uri.getScheme()}://{uri.getAuthority()}"
        if key not in self._systems:
            hadoop = self._jvm.org.apache.hadoop.fs.FileSystem
            self._systems[key] = hadoop.newInstance(
                self._path(path).getFileSystem(self._conf).getUri(), self._conf)
            self._systems[key].setVerifyChecksum(False)
            self._systems[key].setWriteChecksum(False)
        return self._systems[key]

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def is_directory(self, path: str) -> bool:
        return self.exists(path) and self._system(path).getFileStatus(self._path(path)).isDirectory()

    def is_link(self, path: str) -> bool:
        system = self._system(path)
        if not system.exists(self._path(path)):
            return False
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.getUri(), self._conf)
        return context.getFileLinkStatus(self._path(path)).isSymlink()

    def make_directory(self, path: str) -> None:
        self._system(path).mkdirs(self._path(path))

    def remove_tree(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)

    def read_bytes(self, path: str) -> bytes:
        if not self.exists(path):
            raise FileNotFoundError(path)
        stream = self._system(path).open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_json(self, path: str):
        return json.loads(self.read_bytes(path).decode("utf-8"))

    def write_bytes(self, path: str, value: bytes) -> None:
        """Write a temporary sibling, then replace the destination in one rename."""
        target = self._path(path)
        self.make_directory(target.getParent().toString())
        staged = f"{target.getParent().toString()}/.{target.getName()}-{uuid.uuid4().hex}"
        system = self._system(path)
        stream = system.create(self._path(staged), True)
        try:
            stream.write(bytearray(value))
        finally:
            stream.close()
        try:
            self._replace(staged, path)
        except Exception:
            self.remove_tree(staged)
            raise

    def _replace(self, source: str, target: str) -> None:
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._system(target).getUri(), self._conf)
        options = self._gateway.new_array(getattr(fs, "Options$Rename"), 1)
        options[0] = getattr(fs, "Options$Rename").OVERWRITE
        context.rename(self._path(source), self._path(target), options)

    def is_local(self, path: str) -> bool:
        return self._system(path).getUri().getScheme() == "file"

    def resolved(self, path: str) -> str:
        """The path with all links followed; other stores than local disks have none."""
        if not self.is_local(path):
            return self._system(path).makeQualified(self._path(path)).toString()
        return os.path.realpath(self._path(path).toUri().getPath())

    def same_file(self, one: str, other: str) -> bool:
        """Do two paths name one file, also by a link or another spelling?"""
        if self.resolved(one) == self.resolved(other):
            return True
        if not (self.is_local(one) and self.is_local(other) and self.exists(one) and self.exists(other)):
            return False
        return os.path.samefile(self.resolved(one), self.resolved(other))

    @contextmanager
    def held(self, path: str):
        """Only one holder at a time, on any machine: a lock file beside ``path``.

        It is made in one step that fails if it is there. A holder that died leaves it behind; it is
        named in the error, to be removed by hand once its holder is known to be gone.
        """
        target = self._path(path)
        self.make_directory(target.getParent().toString())
        lock = f"{target.getParent().toString()}/.{target.getName()}.lock"
        try:
            if self.is_local(path):             # Hadoop's local create looks first, then creates
                local = self._path(lock).toUri().getPath()
                os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            else:
                self._system(path).create(self._path(lock), False).close()
        except Exception as reason:
            raise RuntimeError(f"another writer holds {lock}") from reason
        try:
            yield
        finally:
            self.remove_tree(lock)

    def content(self, path: str) -> bytes | None:
        return self.read_bytes(path) if self.exists(path) else None

    def swap_json(self, path: str, value, expected: bytes | None) -> None:
        """Replace a file only while it still holds ``expected`` (None: while it is absent)."""
        with self.held(path):
            if self.content(path) != expected:
                raise ValueError("the active pointer moved during processing; nothing was published")
            self.write_json(path, value)

    def write_json(self, path: str, value) -> None:
        text = json.dumps(value, ensure_ascii=False, indent=2) + "\n"
        self.write_bytes(path, text.encode("utf-8"))

    def move_directory(self, source: str, target: str) -> None:
        if not self._system(source).rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def listing_hash(self, path: str) -> str:
        """A hash of all files below a folder: path, length and modification time."""
        found = hashlib.sha256()
        entries = self._system(path).listFiles(self._path(path), True)
        lines = []
        while entries.hasNext():
            entry = entries.next()
            lines.append(f"{entry.getPath()} {entry.getLen()} {entry.getModificationTime()}")
        for line in sorted(lines):
            found.update(line.encode() + b"\n")
        return found.hexdigest()

    def sha256(self, path: str) -> str | None:
        if not self.exists(path) or self.is_directory(path):
            return None
        stream = self._system(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()

    def first_character(self, path: str) -> str:
        """The first character that is no white space or byte-order mark; empty if none."""
        if not self.exists(path):
            raise FileNotFoundError(path)
        stream = self._system(path).open(self._path(path))
        try:
            while (byte := stream.read()) >= 0:
                if byte not in b" \t\r\n\xef\xbb\xbf":
                    return chr(byte)
            return ""
        finally:
            stream.close()


def file_identities(paths: DataFrame, column: str = "path") -> DataFrame:
    """``paths`` with ``real_path`` and ``file_key``, found in parallel where the files are.

    Links are followed and the device and file number are read, so a hard link, a symbolic link or
    another spelling on a disk that ignores case gives the same key. Stores without links (and
    disks that a task does not see) are known by the path alone; absent files have no key.
    """
    schema = T.StructType([*paths.schema, T.StructField("real_path", T.StringType()),
                           T.StructField("file_key", T.StringType())])

    def identify(frames):
        for frame in frames:
            real, keys = [], []
            for path in frame[column]:
                local = None if path is None else re.sub(r"\Afile:/*", "/", path)
                if local is None or not local.startswith("/"):
                    real.append(path)
                    keys.append(None)
                    continue
                real.append(os.path.realpath(local))
                try:
                    state = os.stat(local)
                    keys.append(f"{state.st_dev}:{state.st_ino}")
                except OSError:
                    keys.append(None)
            yield frame.assign(real_path=pd.Series(real, index=frame.index, dtype=object),
                               file_key=pd.Series(keys, index=frame.index, dtype=object))

    return paths.mapInPandas(identify, schema)


def alias_violations(identities: DataFrame, key: str = "paper_id") -> DataFrame:
    """``rule, key, detail`` of every file that several keys name, by its path or its number.

    Counts combine before the shuffle, so a file that very many keys name is one group of sums.
    """
    named = identities.select(key, F.explode(F.array(
        F.struct(F.lit("source_path_shared").alias("rule"), F.col("real_path").alias("name")),
        F.struct(F.lit("source_path_alias").alias("rule"), F.col("file_key").alias("name")))).alias("n"))
    groups = named.where("n.name IS NOT NULL").groupBy("n.rule", "n.name").agg(
        F.count("*").alias("times"), F.min(key).alias("first"), F.max(key).alias("last"))
    return groups.where("times > 1").select("rule", F.col("first").alias("key"), F.col("last").alias("detail"))
