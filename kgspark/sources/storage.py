"""Files of the control plane: on a local disk, or on any file system that Spark can write to."""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a local session that names none gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
    return root.rstrip("/")


class LocalFiles:
    """Paths of a local disk; writes are atomic."""

    def exists(self, path: str) -> bool:
        return Path(path).exists()

    def read(self, path: str) -> str:
        return Path(path).read_text()

    def write(self, path: str, text: str | bytes) -> None:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        scratch = Path(path).with_name(f".{Path(path).name}.{uuid.uuid4().hex}.tmp")
        scratch.write_bytes(text.encode() if isinstance(text, str) else text)
        os.replace(scratch, path)

    def create(self, path: str, text: str) -> bool:
        """Write a file that isn't there yet; False if it is."""
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        try:
            with open(path, "x") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True

    def is_folder(self, path: str) -> bool:
        return Path(path).is_dir()

    def names(self, path: str) -> list[str]:
        return sorted(p.name for p in Path(path).iterdir()) if Path(path).is_dir() else []

    def tree(self, path: str) -> list[str]:
        """Names of all files below a folder."""
        return [p.name for p in Path(path).rglob("*")]

    def delete(self, path: str) -> None:
        shutil.rmtree(path) if Path(path).is_dir() else Path(path).unlink(missing_ok=True)

    def rename(self, old: str, new: str) -> None:
        Path(new).parent.mkdir(parents=True, exist_ok=True)
        os.replace(old, new)

    def sha256(self, path: str) -> str:
        with open(path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()


class SharedFiles:
    """The same through Spark's file systems, for roots such as ``hdfs://`` or ``s3a://``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.jvm = spark, spark._jvm

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, path: str, text: str | bytes, overwrite: bool) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, overwrite)
        try:
            stream.write(bytearray(text.encode() if isinstance(text, str) else text))
        finally:
            stream.close()

    def write(self, path: str, text: str | bytes) -> None:
        scratch = f"{path}.{uuid.uuid4().hex}.tmp"
        self._put(scratch, text, False)
        self.delete(path)
        self.rename(scratch, path)

    def create(self, path: str, text: str) -> bool:
        if self.exists(path):
            return False
        try:
            self._put(path, text, False)
        except Exception:
            if self.exists(path):
                return False
            raise
        return True

    def is_folder(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def tree(self, path: str) -> list[str]:
        fs, p = self._at(path)
        found, every = [], fs.listFiles(p, True)
        while every.hasNext():
            found.append(every.next().getPath().getName())
        return found

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def rename(self, old: str, new: str) -> None:
        fs, p = self._at(new)
        fs.mkdirs(p.getParent())
        if not fs.rename(self.jvm.org.apache.hadoop.fs.Path(old), p):
            raise OSError(f"{old} couldn't be renamed to {new}")

    def sha256(self, path: str) -> str:
        return self.spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]


def files(spark: SparkSession | None, root: str) -> LocalFiles | SharedFiles:
    """What a root's paths are kept with: local files for a plain path, else Spark's file system."""
    return SharedFiles(spark) if spark is not None and "://" in str(root) else LocalFiles()
