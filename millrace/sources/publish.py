"""Publishing of files and folders on any file system that Hadoop reaches.

An object store has no rename, and a rename across machines is no commit. A folder is therefore written under a name of its own and
becomes current by one small file, the pointer, which is created only if it does not exist. A run that fails leaves no pointer, and its
folder is removed; a second run never touches what the first one wrote.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "_PUBLISHED.json"


class Place:
    """A path and its file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.text = spark, path.rstrip("/")
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.text)
        self.system = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def below(self, name: str) -> Place:
        return Place(self.spark, f"{self.text}/{name}")

    def exists(self) -> bool:
        return self.system.exists(self.path)

    def create(self, data: bytes) -> None:
        """The file, new and complete; one that exists is never replaced, and one that could not be written whole is removed."""
        try:
            stream = self.system.create(self.path, False)
        except Exception as why:
            if self.exists():
                raise FileExistsError(f"{self.text} exists") from why
            raise
        try:
            stream.write(bytearray(data))
            stream.close()
        except BaseException:
            self.delete()
            raise

    def read(self) -> bytes:
        stream = self.system.open(self.path)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def delete(self) -> None:
        self.system.delete(self.path, True)


def create_json(spark: SparkSession, path: str, value: object) -> None:
    Place(spark, path).create(json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False).encode())


def publish_folder(spark: SparkSession, target: str, write: Callable[[str], dict]) -> dict:
    """Calls write with the path of a new folder below target; what it returns is published with the folder's name, as target's manifest.

    Raises FileExistsError, before anything is written, if target is published already, and also if another run publishes it meanwhile.
    """
    top = Place(spark, target)
    pointer, name = top.below(POINTER), f"data-{uuid.uuid4().hex}"
    if pointer.exists():
        raise FileExistsError(f"{target} is published")
    try:
        manifest = {"status": "complete", "data": name, **write(f"{top.text}/{name}")}
        pointer.create(json.dumps(manifest, indent=2, sort_keys=True, ensure_ascii=False).encode())
    except BaseException:
        top.below(name).delete()
        raise
    return manifest


def manifest_of(spark: SparkSession, target: str) -> dict:
    """The manifest of a published folder. One without a pointer, or with one that was not written whole, is not published."""
    pointer = Place(spark, target).below(POINTER)
    if not pointer.exists():
        raise FileNotFoundError(f"{target} is not published")
    try:
        return json.loads(pointer.read())
    except ValueError as why:
        raise FileNotFoundError(f"{target} is not published completely") from why


def published_path(spark: SparkSession, target: str) -> str:
    return f"{target.rstrip('/')}/{manifest_of(spark, target)['data']}"
