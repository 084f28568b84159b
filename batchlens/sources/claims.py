"""Files that one of several writers can create: the claim of a name, with what the winner wrote."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from batchlens.session import hadoop_path


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole content; False when it exists. Of several writers one succeeds.

    The content is written under another name first. It gets the name by a rename, which fails where the name is
    taken; on a local disk, where a rename would replace, by a hard link.
    """
    system, target = hadoop_path(spark, path)
    _, draft = hadoop_path(spark, f"{target.getParent()}/_{uuid.uuid4().hex}")
    out = system.create(draft)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if system.getUri().getScheme() != "file":
        won = not system.exists(target) and system.rename(draft, target)
    else:
        paths = spark._jvm.java.nio.file.Paths
        local = lambda p: paths.get(system.makeQualified(p).toUri())
        try:
            spark._jvm.java.nio.file.Files.createLink(local(target), local(draft))
            won = True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            won = False
    if not won or system.exists(draft):
        system.delete(draft, False)
    return won


def read_file(spark: SparkSession, path: str) -> str:
    system, found = hadoop_path(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the published files of a folder, which need not exist."""
    system, folder = hadoop_path(spark, path)
    if not system.exists(folder):
        return []
    return sorted(n for s in system.listStatus(folder) if (n := s.getPath().getName())[0] not in "._")


def exists(spark: SparkSession, path: str) -> bool:
    system, found = hadoop_path(spark, path)
    return system.exists(found)


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder = hadoop_path(spark, path)
    system.delete(folder, True)
