"""Files and folders of whatever file system a path is in."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _folder(spark, path)
    return system.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    hadoop, system = _folder(spark, path)
    return [status.getPath().getName() for status in system.listStatus(hadoop)] if system.exists(hadoop) else []


def matching(spark: SparkSession, path: str, pattern: str) -> dict[str, int]:
    """Folders and files below the path that fit a pattern, relative to it, with their times in milliseconds."""
    hadoop, system = _folder(spark, path)
    start = len(system.makeQualified(hadoop).toUri().getPath().rstrip("/")) + 1
    found = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")) or []
    return {s.getPath().toUri().getPath()[start:]: s.getModificationTime() for s in found}


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """The files below a path, by full name, with their lengths; hidden ones are left out, as readers do."""
    hadoop, system = _folder(spark, path)
    found, files = {}, system.listFiles(hadoop, True)
    while files.hasNext():
        status = files.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found[status.getPath().toString()] = status.getLen()
    return found


def delete(spark: SparkSession, path: str) -> None:
    hadoop, system = _folder(spark, path)
    system.delete(hadoop, True)


def drop_empty(spark: SparkSession, path: str) -> None:
    """Remove a folder that holds nothing; the file system itself refuses any other."""
    hadoop, system = _folder(spark, path)
    if system.exists(hadoop) and not system.listStatus(hadoop):
        system.delete(hadoop, False)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop, system = _folder(spark, path)
    stream = system.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file under a name that nobody has taken; False if somebody has.

    The file appears by a rename that fails where the name exists.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    _, system = _folder(spark, path)
    final = system.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, final, options)
        return True
    except Py4JJavaError:
        system.delete(draft, False)
        if system.exists(final):
            return False
        raise
