"""Small file-system helpers on the session's Hadoop file systems (any URI scheme)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    system, jpath = _open(spark, path)
    return system.exists(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    system, jpath = _open(spark, path)
    if not system.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(jpath))


def list_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Every file below ``path``, at any depth, by its path from there, with its bytes."""
    return {name: size for name, (size, _) in stamps(spark, path).items()}


def stamps(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """As ``list_files``, with the bytes and the time of the last change of each file."""
    system, jpath = _open(spark, path)
    if not system.exists(jpath):
        return {}
    base, found = system.makeQualified(jpath).toUri().getPath(), {}
    files = system.listFiles(jpath, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toUri().getPath()[len(base):].lstrip("/")
        found[name] = (status.getLen(), status.getModificationTime())
    return found


def hidden(name: str) -> bool:
    """Whether Spark's readers skip the file: a part of its path starts with a dot or underscore."""
    return any(part[0] in "._" and "=" not in part for part in name.split("/"))


def size(spark: SparkSession, path: str) -> int:
    system, jpath = _open(spark, path)
    return system.getContentSummary(jpath).getLength()


def delete(spark: SparkSession, path: str) -> None:
    system, jpath = _open(spark, path)
    system.delete(jpath, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    system, jold = _open(spark, old)
    _, jnew = _open(spark, new)
    system.mkdirs(jnew.getParent())
    if not system.rename(jold, jnew):
        raise OSError(f"cannot rename {old} to {new}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, jpath = _open(spark, path)
    stream = system.create(jpath, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, jpath = _open(spark, path)
    stream = system.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def escape_glob(path: str) -> str:
    """``path`` with the characters a reader would take as a pattern escaped."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)
