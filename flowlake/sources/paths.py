"""File-system helpers: existence, search, size and removal of paths.

Uses the Hadoop FileSystem of the path's scheme, so it works for local,
HDFS and object-store URIs alike and understands glob patterns. Checking
first avoids provoking (and logging) failed reads for inputs that are
allowed to be absent. Only names and sizes are read, never data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, pattern: str) -> bool | None:
    """True if ``pattern`` (a path or glob) matches anything; None when the
    session offers no JVM handle (then the caller just tries the read)."""
    try:
        path, fs = _open(spark, pattern)
    except Exception:
        return None
    matches = fs.globStatus(path)
    return matches is not None and len(matches) > 0


def find_paths(spark: SparkSession, root: str, part: str, skip: tuple[str, ...] = ()) -> list[str]:
    """Files and folders below ``root``, at any depth, whose name contains
    ``part``, sorted; a match is not searched further, hidden names (``.``,
    ``_``) and names in ``skip`` are passed over. An absent root gives none."""
    path, fs = _open(spark, root)
    found, todo = [], [path] if fs.exists(path) else []
    while todo:
        for status in fs.listStatus(todo.pop()):
            name = status.getPath().getName()
            if name.startswith((".", "_")) or name in skip:
                continue
            if part in name:
                found.append(status.getPath().toString())
            elif status.isDirectory():
                todo.append(status.getPath())
    return sorted(found)


def size_of(spark: SparkSession, *patterns: str) -> int:
    """Bytes of all files below the matches of the patterns (absent: 0)."""
    total = 0
    for pattern in patterns:
        path, fs = _open(spark, pattern)
        for status in fs.globStatus(path) or ():
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Names, sizes and times of the files below ``paths``: changes when the
    data does."""
    parts = []
    for p in paths:
        path, fs = _open(spark, p)
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            parts.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join(sorted(parts))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted, hidden ones left out; an absent folder has none."""
    path, fs = _open(spark, folder)
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path))
    return sorted(n for n in names if not n.startswith((".", "_")))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; fails if it exists."""
    p, fs = _open(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    p, fs = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file its final name; False, and the file is deleted, if the name is taken."""
    p, fs = _open(spark, source)
    t, _ = _open(spark, target)
    if fs.exists(t) or not fs.rename(p, t):
        fs.delete(p, False)
        return False
    return True


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder a name that is not taken."""
    p, fs = _open(spark, source)
    t, _ = _open(spark, target)
    if fs.exists(t) or not fs.rename(p, t):
        raise OSError(f"{source} cannot become {target}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder the engine itself has written."""
    p, fs = _open(spark, path)
    fs.delete(p, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder when the driver ends."""
    p, fs = _open(spark, path)
    fs.deleteOnExit(p)
