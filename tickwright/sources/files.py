"""Names and sizes of files in whatever file system a path belongs to."""

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _located(spark, path)
    return fs.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Name and length of the entries of a folder, sorted by name; none if it is missing."""
    fs, hadoop = _located(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted((entry.getPath().getName(), entry.getLen()) for entry in fs.listStatus(hadoop))


def modified(spark: SparkSession, path: str) -> int:
    """When a file was last changed, in milliseconds."""
    fs, hadoop = _located(spark, path)
    return fs.getFileStatus(hadoop).getModificationTime()


def below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and length of all files below a folder, those of hidden folders left out."""
    fs, hadoop = _located(spark, path)
    found, pending = [], [hadoop]
    while pending:
        for entry in fs.listStatus(pending.pop()):
            place = entry.getPath()
            if place.getName()[:1] in "_.":
                continue
            if entry.isDirectory():
                pending.append(place)
            else:
                found.append((place.toString(), entry.getLen()))
    return sorted(found)


def ends(spark: SparkSession, path: str, n: int) -> tuple[bytes, bytes]:
    """The first and the last ``n`` bytes of a file that has as many."""
    fs, hadoop = _located(spark, path)
    length = fs.getFileStatus(hadoop).getLen()
    opened = fs.open(hadoop)
    try:

        def at(place: int) -> bytes:
            opened.seek(place)
            return bytes(opened.read() for _ in range(n))

        return at(0), at(length - n)
    finally:
        opened.close()


def mark(spark: SparkSession, path: str) -> None:
    """Make a new empty file; it is an error if there is one."""
    fs, target = _located(spark, path)
    fs.create(target, False).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file; readers skip it until it is whole."""
    fs, target = _located(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}")
    out = fs.create(hidden, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    fs.rename(hidden, target)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _located(spark, path)
    fs.delete(hadoop, True)
