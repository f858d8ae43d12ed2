"""The header of every CSV file of a folder; only first lines are read."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_READERS = 32


def written_names(line: str) -> tuple[str, ...]:
    """The names in a header line, as written."""
    return tuple(next(csv.reader([line]), []))


def column_names(written: tuple[str, ...]) -> tuple[str, ...]:
    """Column names; an empty or repeated one is told apart by its position, as in Spark's reader."""
    return tuple(f"_c{i}" if not name else f"{name}{i}" if written.count(name) > 1 else name for i, name in enumerate(written))


def _first_line(spark: SparkSession, path: str) -> str | None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        source = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()


def csv_files(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(path, path as ``_metadata.file_path`` writes it, header line) of the files below ``path`` that are not empty.

    One open per file, some at a time, next to the listing that every reader of the folder needs.
    """
    listed = spark.read.format("binaryFile").load(path).where("length > 0")
    files = [tuple(row) for row in listed.select("path", F.col("_metadata.file_path")).collect()]
    with ThreadPoolExecutor(_READERS) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file[0]), files))
    # Spark's readers skip a byte order mark, too.
    return [(path, name, line.removeprefix("\ufeff")) for (path, name), line in zip(files, lines) if line is not None]


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV folder by the names in their own header."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, _, line in csv_files(spark, path):
        groups.setdefault(written_names(line), []).append(file)
    return groups


def header_table(spark: SparkSession, path: str) -> tuple[DataFrame, list[tuple[str, ...]]]:
    """``file_path``, ``header_line`` and ``header`` (a number) of every file; and the columns of each number."""
    files = csv_files(spark, path)
    headers = sorted({column_names(written_names(line)) for _, _, line in files})
    rows = [(name, line, headers.index(column_names(written_names(line)))) for _, name, line in files]
    return spark.createDataFrame(rows, "file_path string, header_line string, header int"), headers
