"""Landed CSV and JSON files as bronze columns, for batch and streaming readers alike.

Values are read as text and cast afterwards, so a value that does not fit its declared type
becomes NULL in the column and is kept, with every undeclared field, in ``_rescued_data``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from lakeward.functions.expressions import tolerant_cast
from lakeward.sources.headers import column_names, files_by_header, header_table
from lakeward.sources.json_objects import METADATA as FILE_METADATA
from lakeward.sources.json_objects import split_files

CORRUPT = "_corrupt_record"




def _text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in [*columns, CORRUPT]])


def _file_metadata() -> list[Column]:
    return [F.col(f"_metadata.{c}").alias(c) for c in FILE_METADATA]


def project_declared(
    df: DataFrame,
    schema: StructType,
    raw: Mapping[str, Column],
    extra: Mapping[str, Column],
    undeclared: Column | None = None,
) -> DataFrame:
    """Select the declared columns with their types, the file columns and ``_rescued_data``.

    ``raw`` gives the text of each column that exists; a declared column without text becomes
    a typed NULL. ``extra`` holds further fields to rescue whose names are known, and
    ``undeclared`` a map of those whose names only the data knows.
    """
    declared, kept = [], {}
    for f in schema:
        text = raw.get(f.name)
        value = F.lit(None).cast(f.dataType) if text is None else tolerant_cast(text, f.dataType)
        declared.append(value.alias(f.name))
        if text is not None and not isinstance(f.dataType, StringType):
            kept[f.name] = F.when(value.isNull(), text)
    kept |= extra
    # The test is cheap and false for a clean row, which then builds no JSON.
    needed = F.coalesce(*kept.values(), F.lit(None)).isNotNull() if kept else F.lit(False)
    if undeclared is None:
        # NULL fields are left out of the JSON text.
        fields = F.to_json(F.struct(*[v.alias(k) for k, v in kept.items()])) if kept else F.lit(None)
    else:
        needed = needed | (F.size(undeclared) > 0)
        known = F.create_map(*[item for k, v in kept.items() for item in (F.lit(k), v)])
        fields = F.to_json(F.map_concat(F.map_filter(known, lambda _, v: v.isNotNull()), undeclared))
    rescued = F.when(needed, fields).cast("string")
    return df.select(*declared, *FILE_METADATA, rescued.alias("_rescued_data"))


def _csv_rows_of(reader, path: str | Sequence[str], schema: StructType, written: tuple[str, ...]) -> DataFrame:
    header = column_names(written)
    # A file that was replaced since its header was read fails; names told apart by position cannot be checked.
    source = (
        reader.format("csv")
        .schema(_text_schema(header))
        .option("header", True)
        .option("enforceSchema", header != written)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .load(path)
    )
    df = source.select(*[F.col(f"`{c}`") for c in header], CORRUPT, *_file_metadata())
    names = schema.fieldNames()
    texts = {c: F.col(f"`{c}`") for c in header}
    extra = {CORRUPT: F.col(CORRUPT)} | {c: t for c, t in texts.items() if c not in names}
    return project_declared(df, schema, {c: t for c, t in texts.items() if c in names}, extra)


def csv_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a CSV folder. Each file's values are placed by that file's own header.

    Files with the same header are read together; a header may gain, lose or move columns from
    one file to the next, and columns nobody declared are rescued. A folder may be empty.
    """
    groups = files_by_header(spark, path)
    if len(groups) < 2:
        return _csv_rows_of(spark.read, path, schema, next(iter(groups), tuple(schema.fieldNames())))
    return reduce(DataFrame.unionByName, [_csv_rows_of(spark.read, files, schema, header) for header, files in groups.items()])


def csv_stream_rows(reader, spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a CSV folder as a stream, placed by each file's own header.

    The stream reads lines, and the headers known when it is built join by file path. A file that
    lands later fails the batch before anything of it is stored; the next run finds its header.
    Lines equal to the file's header are headers.
    """
    known, headers = header_table(spark, path)
    lines = reader.format("text").load(path).select(F.col("value").alias("_text"), *_file_metadata())
    # One row per file, from the driver's listing: its broadcast spares every line a shuffle to its file's task.
    lines = lines.where(F.trim("_text") != "").join(F.broadcast(known), "file_path", "left")
    late = F.raise_error(F.concat(F.lit("the header was not known yet of "), "file_path")).cast("int")
    lines = lines.where(~F.col("_text").eqNullSafe(F.col("header_line"))).withColumn("header", F.coalesce("header", late))
    fields = F.lit(None).cast("map<string,string>")
    for number, header in enumerate(headers):
        read = F.from_csv("_text", _text_schema(header).toDDL(), {"columnNameOfCorruptRecord": CORRUPT})
        pairs = [item for c in [*header, CORRUPT] for item in (F.lit(c), read.getField(c))]
        fields = F.when(F.col("header") == number, F.create_map(*pairs)).otherwise(fields)
    return _mapped_rows(lines.select(*FILE_METADATA, fields.alias("_fields")), schema, F.col("_fields").getItem(CORRUPT), [CORRUPT])


def _mapped_rows(df: DataFrame, schema: StructType, unread: Column, apart: Sequence[str] = ()) -> DataFrame:
    """Rows whose texts are in the map ``_fields``; ``apart`` names what is no field of the file."""
    names = schema.fieldNames()
    fields = F.col("_fields")
    undeclared = F.map_filter(fields, lambda k, v: ~k.isin([*names, *apart]) & v.isNotNull())
    return project_declared(
        df,
        schema,
        {n: fields.getItem(n) for n in names},
        {CORRUPT: unread},
        F.coalesce(undeclared, F.expr("cast(map() as map<string,string>)")),
    )


def json_rows(reader, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Rows of a JSON folder through ``spark.read`` or ``spark.readStream``.

    Objects are read as maps, so no inference pass is needed and a new field can appear in any
    file; what is nested in a field, however deep, is its text. A ``multi_line`` file may hold an
    object, arrays of objects, an object per line, or several of these one after another. An object that
    cannot be read is rescued by itself, and so is what stands between objects; the others of the
    file stay rows. Such a file is read by one task; files with an object per line are split over
    many with ``multi_line=False``.
    """
    text = reader.format("text").option("wholetext", multi_line).load(path)
    df = text.select(F.col("value").alias("_text"), *_file_metadata()).filter(F.col("_text").rlike(r"\S"))
    whole = F.lit(True)
    if multi_line:
        files = StructType([StructField("_text", StringType()), StructField("_whole", BooleanType()), *df.schema.fields[1:]])
        df, whole = df.mapInArrow(split_files, files), F.col("_whole")
    fields = F.when(whole, F.from_json("_text", "map<string,string>"))
    df = df.select(*FILE_METADATA, fields.alias("_fields"), "_text")
    return _mapped_rows(df, schema, F.when(F.col("_fields").isNull(), F.col("_text")))


def tag_source(df: DataFrame, source_format: str, run_ts: datetime) -> DataFrame:
    return df.withColumns({"source_format": F.lit(source_format), "ingestion_timestamp": F.lit(run_ts)})


def read_landing(
    spark: SparkSession,
    schema: StructType,
    run_ts: datetime,
    *,
    csv_path: str | None = None,
    json_path: str | None = None,
    multi_line: bool = True,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The CSV and the JSON folder of one feed as a single frame, batch or streaming."""

    def reader():
        if not streaming:
            return spark.read
        stream = spark.readStream
        return stream.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else stream

    feeds = []
    if csv_path:
        rows = csv_stream_rows(reader(), spark, csv_path, schema) if streaming else csv_rows(spark, csv_path, schema)
        feeds.append(tag_source(rows, "csv", run_ts))
    if json_path:
        feeds.append(tag_source(json_rows(reader(), json_path, schema, multi_line), "json", run_ts))
    if not feeds:
        raise ValueError("read_landing needs csv_path, json_path or both")
    return feeds[0] if len(feeds) == 1 else feeds[0].unionByName(feeds[1], allowMissingColumns=True)
