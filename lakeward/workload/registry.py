"""Every registered query: ``(spark, sf_dir) -> DataFrame``.

Results are shown in types that any SQL engine prints alike: dates, times and booleans as
text, arrays joined by commas.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, StructType, TimestampNTZType, TimestampType

from lakeward.datasets import DATASETS, PATIENTS, SERVICES, STAFF, STAFF_SCHEDULE, Dataset
from lakeward.functions.sql_functions import register_range_average
from lakeward.operators import alerts, arrivals, batches, checks, gold, quality, refine
from lakeward.operators import rules as R
from lakeward.operators.kpis import service_kpis
from lakeward.operators.lineage import add_batch_lineage, number_copies
from lakeward.plans.refresh import current_tables, refresh, side_by_side, store_layers, stored
from lakeward.plans.scratch import drop_folder, scratch_database, scratch_root
from lakeward.schemas import FILE_MONITORING_AUDIT
from lakeward.sources.batch_log import BatchLog
from lakeward.sources.landing import csv_rows, json_rows, read_landing, tag_source
from lakeward.sources.listing import landed_files, listed_folders
from lakeward.sources.tables import append_run, preview, saved_tables
from lakeward.streaming.ingest import bronze_stream, content_columns, ingest_available
from lakeward.workload import feeds
from lakeward.workload.feeds import AS_OF, RUN_TS

Query = Callable[[SparkSession, str], DataFrame]

BATCH_ID = "20260107000000"
LANDING_BASE = "/landing"
# Files landed only to be read back by the same query.
LANDED = "gzip"


def presentable(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType, BooleanType)):
            column = column.cast("string")
        elif isinstance(f.dataType, ArrayType):
            column = F.concat_ws(",", column)
        columns.append(column.alias(f.name))
    return df.select(*columns)


class Session:
    """Frames of one session and data folder, built lazily by the queries below."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def bronze(self, d: Dataset) -> DataFrame:
        return feeds.bronze(self.spark, self.sf_dir, d)

    def all_bronze(self) -> dict[str, DataFrame]:
        return {d.name: self.bronze(d) for d in DATASETS}

    def bronze_rows(self) -> dict[str, DataFrame]:
        return {d.name: feeds.bronze_rows(self.spark, self.sf_dir, d) for d in DATASETS}

    def processed(self, d: Dataset) -> DataFrame:
        return refine.process(self.bronze(d), d)

    def silver(self, d: Dataset) -> DataFrame:
        return refine.silver(self.processed(d), d, RUN_TS)

    def quarantine(self, d: Dataset) -> DataFrame:
        return refine.quarantine(refine.process(refine.with_payload(self.bronze(d)), d), d, RUN_TS)

    def patient_flow(self) -> DataFrame:
        return gold.patient_flow(self.silver(PATIENTS), RUN_TS)

    def staff_efficiency(self) -> DataFrame:
        return gold.staff_efficiency(self.silver(STAFF_SCHEDULE), RUN_TS)

    def bed_utilization(self) -> DataFrame:
        return gold.bed_utilization(self.silver(SERVICES), RUN_TS)

    def operational_efficiency(self) -> DataFrame:
        return gold.operational_efficiency(
            self.silver(SERVICES), self.silver(STAFF_SCHEDULE), self.silver(PATIENTS), RUN_TS
        )

    def bottleneck_analysis(self) -> DataFrame:
        return gold.bottleneck_analysis(self.operational_efficiency(), RUN_TS)

    def stored_silver(self, datasets: tuple[Dataset, ...] = DATASETS) -> dict[str, DataFrame]:
        """Silver tables as files, for queries that read them several times."""
        root = scratch_root(self.spark, "silver")
        kept: dict[str, DataFrame] = {}

        def store(d: Dataset) -> None:
            kept[d.name] = stored(self.silver(d), f"{root}/{d.silver_table}")

        side_by_side(self.spark, [lambda d=d: store(d) for d in datasets])
        return kept

    def gold_of(self, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
        services, schedule, patients = silver[SERVICES.name], silver[STAFF_SCHEDULE.name], silver[PATIENTS.name]
        efficiency = gold.operational_efficiency(services, schedule, patients, RUN_TS)
        return {
            "patient_flow": gold.patient_flow(patients, RUN_TS),
            "staff_efficiency": gold.staff_efficiency(schedule, RUN_TS),
            "bed_utilization": gold.bed_utilization(services, RUN_TS),
            "operational_efficiency": efficiency,
            "bottleneck_analysis": gold.bottleneck_analysis(efficiency, RUN_TS),
        }

    def quality_metrics(self) -> DataFrame:
        root = scratch_root(self.spark, "layers")
        return store_layers(self.spark, self.bronze_rows(), RUN_TS, f"{root}/tables", f"{root}/staging").metrics()

    def events(self) -> DataFrame:
        return feeds.control_events(self.spark, self.sf_dir)

    def state(self) -> DataFrame:
        return batches.batch_state(self.events())

    def arrival_status(self) -> DataFrame:
        return arrivals.arrival_status(
            feeds.expected_files(self.spark, self.sf_dir),
            feeds.landed_files(self.spark, self.sf_dir),
            AS_OF,
            LANDING_BASE,
        )

    def landing(self, d: Dataset, raw: bool = False, compression: str = "none") -> tuple[dict[str, str], str]:
        """Write a feed as files; gives its CSV and JSON folders and the root above them."""
        root = scratch_root(self.spark, "landing")
        if raw:
            rows = feeds.raw_feed(self.spark, self.sf_dir, d)
            columns = [c for c in rows.columns if c not in ("source_format", "row_key")]
        else:
            rows, columns = feeds.clean_text_feed(self.spark, self.sf_dir, d), d.columns
        return feeds.land(rows, columns, root, d.feed, compression), root

    def ingested(self, d: Dataset, raw: bool = False, compression: str = "none") -> DataFrame:
        paths, _ = self.landing(d, raw, compression)
        landed = read_landing(self.spark, d.schema, RUN_TS, **paths)
        return add_batch_lineage(landed, BATCH_ID, RUN_TS, content_columns(d))


# --- ingestion ---------------------------------------------------------------------------


def _ingest_one(source_format: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths, _ = Session(spark, sf_dir).landing(PATIENTS)
        if source_format == "csv":
            rows = csv_rows(spark, paths["csv_path"], PATIENTS.schema)
        else:
            rows = json_rows(spark.read, paths["json_path"], PATIENTS.schema)
        return tag_source(rows, source_format, RUN_TS).select(*PATIENTS.columns, "source_format")

    return query


def _ingest_union(spark, sf_dir):
    return Session(spark, sf_dir).ingested(PATIENTS).select(*PATIENTS.columns, "source_format", "batch_id")


def _stream_ingest(d: Dataset) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths, root = Session(spark, sf_dir).landing(d)
        stream = bronze_stream(spark, d, BATCH_ID, RUN_TS, **paths)
        ingest_available(stream, f"{root}/bronze", f"{root}/checkpoint")
        # Partition values are read as text, as they were written.
        table = spark.read.schema(stream.schema).parquet(f"{root}/bronze")
        return table.select(*d.columns, "source_format", "batch_id", "pipeline_stage")

    return query


def _restarted(s: Session, d: Dataset, root: str | None = None) -> tuple[DataFrame, bool]:
    """A bronze table that took one delivery, died while it wrote the next, and was started again; and whether it did die.

    The run that dies has planned its micro-batch, and fails in its tasks before any of it is committed.
    """
    rows = feeds.clean_text_feed(s.spark, s.sf_dir, d)
    later = (F.col("source_format") == "csv") & (F.pmod(F.xxhash64("row_key"), F.lit(2)) == 1)
    landed, root = scratch_root(s.spark, "landing"), root or scratch_root(s.spark, "bronze")
    paths = feeds.land(rows.filter(~later), d.columns, landed, d.feed, LANDED)

    def run(column: str, value: Column) -> StructType:
        # Each run starts with a stream of its own, as a new driver would.
        stream = bronze_stream(s.spark, d, BATCH_ID, RUN_TS, **paths).withColumn(column, value)
        ingest_available(stream, f"{root}/bronze", f"{root}/checkpoint")
        return stream.schema

    whole = ("pipeline_stage", F.col("pipeline_stage"))
    run(*whole)
    feeds.write_csv(rows.filter(later).select(*d.columns), paths["csv_path"], "append", LANDED)
    dies = F.when(F.pmod(F.xxhash64("record_hash"), F.lit(2)) == 0, F.raise_error(F.lit("executor lost")).cast("string"))
    died = False
    try:
        run("pipeline_stage", F.coalesce(dies, "pipeline_stage"))
    except StreamingQueryException as failure:
        if "executor lost" not in str(failure):
            raise
        died = True
    schema = run(*whole)
    drop_folder(s.spark, landed)
    return s.spark.read.schema(schema).parquet(f"{root}/bronze"), died


def _stream_restarted(s: Session) -> DataFrame:
    """Per feed and source format: rows and different rows after a stream died and was restarted."""
    counted = []
    for d in DATASETS:
        text = F.to_json(F.struct(*[F.col(c).cast("string") for c in d.columns]), {"ignoreNullFields": "false"})
        # Rows are told apart by their digest: 32 bytes each in the shuffle instead of the whole text.
        row = F.unhex(F.sha2(text, 256))
        counts = [F.count(F.lit(1)).alias("rows"), F.count(d.columns[0]).alias("with_first"), F.count_distinct(row).alias("different_rows")]
        root = scratch_root(s.spark, "restarted")
        table, died = _restarted(s, d, root)
        rows = table.groupBy("source_format").agg(*counts).select(F.lit(d.name).alias("dataset_name"), "*", F.lit(died).alias("died"))
        # Counted and dropped before the next feed lands.
        counted.append(stored(rows, f"{root}/counted"))
        drop_folder(s.spark, f"{root}/bronze")
    return quality.union_by_name(counted)


def _project_declared_schema(spark, sf_dir):
    """A file without the ``present`` column and with some unreadable weeks."""
    rows = feeds.raw_feed(spark, sf_dir, STAFF_SCHEDULE)
    columns = [c for c in STAFF_SCHEDULE.columns if c != "present"]
    paths = feeds.land(rows, columns, scratch_root(spark, "landing"), STAFF_SCHEDULE.feed)
    return read_landing(spark, STAFF_SCHEDULE.schema, RUN_TS, **paths).select(*STAFF_SCHEDULE.columns, "source_format")


def _evolved(s: Session, d: Dataset, root: str) -> dict[str, str]:
    """A CSV folder in which an older file lacks the last column, and a newer one moves the first and adds ``ward``."""
    size = F.length("row_key")
    rows = feeds.raw_feed(s.spark, s.sf_dir, d).withColumn("ward", F.when(size % 2 == 0, F.concat(F.lit("w"), size)))
    names, path = d.columns, f"{root}/{d.feed}/csv"
    feeds.write_csv(rows.filter("source_format = 'csv'").select(*names[:-1]), path, compression=LANDED)
    feeds.write_csv(rows.filter("source_format = 'json'").select("ward", *names[1:], names[0]), path, "append", LANDED)
    return {"csv_path": path}


def _schema_evolution(read: Callable[[Session, Dataset, dict[str, str], str], DataFrame]) -> Query:
    """Per feed: rows, how many have each column, and rescued wards, after the header changed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s, results = Session(spark, sf_dir), []
        for d in DATASETS:
            first, last = d.columns[0], d.columns[-1]
            ward = F.get_json_object("_rescued_data", "$.ward")
            counts = [F.count(F.lit(1)).alias("rows"), F.count(first).alias("with_first"), F.count(last).alias("with_last"),
                      F.count(ward).alias("with_ward"), F.count_distinct(F.concat_ws("|", F.col(first), ward)).alias("pairs")]
            root = scratch_root(spark, "evolved")
            counted = read(s, d, _evolved(s, d, f"{root}/landing"), root).agg(*counts)
            results.append(stored(counted.select(F.lit(d.name).alias("dataset_name"), "*"), f"{root}/counted"))
            # Counted and dropped before the next feed lands.
            for folder in ("landing", "bronze"):
                drop_folder(spark, f"{root}/{folder}")
        return quality.union_by_name(results)

    return query


def _read_evolved(s: Session, d: Dataset, paths: dict[str, str], root: str) -> DataFrame:
    return read_landing(s.spark, d.schema, RUN_TS, **paths)


def _stream_evolved(s: Session, d: Dataset, paths: dict[str, str], root: str) -> DataFrame:
    stream = bronze_stream(s.spark, d, BATCH_ID, RUN_TS, **paths)
    ingest_available(stream, f"{root}/bronze", f"{root}/checkpoint")
    drop_folder(s.spark, f"{root}/landing")
    return s.spark.read.schema(stream.schema).parquet(f"{root}/bronze")


DEEPEST = 12


def _ingest_json_deep(spark, sf_dir):
    """Objects with a field of 1 to 12 levels that nobody declared, as arrays and as lines: what comes back of each."""
    results = []
    for d in DATASETS:
        rows = feeds.clean_text_feed(spark, sf_dir, d).filter("source_format = 'json'")
        levels = (F.conv(F.substring(F.md5("row_key"), 1, 4), 16, 10).cast("bigint") % DEEPEST + 1).cast("int")
        nested = F.concat(F.repeat(F.lit('{"d":'), levels), F.lit("1"), F.repeat(F.lit("}"), levels))
        deep = rows.select("row_key", F.concat(F.regexp_replace(F.to_json(F.struct(*d.columns)), "[}]$", ""), F.lit(',"nested":'), nested, F.lit("}")).alias("_line"))
        root = scratch_root(spark, "landing")
        for layout, between in {"array": ("[\n", ",\n", "\n]"), "lines": ("", "\n", "\n")}.items():
            path = feeds.write_json_texts(deep, f"{root}/{layout}", *between, LANDED)
            read = json_rows(spark.read, path, d.schema, multi_line=layout == "array")
            text = F.get_json_object("_rescued_data", "$.nested")
            depth = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
            counted = read.groupBy(depth.alias("depth")).agg(
                F.count(F.lit(1)).alias("rows"), F.count("service").alias("with_service"),
                F.count(F.get_json_object("_rescued_data", "$._corrupt_record")).alias("unread"),
            )
            counted = counted.select(F.lit(d.name).alias("dataset_name"), F.lit(layout).alias("layout"), "*")
            # Counted before the next files land, so that one feed stands on disk once, in one layout.
            results.append(stored(counted, f"{root}/counted/{layout}"))
            drop_folder(spark, path)
    return quality.union_by_name(results)


def _reconciliation_detects_loss(spark, sf_dir):
    """Metrics of every feed when each stored table lacks the rows of one source format."""
    s, root = Session(spark, sf_dir), scratch_root(spark, "layers")
    layers = store_layers(spark, s.bronze_rows(), RUN_TS, f"{root}/tables", f"{root}/staging")
    results = []
    for lost in ("none", "silver", "quarantine"):
        left = [
            {n: t.filter("source_format <> 'json'") if layer == lost else t for n, t in tables.items()}
            for layer, tables in (("silver", layers.silver), ("quarantine", layers.quarantine))
        ]
        metrics = quality.reconciled(layers.received, layers.newest, *left)
        results.append(metrics.select(F.lit(lost).alias("lost"), "dataset_name", "batch_id", "records_valid", "records_quarantined", "reconciliation_passed"))
    return quality.union_by_name(results)


def _ingest_json_mixed(spark, sf_dir):
    """JSON files that hold a broken object, then an object per line: rows and rescued texts of every feed."""
    counts = []
    for d in DATASETS:
        rows = feeds.clean_text_feed(spark, sf_dir, d).filter("source_format = 'json'")
        path = feeds.write_json_lines(rows, "row_key", d.columns, f"{scratch_root(spark, 'landing')}/{d.feed}")
        read = json_rows(spark.read, path, d.schema)
        broken = F.coalesce(F.col("_rescued_data"), F.lit("")).contains("unfinished")
        counts.append(read.agg(F.count_if(~broken).alias("rows"), (F.count_if(broken) > 0).alias("broken_rescued")).select(F.lit(d.name).alias("dataset_name"), "rows", "broken_rescued"))
    return quality.union_by_name(counts)


def _rescued_data(spark, sf_dir):
    return Session(spark, sf_dir).ingested(PATIENTS, raw=True).select(*PATIENTS.columns, "_rescued_data")


def _serialization_errors(spark, sf_dir):
    s = Session(spark, sf_dir)
    return quality.serialization_errors(spark, {d.name: s.ingested(d, raw=True, compression=LANDED) for d in DATASETS})


def _file_metadata(spark, sf_dir):
    """The file columns are filled in and agree with each other."""
    whole = (
        F.col("file_path").endswith(F.col("file_name"))
        & F.col("file_path").contains(F.concat(F.lit("/staff/"), "source_format", F.lit("/")))
        & (F.col("file_size") > 0)
        & F.col("file_modification_time").isNotNull()
    )
    rows = Session(spark, sf_dir).ingested(STAFF, raw=True)
    return rows.select("staff_id", "source_format", whole.alias("file_columns_filled"))


def _arrival_listing(spark, sf_dir):
    """Landed feeds per folder: how many JSON documents are listed, and whether every file that
    holds rows is listed with its size."""
    root = scratch_root(spark, "landing")
    found = []
    for d in DATASETS:
        paths = feeds.land(feeds.clean_text_feed(spark, sf_dir, d), d.columns, root, d.feed)
        read = read_landing(spark, d.schema, RUN_TS, **paths).select("file_name", "file_size").distinct()
        found.append(read.withColumn("dataset", F.lit(d.feed)))
    listed = landed_files(spark, root).where("modified_time IS NOT NULL")
    sizes = listed.select("dataset", "file_name", "size")
    missed = quality.union_by_name(found).join(sizes, ["dataset", "file_name"], "left").groupBy("dataset").agg(
        F.bool_and(F.col("file_size").eqNullSafe(F.col("size"))).alias("files_read_are_listed")
    )
    documents = listed.groupBy("dataset").agg(
        F.count_if(F.col("file_name").startswith("part-") & F.col("file_name").endswith(".txt")).alias("json_documents")
    )
    return documents.join(missed, "dataset")


def _lineage_record_hash(spark, sf_dir):
    d = STAFF_SCHEDULE
    rows = feeds.keyed_feed(spark, sf_dir, d).select(*d.columns, "file_name", "file_modification_time")
    stamped = add_batch_lineage(number_copies(rows), BATCH_ID, RUN_TS, d.columns)
    return stamped.select("week", "staff_id", "batch_id", "pipeline_stage", "processed_timestamp", "record_hash")


# --- refinement --------------------------------------------------------------------------


def _on(d: Dataset, build: Callable[[Session, Dataset], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Session(spark, sf_dir), d)


def _normalized(s: Session, d: Dataset) -> DataFrame:
    out = refine.normalize(s.bronze(d), d)
    return out.select(*d.columns, *d.derived, "record_hash")


def _validated(s: Session, d: Dataset) -> DataFrame:
    out = R.validate(refine.normalize(s.bronze(d), d), d.rules)
    return out.select("record_hash", *[r.flag for r in d.rules], R.PASSED)


def _processed(s: Session, d: Dataset) -> DataFrame:
    return s.processed(d).select(
        "record_hash", *d.columns, *d.derived, *_indicators(d), *[r.flag for r in d.all_rules], R.PASSED
    )


def _indicators(d: Dataset) -> list[str]:
    names = ["occupancy_rate", "admission_rate", "refusal_rate", "capacity_gap", "occupancy_pct"]
    return names if d.indicators is not None else []


def _failed_rules(s: Session, d: Dataset) -> DataFrame:
    out = R.explain_failures(s.processed(d), d.all_rules)
    return out.select("record_hash", "failed_rules", "rejection_reasons", "unknown_rules")


def _quarantined(s: Session, d: Dataset) -> DataFrame:
    return s.quarantine(d).drop("record_payload")


def _validate_services_kpis(spark, sf_dir):
    measured = service_kpis(refine.normalize(Session(spark, sf_dir).bronze(SERVICES), SERVICES))
    judged = R.extend_validation(measured, SERVICES.rules, SERVICES.indicator_rules)
    return judged.select("record_hash", *[r.flag for r in SERVICES.all_rules], R.PASSED)


def _service_kpis(spark, sf_dir):
    measured = service_kpis(refine.normalize(Session(spark, sf_dir).bronze(SERVICES), SERVICES))
    return measured.select("record_hash", *_indicators(SERVICES))


def _quarantine_payload(spark, sf_dir):
    out = Session(spark, sf_dir).quarantine(PATIENTS)
    fields = [F.col(f"record_payload.{c}").alias(f"raw_{c}") for c in PATIENTS.columns]
    return out.select("quarantine_id", *fields)


def _quarantine_id(spark, sf_dir):
    out = [Session(spark, sf_dir).quarantine(d).select("quarantine_id", "source_table") for d in DATASETS]
    return quality.union_by_name(out)


def _published(s: Session) -> dict[str, DataFrame]:
    """All 16 derived tables after a full run, read back through what it published."""
    root = scratch_root(s.spark, "tables")
    refresh(s.spark, s.bronze_rows(), RUN_TS, root)
    return current_tables(s.spark, root)


def _refreshed(spark, sf_dir):
    """The bottleneck table after a full run."""
    return _published(Session(spark, sf_dir))["bottleneck_analysis"]


def _refreshed_tables(s: Session) -> DataFrame:
    """Rows and batches of every derived table after a full run."""
    counted = [
        df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("batches"))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in sorted(_published(s).items())
    ]
    return quality.union_by_name(counted)


# --- control, checks ---------------------------------------------------------------------


def _of(build: Callable[[Session], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Session(spark, sf_dir))


def _batch_open(s: Session) -> DataFrame:
    events = s.events()
    return batches.batch_state(events.unionByName(batches.start_batch(s.spark, events, RUN_TS, "hospital_feeds")))


def _batch_close(s: Session) -> DataFrame:
    events = s.events()
    closing = batches.close_events(batches.batch_state(events), s.all_bronze(), batches.COMPLETED, RUN_TS)
    return batches.batch_state(events.unionByName(closing))


def _batch_close_catalog(s: Session) -> DataFrame:
    """As ``batch_close``, over catalog tables read by name, of which only the current batch's partitions are read."""
    bronze = saved_tables({d.bronze_table: feeds.bronze_parts(s.spark, s.sf_dir, d) for d in DATASETS}, scratch_database(s.spark, "bronze"))
    events = s.events()
    closing = batches.close_events(batches.batch_state(events), bronze, batches.COMPLETED, RUN_TS)
    return batches.batch_state(events.unionByName(closing))


def _batch_log(s: Session) -> DataFrame:
    """The control table kept as files: the given events, a close with totals and a new batch, read back."""
    log = BatchLog(s.spark, scratch_root(s.spark, "batch-log"))
    log.append(lambda events: s.events())
    log.close(s.all_bronze(), batches.COMPLETED, RUN_TS)
    log.open(RUN_TS, "hospital_feeds")
    return log.state()


def _audited(s: Session, status: DataFrame, runs: tuple[str, ...]) -> DataFrame:
    """The audit table after these runs appended to it, some of them again."""
    path = f"{scratch_root(s.spark, 'audit')}/file_monitoring_audit"
    for run in runs:
        append_run(arrivals.arrival_audit(status, RUN_TS, "job-1", run, 1.25), path, "run_id")
    return s.spark.read.schema(FILE_MONITORING_AUDIT).parquet(path)


# A folder that is monitored and was never made, and the documents expected of each feed.
NEVER_LANDED, EXPECTED_DOCUMENTS = "transfers", 2


def _arrival_path(s: Session) -> DataFrame:
    """Landed JSON documents listed by folder, judged, and audited; one folder does not exist."""
    root = scratch_root(s.spark, "landing")
    for d in DATASETS:
        feeds.write_json_documents(
            feeds.clean_text_feed(s.spark, s.sf_dir, d).filter("source_format = 'json'"), "row_key", d.columns, f"{root}/{d.feed}"
        )
    monitored = [*(d.feed for d in DATASETS), NEVER_LANDED]
    files, failures = listed_folders(s.spark, {name: f"{root}/{name}" for name in monitored})
    expected = s.spark.createDataFrame([(name, EXPECTED_DOCUMENTS) for name in monitored], "dataset string, expected_count int")
    day = files.agg(F.max(F.to_date("modified_time")).alias("day")).first()["day"]
    status = arrivals.arrival_status(expected.join(failures, "dataset", "left"), files, day, LANDING_BASE)
    return _audited(s, status, ("run-1", "run-1")).select(
        "run_id", "dataset", "s3_path", "expected_files", "received_files", "status", "reason", "error_message", "overall_result"
    )


def _batch_fail(s: Session) -> DataFrame:
    return batches.close_events(s.state(), s.all_bronze(), batches.FAILED, RUN_TS)


def _all_tables(s: Session) -> dict[str, DataFrame]:
    silver = s.stored_silver()
    return (
        {d.bronze_table: s.bronze(d) for d in DATASETS}
        | {d.silver_table: silver[d.name] for d in DATASETS}
        | s.gold_of(silver)
    )


def _lineage_layers(s: Session) -> DataFrame:
    silver = s.stored_silver((PATIENTS,))[PATIENTS.name]
    gold_table = gold.patient_flow(silver, RUN_TS)
    return checks.lineage_layers({"Bronze": s.bronze(PATIENTS), "Silver": silver, "Gold": gold_table})


def _lineage_e2e(s: Session) -> DataFrame:
    silver = s.stored_silver((PATIENTS,))[PATIENTS.name]
    return checks.lineage_end_to_end(s.state(), s.bronze(PATIENTS), silver, gold.patient_flow(silver, RUN_TS))


def _check_silver(s: Session) -> DataFrame:
    found = [
        checks.check_known_batches({d.silver_table: s.silver(d)}, s.bronze(d)) for d in DATASETS
    ]
    return quality.union_by_name(found)


def _avg_by_range(spark, sf_dir):
    name = register_range_average(
        spark,
        "avg_price_by_quantity",
        feeds.table(spark, sf_dir, "lineitem"),
        "l_extendedprice",
        "l_quantity",
        "Average extended price of line items in a range of quantities.",
    )
    calls = [(1, 10), (11, 25), (26, 50), (100, 200)]
    shown = ", ".join(f"round({name}({low}, {high}), 2) AS avg_{low}_{high}" for low, high in calls)
    return spark.sql(f"SELECT {shown}")


def _distinct_service(s: Session) -> DataFrame:
    return s.silver(PATIENTS).select("service").distinct()


def _build() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for d in DATASETS:
        q[d.bronze_table] = _on(d, lambda s, d: s.bronze(d))
        q[f"stream_ingest_{d.name}"] = _stream_ingest(d)
        q[f"normalize_{d.name}"] = _on(d, _normalized)
        q[f"validate_{d.name}"] = _on(d, _validated)
        q[f"process_{d.name}"] = _on(d, _processed)
        q[f"failed_rules_{d.name}"] = _on(d, _failed_rules)
        q[d.silver_table] = _on(d, lambda s, d: s.silver(d))
        q[d.quarantine_table] = _on(d, _quarantined)
    q |= {
        "ingest_csv": _ingest_one("csv"),
        "ingest_json": _ingest_one("json"),
        "ingest_union": _ingest_union,
        "project_declared_schema": _project_declared_schema,
        "schema_evolution_union": _schema_evolution(_read_evolved),
        "stream_ingest_evolved": _schema_evolution(_stream_evolved),
        "stream_restarted": _of(_stream_restarted),
        "ingest_json_deep": _ingest_json_deep,
        "rescued_data": _rescued_data,
        "serialization_errors": _serialization_errors,
        "file_metadata": _file_metadata,
        "arrival_listing": _arrival_listing,
        "lineage_record_hash": _lineage_record_hash,
        "validate_services_kpis": _validate_services_kpis,
        "service_kpis": _service_kpis,
        "quarantine_payload": _quarantine_payload,
        "quarantine_id": _quarantine_id,
        "file_inventory": _of(lambda s: quality.file_inventory(s.all_bronze())),
        "patient_flow": _of(Session.patient_flow),
        "staff_efficiency": _of(Session.staff_efficiency),
        "bed_utilization": _of(Session.bed_utilization),
        "operational_efficiency": _of(Session.operational_efficiency),
        "bottleneck_analysis": _of(Session.bottleneck_analysis),
        "refreshed_bottlenecks": _refreshed,
        "refreshed_tables": _of(_refreshed_tables),
        "data_quality_metrics": _of(Session.quality_metrics),
        "reconciliation_detects_loss": _reconciliation_detects_loss,
        "ingest_json_mixed": _ingest_json_mixed,
        "duplicate_recount": _of(
            lambda s: quality.duplicate_recount({d.name: s.processed(d) for d in DATASETS}, s.quality_metrics())
        ),
        "batch_open": _of(_batch_open),
        "batch_close": _of(_batch_close),
        "batch_close_catalog": _of(_batch_close_catalog),
        "batch_fail": _of(_batch_fail),
        "batch_log": _of(_batch_log),
        "batch_state": _of(Session.state),
        "batch_stale_recovery": _of(lambda s: batches.stale_events(s.state(), RUN_TS)),
        "current_batch": _of(lambda s: batches.current_batch(s.state())),
        "batch_history": _of(lambda s: batches.batch_history(s.state())),
        "latest_batch": _of(lambda s: batches.latest_batch(s.state())),
        "batch_totals": _of(lambda s: batches.batch_totals(s.all_bronze())),
        "batch_files": _of(lambda s: batches.batch_files(s.all_bronze())),
        "arrival_status": _of(Session.arrival_status),
        "arrival_summary": _of(lambda s: arrivals.arrival_summary(s.arrival_status(), RUN_TS)),
        "arrival_anomalies": _of(lambda s: arrivals.arrival_anomalies(s.arrival_status())),
        "arrival_audit_appended": _of(lambda s: _audited(s, s.arrival_status(), ("run-1", "run-2", "run-1"))),
        "arrival_path": _of(_arrival_path),
        "arrival_audit": _of(lambda s: arrivals.arrival_audit(s.arrival_status(), RUN_TS, "job-1", "run-1", 1.25)),
        "alert_services": _of(lambda s: alerts.alert_services(s.operational_efficiency())),
        "alert_summary": _of(lambda s: alerts.alert_summary(s.operational_efficiency())),
        "duplicate_keys_bronze": _of(lambda s: checks.duplicate_keys(s.bronze(PATIENTS), "patient_id")),
        "duplicate_keys_silver": _of(lambda s: checks.duplicate_keys(s.silver(PATIENTS), "patient_id")),
        "distinct_service": _of(_distinct_service),
        "distinct_batches": _of(lambda s: checks.distinct_batches({d.bronze_table: s.bronze(d) for d in DATASETS})),
        "preview_patients": _of(
            lambda s: preview(
                s.silver(PATIENTS).select("patient_id", "arrival_date", "departure_date", "length_of_stay"),
                ["patient_id", "arrival_date"],
                10,
            )
        ),
        "lineage_layers": _of(_lineage_layers),
        "lineage_e2e": _of(_lineage_e2e),
        "batch_consistency": _of(lambda s: checks.batch_consistency(_all_tables(s))),
        "running_batch_count": _of(lambda s: checks.running_batch_count(s.state())),
        "check_batch_open": _of(lambda s: checks.check_batch_open(s.state())),
        "check_stale": _of(lambda s: checks.check_stale(s.state())),
        "check_batch_bronze": _of(
            lambda s: checks.check_known_batches({d.bronze_table: s.bronze(d) for d in DATASETS}, s.state())
        ),
        "check_batch_silver": _of(_check_silver),
        "check_batch_gold": _of(lambda s: checks.check_one_batch(s.gold_of(s.stored_silver()), "gold")),
        "check_metadata": _of(lambda s: checks.check_metadata({d.bronze_table: s.bronze(d) for d in DATASETS}, "BRONZE")),
        "check_inventory": _of(lambda s: checks.check_inventory(quality.file_inventory(s.all_bronze()))),
        "avg_by_range_udf": _avg_by_range,
    }
    return q


def _presented(query: Query) -> Query:
    return lambda spark, sf_dir: presentable(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _presented(query) for name, query in _build().items()}
