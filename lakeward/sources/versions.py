"""Sets of tables replaced as a whole: a folder per version, and a list of the published ones.

``root/published`` holds one small file per published version, named by its number. A file appears
whole or not at all, so a reader always finds a complete set, and the tables of a run that failed are in
a folder nothing points to.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from lakeward.plans.scratch import drop_folder
from lakeward.sources.files import create_if_absent, names_in, text_of

# Versions that stay readable for queries that began before a newer one.
KEPT_VERSIONS = 2


def new_version(root: str) -> tuple[str, str]:
    """Name and folder of a version nobody sees yet."""
    name = uuid4().hex
    return name, f"{root}/versions/{name}"


def _published(spark: SparkSession, root: str) -> list[str]:
    return names_in(spark, f"{root}/published")


def publish(spark: SparkSession, root: str, version: str, tables: Mapping[str, StructType]) -> None:
    """Make a version the current one, and delete those before the last ``KEPT_VERSIONS``.

    Of two runs that publish at once, each gets a number of its own, and the later one is current.
    """
    text = json.dumps({"version": version, "tables": {name: schema.jsonValue() for name, schema in tables.items()}})
    while True:
        known = _published(spark, root)
        number = int(known[-1]) + 1 if known else 1
        if create_if_absent(spark, f"{root}/published/{number:012d}", text):
            break
    for old in known[: max(0, len(known) + 1 - KEPT_VERSIONS)]:
        drop_folder(spark, f"{root}/versions/{json.loads(text_of(spark, f'{root}/published/{old}'))['version']}")
        drop_folder(spark, f"{root}/published/{old}")


def current(spark: SparkSession, root: str) -> tuple[str, dict[str, dict]]:
    """Folder and table schemas of the version published last."""
    known = _published(spark, root)
    if not known:
        raise LookupError(f"no version has been published below {root}")
    entry = json.loads(text_of(spark, f"{root}/published/{known[-1]}"))
    return f"{root}/versions/{entry['version']}", entry["tables"]
