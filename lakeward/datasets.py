"""The four feeds, described once: columns, text columns, keys, derived columns and rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from lakeward.operators import rules as R
from lakeward.operators.kpis import service_kpis

_TYPES = {"string": StringType(), "int": IntegerType(), "date": DateType()}


def _columns(text: str) -> StructType:
    pairs = [item.split(":") for item in text.split()]
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


@dataclass(frozen=True, eq=False)
class Dataset:
    """One feed. ``name`` labels metrics, ``feed`` names the landing folder and bronze table."""

    name: str
    feed: str
    schema: StructType
    text_columns: tuple[str, ...]
    keys: tuple[str, ...]
    rules: R.RuleSet
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)
    indicators: Callable[[DataFrame], DataFrame] | None = None
    indicator_rules: R.RuleSet = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def all_rules(self) -> R.RuleSet:
        return self.rules + self.indicator_rules

    @property
    def bronze_table(self) -> str:
        return f"bronze_{self.feed}"

    @property
    def silver_table(self) -> str:
        return f"silver_{self.name}"

    @property
    def quarantine_table(self) -> str:
        return f"quarantine_{self.name}"


PATIENTS = Dataset(
    name="patients",
    feed="patients",
    schema=_columns(
        "patient_id:string name:string age:int arrival_date:date departure_date:date service:string satisfaction:int"
    ),
    text_columns=("service",),
    keys=("patient_id", "arrival_date"),
    rules=R.PATIENT_RULES,
    derived={"length_of_stay": lambda: F.datediff("departure_date", "arrival_date")},
)

STAFF = Dataset(
    name="staff",
    feed="staff",
    schema=_columns("staff_id:string staff_name:string role:string service:string"),
    text_columns=("role", "service"),
    keys=("staff_id",),
    rules=R.STAFF_RULES,
)

STAFF_SCHEDULE = Dataset(
    name="staff_schedule",
    feed="staff_schedule",
    schema=_columns("week:int staff_id:string staff_name:string role:string service:string present:int"),
    text_columns=("role", "service"),
    keys=("week", "staff_id", "service"),
    rules=R.SCHEDULE_RULES,
)

SERVICES = Dataset(
    name="services",
    feed="services_weekly",
    schema=_columns(
        "week:int month:int service:string available_beds:int patients_request:int patients_admitted:int "
        "patients_refused:int patient_satisfaction:int staff_morale:int event:string"
    ),
    text_columns=("service", "event"),
    keys=("week", "service"),
    rules=R.SERVICE_RULES,
    indicators=service_kpis,
    indicator_rules=R.SERVICE_KPI_RULES,
)

DATASETS = (PATIENTS, STAFF, STAFF_SCHEDULE, SERVICES)
