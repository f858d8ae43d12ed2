"""Declarative row rules: flags, the overall verdict, and the reasons for a failure."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSED = "validation_passed"


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate over one row and the message shown when it is false."""

    flag: str
    predicate: str
    message: str


RuleSet = tuple[Rule, ...]


def _verdict(flags: Iterable[str]) -> Column:
    """All flags hold; an unknown (NULL) flag counts as a failure."""
    return F.expr(f"coalesce({' AND '.join(flags)}, false)")


def _flags(rules: Sequence[Rule]) -> dict[str, Column]:
    return {rule.flag: F.expr(rule.predicate) for rule in rules}


def validate(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Add one boolean column per rule and ``validation_passed``."""
    flagged = df.withColumns(_flags(rules))
    return flagged.withColumn(PASSED, _verdict(r.flag for r in rules))


def extend_validation(df: DataFrame, base: RuleSet, extra: RuleSet) -> DataFrame:
    """Tighten an existing verdict by further rules; runs the base rules first if they are missing."""
    judged = df if PASSED in df.columns else validate(df, base)
    flagged = judged.withColumns(_flags(extra))
    return flagged.withColumn(PASSED, _verdict([PASSED, *(r.flag for r in extra)]))


def explain_failures(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Add the names and messages of false flags, and the names of unknown (NULL) flags.

    A false flag is listed in ``failed_rules`` and ``rejection_reasons``. A flag that is NULL
    rejects the row too but is not false, so it is listed apart, in ``unknown_rules``.
    """

    def listing(condition, text) -> Column:
        return F.array_compact(F.array(*[F.when(condition(r), F.lit(text(r))) for r in rules]))

    def failed(rule: Rule) -> Column:
        return ~F.col(rule.flag)

    return df.withColumns(
        {
            "failed_rules": listing(failed, lambda r: r.flag),
            "rejection_reasons": listing(failed, lambda r: r.message),
            "unknown_rules": listing(lambda r: F.col(r.flag).isNull(), lambda r: r.flag),
        }
    )


def passing(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rows on which every rule holds: the same rows as ``validation_passed``.

    Stated as one conjunct per rule, which Catalyst can split and push into the scan; the
    single verdict column hides them behind a ``coalesce``.
    """
    return df.filter(" AND ".join(r.flag for r in rules))


def failing(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(PASSED))


def drop_flags(df: DataFrame, rules: RuleSet) -> DataFrame:
    return df.drop(*[r.flag for r in rules], PASSED)


# ---------------------------------------------------------------------------
# The rules of the four feeds. Flags, bounds, role names and messages are fixed
# values that stored results contain.
# ---------------------------------------------------------------------------

VALIDATION_VERSION = "v1.2"

ROLE_NAMES = ("doctor", "nurse", "technician", "administrator")

_ROLE_LIST = ", ".join(f"'{role}'" for role in ROLE_NAMES)

SERVICE_PRESENT = Rule("valid_service", "service IS NOT NULL AND trim(service) <> ''", "Service cannot be null or empty")
ROLE_PRESENT = Rule("valid_role", "role IS NOT NULL AND trim(role) <> ''", "Role cannot be null or empty")
ROLE_KNOWN = Rule("valid_role_value", f"role IN ({_ROLE_LIST})", "Role must be one of: " + ", ".join(ROLE_NAMES))
STAFF_ID_PRESENT = Rule("valid_staff_id", "staff_id IS NOT NULL", "Staff ID cannot be null")

PATIENT_RULES: RuleSet = (
    Rule("valid_patient_id", "patient_id IS NOT NULL", "Patient ID cannot be null"),
    Rule("valid_arrival_date", "arrival_date IS NOT NULL", "Arrival date cannot be null"),
    Rule("valid_departure_date", "departure_date IS NOT NULL", "Departure date cannot be null"),
    Rule("valid_patient_name", "name IS NOT NULL", "Patient name cannot be null"),
    SERVICE_PRESENT,
    Rule("valid_age", "age BETWEEN 0 AND 110", "Age must be between 0 and 110"),
    Rule("valid_satisfaction", "satisfaction BETWEEN 0 AND 100", "Satisfaction must be between 0 and 100"),
    Rule("valid_dates", "departure_date >= arrival_date", "Departure date must be >= arrival date"),
    Rule("valid_length_of_stay", "length_of_stay BETWEEN 0 AND 180", "Length of stay must be between 0 and 180 days"),
)

STAFF_RULES: RuleSet = (
    STAFF_ID_PRESENT,
    Rule("valid_staff_name", "staff_name IS NOT NULL AND trim(staff_name) <> ''", "Staff name cannot be null or empty"),
    ROLE_PRESENT,
    SERVICE_PRESENT,
    ROLE_KNOWN,
)

SCHEDULE_RULES: RuleSet = (
    STAFF_ID_PRESENT,
    Rule("valid_presence", "present IN (0, 1)", "Present must be 0 or 1"),
    Rule("valid_week", "week > 0", "Week must be greater than 0"),
    ROLE_PRESENT,
    SERVICE_PRESENT,
    ROLE_KNOWN,
)

SERVICE_RULES: RuleSet = (
    SERVICE_PRESENT,
    Rule("valid_week", "week BETWEEN 1 AND 53", "Week must be between 1 and 53"),
    Rule("valid_month", "month BETWEEN 1 AND 12", "Month must be between 1 and 12"),
    Rule("valid_available_beds", "available_beds > 0", "Available beds must be greater than 0"),
    Rule("valid_patients_request", "patients_request >= 0", "Patients requested must be >= 0"),
    Rule("valid_patients_admitted", "patients_admitted >= 0", "Patients admitted must be >= 0"),
    Rule("valid_patients_refused", "patients_refused >= 0", "Patients refused must be >= 0"),
    Rule(
        "valid_patient_satisfaction",
        "patient_satisfaction BETWEEN 0 AND 100",
        "Patient satisfaction must be between 0 and 100",
    ),
    Rule("valid_staff_morale", "staff_morale BETWEEN 0 AND 100", "Staff morale must be between 0 and 100"),
    Rule(
        "valid_admitted_vs_beds",
        "patients_admitted <= available_beds",
        "Patients admitted cannot exceed available beds",
    ),
    Rule(
        "valid_requests_vs_admitted",
        "patients_request >= patients_admitted",
        "Patients requested must be >= patients admitted",
    ),
    Rule(
        "valid_requests_vs_refused",
        "patients_request >= patients_refused",
        "Patients requested must be >= patients refused",
    ),
    Rule(
        "valid_request_balance",
        "patients_request = patients_admitted + patients_refused",
        "Patients requested must equal admitted + refused",
    ),
    Rule("valid_event", "event IS NOT NULL AND trim(event) <> ''", "Event cannot be null or empty"),
)

SERVICE_KPI_RULES: RuleSet = (
    Rule("valid_occupancy_rate", "occupancy_rate IS NOT NULL AND occupancy_rate <= 1", "Occupancy rate must be <= 1"),
    Rule(
        "valid_admission_rate",
        "admission_rate IS NOT NULL AND admission_rate BETWEEN 0 AND 1",
        "Admission rate must be between 0 and 1",
    ),
    Rule(
        "valid_refusal_rate",
        "refusal_rate IS NOT NULL AND refusal_rate BETWEEN 0 AND 1",
        "Refusal rate must be between 0 and 1",
    ),
)
