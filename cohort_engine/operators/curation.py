"""Raw tables -> model tables: names, personal data, the wide fact table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.sources.io import quoted
from cohort_engine.sources.layout import table_bytes

# Column names of the curated tables.
ENCOUNTER_NAMES = {
    "Id": "Enc_Id",
    "START": "START_TIME",
    "END": "END_TIME",
    "PROVIDER": "ORGANIZATION",
}
PROVIDER_NAMES = {"Id": "PROVIDER", "NAME": "Provider_Name"}
ORGANIZATION_NAMES = {
    "Id": "ORGANIZATION",
    "NAME": "Org_Name",
    "ADDRESS": "PROVIDER_ADDRESS",
    "CITY": "PROVIDER_CITY",
    "STATE": "PROVIDER_STATE",
    "ZIP": "PROVIDER_ZIP",
    "GENDER": "PROVIDER_GENDER",
}
PATIENT_NAMES = {"Id": "PATIENT"}

# Personal columns of the patients table.
PII_COLUMNS = (
    "SSN",
    "DRIVERS",
    "PASSPORT",
    "PREFIX",
    "FIRST",
    "LAST",
    "SUFFIX",
    "MAIDEN",
    "BIRTHPLACE",
    "ADDRESS",
)


def curate_encounters(df: DataFrame) -> DataFrame:
    """Columns the table lacks are skipped, as in all ``curate_`` functions."""
    return df.withColumnsRenamed(ENCOUNTER_NAMES)


def curate_providers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(PROVIDER_NAMES)


def curate_organizations(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(ORGANIZATION_NAMES)


def curate_patients(df: DataFrame, pii: Iterable[str] = ()) -> DataFrame:
    return obfuscate(df, pii).withColumnsRenamed(PATIENT_NAMES)


def obfuscate(df: DataFrame, columns: Iterable[str], salt: str | None = None) -> DataFrame:
    """Replace the columns by their sha1 hash as hex text. Null stays null.

    Columns of other types are hashed as text. Without ``salt`` the hash is the
    plain sha1 of the value, so equal values stay joinable across tables.
    """
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns to hash are missing: {missing}; table has {df.columns}")
    prefix = [] if salt is None else [F.lit(salt)]
    return df.withColumns(
        {c: F.sha1(F.concat(*prefix, F.col(c).cast("string"))) for c in columns}
    )


def patient_encounters(
    encounters: DataFrame, patients: DataFrame, organizations: DataFrame
) -> DataFrame:
    """Wide fact: encounters with their patient and organization (inner joins).

    No broadcast hint: a dimension is broadcast when its measured size allows it,
    and otherwise AQE splits the partitions of patients or organizations that hold
    a large share of the encounters. Patients have the most columns: organizations that
    are not broadcast are joined first, so that only encounters are shuffled to them. Beyond
    the threshold the rows come sorted by PATIENT, which makes them small on disk and in
    the shuffles that follow.
    """
    _check_names(encounters, patients, organizations)
    if _will_be_broadcast(organizations):
        joined = encounters.join(patients, ["PATIENT"]).join(organizations, ["ORGANIZATION"])
    else:
        joined = encounters.join(organizations, ["ORGANIZATION"]).join(patients, ["PATIENT"])
    named = {c.lower(): c for c in encounters.columns}
    keys = [named["organization"], named["patient"]]
    rest = [
        c
        for table in (encounters, patients, organizations)
        for c in table.columns
        if c.lower() not in ("organization", "patient")
    ]
    return joined.select(*[quoted(c) for c in [*keys, *rest]])


def _will_be_broadcast(df: DataFrame) -> bool:
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return table_bytes(df) <= conf.autoBroadcastJoinThreshold()


def _check_names(encounters, patients, organizations):
    seen = {c.lower(): "encounters" for c in encounters.columns}
    for name, table, key in (
        ("patients", patients, "patient"),
        ("organizations", organizations, "organization"),
    ):
        for c in table.columns:
            if c.lower() != key and c.lower() in seen:
                raise ValueError(f"column {c} is in both {seen[c.lower()]} and {name}; rename one")
            seen.setdefault(c.lower(), name)
