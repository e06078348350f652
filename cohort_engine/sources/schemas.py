"""Declared types of the raw columns. Columns not listed stay text."""

from __future__ import annotations

# Raw columns which are not plain text.
RAW_TYPES: dict[str, dict[str, str]] = {
    "patients": {"BIRTHDATE": "date"},
    "encounters": {"START": "timestamp", "END": "timestamp", "COST": "double"},
    "organizations": {},
    "providers": {},
}

ENTITIES = ("patients", "organizations", "providers", "encounters", "patient_encounters")
