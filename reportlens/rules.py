"""Rule sets: which columns to read and which values to keep, map or drop.

A ``Rules`` object is plain data. Every operator takes one, so the same plan runs on the
vaccine-safety extracts (the defaults) and on any other three related tables.
"""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on these exact words, patterns, weights and names.

TARGET_TYPE_PATTERN = "COVID19"
TARGET_MAKERS = (
    "COVID19",
    "PFIZER\\BIONTECH",
    "MODERNA",
    "JANSSEN",
    "PFIZER",
    "BIONTECH",
    "NOVAVAX",
)

MAKER_RULES = (
    ("PFIZER|BIONTECH", "PFIZER"),
    ("MODERNA", "MODERNA"),
    ("JANSSEN|J&J|JOHNSON", "JANSSEN"),
)
MAKERS = ("PFIZER", "MODERNA", "JANSSEN")

SYMPTOM_DENY_PATTERN = (
    "COVID-19|COVID19|CORONAVIRUS|SARS-COV-2|VACCINATION|VACCINE|IMMUNISATION|IMMUNIZATION"
    "|PRODUCT QUALITY|PRODUCT TEMPERATURE|INAPPROPRIATE SCHEDULE|EXPIRED PRODUCT"
    "|PRODUCT STORAGE|INCORRECT DOSE|UNEVALUABLE|TEST|ADMINISTERED|ADMINISTRATION|QUALITY"
    "|STORAGE|ERROR|ISSUE|EXCURSION|INAPPROPRIATE|WRONG|PRODUCT"
)
SYMPTOM_GENERIC_TERMS = (
    "PAIN",
    "FEVER",
    "HEADACHE",
    "NAUSEA",
    "FATIGUE",
    "CHILLS",
    "DIARRHEA",
    "VOMITING",
    "DIZZINESS",
)
CURATED_DENY_PATTERN = (
    "COVID-19|COVID19|CORONAVIRUS|SARS-COV-2|VACCINATION|VACCINE|IMMUNISATION|IMMUNIZATION"
    "|PRODUCT QUALITY ISSUE|PRODUCT TEMPERATURE EXCURSION"
    "|INAPPROPRIATE SCHEDULE OF PRODUCT ADMINISTRATION"
)

STATE_WEIGHTS = (
    ("CA", 0.18),
    ("TX", 0.15),
    ("FL", 0.12),
    ("NY", 0.10),
    ("PA", 0.08),
    ("IL", 0.07),
    ("OH", 0.06),
    ("GA", 0.05),
    ("NC", 0.05),
    ("MI", 0.04),
    ("AZ", 0.03),
    ("VA", 0.03),
    ("WA", 0.02),
    ("MA", 0.01),
    ("NJ", 0.01),
)
FALLBACK_STATES = ("CA", "TX", "FL", "NY", "PA")

REQUIRED_FILES = ("VAERSDATA.csv", "VAERSSYMPTOMS.csv", "VAERSVAX.csv")

# Analysis name -> (stem of the NDJSON and CSV outputs, relational table, datasource).
OUTPUT_STEMS = {
    "symptoms": ("chunked_symptoms", "vaers_symptoms_analysis", "vaers_symptoms_by_manufacturer"),
    "severity": ("severity", "vaers_severity_analysis", "vaers_severity_by_age"),
    "geographic": ("geographic", "vaers_geographic_analysis", "vaers_geographic_distribution"),
}
NDJSON_SUFFIX = "_for_druid.json"
CSV_SUFFIX = "_analysis.csv"

# End of fixed values.


@dataclass(frozen=True)
class Rules:
    """Column names and value rules for one family of report tables."""

    id_col: str = "VAERS_ID"
    died_col: str = "DIED"
    hospital_col: str = "HOSPITAL"
    flag_value: str = "Y"
    age_cols: tuple[str, ...] = ("AGE_YRS", "CAGE_YR")
    symptom_col: str = "SYMPTOM1"
    type_col: str = "VAX_TYPE"
    maker_col: str = "VAX_MANU"

    target_type_pattern: str = TARGET_TYPE_PATTERN
    target_makers: tuple[str, ...] = TARGET_MAKERS

    maker_rules: tuple[tuple[str, str], ...] = MAKER_RULES
    maker_default: str = "OTHER"
    makers: tuple[str, ...] = MAKERS

    symptom_min_length: int = 3
    symptom_deny_pattern: str = SYMPTOM_DENY_PATTERN
    symptom_deny_terms: tuple[str, ...] = SYMPTOM_GENERIC_TERMS
    curated_deny_pattern: str = CURATED_DENY_PATTERN

    age_breaks: tuple[float, ...] = (18, 65)
    age_labels: tuple[str, ...] = ("0-17", "18-64", "65+")
    age_unknown: str = "Unknown"

    @property
    def report_schema(self) -> dict[str, str]:
        """Columns the analyses read from the report table, with their types."""
        return {
            self.id_col: "bigint",
            self.died_col: "string",
            self.hospital_col: "string",
            **{name: "double" for name in self.age_cols},
        }

    @property
    def symptom_schema(self) -> dict[str, str]:
        return {self.id_col: "bigint", self.symptom_col: "string"}

    @property
    def vaccine_schema(self) -> dict[str, str]:
        return {self.id_col: "bigint", self.type_col: "string", self.maker_col: "string"}


DEFAULT_RULES = Rules()

# Ten-year age bands, an alternative to the three default groups.
DECADE_BREAKS = (18, 30, 40, 50, 60, 70, 80)
DECADE_LABELS = ("0-17", "18-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+")
