"""Run configuration.

A frozen dataclass replaces the untyped JSON dict: zone ranges, planning-district
groups, category maps, control-column lists and sampling fractions are explicit
arguments, so every operator is a pure function of (DataFrames, RunConfig).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed pipeline's for identical results.
# ---------------------------------------------------------------------------

# Default zone numbering: internal zones 1..5999, external 6000..8886, roaming id 8888.
DEFAULT_INTERNAL_RANGES = ((1, 5999),)
DEFAULT_EXTERNAL_RANGES = ((6000, 8886),)
ROAMING_ZONE_ID = 8888

# Age bands, both ends inclusive, and their control-column names.
AGE_BINS = ((0, 4), (5, 10), (11, 15), (16, 25), (26, 35), (36, 45), (46, 55), (56, 64), (65, 200))

# Planning-district groups of the sample configuration (inclusive ends, shared ends allowed).
DEFAULT_PD_GROUPS = ((1, 12), (12, 24), (24, 36), (36, 10000))

# Category maps of the sample configuration (letter -> code).
DEFAULT_PERSON_CATEGORY_MAP = {
    "Occupation": {"G": 1, "S": 2, "M": 3, "P": 4, "O": 5},
    "EmploymentStatus": {"O": 1, "F": 2, "P": 3, "J": 4, "H": 5},
}

# Invalid codes that get re-drawn from weighted shares.
INVALID_OCCUPATION = "9"
INVALID_EMPLOYMENT_STATUS = "9"
INVALID_STUDENT_STATUS = "9"
INVALID_INCOME_CLASS = 7

# Control-table column order (MAZ; TAZ drops "maz"; meta keeps META_MEASURES).
CONTROL_KEYS_MAZ = ("region", "puma", "taz", "maz")
CONTROL_KEYS_TAZ = ("region", "puma", "taz")
AGE_COLUMNS = tuple(f"age{lo}_{hi}" for lo, hi in AGE_BINS)
CONTROL_MEASURES = (
    ("totalhh", "totpop", "S_O", "S_S", "S_P", "license_Y", "license_N",
     "E_O", "E_F", "E_P", "E_J", "E_H", "P", "G", "S", "M", "O")
    + AGE_COLUMNS
    + ("hhsize1", "hhsize2", "hhsize3", "hhsize4p",
       "income_class_1", "income_class_2", "income_class_3",
       "income_class_4", "income_class_5", "income_class_6",
       "male", "female",
       "employment_zone_internal", "employment_zone_external",
       "employment_zone_roaming", "employment_zone_0")
)
META_MEASURES = (
    ("totalhh", "totpop", "S_O", "S_S", "S_P", "P", "G", "S", "M", "O")
    + AGE_COLUMNS
    + ("E_O", "E_F", "E_P", "E_J", "E_H",
       "income_class_1", "income_class_2", "income_class_3",
       "income_class_4", "income_class_5", "income_class_6",
       "male", "female",
       "employment_zone_internal", "employment_zone_external",
       "employment_zone_roaming", "employment_zone_0")
)
HOUSEHOLD_MEASURES = ("totalhh", "hhsize1", "hhsize2", "hhsize3", "hhsize4p",
                      "income_class_1", "income_class_2", "income_class_3",
                      "income_class_4", "income_class_5", "income_class_6")
PERSON_MEASURES = tuple(c for c in CONTROL_MEASURES if c not in HOUSEHOLD_MEASURES)

# Zone given to zones that are new to the controls in a forecast.
NEW_ZONE_REGION = 1
NEW_ZONE_PUMA = 3

# Synthesizer settings: weight cap.
MAX_EXPANSION_FACTOR = 320.0


@dataclass(frozen=True)
class ZoneRanges:
    """A zone set given as inclusive ``(lo, hi)`` pairs; never materialised as ids."""

    ranges: tuple[tuple[int, int], ...]

    @classmethod
    def of(cls, pairs: Sequence[Sequence[int]]) -> "ZoneRanges":
        return cls(tuple((int(lo), int(hi)) for lo, hi in pairs))


@dataclass(frozen=True)
class RunConfig:
    internal: ZoneRanges = ZoneRanges(DEFAULT_INTERNAL_RANGES)
    external: ZoneRanges = ZoneRanges(DEFAULT_EXTERNAL_RANGES)
    roaming_zone: int = ROAMING_ZONE_ID
    pd_groups: tuple[tuple[int, int], ...] = DEFAULT_PD_GROUPS
    person_category_map: Mapping[str, Mapping[str, int]] = field(
        default_factory=lambda: DEFAULT_PERSON_CATEGORY_MAP)
    drop_control_columns: tuple[str, ...] = ()
    person_control_columns: tuple[str, ...] = ("totpop",)
    household_control_columns: tuple[str, ...] = ("totalhh",)
    input_sample: float = 1.0
    percent_population: float = 1.0
    max_expansion_factor: float = MAX_EXPANSION_FACTOR
    balance_iterations: int = 100

    @classmethod
    def from_json(cls, d: Mapping) -> "RunConfig":
        """Build from the JSON keys of the original configuration file."""
        kw: dict = {}
        if "ZoneRanges" in d:
            kw["internal"] = ZoneRanges.of(d["ZoneRanges"])
        if "ExternalZoneRanges" in d:
            kw["external"] = ZoneRanges.of(d["ExternalZoneRanges"])
        if "PdGroups" in d:
            kw["pd_groups"] = tuple((int(a), int(b)) for a, b in d["PdGroups"])
        if "CategoryMapping" in d:
            kw["person_category_map"] = dict(d["CategoryMapping"].get("Persons", {}))
        if d.get("DropControlColumns"):
            kw["drop_control_columns"] = tuple(d["DropControlColumns"])
        if d.get("PersonControlColumns"):
            kw["person_control_columns"] = tuple(d["PersonControlColumns"])
        if d.get("HouseholdControlColumns"):
            kw["household_control_columns"] = tuple(d["HouseholdControlColumns"])
        if "InputSample" in d:
            kw["input_sample"] = float(d["InputSample"])
        return cls(**kw)
