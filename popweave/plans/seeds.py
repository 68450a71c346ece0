"""Seed preparation pipeline (PL1): zones -> join -> puma -> impute -> join -> filter ->
controls -> sample -> re-code -> processed seeds.

Each step is a DataFrame transformation. The person-household join is the only fact-fact
shuffle and runs once: ``prepare`` writes its rows as a table under the checkpoint folder,
which every later step scans with its own columns only.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popweave.config import (INVALID_EMPLOYMENT_STATUS, INVALID_INCOME_CLASS,
                             INVALID_OCCUPATION, INVALID_STUDENT_STATUS, RunConfig)
from popweave.functions.recode import recode
from popweave.functions.sizing import broadcast_if_bounded
from popweave.operators.controls import raw_zone_controls
from popweave.operators.impute import ImputeSpec, resample_invalid
from popweave.operators.sampling import sample_households
from popweave.operators.seeds import (filter_internal, households_with_zone,
                                      persons_households, zone_map)
from popweave.session import materialize

PERSON_KEY = ("household_id", "person_number")
PERSON_ATTRIBUTES = ("age", "sex", "license", "transit_pass", "employment_status", "occupation",
                     "free_parking", "student_status", "employment_zone", "school_zone")

HOUSEHOLD_IMPUTE = (ImputeSpec("income_class", INVALID_INCOME_CLASS),)
PERSON_IMPUTE = (ImputeSpec("occupation", INVALID_OCCUPATION),
                 ImputeSpec("employment_status", INVALID_EMPLOYMENT_STATUS),
                 ImputeSpec("student_status", INVALID_STUDENT_STATUS))


@dataclass
class PreparedSeeds:
    zone_map: DataFrame           # zone, pd, puma
    households: DataFrame         # internal households with pd, puma, imputed income
    persons_households: DataFrame  # internal persons joined to households, imputed


def prepare(zones: DataFrame, households: DataFrame, persons: DataFrame,
            cfg: RunConfig, unread: Sequence[str] = ()) -> PreparedSeeds:
    """Geography, imputation and internal filter, in the surveyed order. The joined table is written
    without the columns ``unread``, which the caller never reads.

    Imputation shares are taken before the internal-zone filter (over every zone the
    zone map knows), exactly as the filter follows the imputation there.
    """
    zmap = broadcast_if_bounded(zone_map(zones, cfg))
    # Each imputation reads its input twice: the shares need the group, the codes and the
    # weight only, so that pass is pruned to them; caching both fact frames for it would
    # put a second copy of all their columns on the executors' disks.
    hz0 = households_with_zone(households, zmap)
    hz = resample_invalid(hz0, HOUSEHOLD_IMPUTE, "expansion_factor", ["household_id"])
    # The one fact join of a run: its rows are written once; shares, draws, controls, seeds and
    # incidence all read that table.
    ph0 = materialize(persons_households(persons, hz).drop(*unread), "persons-households")
    ph = resample_invalid(ph0, PERSON_IMPUTE, "expansion_factor", list(PERSON_KEY))
    return PreparedSeeds(zmap,
                         filter_internal(hz, "household_zone", cfg),
                         filter_internal(ph, "household_zone", cfg))


def raw_controls(seeds: PreparedSeeds, cfg: RunConfig) -> DataFrame:
    return raw_zone_controls(seeds.households, seeds.persons_households, seeds.zone_map, cfg)


def sampled(seeds: PreparedSeeds, cfg: RunConfig, method: str = "threshold") -> DataFrame:
    return sample_households(seeds.persons_households, cfg.input_sample, PERSON_KEY,
                             "puma", method)


def processed_households(persons_hh: DataFrame) -> DataFrame:
    """One row per household present among the (sampled) persons, weight rounded to 5
    places. Households without persons are absent here but counted in ``totalhh`` (D15).

    The aggregate combines map-side, so a household's rows meet as one."""
    # the smallest whole row of an id, so that rows under one id never mix
    row = F.min(F.struct("puma", "dwelling_type", "number_of_persons", "vehicles", "income_class",
                         F.col("household_weight").alias("weight"))).alias("r")
    g = persons_hh.groupBy("household_id").agg(row).select("household_id", "r.*")
    return g.select("household_id", F.col("puma").cast("int").alias("puma"), "dwelling_type",
                    "number_of_persons", "vehicles", "income_class",
                    F.round("weight", 5).cast("double").alias("weight"))


def processed_persons(persons_hh: DataFrame, cfg: RunConfig) -> DataFrame:
    """Person seed for the synthesizer: categories re-coded by the configured maps
    (unmapped -> null), ``weight`` unrounded and ``weightp`` rounded to 5 places (D16). Attributes left
    unread by ``prepare`` are absent."""
    p = recode(persons_hh, {c: m for c, m in _person_maps(cfg).items()})
    return p.select("household_id", "person_number", F.col("puma").cast("int").alias("puma"),
                    *[c for c in PERSON_ATTRIBUTES if c in p.columns],
                    F.col("expansion_factor").cast("double").alias("weight"),
                    F.round("expansion_factor", 5).cast("double").alias("weightp"))


def _person_maps(cfg: RunConfig) -> dict:
    names = {"Occupation": "occupation", "EmploymentStatus": "employment_status",
             "StudentStatus": "student_status"}
    return {names.get(k, k): v for k, v in cfg.person_category_map.items()}
