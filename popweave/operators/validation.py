"""Observed-vs-synthesized validation (JN8, JN9, JN13, AG20-AG23, PRJ16, PRJ17, PL4).

Each side is reduced by ONE global aggregate holding every labelled conditional sum
(partial sums per task, a single tiny exchange), then unpivoted into
``(label, value)`` rows; the two sides join on the label (a few dozen rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popweave.config import AGE_BINS, RunConfig
from popweave.functions.sizing import broadcast_if_bounded
from popweave.functions.zones import employment_zone_type, in_ranges
from popweave.operators.seeds import filter_positive_pd


def validation_join(persons: DataFrame, households: DataFrame, zones: DataFrame,
                    cfg: RunConfig) -> DataFrame:
    """persons x households x zones (zones broadcast; a dimension), ``pd > 0`` and home
    zone internal (JN8, PRJ16, PRJ14). The person weight keeps ``expansion_factor``."""
    h = households.withColumnRenamed("expansion_factor", "household_expansion")
    z = broadcast_if_bounded(zones.select(F.col("zone").alias("household_zone"), "pd"))
    j = persons.join(h, "household_id", "inner").join(z, "household_zone", "inner")
    return filter_positive_pd(j).filter(in_ranges("household_zone", cfg.internal))


def person_labels(cfg: RunConfig) -> list[tuple[str, Column]]:
    """The 28 person rows in report order: label and predicate."""
    ez = F.col("employment_zone")
    rows: list[tuple[str, Column]] = [("Population", F.lit(True)),
                                      ("Male", F.col("sex") == "M"),
                                      ("Female", F.col("sex") == "F")]
    rows += [(f"Occupation {v}", F.col("occupation") == v) for v in "PGSMO"]
    rows += [(f"EmploymentStatus {v}", F.col("employment_status") == v) for v in "FPOHJ"]
    rows += [("EmploymentZone Internal", in_ranges(ez, cfg.internal)),
             ("EmploymentZone Roaming", ez == cfg.roaming_zone),
             # the roaming id is *not* excluded here, unlike in the controls (D11)
             ("EmploymentZone External", in_ranges(ez, cfg.external))]
    rows += [(f"StudentStatus {v}", F.col("student_status") == v) for v in "SPO"]
    rows += [(f"Age {lo} - {hi}", F.col("age").between(lo, hi)) for lo, hi in AGE_BINS]
    return rows


def household_labels() -> list[tuple[str, Column]]:
    """The 12 household rows: total, income classes 1-7, sizes 1, 2, 3, 4+."""
    rows: list[tuple[str, Column]] = [("Total Households", F.lit(True))]
    rows += [(f"Income Class {k}", F.col("income_class") == k) for k in range(1, 8)]
    rows += [(f"Number of Persons {k}", F.col("number_of_persons") == k) for k in (1, 2, 3)]
    rows.append(("Number of Persons 4+", F.col("number_of_persons") >= 4))
    return rows


def labelled_totals(df: DataFrame, labels: list[tuple[str, Column]], weight: str,
                    value_name: str) -> DataFrame:
    """One aggregate pass -> ``(ordinal, label, value_name)`` rows (double, 0 when nothing matches)."""
    aggs = [F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("double").alias(f"_v{i}")
            for i, (_, cond) in enumerate(labels)]
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("label"), F.col(f"_v{i}").alias(value_name))
                      for i, (name, _) in enumerate(labels)])
    return wide.select(F.inline(pairs))


def compare_totals(observed: DataFrame, synthesized: DataFrame,
                   labels: list[tuple[str, Column]], weight: str = "expansion_factor",
                   ordinal: bool = False) -> DataFrame:
    """``label, observed_total, synthesized_total, abs_difference`` where the difference
    is observed - synthesized, signed (D10). ``ordinal`` keeps the row's place in the report, which
    is carried from the label list through unpivot and join (SNK7)."""
    o = labelled_totals(observed, labels, weight, "observed_total")
    s = labelled_totals(synthesized, labels, weight, "synthesized_total")
    both = (o.join(s, ["ordinal", "label"], "inner")
            .withColumn("abs_difference", F.col("observed_total") - F.col("synthesized_total")))
    return both if ordinal else both.drop("ordinal")


def validation_persons(obs_joined: DataFrame, syn_joined: DataFrame, cfg: RunConfig,
                       ordinal: bool = False) -> DataFrame:
    """AG20 over two :func:`validation_join` results."""
    return compare_totals(obs_joined, syn_joined, person_labels(cfg), ordinal=ordinal)


def validation_households(obs_households: DataFrame, syn_households: DataFrame,
                          cfg: RunConfig, ordinal: bool = False) -> DataFrame:
    """AG21: households filtered to internal zones only (no PD filter, as surveyed)."""
    o = obs_households.filter(in_ranges("household_zone", cfg.internal))
    s = syn_households.filter(in_ranges("household_zone", cfg.internal))
    return compare_totals(o, s, household_labels(), ordinal=ordinal)


CROSSTAB_OCCUPATIONS = ("P", "G", "S", "M", "O")
CROSSTAB_STATUSES = ("F", "P", "O", "J", "H")


def occupation_zone_crosstab(obs_joined: DataFrame, syn_joined: DataFrame,
                             cfg: RunConfig) -> DataFrame:
    """PD x occupation x status x employment-zone type, observed vs synthesized, full
    outer, missing -> 0, ``delta`` = synthesized - observed, PD 1..59 (AG22, PRJ17)."""
    keys = ["pd", "occupation", "employment_status", "employment_zone_type"]

    def side(df: DataFrame, name: str) -> DataFrame:
        t = df.withColumn("employment_zone_type",
                          employment_zone_type("employment_zone", cfg.internal, cfg.roaming_zone))
        return t.groupBy(*keys).agg(F.sum("expansion_factor").cast("double").alias(name))

    j = side(obs_joined, "total_input").join(side(syn_joined, "total_synthesized"), keys, "full_outer")
    j = j.na.fill(0.0, ["total_input", "total_synthesized"])
    j = j.withColumn("delta", F.col("total_synthesized") - F.col("total_input"))
    return j.filter(F.col("pd").between(1, 59)
                    & F.col("occupation").isin(*CROSSTAB_OCCUPATIONS)
                    & F.col("employment_status").isin(*CROSSTAB_STATUSES))


def pd_compare(controls_maz: DataFrame, control_col: str, households: DataFrame,
               predicate: Column, zones: DataFrame) -> DataFrame:
    """Per PD: a control column summed over zones vs the synthesized households meeting
    ``predicate`` (AG23, JN9, JN13). Outer on PD; a PD missing on one side stays null."""
    z = broadcast_if_bounded(zones.select("zone", "pd"))
    c = (controls_maz.join(z, controls_maz["taz"] == z["zone"], "inner")
         .groupBy("pd").agg(F.sum(control_col).cast("double").alias("control")))
    h = (households.filter(predicate)
         .join(z, households["household_zone"] == z["zone"], "inner")
         .groupBy("pd").agg(F.sum("expansion_factor").cast("double").alias("synthesized")))
    return c.join(h, "pd", "full_outer")
