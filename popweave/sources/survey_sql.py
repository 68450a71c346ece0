"""DuckDB twins of the survey views and of the seed preparation, as SQL CTE text.

Used only by the oracle check (``__spark_entry__.oracle_sql``): the same rules as
``survey_views`` and the same keyed draws, written as plain SQL over the test tables.
The test configuration (internal 1..20, external 21..25, roaming 25, PD groups
[1,2],[2,4],[4,5]) is spelled out literally.
"""

from __future__ import annotations

from popweave.config import AGE_BINS, AGE_COLUMNS, DEFAULT_PERSON_CATEGORY_MAP
from popweave.functions.draws import keyed_uniform_sql

INTERNAL = "BETWEEN 1 AND 20"
EXTERNAL = "BETWEEN 21 AND 25"
ROAMING = 25

VIEWS = """
zones AS (
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS zone, CAST(n_regionkey + 1 AS INTEGER) AS pd FROM nation),
zmap AS (
  SELECT zone, pd,
         CASE WHEN pd BETWEEN 4 AND 5 THEN 3 WHEN pd BETWEEN 2 AND 4 THEN 2
              WHEN pd BETWEEN 1 AND 2 THEN 1 ELSE 0 END AS puma
  FROM zones),
hh AS (
  SELECT o_orderkey AS household_id,
         CAST(c_nationkey + 1 AS INTEGER) AS household_zone,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 ELSE 0 END AS INTEGER)
           AS dwelling_type,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS number_of_persons,
         CAST(o_custkey % 4 AS INTEGER) AS vehicles,
         CAST(o_orderkey % 7 + 1 AS INTEGER) AS income_class,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 10000 AS DECIMAL(18,6)) AS expansion_factor
  FROM orders JOIN customer ON o_custkey = c_custkey),
ps AS (
  SELECT l_orderkey AS household_id,
         CAST(l_linenumber AS INTEGER) AS person_number,
         CAST(l_quantity * 2 AS INTEGER) AS age,
         CASE WHEN l_linestatus = 'O' THEN 'M' ELSE 'F' END AS sex,
         CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS license,
         CASE WHEN l_tax >= 0.04 THEN 'Y' ELSE 'N' END AS transit_pass,
         ['F','P','O','J','H','9'][CAST(l_suppkey % 6 AS INTEGER) + 1] AS employment_status,
         ['P','G','S','M','O','9'][CAST(l_partkey % 6 AS INTEGER) + 1] AS occupation,
         CASE WHEN l_partkey % 2 = 0 THEN 'Y' ELSE 'N' END AS free_parking,
         ['S','P','O','9'][CAST((l_orderkey + l_linenumber) % 4 AS INTEGER) + 1] AS student_status,
         CAST(l_suppkey % 27 AS INTEGER) AS employment_zone,
         CAST(l_partkey % 21 AS INTEGER) AS school_zone,
         CAST(1 + CAST(l_discount AS DECIMAL(18,2)) * 10 AS DECIMAL(18,6)) AS expansion_factor
  FROM lineitem)"""


def _bounds(name: str, src: str, col: str, invalid: str, weight: str) -> str:
    return f"""
{name} AS (
  SELECT puma, v,
         CAST(SUM(w) OVER (PARTITION BY puma ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS DOUBLE) / CAST(SUM(w) OVER (PARTITION BY puma) AS DOUBLE) AS hi
  FROM (SELECT puma, {col} AS v, SUM({weight}) AS w FROM {src}
        WHERE {col} IS NOT NULL AND {col} <> {invalid} GROUP BY 1, 2) t)"""


def _draw(col: str, invalid: str, bounds: str, src: str, key: tuple[str, ...]) -> str:
    u = keyed_uniform_sql(col, *[f"{src}.{k}" for k in key])
    return (f"CASE WHEN {col} = {invalid} THEN COALESCE((SELECT min(b.v) FROM {bounds} b "
            f"WHERE b.puma = {src}.puma AND b.hi > {u}), {col}) ELSE {col} END AS {col}")


SEEDS = VIEWS + """,
hz0 AS (SELECT h.*, z.pd, z.puma FROM hh h JOIN zmap z ON h.household_zone = z.zone),""" \
    + _bounds("inc_b", "hz0", "income_class", "7", "expansion_factor") + f""",
hz AS (SELECT * REPLACE ({_draw("income_class", "7", "inc_b", "hz0", ("household_id",))}) FROM hz0),
ph0 AS (SELECT p.*, h.household_zone, h.dwelling_type, h.number_of_persons, h.vehicles,
               h.income_class, h.expansion_factor AS household_weight, h.pd, h.puma
        FROM ps p JOIN hz h ON p.household_id = h.household_id),""" \
    + _bounds("occ_b", "ph0", "occupation", "'9'", "expansion_factor") + "," \
    + _bounds("emp_b", "ph0", "employment_status", "'9'", "expansion_factor") + "," \
    + _bounds("stu_b", "ph0", "student_status", "'9'", "expansion_factor") + f""",
ph_all AS (SELECT * REPLACE (
    {_draw("occupation", "'9'", "occ_b", "ph0", ("household_id", "person_number"))},
    {_draw("employment_status", "'9'", "emp_b", "ph0", ("household_id", "person_number"))},
    {_draw("student_status", "'9'", "stu_b", "ph0", ("household_id", "person_number"))})
  FROM ph0),
hzi AS (SELECT * FROM hz WHERE household_zone {INTERNAL}),
phi AS (SELECT * FROM ph_all WHERE household_zone {INTERNAL})"""


def _s(cond: str, w: str = "expansion_factor") -> str:
    return f"SUM(CASE WHEN {cond} THEN {w} END)"


def _q(v: str) -> str:
    return f"'{v}'"


HH_MEASURES = ",\n".join(
    ["SUM(expansion_factor) AS totalhh"]
    + [f"{_s(f'income_class = {k}')} AS income_class_{k}" for k in range(1, 7)]
    + [f"{_s(f'number_of_persons = {k}')} AS hhsize{k}" for k in (1, 2, 3)]
    + [f"{_s('number_of_persons >= 4')} AS hhsize4p"]
)

PERSON_MEASURES = ",\n".join(
    ["SUM(expansion_factor) AS totpop",
     f"{_s('sex = ' + _q('M'))} AS male",
     f"{_s('sex = ' + _q('F'))} AS female",
     f"{_s(f'employment_zone {INTERNAL}')} AS employment_zone_internal",
     f"{_s(f'employment_zone = {ROAMING}')} AS employment_zone_roaming",
     f"{_s(f'employment_zone {EXTERNAL} AND employment_zone <> {ROAMING}')} AS employment_zone_external",
     f"{_s('employment_zone = 0')} AS employment_zone_0"]
    + [f"{_s(f'age BETWEEN {lo} AND {hi}')} AS {name}" for (lo, hi), name in zip(AGE_BINS, AGE_COLUMNS)]
    + [f"{_s('employment_status = ' + _q(v))} AS E_{v}" for v in "JPFOH"]
    + [f"{_s('occupation = ' + _q(v))} AS {v}" for v in "PGSMO"]
    + [f"{_s('license = ' + _q(v))} AS license_{v}" for v in "YN"]
    + [f"{_s('student_status = ' + _q(v))} AS S_{v}" for v in "OSP"]
)


def with_seeds(body: str) -> str:
    """Seed CTEs followed by ``body`` (more CTEs and a SELECT, or just a SELECT)."""
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return "WITH " + SEEDS + sep + body


def _code_case(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


OCC_CODE = _code_case("occupation", DEFAULT_PERSON_CATEGORY_MAP["Occupation"])
EMP_CODE = _code_case("employment_status", DEFAULT_PERSON_CATEGORY_MAP["EmploymentStatus"])

PERSON_REST = ("age", "sex", "license", "transit_pass", "employment_status", "occupation",
               "free_parking", "student_status", "employment_zone", "school_zone", "expansion_factor")

SEED_HOUSEHOLDS_FROM = """SELECT DISTINCT household_id, CAST(puma AS INTEGER) AS puma, dwelling_type,
  number_of_persons, vehicles, income_class, CAST(round(household_weight, 5) AS DOUBLE) AS weight
FROM {src}"""

SEED_PERSONS_SQL = f"""SELECT household_id, person_number, CAST(puma AS INTEGER) AS puma, age, sex, license,
  transit_pass, {EMP_CODE} AS employment_status, {OCC_CODE} AS occupation, free_parking,
  student_status, employment_zone, school_zone, CAST(expansion_factor AS DOUBLE) AS weight,
  CAST(round(expansion_factor, 5) AS DOUBLE) AS weightp
FROM phi"""

SHARES_SQL = """
long AS (""" + "\n  UNION ALL ".join(
    f"SELECT puma, '{c}' AS col, {c} AS value, expansion_factor FROM ph0 "
    f"WHERE {c} IS NOT NULL AND {c} <> '9'"
    for c in ("occupation", "employment_status", "student_status")) + """),
sums AS (SELECT puma, col, value, SUM(expansion_factor) AS w FROM long GROUP BY 1, 2, 3),
cw AS (SELECT *, SUM(w) OVER (PARTITION BY puma, col ORDER BY value
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
              SUM(w) OVER (PARTITION BY puma, col) AS tot FROM sums)
SELECT puma, col AS "column", value, CAST(w AS DOUBLE) AS weight,
       CAST(w AS DOUBLE) / CAST(tot AS DOUBLE) AS share,
       CAST(cum - w AS DOUBLE) / CAST(tot AS DOUBLE) AS lower,
       CAST(cum AS DOUBLE) / CAST(tot AS DOUBLE) AS upper
FROM cw"""


def sample_threshold_sql(frac: float) -> str:
    u = keyed_uniform_sql("sample", "household_id", "person_number")
    src = "(SELECT * FROM phi WHERE household_id IN (SELECT household_id FROM ids)) s"
    return (f"ids AS (SELECT DISTINCT household_id FROM phi WHERE {u} < {frac})\n"
            + SEED_HOUSEHOLDS_FROM.format(src=src))


def sample_exact_sql(frac: float) -> str:
    u = keyed_uniform_sql("sample", "household_id", "person_number")
    src = "(SELECT * FROM phi WHERE household_id IN (SELECT household_id FROM ids)) s"
    return f"""r AS (SELECT household_id,
              row_number() OVER (PARTITION BY puma ORDER BY u, household_id, person_number) AS rn,
              COUNT(*) OVER (PARTITION BY puma) AS n
       FROM (SELECT *, {u} AS u FROM phi) t),
ids AS (SELECT DISTINCT household_id FROM r WHERE rn <= round_even(n * {frac}, 0))
""" + SEED_HOUSEHOLDS_FROM.format(src=src)


def raw_controls_cte(measures: tuple[str, ...]) -> str:
    """``raw`` CTE: untruncated per-zone measures on the internal spine, nulls -> 0."""
    cols = ", ".join(f"COALESCE({m}, 0) AS {m}" for m in measures)
    return f"""
hh_agg AS (SELECT household_zone AS zone, {HH_MEASURES} FROM hzi GROUP BY 1),
p_agg AS (SELECT household_zone AS zone, {PERSON_MEASURES} FROM phi GROUP BY 1),
raw AS (SELECT 1 AS region, CAST(z.puma AS INTEGER) AS puma, z.zone AS taz, z.zone AS maz, {cols}
        FROM zmap z LEFT JOIN hh_agg USING (zone) LEFT JOIN p_agg USING (zone)
        WHERE z.zone {INTERNAL})"""


# --- forecast twins --------------------------------------------------------------------

def _puma_case(pd_col: str, otherwise: str) -> str:
    return (f"CASE WHEN {pd_col} BETWEEN 4 AND 5 THEN 3 WHEN {pd_col} BETWEEN 2 AND 4 THEN 2 "
            f"WHEN {pd_col} BETWEEN 1 AND 2 THEN 1 ELSE {otherwise} END")


VECTOR = """vec AS (SELECT zone, CASE WHEN zone % 6 = 0 THEN 0.0 ELSE CAST(zone AS DOUBLE) * 1000.0 END
                AS population FROM zones)"""


def forecast_ctes(measures: tuple[str, ...], person: tuple[str, ...], household: tuple[str, ...],
                  zero_zone: int = 5) -> str:
    """CTEs ``cm`` (base MAZ controls with ``zero_zone`` zeroed), ``fo`` (outer join with the
    vector), ``cls``, ``rat`` (t1 ratios by original puma), ``lastr`` and ``fc`` (unceiled
    forecast values of the control columns)."""
    controls = [c for c in person if c in measures] + \
        [c for c in household if c in measures and c not in person]
    trunc = ", ".join(f"CASE WHEN maz = {zero_zone} THEN 0 ELSE CAST(trunc({m}) AS BIGINT) END AS {m}"
                      for m in measures)
    fill = ", ".join(f"COALESCE(mm.{m}, 0) AS {m}" for m in measures)
    rat = ", ".join(f"CAST(SUM({c}) AS DOUBLE) / CAST(SUM(totpop) AS DOUBLE) AS {c}" for c in controls)
    newtot = "CASE WHEN lastr.p0 IS NOT NULL THEN cls.new ELSE cls.totpop END" \
        if "totpop" in person else "cls.totpop"

    def val(c: str) -> str:
        t2 = newtot if c == "totpop" else \
            f"CASE WHEN lastr.p0 IS NOT NULL THEN lastr.{c} * ({newtot}) ELSE cls.{c} END"
        return (f"CASE cls.cls WHEN 't1' THEN cls.{c} * (cls.new / cls.totpop) WHEN 't2' THEN {t2} "
                f"WHEN 't3' THEN 0.0 ELSE CAST(cls.{c} AS DOUBLE) END AS {c}")

    return f"""
cm AS (SELECT region, puma, taz, maz, {trunc} FROM raw),
{VECTOR},
mm AS (SELECT c.* REPLACE ({_puma_case("z.pd", "c.puma")} AS puma) FROM cm c JOIN zones z ON c.maz = z.zone),
fo AS (SELECT CASE WHEN COALESCE(mm.region, 0) = 0 THEN 1 ELSE mm.region END AS region,
              CASE WHEN COALESCE(mm.puma, 0) = 0 THEN 3 ELSE mm.puma END AS puma,
              mm.puma AS p0, COALESCE(mm.maz, vec.zone) AS k, {fill},
              COALESCE(vec.population, 0.0) AS new
       FROM mm FULL OUTER JOIN vec ON mm.maz = vec.zone),
cls AS (SELECT *, CASE WHEN totpop > 0 AND new > 0 THEN 't1' WHEN totpop = 0 AND new > 0 THEN 't2'
                       WHEN new = 0 THEN 't3' END AS cls FROM fo),
rat AS (SELECT p0, {rat} FROM cls WHERE cls = 't1' GROUP BY p0),
lastr AS (SELECT * FROM rat WHERE p0 <> 0 ORDER BY p0 DESC LIMIT 1),
fc AS (SELECT cls.region, cls.puma, cls.k, {", ".join(val(c) for c in controls)}
       FROM cls LEFT JOIN lastr ON TRUE)"""


def forecast_controls(measures, person, household) -> list[str]:
    return [c for c in person if c in measures] + \
        [c for c in household if c in measures and c not in person]


# --- synthetic population and outputs --------------------------------------------------

def _inverse_case(col: str, mapping: dict) -> str:
    inv: dict = {}
    for label, code in mapping.items():
        inv[code] = label
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in inv.items())
    return f"CASE {col} {whens} END"


SYNTHETIC = f"""
syn_hh AS (SELECT household_id AS temp_id, household_zone AS maz,
                  CAST(floor(expansion_factor) * 2 AS INTEGER) AS finalweight,
                  dwelling_type, number_of_persons, vehicles, income_class
           FROM hh),
syn_p AS (SELECT p.household_id AS temp_id, p.person_number, p.age, p.sex, p.license, p.transit_pass,
                 {_code_case("p.employment_status", DEFAULT_PERSON_CATEGORY_MAP["EmploymentStatus"])}
                   AS employment_status,
                 {_code_case("p.occupation", DEFAULT_PERSON_CATEGORY_MAP["Occupation"])} AS occupation,
                 p.free_parking, p.student_status, p.employment_zone, h.finalweight
          FROM ps p JOIN syn_hh h ON p.household_id = h.temp_id),
tr_p AS (SELECT CAST(temp_id AS BIGINT) AS household_id, CAST(person_number AS INTEGER) AS person_number,
                TRY_CAST(age AS SMALLINT) AS age, sex, license, transit_pass,
                TRY_CAST(employment_status AS SMALLINT) AS employment_status,
                TRY_CAST(occupation AS SMALLINT) AS occupation, free_parking, student_status,
                TRY_CAST(employment_zone AS INTEGER) AS employment_zone,
                CAST(0 AS INTEGER) AS school_zone, TRY_CAST(finalweight AS INTEGER) AS expansion_factor
         FROM syn_p),
tr_h AS (SELECT CAST(temp_id AS BIGINT) AS household_id, TRY_CAST(maz AS INTEGER) AS household_zone,
                TRY_CAST(finalweight AS INTEGER) AS expansion_factor,
                TRY_CAST(number_of_persons AS TINYINT) AS number_of_persons,
                TRY_CAST(dwelling_type AS TINYINT) AS dwelling_type,
                TRY_CAST(vehicles AS TINYINT) AS vehicles, TRY_CAST(income_class AS TINYINT) AS income_class
         FROM syn_hh),
out_p AS (SELECT * REPLACE (
            {_inverse_case("employment_status", DEFAULT_PERSON_CATEGORY_MAP["EmploymentStatus"])}
              AS employment_status,
            {_inverse_case("occupation", DEFAULT_PERSON_CATEGORY_MAP["Occupation"])} AS occupation,
            CAST(expansion_factor AS DOUBLE) * CAST(2.0 AS DOUBLE) AS expansion_factor)
          FROM tr_p),
out_h AS (SELECT * REPLACE (CAST(expansion_factor AS DOUBLE) * CAST(2.0 AS DOUBLE) AS expansion_factor)
          FROM tr_h),
sj AS (SELECT p.* RENAME (expansion_factor AS persons), h.household_zone,
              h.expansion_factor AS household_expansion, h.number_of_persons, h.dwelling_type,
              h.vehicles, h.income_class
       FROM out_p p JOIN out_h h ON p.household_id = h.household_id)"""


def with_outputs(body: str) -> str:
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return "WITH " + VIEWS + "," + SYNTHETIC + sep + body


def _label_sums(labels: list[tuple[str, str]], src: str, weight: str, name: str) -> str:
    cols = ", ".join(f"CAST(COALESCE(SUM(CASE WHEN {cond} THEN {weight} END), 0) AS DOUBLE) AS v{i}"
                     for i, (_, cond) in enumerate(labels))
    unp = " UNION ALL ".join(f"SELECT '{lab}' AS label, v{i} AS {name} FROM w_{name}"
                             for i, (lab, _) in enumerate(labels))
    return f"w_{name} AS (SELECT {cols} FROM {src}),\nl_{name} AS ({unp})"


PERSON_LABELS = (
    [("Population", "TRUE"), ("Male", "sex = 'M'"), ("Female", "sex = 'F'")]
    + [(f"Occupation {v}", f"occupation = '{v}'") for v in "PGSMO"]
    + [(f"EmploymentStatus {v}", f"employment_status = '{v}'") for v in "FPOHJ"]
    + [("EmploymentZone Internal", f"employment_zone {INTERNAL}"),
       ("EmploymentZone Roaming", f"employment_zone = {ROAMING}"),
       ("EmploymentZone External", f"employment_zone {EXTERNAL}")]
    + [(f"StudentStatus {v}", f"student_status = '{v}'") for v in "SPO"]
    + [(f"Age {lo} - {hi}", f"age BETWEEN {lo} AND {hi}") for lo, hi in AGE_BINS]
)
HOUSEHOLD_LABELS = (
    [("Total Households", "TRUE")]
    + [(f"Income Class {k}", f"income_class = {k}") for k in range(1, 8)]
    + [(f"Number of Persons {k}", f"number_of_persons = {k}") for k in (1, 2, 3)]
    + [("Number of Persons 4+", "number_of_persons >= 4")]
)

VALIDATION_JOINS = f"""
obs AS (SELECT p.*, h.household_zone, h.expansion_factor AS household_expansion, h.income_class,
               h.number_of_persons, z.pd
        FROM ps p JOIN hh h ON p.household_id = h.household_id
        JOIN zones z ON h.household_zone = z.zone
        WHERE z.pd > 0 AND h.household_zone {INTERNAL}),
syn AS (SELECT p.*, h.household_zone, h.expansion_factor AS household_expansion, h.income_class,
               h.number_of_persons, z.pd
        FROM out_p p JOIN out_h h ON p.household_id = h.household_id
        JOIN zones z ON h.household_zone = z.zone
        WHERE z.pd > 0 AND h.household_zone {INTERNAL})"""


def compare_sql(labels, obs_src: str, syn_src: str) -> str:
    return (_label_sums(labels, obs_src, "expansion_factor", "observed_total") + ",\n"
            + _label_sums(labels, syn_src, "expansion_factor", "synthesized_total") + """
SELECT o.label, o.observed_total, s.synthesized_total, o.observed_total - s.synthesized_total AS abs_difference
FROM l_observed_total o JOIN l_synthesized_total s ON o.label = s.label""")
