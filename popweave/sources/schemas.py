"""Explicit schemas: nothing is inferred.

Seed files keep their original CamelCase headers on disk; readers rename them to the
snake_case names every operator uses (``SEED_PERSON_RENAMES`` / ``SEED_HOUSEHOLD_RENAMES``).
"""

from __future__ import annotations

from pyspark.sql import types as T

PERSON_SEED = T.StructType([
    T.StructField("HouseholdId", T.LongType()),
    T.StructField("PersonNumber", T.IntegerType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Sex", T.StringType()),
    T.StructField("License", T.StringType()),
    T.StructField("TransitPass", T.StringType()),
    T.StructField("EmploymentStatus", T.StringType()),
    T.StructField("Occupation", T.StringType()),
    T.StructField("FreeParking", T.StringType()),
    T.StructField("StudentStatus", T.StringType()),
    T.StructField("EmploymentZone", T.IntegerType()),
    T.StructField("SchoolZone", T.IntegerType()),
    T.StructField("ExpansionFactor", T.DoubleType()),
])

HOUSEHOLD_SEED = T.StructType([
    T.StructField("HouseholdId", T.LongType()),
    T.StructField("HouseholdZone", T.IntegerType()),
    T.StructField("DwellingType", T.IntegerType()),
    T.StructField("NumberOfPersons", T.IntegerType()),
    T.StructField("Vehicles", T.IntegerType()),
    T.StructField("IncomeClass", T.IntegerType()),
    T.StructField("ExpansionFactor", T.DoubleType()),
])

ZONE_MAP = T.StructType([
    T.StructField("Zone", T.IntegerType()),
    T.StructField("PD", T.IntegerType()),
])

POPULATION_VECTOR = T.StructType([
    T.StructField("zone", T.IntegerType()),
    T.StructField("population", T.DoubleType()),
])

SEED_PERSON_RENAMES = {
    "HouseholdId": "household_id", "PersonNumber": "person_number", "Age": "age",
    "Sex": "sex", "License": "license", "TransitPass": "transit_pass",
    "EmploymentStatus": "employment_status", "Occupation": "occupation",
    "FreeParking": "free_parking", "StudentStatus": "student_status",
    "EmploymentZone": "employment_zone", "SchoolZone": "school_zone",
    "ExpansionFactor": "expansion_factor",
}
SEED_HOUSEHOLD_RENAMES = {
    "HouseholdId": "household_id", "HouseholdZone": "household_zone",
    "DwellingType": "dwelling_type", "NumberOfPersons": "number_of_persons",
    "Vehicles": "vehicles", "IncomeClass": "income_class",
    "ExpansionFactor": "expansion_factor",
}
