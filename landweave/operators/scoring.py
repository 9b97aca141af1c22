"""Priority scores: lookups, null-skipping mean and relabelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Land cover codes, their names and scores.
LAND_COVER = {
    1: "Deciduous woodland", 2: "Coniferous woodland", 3: "Arable", 4: "Improved grassland", 5: "Neutral Grassland", 6: "Calcareous grassland",
    7: "Acid grassland", 8: "Fen", 9: "Heather", 10: "Heather grassland", 11: "Bog", 12: "Inland rock", 13: "Saltwater", 14: "Freshwater",
    15: "Supralittoral rock", 16: "Supralittoral sediment", 17: "Littoral rock", 18: "Littoral sediment", 19: "Saltmarsh", 20: "Urban", 21: "Suburban",
}
LAND_COVER_SCORES = {
    1: 0.0, 2: 0.0, 3: 1.0, 4: 1.0, 5: 0.5, 6: 0.5, 7: 0.5, 8: 0.0, 9: 0.5, 10: 0.5, 11: 0.0,
    12: 1.0, 13: 1.0, 14: 1.0, 15: 1.0, 16: 1.0, 17: 1.0, 18: 1.0, 19: 0.0, 20: 0.0, 21: 0.0,
}

# Scores of agricultural grades, habitat classes, soil groups and recharge classes.
GRADE_SCORES = {"Grade 1": 0.0, "Grade 2": 0.2, "Grade 3": 0.75, "Grade 4": 1.0, "Grade 5": 1.0, "Urban": 0.0, "Non Agricultural": 0.0}
HABITAT_SCORES = {
    "Network Enhancement Zone 1": 1.0, "PHI_Other": 0.0, "SSSI": 0.0, "Network Enhancement Zone 2": 1.0, "Ancient woodland": 0.0, "Network Expansion Zone": 1.0,
    "Restorable Habitat": 0.5, "Wood pasture and parkland": 0.5, "Fragmentation Action Zone": 1.0, "Traditional orchard": 0.0, "Habitat Restoration-Creation": 1.0,
    "Rivers": 1.0, "Lowland meadows": 0.0, "Lowland fens": 0.0, "Lowland dry acid grassland": 0.0, "Lowland calcareous grassland": 0.0,
    "Purple moor grass & rush pastures": 0.0, "Lowland heathland": 0.0, "Reedbeds": 0.0, "Lakes": 0.0,
}
SOIL_SCORES = {
    "ALL": 0.5, "HEAVY TO MEDIUM": 1.0, "MEDIUM TO HEAVY": 1.0, "MEDIUM TO LIGHT(SILTY) TO HEAVY": 0.5, "MEDIUM(SILTY) TO LIGHT(SILTY)": 0.5,
    "LIGHT(SANDY) TO MEDIUM(SANDY)": 0.5, "MEDIUM TO LIGHT(SILTY)": 0.5, "LIGHT TO MEDIUM": 0.5, "LIGHT(SILTY) TO MEDIUM(SILTY)": 0.5,
    "LIGHT(SANDY)": 0.5, "MEDIUM(SILTY) TO LIGHT(SILTY) TO HEAVY": 0.5, "MEDIUM": 0.75, "MEDIUM TO LIGHT": 0.5,
}
RECHARGE_SCORES = {"HIGH": 1.0, "MEDIUM": 0.5, "LOW": 0.0}
NO_HABITAT, NO_RECHARGE = 0.5, 0.0


def lookup(key: Column, table: dict) -> Column:
    """The value of a key in a small table; exact and case-sensitive, null where it isn't there."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def land_cover_code(df: DataFrame, column: str = "CEH_LU") -> Column:
    return F.expr(f"CAST(try_cast({column} AS DOUBLE) AS INT)")


def sub_scores(df: DataFrame) -> DataFrame:
    """Adds lu, alc, hb, sl and rch scores of CEH_LU, alc_grade, prio_hb, sl_grp and rch_pt; a missing column scores null (recharge 0)."""
    has = set(df.columns)
    null = F.lit(None).cast("double")
    known = {
        "lu_prio": lookup(land_cover_code(df), LAND_COVER_SCORES) if "CEH_LU" in has else null,
        "alc_prio": lookup(F.col("alc_grade"), GRADE_SCORES) if "alc_grade" in has else null,
        "hb_prio": lookup(F.col("prio_hb"), HABITAT_SCORES) if "prio_hb" in has else null,
        "sl_prio": lookup(F.col("sl_grp"), SOIL_SCORES) if "sl_grp" in has else null,
        "rch_prio": lookup(F.col("rch_pt"), RECHARGE_SCORES) if "rch_pt" in has else null,
    }
    return df.withColumns(known)


def filled(df: DataFrame) -> DataFrame:
    """Habitats without a score count 0.5, anything but HIGH, MEDIUM and LOW recharge 0."""
    return df.withColumns({"hb_prio": F.coalesce("hb_prio", F.lit(NO_HABITAT)), "rch_prio": F.coalesce("rch_prio", F.lit(NO_RECHARGE))})


SUB_SCORES = ["lu_prio", "alc_prio", "hb_prio", "sl_prio", "rch_prio"]


def mean_skipping_nulls(columns: list[str]) -> tuple[Column, Column]:
    """The number of values and their mean, summed in the given order."""
    held = F.filter(F.array(*columns), lambda v: v.isNotNull())
    return F.size(held), F.aggregate(held, F.lit(0.0), lambda a, v: a + v) / F.nullif(F.size(held), F.lit(0))


def priority_scores(df: DataFrame) -> DataFrame:
    """Adds ``n_prio_scores`` and ``tot_prio``, the mean of the sub-scores there are, and turns CEH_LU into its name."""
    n, mean = mean_skipping_nulls(SUB_SCORES)
    out = filled(sub_scores(df)).withColumns({"n_prio_scores": n.cast("int"), "tot_prio": mean})
    return (out.withColumn("CEH_LU", lookup(land_cover_code(df), LAND_COVER)) if "CEH_LU" in df.columns else out).drop(*SUB_SCORES)


def unmapped(df: DataFrame, column: str, table: dict, code: bool = False) -> DataFrame:
    """(value, n) of values that are there but have no score, most frequent first; at most five."""
    value = land_cover_code(df, column) if code else F.col(column)
    rows = df.select(value.alias("value")).filter(F.col("value").isNotNull() & lookup(F.col("value"), table).isNull())
    return rows.groupBy(F.col("value").cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(5)


def sql_case(expression: str, table: dict) -> str:
    """The lookup as SQL."""
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"CASE {expression} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items()) + " END"
