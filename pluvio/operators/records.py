"""Incident records: date parsing with fallback, period merge, the daily
hazard pivot with its null rules, hazard totals and the published record table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions.dates import parse_date
from pluvio.functions.nulls import row_total, strict_sum, zero_fill
from pluvio.operators.columns import rename_regex, select_first, select_prefix
from pluvio.operators.reshape import pivot

# fixed values: hazards carried into the daily table, extra types kept in the
# published record table (the trailing space of 'Lightning ' is part of the value)
HAZARDS = ("Flood", "Slope-failure", "Wind-Storm")
PUBLISHED_EXTRA_TYPES = ("Fire", "Infrastructure", "Lightning ")
# fixed values: the numeric measures of an incident record, and those of them that the
# daily table publishes (with a total over the hazards)
MEASURES = ("number_of_incidents", "affected_hhs", "affected_individuals", "casualties_ind", "missing_ind",
            "injured_ind", "displaced_hh", "displaced_ind", "partially_damaged_shelters",
            "totally_damaged_shelters", "damaged_waterpoints", "damaged_latrines", "damaged_health_facilities",
            "damaged_food_distribution_site")
PUBLISHED_MEASURES = tuple(m for m in MEASURES if m not in ("casualties_ind", "missing_ind", "injured_ind"))
# fixed values: column-name rewrite rules of the published record table, and the
# columns and column prefixes it leaves out
RECORD_NAME_RULES = ((r"\.", "_"), ("__", "_"), ("_other_", "_other"), ("_ind_", "_ind"),
                     ("problems_require_intervention_", "problems_require_intervention"),
                     ("protection_concern_", "protection_concern"),
                     ("can_needs_be_managed_in_the_site_", "can_needs_be_managed_in_the_site"))
RECORD_DROPPED_PREFIXES = ("gps", "required_response_", "response_delivered", "displacement_refuge", "traffic")
RECORD_DROPPED = ("organization", "type_of_incident_other", "location_access", "problems_require_intervention",
                  "protection_concern", "can_needs_be_managed_in_the_site", "additional_comments")


def parse_incident_dates(df: DataFrame, incident: str = "date_of_incident",
                         assessment: str = "date_of_assessment", fmt: str = "d/M/yyyy") -> DataFrame:
    """Day-first date text -> DATE; a missing incident date falls back to the
    assessment date."""
    a = parse_date(assessment, fmt)
    return df.withColumns({assessment: a, incident: F.coalesce(parse_date(incident, fmt), a)})


def merge_periods(old: DataFrame, new: DataFrame, cut, date: str = "date_of_incident") -> DataFrame:
    """Older extract cut before ``cut`` plus the newer extract whole, by name."""
    return old.filter(F.col(date) < F.lit(cut)).unionByName(new, allowMissingColumns=True)


def reported_incidents(df: DataFrame, flag: str = "incident", assessment: str = "date_of_assessment") -> DataFrame:
    """Rows confirmed as incidents, without the assessment date."""
    return df.filter(F.col(flag) == "Yes").drop(assessment)


def incident_pivot(df: DataFrame, measures, hazards=HAZARDS, date: str = "date_of_incident",
                   kind: str = "type_of_incident", sep: str = "_") -> DataFrame:
    """One row per date, one column per (measure, hazard): the strict sum of the
    day's records (one unknown value voids the cell) and then every void or
    absent cell reported as 0."""
    x = df.filter(F.col(kind).isin(list(hazards)) & F.col(date).isNotNull())
    p = pivot(x, [date], kind, list(hazards), {m: strict_sum(m) for m in measures}, sep=sep)
    cells = [f"{m}{sep}{h}" for m in measures for h in hazards]
    return p.select(F.col(date).alias("date"),
                    *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in cells])


def hazard_totals(df: DataFrame, measures, hazards=HAZARDS, sep: str = "_",
                  names: dict[str, str] | None = None) -> DataFrame:
    """Per measure, the row total over its hazard columns: null only when every
    hazard cell is null (a day without any incident row), else the sum of the known."""
    names = names or {m: f"total_{m}" for m in measures}
    out = {}
    for m in measures:
        cols = [f"{m}{sep}{h}" for h in hazards if f"{m}{sep}{h}" in df.columns]
        out[names[m]] = row_total(cols)
    return df.withColumns(out)


def clean_records(df: DataFrame, hazards=HAZARDS, extra_types=PUBLISHED_EXTRA_TYPES,
                  kind: str = "type_of_incident", date: str = "date_of_incident",
                  drop=("incident_picture", "uid", "time_of_submission"),
                  drop_prefixes=RECORD_DROPPED_PREFIXES, drop_after=RECORD_DROPPED,
                  name_rules=RECORD_NAME_RULES) -> DataFrame:
    """The published record table: confirmed incidents of the published types,
    numeric nulls as 0, bookkeeping and coordinate columns removed, names
    normalised, date first, sorted by date. The sort breaks ties on the other
    columns so that a date holding a large share of the records is still split
    over several range partitions."""
    x = reported_incidents(df).drop("incident")
    x = x.filter(F.col(kind).isin([*hazards, *extra_types]))
    x = zero_fill(x).drop(*[c for c in drop if c in x.columns])
    x = select_first(x, date)
    x = rename_regex(x, name_rules)
    x = select_prefix(x, *drop_prefixes, drop=True).drop(*drop_after)
    return x.orderBy(date, *[c for c in x.columns if c != date])
