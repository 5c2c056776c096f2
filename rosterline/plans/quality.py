"""Data repair and reconciliation: addresses, phone countries, tax forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import col, text_length, version_part
from ..models import campus as m
from ..operators import aggregates, batch, changes, joins, ranking
from ..operators.changes import ChangeSet
from ..sources.registry import TableRegistry

# The columns that make two addresses the same.
ADDRESS_LINES = (
    "ADDRESS_LINE_1", "ADDRESS_LINE_2", "ADDRESS_LINE_3", "ADDRESS_LINE_4", "CITY", "STATE", "ZIP_CODE", "COUNTRY", "COUNTY", "NO_MAIL",
)
# Where the release is kept and the release the repair is meant for (major, minor, at least).
VERSION_SETTING = ("SYSADMIN", "DATABASE", "VERSION")
REPAIRABLE_RELEASE = (9, 1, 0)


def release_is_repairable(t: TableRegistry) -> bool:
    major, minor, patch = REPAIRABLE_RELEASE
    test = (
        (version_part("SETTING", 3) == major) & (version_part("SETTING", 2) == minor) & (version_part("SETTING", 1) >= patch)
    )
    return not m.settings(t, *VERSION_SETTING).filter(test).isEmpty()


def people_missing_addresses(t: TableRegistry, schedule: DataFrame | None = None) -> DataFrame:
    """People with an active scheduled address that the address table lacks."""
    active = (schedule if schedule is not None else t["ADDRESSSCHEDULE"]).filter(F.col("STATUS") == "A")
    return joins.anti(active, t["ADDRESS"], ["PEOPLE_ORG_CODE_ID", "ADDRESS_TYPE"]).select("PEOPLE_ORG_CODE_ID").distinct()


def repair_addresses(t: TableRegistry, excluded_types: Sequence[str] = ("EMAL",), check_release: bool = True) -> ChangeSet:
    """One pass of the duplicate repair; repeat on the new state while changes remain."""
    if check_release and not release_is_repairable(t):
        raise changes.RunAborted("this repair is only meant for release " + ".".join(map(str, REPAIRABLE_RELEASE[:2])))
    person = "PEOPLE_ORG_CODE_ID"
    eligible = ~F.col("ADDRESS_TYPE").isin(*excluded_types) & (F.col("RECURRING") == "N")
    return batch.repair_versions(
        t["ADDRESSSCHEDULE"], "SEQUENCE_NO", [person, "ADDRESS_TYPE", *ADDRESS_LINES], [person, "ADDRESS_TYPE", *ADDRESS_LINES],
        "START_DATE", "END_DATE", "STATUS", eligible, match=[person, *ADDRESS_LINES],
    )


def override_by_prefix(
    number: str, country: str, default: int, length: int, narrow: Sequence[str], narrow_value: int, wide: str, wide_value: int
) -> Column:
    """Country of numbers that a prefix table cannot express; only rows still at the default change."""
    number_col, country_col = col(number), col(country)
    eligible = (country_col == default) & (text_length(number_col) == length)
    return (
        F.when(eligible & F.substring(number_col, 1, len(narrow[0])).isin(*narrow), narrow_value)
        .when(eligible & F.startswith(number_col, F.lit(wide)), wide_value)
        .otherwise(country_col)
    )


# The shared "7" prefix — length, leading digits and the two countries.
SHARED_PREFIX = {"length": 11, "narrow": ("77", "76"), "narrow_value": 122, "wide": "7", "wide_value": 190}


def duplicate_phones(t: TableRegistry) -> DataFrame:
    """Phones held more than once by a person under one type with different countries; with a primary flag."""
    key = ["PersonId", "PhoneType", "PhoneNumber"]
    phones = t["PersonPhone"]
    mixed = phones.groupBy(*key).agg(F.min("CountryId").alias("_lo"), F.max("CountryId").alias("_hi")).filter("_lo <> _hi")
    rows = joins.semi(phones.filter(F.col("CountryId").isNotNull()), mixed, key)
    primary = t["PEOPLE"].select("PersonId", F.col("PrimaryPhoneId").alias("PersonPhoneId")).dropna().distinct().withColumn("_primary", F.lit(True))
    return rows.join(primary, ["PersonId", "PersonPhoneId"], "left").withColumn("IsPrimary", F.coalesce("_primary", F.lit(False))).drop("_primary")


def phone_country(t: TableRegistry, default_country: int = 240) -> ChangeSet:
    """Drop duplicate numbers (primary first, then oldest, stays) and set countries from dialing codes."""
    order = [~F.col("IsPrimary"), dates.on_date("Create_Date", "Create_Time")]
    doomed = ranking.beaten_per_key(duplicate_phones(t), ["PersonId", "PhoneType", "PhoneNumber"], order)
    deleted = changes.delete_matching(t["PersonPhone"], doomed, ["PersonPhoneId"])
    found = joins.prefix_lookup(deleted.new_state, "PhoneNumber", t["DialingCodes"], "Prefix", "NumberLength", "CountryId", "_found")
    looked_up = F.when((F.col("CountryId") == default_country) & F.col("_found").isNotNull(), F.col("_found")).otherwise(F.col("CountryId"))
    fixed = found.withColumn("_new", looked_up)
    fixed = fixed.withColumn("_new", override_by_prefix("PhoneNumber", "_new", default_country, **SHARED_PREFIX))
    columns = [F.col("_new").cast("int").alias(c) if c == "CountryId" else F.col(c) for c in t["PersonPhone"].columns]
    updated = fixed.filter(~F.col("_new").eqNullSafe(F.col("CountryId"))).select(*columns, F.lit("UPDATE").alias("action"))
    return ChangeSet(fixed.select(*columns), deleted.changes.unionByName(updated))


INFORMATION, SUMMARY, DETAIL, REFUND = (
    "Reported1098TInformation", "Reported1098TPeriodSummary", "Reported1098TSummaryDetail", "Reported1098TRefundCode",
)


def copy_tax_forms(t: TableRegistry, old: str, new: str, tax_year: int) -> dict[str, ChangeSet]:
    """Copy each person's last run of a tax year, with its summaries and details, keeping the ids; what the new side has by its id is not copied again."""
    runs = t.table(INFORMATION, old).filter(F.col("TaxYear") == tax_year)
    latest = ranking.last_per_key(runs, ["People_Code_Id"], [F.col("ReportedInformationId")])
    periods = joins.semi(t.table(SUMMARY, old), latest, ["ReportedInformationId"])
    info = changes.insert_missing(t.table(INFORMATION, new), latest, ["ReportedInformationId"])
    summary = changes.insert_missing(t.table(SUMMARY, new), periods, ["ReportedPeriodSummaryId"])
    details = joins.semi(t.table(DETAIL, old), periods, ["ReportedPeriodSummaryId"])
    detail = changes.insert_missing(t.table(DETAIL, new), details, ["ReportedSummaryDetailId"])
    refund = changes.insert_missing(t.table(REFUND, new), t.table(REFUND, old), ["ReportedRefundCodeId"])
    return {INFORMATION: info, SUMMARY: summary, DETAIL: detail, REFUND: refund}


def _chain(t: TableRegistry, info_db: str, rest_db: str, tax_year: int) -> DataFrame:
    info = t.table(INFORMATION, info_db).filter(F.col("TaxYear") == tax_year).select(
        "ReportedInformationId", "People_Code_Id", "NameLine1", "Payment", "PaymentAdjustment", "Scholarship"
    )
    summary = t.table(SUMMARY, rest_db).drop("TaxYear")
    return info.join(summary, "ReportedInformationId").join(t.table(DETAIL, rest_db), "ReportedPeriodSummaryId")


def tax_form_totals(t: TableRegistry, old: str, new: str, tax_year: int) -> DataFrame:
    """Rows and sums on both sides; the old side counts all runs, against the new summaries and details."""
    out = None
    for side, db in (("old", old), ("new", new)):
        part = _chain(t, db, new, tax_year).agg(
            F.count(F.lit(1)).alias("Rows"), F.sum("Payment").alias("PaymentSum"), F.sum("Amount").alias("DetailSum")
        ).select(F.lit(side).alias("side"), "Rows", "PaymentSum", "DetailSum")
        out = part if out is None else out.unionByName(part)
    return out


def reconcile_tax_forms(t: TableRegistry, old: str, new: str, tax_year: int) -> DataFrame:
    """Per table: rows on the new side and how many are identical on the old side."""
    of_year = F.col("TaxYear") == tax_year
    old_periods = t.table(SUMMARY, old).filter(of_year)
    sides = {
        INFORMATION: (t.table(INFORMATION, new).filter(of_year), t.table(INFORMATION, old).filter(of_year), "ReportedInformationId"),
        SUMMARY: (t.table(SUMMARY, new).filter(of_year), old_periods, "ReportedPeriodSummaryId"),
        DETAIL: (t.table(DETAIL, new), joins.semi(t.table(DETAIL, old), old_periods, ["ReportedPeriodSummaryId"]), "ReportedSummaryDetailId"),
    }
    out = None
    for name, (here, there, key) in sides.items():
        part = aggregates.reconcile(here, there, key, here.columns).select(F.lit(name).alias("table_name"), "total_rows", "matched_rows")
        out = part if out is None else out.unionByName(part)
    return out


def sample_tax_forms(t: TableRegistry, old: str, new: str, tax_year: int, k: int = 5, seed: int = 0) -> DataFrame:
    """A few rows of the new side beside the same rows of the old side."""
    keys = ["ReportedInformationId", "ReportedPeriodSummaryId", "ReportedSummaryDetailId"]
    shown = ["NameLine1", "Payment", "AcademicYear", "AcademicTerm", "CumulativeChargesBilled", "Amount", "ChargeCreditCode"]
    here = ranking.seeded_sample(_chain(t, new, new, tax_year), keys, k, seed).select(*keys, F.struct(*shown).alias("here"))
    there = _chain(t, old, old, tax_year).select(*keys, F.struct(*shown).alias("there"))
    return here.join(there, keys, "left")


def repeated_tax_forms(t: TableRegistry, db: str, tax_year: int) -> DataFrame:
    rows = t.table(INFORMATION, db).filter((F.col("TaxYear") == tax_year) & F.col("People_Code_Id").isNotNull())
    return aggregates.duplicates(rows, ["People_Code_Id"], "Count")


def tax_form_keys(t: TableRegistry, db: str) -> DataFrame:
    ids = {INFORMATION: "ReportedInformationId", SUMMARY: "ReportedPeriodSummaryId", DETAIL: "ReportedSummaryDetailId", REFUND: "ReportedRefundCodeId"}
    return aggregates.high_water({n: (t.table(n, db), k) for n, k in ids.items()})
