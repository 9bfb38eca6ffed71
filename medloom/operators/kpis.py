"""Hospital measures over the standardized tables.

Facts are reduced to the grain a measure needs before they are shuffled for a join, so a key that holds a
large part of the rows arrives at the join as a few rows. Windows run over groups whose size the calendar
bounds, not over all rows of a patient.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHARGE_PARTS = (
    "doctor_fees", "lab_charges", "nursing_charges", "pharmacy_charges", "procedure_charges", "room_charges",
)
SMALL_CELL = 11


def month_of(day: str | Column) -> Column:
    """First day of the month."""
    return F.trunc(F.col(day) if isinstance(day, str) else day, "MM")


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` rounded to six places; NULL where ``whole`` is 0."""
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), 6)


def suppress_small(df: DataFrame, count_column: str, measures: tuple[str, ...] = (), least: int = SMALL_CELL) -> DataFrame:
    """Blank out counts below ``least`` together with the measures built on them."""
    shown = F.col(count_column) >= least
    return df.select(
        *[F.when(shown, F.col(c)).alias(c) if c == count_column or c in measures else F.col(c) for c in df.columns]
    )


def with_prior_month(monthly: DataFrame, month: str, value: str, alias: str) -> DataFrame:
    """Add the value of the calendar month before; ``monthly`` has one row per month.

    Each row is also sent to the next month and the two meet in a group: no join and no unpartitioned window.
    """
    others = [c for c in monthly.columns if c != month]
    own = F.col("ahead") == 0
    met = (
        monthly.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("ahead"))
        .groupBy(F.add_months(month, F.col("ahead")).alias(month))
        .agg(
            *[F.max(F.when(own, F.col(c))).alias(c) for c in others],
            F.max(F.when(~own, F.col(value))).alias(alias),
            F.min("ahead").alias("ahead"),
        )
    )
    return met.filter(own).drop("ahead")


def kpi_los_monthly(admissions: DataFrame) -> DataFrame:
    """Admissions, mean and median stay per month of admission, and the change on the month before."""
    stays = admissions.select(
        month_of("admission_date_final").alias("admission_month"),
        F.datediff("discharge_date_final", "admission_date_final").alias("los_days"),
    )
    monthly = (
        stays.groupBy("admission_month", "los_days")
        .agg(F.count("los_days").alias("n"))
        .filter("n > 0")  # both dates known; a filter on the dates themselves would be copied into their rules
        .groupBy("admission_month")
        .agg(
            F.sum("n").alias("admissions"),
            _ratio(F.sum(F.col("n") * F.col("los_days")), F.sum("n")).alias("mean_los_days"),
            F.percentile("los_days", F.lit(0.5), F.col("n")).alias("median_los_days"),
        )
    )
    both = with_prior_month(monthly, "admission_month", "admissions", "prior_admissions")
    return both.select(
        "admission_month", "admissions", "mean_los_days", "median_los_days",
        (F.col("admissions") - F.col("prior_admissions")).alias("change_on_prior_month"),
    )


def kpi_occupancy(admissions: DataFrame, departments: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Patient days by beds and days, per department and month; the discharge day does not count.

    Stays that have not ended count up to ``as_of``, which does not count either; without it they have no days.
    A department that the department table lacks has its patient days, without beds and occupancy.

    A stay contributes its days in its first and last month and, for the full months between, a step up and
    a step down. Steps are summed per department and month and then run up along the months. A stay of one
    day and one that never ends (discharge in 9999) so cost the same three or four rows.
    """
    first, end = F.col("admission_date_final"), F.col("discharge_date_final")
    if as_of is not None:
        end = F.coalesce(end, F.lit(as_of))
    # equal stays are one row from here on; a filter on the dates themselves would be copied into their rules
    counted = (
        admissions.filter(F.col("department_id").isNotNull())
        .select("department_id", first.alias("first_day"), end.alias("end_day"))
        .groupBy("department_id", "first_day", "end_day")
        .agg(F.count_if(F.col("end_day") > F.col("first_day")).alias("stays"))
        .filter("stays > 0")
    )
    stays = counted.select("*", month_of("first_day").alias("first_month"), month_of(F.date_sub("end_day", 1)).alias("last_month"))
    one_month = F.col("first_month") == F.col("last_month")
    after_first = F.add_months("first_month", 1)

    def step(month: Column, days: Column, sign: int) -> Column:
        return F.struct(month.alias("month"), (days * F.col("stays")).alias("days"), (F.lit(sign) * F.col("stays")).alias("step"))

    steps = stays.select(
        "department_id",
        F.inline(
            F.when(
                one_month,
                F.array(step(F.col("first_month"), F.datediff("end_day", "first_day"), 0)),
            ).otherwise(
                F.array(
                    step(F.col("first_month"), F.datediff(after_first, F.col("first_day")), 0),
                    step(F.col("last_month"), F.datediff("end_day", "last_month"), 0),
                    step(after_first, F.lit(0), 1),
                    step(F.col("last_month"), F.lit(0), -1),
                )
            )
        ),
    )
    per_month = steps.groupBy("department_id", "month").agg(
        F.sum("days").alias("days"), F.sum("step").alias("step")
    )
    along = Window.partitionBy("department_id").orderBy("month")
    running = per_month.select(
        "department_id", "month", "days",
        F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("full_stays"),
        F.lead("month").over(along).alias("next_month"),
    )
    last_filled = F.when(F.col("full_stays") > 0, F.add_months("next_month", -1)).otherwise(F.col("month"))
    filled = running.select(
        "department_id", "days", "full_stays", F.col("month").alias("from_month"),
        F.explode(F.sequence("month", last_filled, F.expr("interval 1 month"))).alias("month"),
    )
    month_days = F.dayofmonth(F.last_day("month"))
    used = filled.select(
        "department_id", "month",
        (
            F.when(F.col("month") == F.col("from_month"), F.col("days")).otherwise(F.lit(0))
            + F.col("full_stays") * month_days
        ).alias("patient_days"),
        month_days.alias("month_days"),
    ).filter(F.col("patient_days") > 0)
    beds = departments.groupBy(F.col("department_id").cast("int").alias("department_id")).agg(
        F.sum("bed_count").alias("beds")
    )
    return used.join(beds, "department_id", "left").select(
        "department_id", "month", "patient_days", "beds",
        _ratio(F.col("patient_days"), F.col("beds") * F.col("month_days")).alias("occupancy"),
    )


def kpi_revenue_tieout(billing: DataFrame, admissions: DataFrame) -> DataFrame:
    """Per month of bill (none for bills without a readable date): billed, covered, due and paid amounts, bills whose parts miss the total, and
    revenue per admission. Bills are summed per admission and month before they meet the admissions."""
    zero = F.lit(0).cast("decimal(18,2)")

    def amount(name: str) -> Column:
        return F.coalesce(F.col(name), zero)

    parts = sum((amount(c) for c in CHARGE_PARTS[1:]), amount(CHARGE_PARTS[0]))
    per_stay = (
        billing.groupBy("admission_id", month_of("bill_date").alias("bill_month"))
        .agg(
            F.count(F.lit(1)).alias("bills"),
            F.sum(amount("total_amount")).alias("billed"),
            F.sum(amount("insurance_coverage")).alias("covered"),
            F.sum(amount("patient_due")).alias("due"),
            F.count_if(F.abs(amount("total_amount") - parts) > F.lit("0.01").cast("decimal(3,2)")).alias("mismatched"),
        )
    )
    known = admissions.select("admission_id").distinct().withColumn("known", F.lit(1))
    return (
        per_stay.join(known, "admission_id", "left")
        .groupBy("bill_month")
        .agg(
            F.sum("bills").alias("bills"),
            F.count("known").alias("admissions"),
            F.sum("billed").cast("decimal(38,2)").alias("billed"),
            F.sum("covered").cast("decimal(38,2)").alias("covered"),
            F.sum("due").cast("decimal(38,2)").alias("due"),
            F.sum(F.col("billed") - F.col("covered") - F.col("due")).cast("decimal(38,2)").alias("paid"),
            F.sum("mismatched").alias("mismatched_bills"),
            _ratio(F.sum(F.when(F.col("known") == 1, F.col("billed"))), F.count("known")).alias("revenue_per_admission"),
        )
    )


def kpi_payer_mix(billing: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Share of each payer class in the amount billed per month. Unknown payers are 'Unknown'; bills without a
    readable date have a row without month.

    Amounts are summed per admission, then per patient, then per payer, so each join has one row per key
    and month on the bill side and one row per key on the other.
    """
    per_stay = billing.groupBy(
        "admission_id", month_of("bill_date").alias("bill_month")
    ).agg(F.sum("total_amount").alias("amount"))
    owner = admissions.groupBy("admission_id").agg(F.min("patient_id").alias("patient_id"))
    per_patient = (
        per_stay.join(owner, "admission_id", "left")
        .groupBy("patient_id", "bill_month")
        .agg(F.sum("amount").alias("amount"))
    )
    payer = patients.filter(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(
        F.min("insurance_type").alias("payer")
    )
    mixed = (
        per_patient.join(payer, "patient_id", "left")
        .groupBy("bill_month", F.coalesce("payer", F.lit("Unknown")).alias("insurance_type"))
        .agg(F.sum("amount").cast("decimal(38,2)").alias("amount"))
    )
    month = Window.partitionBy("bill_month")
    return mixed.select(
        "bill_month", "insurance_type", "amount",
        _ratio(F.col("amount"), F.sum("amount").over(month)).alias("share"),
    )


def kpi_top_codes(diagnoses: DataFrame, procedures: DataFrame, least: int = SMALL_CELL) -> DataFrame:
    """Codes by frequency with rank and running share; codes with fewer than ``least`` rows are left out.

    Small codes are dropped before the ranking window (they rank last, so no shown rank or share changes).
    What is ranked is a code list, not the facts.
    """
    codes = diagnoses.select(F.lit("ICD").alias("code_system"), F.col("icd_code").alias("code")).unionByName(
        procedures.select(F.lit("CPT").alias("code_system"), F.col("cpt_code").alias("code"))
    )
    counted = codes.filter(F.col("code").isNotNull()).groupBy("code_system", "code").agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counted.groupBy("code_system").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("code_system").orderBy(F.col("n").desc(), F.col("code"))
    ranked = counted.filter(F.col("n") >= least).select(
        "code_system", "code", "n",
        F.row_number().over(order).alias("place"),
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
    )
    return ranked.join(totals, "code_system").select(
        "code_system", "code", "n", "place",
        _ratio(F.col("n"), F.col("total")).alias("share"),
        _ratio(F.col("running"), F.col("total")).alias("running_share"),
    )


def kpi_readmit_30d(admissions: DataFrame, days: int = 30) -> DataFrame:
    """Index discharges and readmissions within ``days`` days, per month of discharge.

    Stays of a patient follow each other by admission date and id. A stay is an index stay if it has ended
    and the patient did not die; it counts as readmitted when the patient's next stay begins 0 to ``days``
    days after its end.

    Stays that begin on one day follow each other on that day, so they can be counted without being sorted;
    only the day's last one looks to a later day. Stays are therefore first summed per patient, day and
    discharge month, with the last one kept aside. The window over a patient then holds those sums, whose
    number the calendar bounds, even for a patient id that stands for a third of all stays.
    """
    day, left_on = F.col("day"), F.col("left_on")

    def within(begin: Column, end: Column) -> Column:
        return F.coalesce(F.datediff(begin, end).between(0, days), F.lit(False))

    stays = admissions.filter(F.col("patient_id").isNotNull()).select(
        "patient_id", "admission_id",
        F.col("admission_date_final").alias("day"), F.col("discharge_date_final").alias("left_on"),
        (F.col("discharge_date_final").isNotNull() & (F.col("discharge_status") != "Expired")).alias("is_index"),
    )
    # The day's last stay as one number that sorts by id, then end, then kind: unlike a struct, its maximum
    # is kept in a hash aggregate. The end is a day count below 2**22, 0 when the stay is open.
    end_number = F.coalesce(F.datediff(left_on, F.lit("0001-01-01").cast("date")) + 1, F.lit(0))
    packed = F.shiftleft(F.col("admission_id").cast("bigint"), 24) + end_number * 2 + F.col("is_index").cast("int")
    # stays without a day are left out by their count: a filter on the day would be copied into its rules
    sums = stays.groupBy("patient_id", "day", month_of("left_on").alias("discharge_month")).agg(
        F.count_if("is_index").alias("index_stays"),
        F.count_if(F.col("is_index") & within(day, left_on)).alias("same_day"),
        F.max(packed).alias("last"),
        F.count("day").alias("known"),
    ).filter("known > 0")
    along = Window.partitionBy("patient_id").orderBy("day", "last")
    linked = sums.withColumn("next_day", F.lead("day").over(along)).withColumn(
        "low_bits", F.pmod(F.col("last"), F.lit(2**24)).cast("int")
    )
    last_is_index = F.pmod(F.col("low_bits"), F.lit(2)) == 1
    last_left_on = F.date_add(F.lit("0001-01-01").cast("date"), F.shiftright("low_bits", 1) - 1)
    ends_day = last_is_index & F.coalesce(F.col("next_day") != day, F.lit(True))
    counted_same_day = (ends_day & within(day, last_left_on)).cast("int")
    comes_back = (ends_day & within(F.col("next_day"), last_left_on)).cast("int")
    return (
        linked.filter(F.col("discharge_month").isNotNull())
        .groupBy("discharge_month")
        .agg(
            F.sum("index_stays").alias("index_discharges"),
            F.sum(F.col("same_day") - counted_same_day + comes_back).alias("readmissions"),
        )
        .withColumn("readmission_rate", _ratio(F.col("readmissions"), F.col("index_discharges")))
    )


def kpi_labs(lab_results: DataFrame, admissions: DataFrame) -> DataFrame:
    """Per test: results, share with a value, and days from admission to test (median and mean).

    Results are counted per admission, test and day before the join. There is no order time in the data, so
    the turnaround is a stand-in; tests without a date or a known admission count only for completion.
    """
    counted = lab_results.groupBy("test_name", "admission_id", "test_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("result_value").alias("done")
    )
    begun = admissions.filter(F.col("admission_date_final").isNotNull()).groupBy("admission_id").agg(
        F.min("admission_date_final").alias("begun")
    )
    days = (
        counted.join(begun, "admission_id", "left")
        .groupBy("test_name", F.datediff("test_date", "begun").alias("wait_days"))
        .agg(F.sum("n").alias("n"), F.sum("done").alias("done"))
    )
    known = F.when(F.col("wait_days").isNotNull(), F.col("n"))
    return days.groupBy("test_name").agg(
        F.sum("n").alias("results"),
        _ratio(F.sum("done"), F.sum("n")).alias("completion_rate"),
        F.coalesce(F.sum(known), F.lit(0)).alias("timed_results"),
        F.percentile("wait_days", F.lit(0.5), F.col("n")).alias("median_wait_days"),
        _ratio(F.sum(known * F.col("wait_days")), F.sum(known)).alias("mean_wait_days"),
    )
