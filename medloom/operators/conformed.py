"""Conformed entities: all code maps as one lookup, applied to whole entities, with keys resolved to canonical ids.

A map of a domain (departments, procedure codes, payers, ...) has canonical codes, each with an id and a label, and
aliases, which stand for a code or for another alias: a superseded code points to its successor, which may have been
superseded in turn. :func:`combined` follows such chains and returns one table, a row for each domain and source value.

:func:`conform_entity` joins each mapped column with its domain's part of that table. The parts are small next to facts
and already written, so the planner broadcasts them by their bytes and an entity is conformed in one map stage; a
part too large for that costs one shuffle of the entity, whose very frequent values adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.functions.text import or_na
from medloom.operators.kpis import month_of
from medloom.operators.quality import latest_per_key
from medloom.sources.shared import written

CODE_COLUMNS = ("domain", "code", "canonical_id", "label")
ALIAS_COLUMNS = ("domain", "source_value", "target_value")

# Which column of each entity belongs to which domain.
ENTITY_DOMAINS: dict[str, dict[str, str]] = {
    "admissions": {"department_id": "department", "hospital_id": "hospital"},
    "billing": {"payment_status": "payment"},
    "departments": {"department_id": "department", "hospital_id": "hospital"},
    "diagnoses": {"icd_code": "icd"},
    "hospitals": {"hospital_id": "hospital"},
    "lab_results": {"unit": "unit"},
    "patients": {"gender": "gender", "insurance_type": "payer"},
    "procedures": {"cpt_code": "cpt"},
    "providers": {"department_id": "department"},
}


def one_code(codes: DataFrame) -> DataFrame:
    """One row per domain and code: the smallest id, then the smallest label."""
    best = F.min(F.struct("canonical_id", "label")).alias("best")
    known = codes.filter(F.col("domain").isNotNull() & F.col("code").isNotNull() & F.col("canonical_id").isNotNull())
    return known.groupBy("domain", "code").agg(best).select("domain", "code", "best.*")


def followed(aliases: DataFrame, codes: DataFrame) -> DataFrame:
    """The last value each alias leads to: domain, source_value, target_value.

    Of several targets the smallest counts; a canonical code is no alias, whatever the aliases say. In each round every
    alias jumps to the target of its target, so a chain of n steps takes about log2(n) rounds; each is written. Aliases
    that go in a circle, or lead into one, are left out.
    """
    known = aliases.filter(F.col("domain").isNotNull() & F.col("source_value").isNotNull() & F.col("target_value").isNotNull())
    own = codes.select("domain", F.col("code").alias("source_value"))
    single = known.groupBy("domain", "source_value").agg(F.min("target_value").alias("target_value"))
    steps = written(single.join(own, ["domain", "source_value"], "left_anti"), "aliases")
    rounds = max(1, steps.count()).bit_length()
    onward = lambda: steps.select("domain", F.col("source_value").alias("target_value"), F.col("target_value").alias("onward"))
    for _ in range(rounds):
        jumped = steps.join(onward(), ["domain", "target_value"], "left")
        longer = written(jumped.select("domain", "source_value", F.coalesce("onward", "target_value").alias("target_value"), F.col("onward").isNotNull().alias("moved")), "aliases")
        moved = longer.filter("moved").limit(1).count()
        steps = longer.drop("moved")
        if not moved:
            return steps
    return steps.join(onward().select("domain", "target_value"), ["domain", "target_value"], "left_anti").select("domain", "source_value", "target_value")


def combined(codes: DataFrame, aliases: DataFrame) -> DataFrame:
    """All maps as one written table: domain, source_value, canonical_id, label; one row per domain and source value."""
    own = written(one_code(codes), "codes")
    reached = followed(aliases, own).join(own.withColumnRenamed("code", "target_value"), ["domain", "target_value"])
    columns = ["domain", "source_value", "canonical_id", "label"]
    return written(own.withColumnRenamed("code", "source_value").select(columns).unionByName(reached.select(columns)), "lookup")


def conform_entity(df: DataFrame, lookup: DataFrame, domains: Mapping[str, str]) -> DataFrame:
    """Add ``<column>_canonical`` (id) and ``<column>_label`` for each mapped column, and ``unmapped``.

    ``unmapped`` counts the row's values that no map knows; missing values are no values. Rows stay as many as they are.
    """
    kept, unmapped = list(df.columns), F.lit(0)
    for column, domain in domains.items():
        part = lookup.filter(F.col("domain") == domain).select(
            F.col("source_value").alias("_source"), F.col("canonical_id").alias(f"{column}_canonical"), F.col("label").alias(f"{column}_label")
        )
        df = df.join(part, df[column].cast("string") == part["_source"], "left").drop("_source")
        kept += [f"{column}_canonical", f"{column}_label"]
        unmapped = unmapped + (F.col(column).isNotNull() & F.col(f"{column}_canonical").isNull()).cast("int")
    return df.select(*kept, unmapped.alias("unmapped"))


def conformed(entity: str, std: DataFrame, lookup: DataFrame) -> DataFrame:
    """A standardized table with its canonical ids and labels."""
    return conform_entity(std, lookup, ENTITY_DOMAINS[entity])


def conformed_stays(admissions: DataFrame, patients: DataFrame, lookup: DataFrame) -> DataFrame:
    """Conformed stays with the length of stay and the patient's conformed gender and payer.

    The patient side, one row per id, is written first: stays are shuffled at most once, and a patient with very many
    of them, or none, is split.
    """
    columns = ["patient_id", "gender", "insurance_type", "created_date"]
    one = latest_per_key(patients.select(*columns), "patient_id", ("created_date",))
    people = written(conformed("patients", one, lookup).drop("created_date", "unmapped"), "people")
    los = F.datediff("discharge_date_final", "admission_date_final").alias("los_days")
    return conformed("admissions", admissions, lookup).select("*", los).join(people, "patient_id", "left")


def conformed_procedures(procedures: DataFrame, providers: DataFrame, lookup: DataFrame) -> DataFrame:
    """Conformed procedures with the canonical department of their provider."""
    one = latest_per_key(providers.select("provider_id", "department_id"), "provider_id", ("department_id",))
    of = written(conformed("providers", one, lookup).select(
        "provider_id", F.col("department_id_canonical").alias("provider_department"), F.col("department_id_label").alias("provider_department_label")
    ), "providers")
    return conformed("procedures", procedures, lookup).join(of, "provider_id", "left")


def conformed_bills(billing: DataFrame, stays: DataFrame, lookup: DataFrame) -> DataFrame:
    """Conformed bills with the canonical department and payer of their stay. ``stays`` has one row per admission."""
    of = stays.select(
        "admission_id",
        F.col("department_id_canonical").alias("stay_department"),
        F.col("department_id_label").alias("stay_department_label"),
        F.col("insurance_type_canonical").alias("payer"),
        F.col("insurance_type_label").alias("payer_label"),
    )
    return conformed("billing", billing, lookup).join(of, "admission_id", "left")


#: Of a stay's columns, those by which the latest one is told from others of the same dates, in their order. All that
#: follows them in a stay is theirs to decide (labels), or never looked at.
STAY_ORDER = ("admission_date_final", "discharge_date_final")
STAY_IDS = ("patient_id", "admission_date", "hospital_id", "department_id")


def one_stay(stays: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per admission, written: the one with the latest dates.

    ``columns`` names what the caller needs of a stay: dates, ids, and what follows from these (labels, canonical ids,
    length of stay). Only they are computed, shuffled and written, and the same row is chosen.
    """
    if columns is not None:
        names = ("admission_id", *STAY_ORDER, *STAY_IDS)
        stays = stays.select(*names, *[c for c in columns if c not in names])
    latest = latest_per_key(stays, "admission_id", STAY_ORDER)
    return written(latest if columns is None else latest.select("admission_id", *columns), "stays")


# Measures on conformed tables -------------------------------------------------------------------------

UNKNOWN = "Unmapped"

#: What bills, and the measure of departments, take from a stay.
OF_BILLED = ("department_id_canonical", "department_id_label", "insurance_type_canonical", "insurance_type_label")
OF_ACTIVE = (*OF_BILLED, "admission_date_final", "los_days")


def department_activity(stays: DataFrame, procedures: DataFrame, bills: DataFrame) -> DataFrame:
    """Per canonical department and month: stays begun, mean length, procedures of its providers, and amount billed.

    Each table is summed on its own and the sums meet in a union: no join of facts.
    """

    def summed(df: DataFrame, department: str, day: str, **sums) -> DataFrame:
        label = F.coalesce(F.col(department), F.lit(UNKNOWN)).alias("department")
        out = df.groupBy(label, month_of(day).alias("month")).agg(*[c.alias(n) for n, c in sums.items()])
        names = ["stays", "days", "measured", "procedures", "billed"]
        kinds = {"billed": "decimal(38,2)"}
        return out.select("department", "month", *[(F.col(n) if n in sums else F.lit(None)).cast(kinds.get(n, "long")).alias(n) for n in names])

    parts = [
        summed(stays, "department_id_label", "admission_date_final", stays=F.count(F.lit(1)), days=F.sum("los_days"), measured=F.count("los_days")),
        summed(procedures, "provider_department_label", "procedure_date", procedures=F.count(F.lit(1))),
        summed(bills, "stay_department_label", "bill_date", billed=F.sum("total_amount")),
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("department", "month")
    total = both.agg(*[F.sum(n).alias(n) for n in ("stays", "days", "measured", "procedures", "billed")])
    mean = F.round(F.col("days").cast("double") / F.nullif("measured", F.lit(0)), 6)
    return total.select(
        "department",
        "month",
        F.coalesce("stays", F.lit(0)).alias("stays"),
        mean.alias("mean_los"),
        F.coalesce("procedures", F.lit(0)).alias("procedures"),
        F.coalesce("billed", F.lit(0)).cast("decimal(38,2)").alias("billed"),
    )


def payer_amounts(bills: DataFrame) -> DataFrame:
    """Per canonical payer: bills, amount and due, and the share of the whole amount."""
    payer = or_na(F.col("payer_label")).alias("payer")
    sums = bills.groupBy(payer).agg(F.count(F.lit(1)).alias("bills"), F.sum("total_amount").alias("amount"), F.sum("patient_due").alias("due"))
    whole = F.array_agg(F.struct("payer", "bills", "amount", "due")).alias("rows")  # one row per payer
    listed = sums.agg(whole, F.sum("amount").alias("total")).select(F.explode("rows").alias("r"), "total")
    share = F.round(F.col("r.amount").cast("double") / F.nullif("total", F.lit(0)).cast("double"), 6)
    return listed.select(
        "r.payer", "r.bills", F.col("r.amount").cast("decimal(38,2)").alias("amount"), F.col("r.due").cast("decimal(38,2)").alias("due"), share.alias("amount_share")
    )


def unmapped_values(df: DataFrame, domains: Mapping[str, str]) -> DataFrame:
    """The values no map knows, with their rows: domain, source_value, rows. Feeds the next edition of the maps."""
    known = [F.when(F.col(c).isNotNull() & F.col(f"{c}_canonical").isNull(), F.struct(F.lit(d).alias("domain"), F.col(c).cast("string").alias("source_value"))) for c, d in domains.items()]
    found = df.filter("unmapped > 0").select(F.explode(F.filter(F.array(*known), lambda x: x.isNotNull())).alias("v")).select("v.*")
    return found.groupBy("domain", "source_value").agg(F.count(F.lit(1)).alias("rows"))
