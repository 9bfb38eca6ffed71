"""DuckDB queries for every registered query that SQL can state, over whole tables."""

from __future__ import annotations

import datetime as dt

from medloom.functions import folds as M
from medloom.functions import text as S
from medloom.operators.health import OBJECT_NAMES
from medloom.operators.kpis import CHARGE_PARTS
from medloom.plans import checks_std as C
from medloom.plans.checks_std import std
from medloom.plans.queries import AS_OF, EXAMPLE_SALT, RUN_OBJECTS, RUN_UTC, TABLES
from medloom.sources.raw import raw_duckdb


def _text(value: str) -> str:
    return f"cast({value} as varchar)"


# Health ---------------------------------------------------------------------------------------------

def _window(entity: str, column: str, days: int) -> str:
    return f"cast({column} as date) >= date '{AS_OF[entity]}' - {days}"


def _sum(condition: str, value: str, kind: str) -> str:
    return f"coalesce(sum(case when {condition} then coalesce(try_cast({value} as {kind}), 0) else 0 end), 0)"


def _mean(condition: str, value: str, kind: str) -> str:
    value = f"try_cast({value} as {kind})"
    n = f"count(*) filter (where {condition} and {value} is not null)"
    total = f"sum({value}) filter (where {condition})"
    return f"cast(case when {n} > 0 then round(cast({total} as double) / {n}, 6) else 0 end as decimal(38,6))"


def _metrics() -> dict[str, list[tuple[str, str, str]]]:
    w = {
        "patients": _window("patients", "created_date", 30),
        "admissions": _window("admissions", "admission_date", 30),
        "billing": _window("billing", "bill_date", 30),
        "diagnoses": _window("diagnoses", "diagnosis_date", 90),
        "procedures": _window("procedures", "procedure_date", 90),
        "lab_results": _window("lab_results", "test_date", 30),
    }

    def count(condition: str) -> str:
        return f"count(*) filter (where {condition})"

    rows = ("rowcount_metadata", "count(*)", "bigint")
    return {
        "patients": [
            rows,
            ("rows_last_30d", count(w["patients"]), "bigint"),
            ("null_gender_last_30d", count(f"{w['patients']} and (gender is null or gender in ('Unknown', 'NA'))"), "bigint"),
        ],
        "admissions": [
            rows,
            ("admissions_last_30d", count(w["admissions"]), "bigint"),
            ("avg_los_last_30d", _mean(w["admissions"], "length_of_stay", "decimal(18,4)"), "decimal"),
        ],
        "billing": [
            rows,
            ("total_amount_last_30d", f"cast({_sum(w['billing'], 'total_amount', 'decimal(19,4)')} as decimal(38,4))", "decimal"),
            ("patient_due_last_30d", f"cast({_sum(w['billing'], 'patient_due', 'decimal(19,4)')} as decimal(38,4))", "decimal"),
        ],
        "diagnoses": [
            rows,
            ("diagnoses_last_90d", count(w["diagnoses"]), "bigint"),
            ("null_icd_last_90d", count(f"{w['diagnoses']} and icd_code is null"), "bigint"),
        ],
        "procedures": [
            rows,
            ("procedures_last_90d", count(w["procedures"]), "bigint"),
            ("null_cpt_last_90d", count(f"{w['procedures']} and cpt_code is null"), "bigint"),
        ],
        "lab_results": [
            rows,
            ("lab_results_last_30d", count(w["lab_results"]), "bigint"),
            ("avg_result_value_last_30d", _mean(w["lab_results"], "result_value", "decimal(18,6)"), "decimal"),
        ],
        "providers": [
            rows,
            ("active_providers", "count(*)", "bigint"),
            ("avg_experience_ge5", _mean("years_experience >= 5", "years_experience", "decimal(18,2)"), "decimal"),
        ],
        "departments": [
            rows,
            ("high_occupancy_units", count("avg_occupancy >= 0.85"), "bigint"),
            ("beds_high_occupancy", "cast(" + _sum("avg_occupancy >= 0.85", "bed_count", "bigint") + " as bigint)", "bigint"),
        ],
        "hospitals": [
            rows,
            ("beds_total", "cast(coalesce(sum(cast(total_beds as bigint)), 0) as bigint)", "bigint"),
            ("avg_icu_pct_recent", _mean("true", "icu_percentage", "decimal(5,2)"), "decimal"),
        ],
    }


def health(entity: str) -> str:
    metrics = _metrics()[entity]
    aggregates = ", ".join(f"{expr} {name}" for name, expr, _ in metrics)
    rows = " union all ".join(
        f"select '{OBJECT_NAMES[entity]}' object_name, '{name}' metric, round(cast({name} as double), 6) value_num, "
        f"{_text(name)} value_text, '{kind}' value_type from m"
        for name, _, kind in metrics
    )
    return f"with m as (select {aggregates} from {std(entity)}) {rows}"


def health_all() -> str:
    return " union all ".join(f"select * from ({health(e)})" for e in OBJECT_NAMES)


def metrics_append() -> str:
    def run(name: str, day: int) -> str:
        at = RUN_UTC + dt.timedelta(days=day)
        return (
            f"select *, timestamp '{at}' run_utc, '{name}' run_id, date '{at.date()}' run_date from ({health_all()})"
        )

    return f"{run('run-a', 0)} union all {run('run-b', 1)}"


def metrics_run_read() -> str:
    return (
        "select run_id, object_name, metric, value_num, value_text, value_type, run_utc "
        f"from ({raw_duckdb('old_metric_log')}) where run_id = 'run-7'"
    )


def metrics_backfill() -> str:
    return (
        "select object_name, metric, value_num, value_text, value_type, run_utc, "
        "coalesce(run_id, sha256(object_name||'|'||metric||'|'||value_text||'|'||strftime(run_utc, '%Y-%m-%d %H:%M:%S.%f'))) run_id, "
        f"run_date from ({raw_duckdb('old_metric_log')})"
    )


# Catalog and profile --------------------------------------------------------------------------------

def table_rowcounts() -> str:
    return " union all ".join(
        f"select 'main' table_schema, '{t}' table_name, count(*) row_count from {t}" for t in TABLES
    )


def profile(source: str, columns: list[tuple[str, str]], where: str = "", fraction: float = 1.0) -> str:
    """``columns`` are (name, Spark type name)."""
    parts = []
    for name, kind in columns:
        ranged = kind in ("bigint", "int", "double", "boolean") or kind.startswith(("date", "timestamp"))
        shown = f"cast({name} as integer)" if kind == "boolean" else name
        low, high = (_text(f"min({shown})"), _text(f"max({shown})")) if ranged else ("cast(null as varchar)",) * 2
        parts.append(
            f"""select '{name}' column_name, '{kind}' data_type, count(*) sample_rows,
              count(*) - count({name}) null_count,
              cast(round((count(*) - count({name})) * 100.0 / count(*), 2) as decimal(5,2)) null_pct,
              count(distinct {name}) distinct_count, {low} min_value, {high} max_value,
              (select string_agg(v || ' (' || f || ')', ', ' order by f desc, v) from (
                 select {_text(shown)} v, count(*) f from src where {name} is not null group by 1
                 order by f desc, v limit 5)) sample_values, cast({fraction} as double) sampled_fraction
            from src"""
        )
    return f"with src as (select * from {source} {where}) " + " union all ".join(parts)


ORDER_COLUMNS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
]
EVENT_COLUMNS = [
    ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"),
    ("props", "string"),
]
STAY_COLUMNS = [
    ("admission_id", "int"), ("admission_date", "date"), ("patient_id", "int"), ("hospital_id", "int"),
    ("department_id", "int"), ("discharge_date", "date"), ("admission_type", "string"), ("discharge_status", "string"),
    ("length_of_stay", "int"), ("room_number", "string"), ("attending_physician", "string"),
    ("admission_date_imputed", "date"), ("discharge_date_imputed", "date"), ("is_admission_date_imputed", "boolean"),
    ("is_discharge_date_imputed", "boolean"), ("admission_date_final", "date"), ("discharge_date_final", "date"),
]


def profile_sampled() -> str:
    bucket = "cast('0x' || left(md5(cast(o_orderkey as varchar)), 8) as bigint)"
    return profile("orders", ORDER_COLUMNS, f"where {bucket} < cast(floor(4294967296 * 0.1) as bigint)", 0.1)


# Run log --------------------------------------------------------------------------------------------

def latest_run_stats() -> str:
    objects = ", ".join(f"('{o}')" for o in RUN_OBJECTS)
    return f"""with objects(object_name) as (values {objects}),
      hits as (select o.object_name, l.* exclude (object_name) from objects o join ({raw_duckdb('run_log')}) l
        on l.query_text like '%;obj:' || o.object_name || '*/%' or l.query_text like '%from ' || o.object_name || '%'),
      latest as (select * from hits qualify row_number() over (partition by object_name order by ended_at desc, log_id desc) = 1),
      means as (select object_name, sum(cpu_us) / count(*) c, sum(duration_us) / count(*) d, sum(reads) / count(*) r,
        sum(executions) n from hits group by 1)
      select o.object_name, 'timing:sample_recent' metric,
        case when l.log_id is null then 'cpu_ms=NULL|elapsed_ms=7|logical_reads=NULL' else
          'cpu_ms=' || cast(cpu_us // 1000 as varchar) || '|elapsed_ms=' || cast(duration_us // 1000 as varchar)
          || '|logical_reads=' || cast(reads as varchar) end value_text
      from objects o left join latest l using (object_name)
      union all
      select object_name, 'timing:recent_aggregate', 'cpu_ms=' || cast(cast(floor(c / 1000) as bigint) as varchar)
        || '|elapsed_ms=' || cast(cast(floor(d / 1000) as bigint) as varchar) || '|logical_reads='
        || cast(cast(floor(r) as bigint) as varchar) || '|exec_count=' || cast(n as varchar)
      from means"""


# Single rules ---------------------------------------------------------------------------------------

def rule(raw: str, column: str, expr: str, alias: str, tokens=S.COMMON_TOKENS) -> str:
    return (
        f"with c as (select {C.clean(column)} v from ({raw_duckdb(raw)})), "
        f"t as (select {C.token('v', tokens)} v from c) "
        f"select v as input, {expr} as {alias}, count(*) n from t group by all"
    )


# Measures -------------------------------------------------------------------------------------------

def kpi_los_monthly() -> str:
    return f"""with s as (select date_trunc('month', admission_date_final)::date m,
        discharge_date_final - admission_date_final los from {std('admissions')}
        where admission_date_final is not null and discharge_date_final is not null),
      g as (select m, count(*) n, round(avg(los), 6) mean, quantile_cont(los::double, 0.5) med from s group by 1)
      select g.m admission_month, g.n admissions, g.mean mean_los_days, g.med median_los_days,
        g.n - p.n change_on_prior_month from g left join g p on p.m = (g.m - interval 1 month)::date"""


def kpi_occupancy() -> str:
    return f"""with s as (select department_id, admission_date_final a,
        coalesce(discharge_date_final, date '{AS_OF['admissions']}') d from {std('admissions')}
        where department_id is not null and coalesce(discharge_date_final, date '{AS_OF['admissions']}') > admission_date_final),
      e as (select department_id, a, d,
        unnest(generate_series(date_trunc('month', a), date_trunc('month', d - 1), interval 1 month))::date m from s),
      p as (select department_id, m,
        sum(least(d, (m + interval 1 month)::date) - greatest(a, m)) as n_days from e group by 1, 2),
      b as (select department_id, sum(bed_count) beds from {std('departments')} group by 1)
      select cast(p.department_id as integer) department_id, m as "month", cast(n_days as bigint) patient_days,
        cast(beds as bigint) beds, round(cast(n_days as double) / nullif(beds * day(last_day(m)), 0), 6) occupancy
      from p left join b using (department_id) where n_days > 0"""


def kpi_revenue_tieout() -> str:
    parts = " + ".join(f"coalesce({c}, 0)" for c in CHARGE_PARTS)
    return f"""with a as (select distinct admission_id, true known from {std('admissions')}),
      b as (select *, date_trunc('month', bill_date)::date m from {std('billing')})
      select m bill_month, count(*) bills, count(distinct admission_id) filter (where known) admissions,
        cast(sum(coalesce(total_amount, 0)) as decimal(38,2)) billed,
        cast(sum(coalesce(insurance_coverage, 0)) as decimal(38,2)) covered,
        cast(sum(coalesce(patient_due, 0)) as decimal(38,2)) due,
        cast(sum(coalesce(total_amount, 0) - coalesce(insurance_coverage, 0) - coalesce(patient_due, 0)) as decimal(38,2)) paid,
        count(*) filter (where abs(coalesce(total_amount, 0) - ({parts})) > 0.01) mismatched_bills,
        round(cast(sum(total_amount) filter (where known) as double)
          / count(distinct admission_id) filter (where known), 6) revenue_per_admission
      from b left join a using (admission_id) group by 1"""


def kpi_payer_mix() -> str:
    return f"""with x as (select date_trunc('month', bill_date)::date m, coalesce(p.insurance_type, 'Unknown') t,
        sum(total_amount) amount
      from {std('billing')} b left join {std('admissions')} a using (admission_id)
        left join {std('patients')} p on p.patient_id = a.patient_id
      group by all)
      select m bill_month, t insurance_type, cast(amount as decimal(38,2)) amount,
        round(cast(amount as double) / cast(sum(amount) over (partition by m) as double), 6) share from x"""


def kpi_top_codes() -> str:
    return f"""with c as (select 'ICD' s, icd_code code from {std('diagnoses')} union all
        select 'CPT', cpt_code from {std('procedures')}),
      g as (select s, code, count(*) n from c where code is not null group by all),
      r as (select s, code, n, row_number() over w place, sum(n) over (partition by s) total,
        sum(n) over (partition by s order by n desc, code rows unbounded preceding) running
        from g window w as (partition by s order by n desc, code))
      select s code_system, code, n, cast(place as integer) place, round(n / total, 6) share,
        round(running / total, 6) running_share from r where n >= 11"""


def kpi_readmit_30d() -> str:
    return f"""with s as (select *, lead(admission_date_final) over (partition by patient_id
          order by admission_date_final, admission_id, discharge_date_final nulls first) next_day
        from {std('admissions')} where patient_id is not null and admission_date_final is not null)
      select date_trunc('month', discharge_date_final)::date discharge_month, count(*) index_discharges,
        count(*) filter (where next_day - discharge_date_final between 0 and 30) readmissions,
        round(cast(count(*) filter (where next_day - discharge_date_final between 0 and 30) as double) / count(*), 6)
          readmission_rate
      from s where discharge_date_final is not null and discharge_status <> 'Expired' group by 1"""


def kpi_labs() -> str:
    return f"""with a as (select admission_id, min(admission_date_final) begun from {std('admissions')} group by 1)
      select test_name, count(*) results, round(count(result_value) / count(*), 6) completion_rate,
        count(test_date - begun) timed_results,
        quantile_cont(cast(test_date - begun as double), 0.5) median_wait_days,
        round(avg(test_date - begun), 6) mean_wait_days
      from {std('lab_results')} left join a using (admission_id) group by 1"""


# Conformance, de-identification, guards -------------------------------------------------------------

DEPARTMENT_MAP = f"""(select {C.sentence('n_name')} source_value, r_name standard_value
    from nation join region on n_regionkey = r_regionkey)"""
CPT_MAP = """(select case when p_partkey < 10000 then lpad(cast(p_partkey as varchar), 5, '0') else cast(p_partkey as varchar) end
    source_value, p_brand standard_value from part)"""
ICD_MAP = """(select chr(cast(65 + p_partkey % 26 as integer)) || lpad(cast(p_partkey % 100 as varchar), 2, '0')
    || cast(p_partkey % 10 as varchar) source_value, p_type standard_value from part)"""
GENDER_MAP = "(values ('Male', 'M'), ('Female', 'F'))"
PAYER_MAP = "(values ('Government', 'Public'), ('Private', 'Commercial'), ('Self Pay', 'Self'), ('Corporate', 'Commercial'))"
UNIT_MAP = "(values ('mg/dL', 'mg_dl'))"


def conformed(entity: str, key: str, column: str, lookup: str) -> str:
    return f"""with m(source_value, standard_value) as (select * from {lookup}),
      one as (select source_value, min(standard_value) standard_value from m group by 1)
      select {key}, {column}, case when {column} is null then null
        else coalesce(standard_value, 'Unmapped') end {column}_conformed
      from {std(entity)} left join one on source_value = {column}"""


def conform_unmapped() -> str:
    return " union all ".join(
        f"""select '{c}' column_name, count({c}) rows_with_value,
          count(*) filter (where {c} is not null and {c} not in (select col0 from {m})) unmapped from {std('patients')}"""
        for c, m in (("gender", GENDER_MAP), ("insurance_type", PAYER_MAP))
    )


def _sha(value: str) -> str:
    return f"sha256(cast({value} as varchar) || '{EXAMPLE_SALT}')"


def _encounter(value: str) -> str:
    return _sha(f"('encounter|' || {value})")


def _age(today: int) -> str:
    return f"(({today} - (year(date_of_birth) * 10000 + month(date_of_birth) * 100 + day(date_of_birth))) // 10000)"


def _band(age: str) -> str:
    return (
        f"case when {age} is null or {age} < 0 then 'Unknown' when {age} >= 89 then '90+' when {age} >= 80 then '80-88' "
        f"else cast({age} // 10 * 10 as varchar) || '-' || cast({age} // 10 * 10 + 9 as varchar) end"
    )


def _allowed(day: str, age: str) -> str:
    return f"case when {age} between 0 and 88 then {day} end"


def _month(day: str) -> str:
    return f"date_trunc('month', {day})::date"


def deid_shift() -> str:
    number = f"(cast('0x' || left({_sha("('shift|' || admission_id)")}, 8) as bigint) % 7 - 3)"
    return f"""select {_encounter('admission_id')} encounter_hash, admission_date_final + cast({number} as integer) admission_day,
        discharge_date_final + cast({number} as integer) discharge_day from {std('admissions')}"""


def deid_age_band() -> str:
    age = _age(20240101)
    return f"""select {_sha('patient_id')} patient_hash, {_band(age)} age_band,
        {_allowed('cast(created_date as date)', age)} created_day from {std('patients')}"""


def deid_export() -> str:
    age = _age(20240101)
    return f"""select {_sha('a.patient_id')} patient_id_hash, {_encounter('admission_id')} admission_id_hash, hospital_id,
        department_id, admission_type, discharge_status, gender, insurance_type, left(pincode, 3) pincode_zip3,
        {_band(age)} age_band, {_allowed(_month('admission_date_final'), age)} admission_date_final_month,
        {_allowed(_month('discharge_date_final'), age)} discharge_date_final_month, length_of_stay
      from {std('admissions')} a left join {std('patients')} p on p.patient_id = a.patient_id"""


def suppress_small() -> str:
    return f"""with g as (select payment_status, {_month('bill_date')} bill_month, count(*) n,
        cast(sum(total_amount) as decimal(38,2)) amount from {std('billing')} group by all)
      select payment_status, bill_month, case when n >= 11 then n end n, case when n >= 11 then amount end amount from g"""


def dim_patients_latest() -> str:
    return f"""select * from (select * from {std('patients')} union all select * from ({C.std_patients('raw_patient_updates')}))
      where patient_id is not null
      qualify row_number() over (partition by patient_id order by created_date desc nulls last, mrn desc nulls last,
        gender desc nulls last, blood_group desc nulls last, insurance_type desc nulls last, area desc nulls last,
        pincode desc nulls last, date_of_birth desc nulls last) = 1"""


CHECKS: dict[str, str] = {
    **{f"std_{e}": C.CHECKS[e]() for e in C.CHECKS},
    **{f"health_{e}": health(e) for e in OBJECT_NAMES},
    "health_all": health_all(),
    "publish_views": f"""select admission_type, count(*) bills, cast(sum(total_amount) as decimal(38,2)) amount
        from {std('billing')} b join {std('admissions')} a on a.admission_id = b.admission_id group by 1""",
    "table_rowcounts": table_rowcounts(),
    "profile_orders": profile("orders", ORDER_COLUMNS),
    "profile_events": profile("events", EVENT_COLUMNS),
    "profile_admissions": profile(std("admissions"), STAY_COLUMNS),
    "profile_sampled": profile_sampled(),
    "metrics_append": metrics_append(),
    "metrics_run_read": metrics_run_read(),
    "metrics_backfill": metrics_backfill(),
    "latest_run_stats": latest_run_stats(),
    "semi_exists": f"select * from {std('admissions')} where admission_id in (select admission_id from {std('lab_results')})",
    "preview": f"select * from {std('admissions')} order by admission_date nulls first, admission_id limit 25",
    "listagg_top": f"""with g as (select diagnosis_type, icd_code, count(*) f from {std('diagnoses')}
        where icd_code is not null group by 1, 2 qualify row_number() over (partition by diagnosis_type order by f desc, icd_code) <= 5)
      select diagnosis_type, string_agg(icd_code || ' (' || f || ')', ', ' order by f desc, icd_code) top_codes from g group by 1""",
    "export_csv": f"select test_name, {_text('results')} results, {_text('timed_results')} timed_results from ({kpi_labs()})",
    "fold_admission_type": rule(
        "raw_admissions", "admission_type", C.mapped("v", M.ADMISSION_TYPES, C.sentence("v")), "label"
    ),
    "fold_discharge_status": rule(
        "raw_admissions", "discharge_status", C.mapped("v", M.DISCHARGE_STATUSES, C.sentence("v")), "label"
    ),
    "fold_payment_status": rule("raw_billing", "payment_status", C.mapped("v", M.PAYMENT_STATUSES), "label"),
    "fold_diagnosis_type": rule("raw_diagnoses", "diagnosis_type", C.mapped("v", M.DIAGNOSIS_TYPES), "label"),
    "fold_payer": rule("raw_patients", "insurance_type", C.payer("v"), "label", S.PATIENT_TOKENS),
    "fold_blood_group": rule("raw_patients", "blood_group", C.blood_group("v"), "label", S.PATIENT_TOKENS),
    "fold_gender": rule("raw_patients", "gender", C.gender("v"), "label", S.PATIENT_TOKENS),
    "fold_accreditation": rule(
        "raw_hospitals", "accreditation", C.mapped("v", M.ACCREDITATIONS, "v"), "label"
    ),
    "valid_icd": rule("raw_diagnoses", "icd_code", C.icd("v"), "code"),
    "valid_cpt": rule("raw_procedures", "cpt_code", C.cpt("v"), "code", S.PROCEDURE_TOKENS),
    "valid_pincode": rule("raw_patients", "pincode", C.pincode("v"), "code", S.PATIENT_TOKENS),
    "title_name": rule("raw_providers", "name", C.title("v", True), "title", S.PROVIDER_TOKENS),
    "title_specialty": rule("raw_providers", "specialty", C.title("v", False), "title", S.PROVIDER_TOKENS),
    "title_description": rule(
        "raw_procedures", "procedure_description", C.description("v"), "title", S.PROCEDURE_TOKENS
    ),
    "parse_dates_stay": rule("raw_admissions", "admission_date", C.day(C.dashed("v"), C.STAY), "parsed"),
    "parse_dates_diagnosis": rule(
        "raw_diagnoses", "diagnosis_date", C.day(C.dashed("v"), ["ymd", "ymd_time", "dmy", "mdy", "dmy2", "mdy2"]), "parsed"
    ),
    "parse_dates_test": rule(
        "raw_lab_results", "test_date", C.day(C.dashed("v"), ["ymd", "dmy", "mdy"]), "parsed", S.LAB_TOKENS
    ),
    "parse_dates_birth": rule(
        "raw_patients", "date_of_birth", C.day(C.dashed("v"), ["ymd", "compact", "mdy", "dmy"]), "parsed",
        S.PATIENT_TOKENS,
    ),
    "parse_dates_procedure": rule(
        "raw_procedures", "procedure_date", C.day(C.dashed("v"), ["ymd", "ymd_iso", "compact", "mdy", "dmy", "mon"]), "parsed",
        S.PROCEDURE_TOKENS,
    ),
    "parse_dates_created": rule(
        "raw_patients", "created_date", C.created("v"), "parsed", S.PATIENT_TOKENS
    ),
    "kpi_los_monthly": kpi_los_monthly(),
    "kpi_occupancy": kpi_occupancy(),
    "kpi_revenue_tieout": kpi_revenue_tieout(),
    "kpi_payer_mix": kpi_payer_mix(),
    "kpi_top_codes": kpi_top_codes(),
    "kpi_readmit_30d": kpi_readmit_30d(),
    "kpi_labs": kpi_labs(),
    "conform_gender": conformed("patients", "patient_id", "gender", GENDER_MAP),
    "conform_payer": conformed("patients", "patient_id", "insurance_type", PAYER_MAP),
    "conform_unit": conformed("lab_results", "lab_result_id", "unit", UNIT_MAP),
    "conform_department": conformed("departments", "department_id", "dept_name", DEPARTMENT_MAP),
    "conform_cpt": conformed("procedures", "procedure_id", "cpt_code", CPT_MAP),
    "conform_icd": conformed("diagnoses", "diagnosis_id", "icd_code", ICD_MAP),
    "conform_unmapped": conform_unmapped(),
    "deid_hash": f"""select {_sha('patient_id')} patient_hash, {_encounter('admission_id')} encounter_hash, length_of_stay
        from {std('admissions')}""",
    "deid_month": f"""select {_month('admission_date_final')} admission_month, {_month('discharge_date_final')} discharge_month,
        count(*) stays from {std('admissions')} group by all""",
    "deid_shift": deid_shift(),
    "deid_age_band": deid_age_band(),
    "deid_export": deid_export(),
    "suppress_small": suppress_small(),
    "dup_key_check": f"select diagnosis_id, count(*) \"rows\" from {std('diagnoses')} group by 1 having count(*) > 1",
    "exclude_test_rows": f"""select * from {std('admissions')} a where discharge_status <> 'Left Against Medical Advice'
        and not exists (select 1 from customer where c_acctbal < 0 and c_custkey = a.patient_id)""",
    "dim_patients_latest": dim_patients_latest(),
    "stay_quality": f"""select admission_type, count(*) stays, count(*) filter (where length_of_stay < 0) negative_length,
        count(*) filter (where discharge_date_final < admission_date_final) ends_before_begin,
        count(*) filter (where is_admission_date_imputed) imputed_admissions,
        count(*) filter (where is_discharge_date_imputed) imputed_discharges from {std('admissions')} group by 1""",
}
