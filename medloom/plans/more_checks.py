"""DuckDB queries for the queries of ``more_queries``."""

from __future__ import annotations

from medloom.operators.conformed import ENTITY_DOMAINS
from medloom.operators.deid_linked import POLICY
from medloom.operators.standardize import INPUT_WIDTH, OUTPUT_WIDTHS, PATIENT_WIDTHS, PROCEDURE_WIDTHS, PROVIDER_WIDTHS
from medloom.plans.checks import CPT_MAP, EVENT_COLUMNS, ICD_MAP, ORDER_COLUMNS, _age, _encounter, _sha, health_all
from medloom.plans.checks_std import CHECKS as STD
from medloom.plans.checks_std import PARTS, clean, std, std_patients, token
from medloom.plans.more_queries import DELIVERIES, FIRST_LOAD, SKETCHED_DAYS, SPELLINGS
from medloom.sources.raw import raw_duckdb

# Conformed entities -----------------------------------------------------------------------------------

LOOKUP = f"""(with recursive codes(domain, code, canonical_id, label) as (
    select 'department', r_name, r_regionkey + 100, r_name from region
    union all select 'hospital', cast(r_regionkey as varchar), r_regionkey, r_name from region where r_regionkey < 4
    union all select 'cpt', source_value, cast(source_value as bigint), standard_value from {CPT_MAP} where cast(source_value as bigint) % 7 <> 0
    union all select 'icd', source_value, length(standard_value), standard_value from {ICD_MAP}
    union all values ('gender', 'Male', 1, 'M'), ('gender', 'Female', 0, 'F'), ('unit', 'mg/dL', 0, 'mg_dl'),
      ('payer', 'Government', 1, 'Public'), ('payer', 'Private', 0, 'Commercial'), ('payer', 'Self Pay', 2, 'Self'), ('payer', 'Corporate', 0, 'Commercial'),
      ('payment', 'Paid', 1, 'Settled'), ('payment', 'Pending', 0, 'Open'), ('payment', 'Partial', 0, 'Open'), ('payment', 'Outstanding', 0, 'Open')),
  best as (select distinct on (domain, code) * from codes order by domain, code, canonical_id, label),
  aliases(domain, source_value, target_value) as (
    select 'department', cast(n_nationkey as varchar), case when n_nationkey % 5 = 3 then cast(n_nationkey - 1 as varchar) else r_name end
      from nation join region on n_regionkey = r_regionkey where n_nationkey % 10 <> 7
    union all select 'cpt', lpad(cast(p_partkey as varchar), 5, '0'), lpad(cast(p_partkey // 7 as varchar), 5, '0') from part where p_partkey % 7 = 0 and p_partkey < 100000),
  walk(domain, source_value, goal) as (
    select * from aliases
    union select w.domain, w.source_value, a.target_value from walk w join aliases a on a.domain = w.domain and a.source_value = w.goal)
  select domain, code source_value, cast(canonical_id as bigint) canonical_id, label from best
  union all select w.domain, w.source_value, cast(canonical_id as bigint), label from walk w join best b on b.domain = w.domain and b.code = w.goal)"""


def conformed(entity: str) -> str:
    domains = ENTITY_DOMAINS[entity]
    columns = "".join(f", {c}_m.canonical_id {c}_canonical, {c}_m.label {c}_label" for c in domains)
    unmapped = " + ".join(f"cast(s.{c} is not null and {c}_m.label is null as integer)" for c in domains)
    joins = " ".join(f"left join (select * from {LOOKUP} where domain = '{d}') {c}_m on {c}_m.source_value = cast(s.{c} as varchar)" for c, d in domains.items())
    return f"select s.*{columns}, {unmapped} unmapped from {std(entity)} s {joins}"


def conformed_admissions() -> str:
    return f"""select a.*, date_diff('day', admission_date_final, discharge_date_final) los_days, gender, insurance_type,
        gender_canonical, gender_label, insurance_type_canonical, insurance_type_label
      from ({conformed('admissions')}) a left join ({conformed('patients')}) p on p.patient_id = a.patient_id"""


def conformed_procedures() -> str:
    return f"""select p.*, d.department_id_canonical provider_department, d.department_id_label provider_department_label
      from ({conformed('procedures')}) p left join ({conformed('providers')}) d on d.provider_id = p.provider_id"""


def conformed_billing() -> str:
    return f"""select b.*, s.department_id_canonical stay_department, s.department_id_label stay_department_label,
        s.insurance_type_canonical payer, s.insurance_type_label payer_label
      from ({conformed('billing')}) b left join ({conformed_admissions()}) s on s.admission_id = b.admission_id"""


def kpi_department_activity() -> str:
    month = "cast(date_trunc('month', {}) as date)"
    return f"""with s as (select coalesce(department_id_label, 'Unmapped') department, {month.format('admission_date_final')} "month", count(*) stays, round(avg(los_days), 6) mean_los
        from ({conformed_admissions()}) group by 1, 2),
      p as (select coalesce(provider_department_label, 'Unmapped') department, {month.format('procedure_date')} "month", count(*) procedures from ({conformed_procedures()}) group by 1, 2),
      b as (select coalesce(stay_department_label, 'Unmapped') department, {month.format('bill_date')} "month", sum(total_amount) billed from ({conformed_billing()}) group by 1, 2),
      k as (select department, "month" from s union select department, "month" from p union select department, "month" from b)
      select k.department, k."month", coalesce(stays, 0) stays, mean_los, coalesce(procedures, 0) procedures, cast(coalesce(billed, 0) as decimal(38,2)) billed
      from k left join s on s.department = k.department and s."month" is not distinct from k."month"
        left join p on p.department = k.department and p."month" is not distinct from k."month"
        left join b on b.department = k.department and b."month" is not distinct from k."month" """


def kpi_payer_amounts() -> str:
    return f"""select coalesce(payer_label, 'NA') payer, count(*) bills, cast(sum(total_amount) as decimal(38,2)) amount, cast(sum(patient_due) as decimal(38,2)) due,
        round(cast(sum(total_amount) as double) / cast(sum(sum(total_amount)) over () as double), 6) amount_share
      from ({conformed_billing()}) group by 1"""


def conformed_unmapped() -> str:
    parts = [
        f"select '{e}' entity, '{d}' domain, cast({c} as varchar) source_value, count(*) \"rows\" from ({conformed(e)}) where {c} is not null and {c}_canonical is null group by 3"
        for e, domains in ENTITY_DOMAINS.items()
        for c, d in domains.items()
    ]
    return " union all ".join(parts)


# The patient dimension in versions --------------------------------------------------------------------

_PATIENTS = "patient_id, mrn, gender, blood_group, insurance_type, area, pincode, date_of_birth, created_date"


def dim_patients(last: str) -> str:
    """Of the first load and the updates up to a day, the latest row of each patient."""
    order = ", ".join(f"{c} desc nulls last" for c in ("created_date", "mrn", "gender", "blood_group", "insurance_type", "area", "pincode", "date_of_birth"))
    return f"""select {_PATIENTS} from (select * from {std('patients')} union all
        select * from ({std_patients('raw_patient_updates')}) where cast(created_date as date) <= date '{last}')
      where patient_id is not null qualify row_number() over (partition by patient_id order by {order}) = 1"""


def dim_patients_history() -> str:
    first, second, third = (d.isoformat() for d in DELIVERIES)
    updates = f"(select *, cast(created_date as date) d from ({std_patients('raw_patient_updates')}))"
    written = "(select count(distinct patient_id) from {} where d > date '{}' and d <= date '{}')"
    return f"""select 1 "version", date '{FIRST_LOAD}' "day", 0 changes, (select count(distinct patient_id) from {std('patients')}) rows_written
      union all select 2, date '{first}', 1, {written.format(updates, '0001-01-01', first)}
      union all select 3, date '{second}', 2, {written.format(updates, first, second)}
      union all select 4, date '{second}', 0, (select count(*) from ({dim_patients(second)}))
      union all select 5, date '{third}', 1, {written.format(updates, second, third)}"""


# Profiles by sketch -----------------------------------------------------------------------------------

def profile_top_values() -> str:
    parts = [
        f"""(select '{t}' table_name, '{c}' column_name, row_number() over (order by count(*) desc, v) place, v "value", count(*) freq
          from (select cast({c} as varchar) v from {t}) where v is not null group by v qualify place <= 5)"""
        for t, columns in (("events", EVENT_COLUMNS), ("orders", ORDER_COLUMNS))
        for c, _ in columns
    ]
    return " union all ".join(parts)


def sketched_days() -> str:
    since, until = SKETCHED_DAYS
    days = f"(select * from events where cast(ts as date) between date '{since}' and date '{until}')"
    return " union all ".join(
        f"select '{c}' column_name, count(*) \"rows\", count(*) - count({c}) nulls, count(distinct {c}) distinct_count, true within_bound from {days}" for c, _ in EVENT_COLUMNS
    )


def profile_case_blind() -> str:
    names = ("gender", "blood_group", "insurance_type", "area")
    listed = ", ".join(names)
    rows = f"with src as (select {listed} from ({raw_duckdb('raw_patients')}) union all select {listed} from ({raw_duckdb('raw_patient_updates')})) "
    return rows + " union all ".join(
        f"""select '{c}' column_name, 'string' data_type, count(*) sample_rows, count(*) - count({c}) null_count,
          cast(round((count(*) - count({c})) * 100.0 / count(*), 2) as decimal(5,2)) null_pct, count(distinct lower(rtrim({c}, ' '))) distinct_count,
          cast(null as varchar) min_value, cast(null as varchar) max_value,
          (select string_agg(v || ' (' || f || ')', ', ' order by f desc, v) from (
            select min({c}) v, count(*) f from src where {c} is not null group by lower(rtrim({c}, ' ')) order by f desc, v limit 5)) sample_values,
          cast(1 as double) sampled_fraction from src"""
        for c in names
    )


# Losses ------------------------------------------------------------------------------------------------

_WIDTHS = {"patients": PATIENT_WIDTHS, "procedures": PROCEDURE_WIDTHS, "providers": PROVIDER_WIDTHS}


def losses_of(entity: str) -> str:
    """Each row with its raw, cleaned and converted columns side by side, then counts over them."""
    STD[entity]()
    names, tokens, final, keys = PARTS[f"raw_{entity}"]
    cleaned = ", ".join(f'{clean(n)} "{n}"' for n in names)
    nulled = ", ".join(f'{token(n, tokens)} "{n}"' for n in names)
    widths = _WIDTHS.get(entity, {})
    gone = " or ".join(f"{k} is null" for k in keys) or "false"
    counts = [("rows", None, "count(*)"), ("dropped", None, f"count(*) filter (where {gone})")]
    for n in names:
        long = f'length(r."{n}") > {widths.get(n, INPUT_WIDTH)}' + (f' or length("{n}") > {OUTPUT_WIDTHS[n]}' if n in OUTPUT_WIDTHS else "")
        counts += [("failed", n, f'count(*) filter (where t."{n}" is not null and "{n}" is null)'), ("cut", n, f"count(*) filter (where {long})")]
    rows = ", ".join(f"{{'a': '{rule}', 'b': {'null' if n is None else repr(n)}, 'c': c{i}}}" for i, (rule, n, _) in enumerate(counts))
    sums = ", ".join(f"{count} c{i}" for i, (_, _, count) in enumerate(counts))
    return f"""select '{entity}' table_name, u.x.a rule, u.x.b column_name, u.x.c n from (
      with raw as ({raw_duckdb(f'raw_{entity}')}), cleaned as materialized (select raw r, {cleaned} from raw), nulled as materialized (select r, {nulled} from cleaned),
        f as materialized (select t, r, {final} from (select nulled t, * from nulled)),
        w as (select {sums} from f)
      select unnest([{rows}]) x from w) u"""


# Guarded joins and linked exports -----------------------------------------------------------------------

def guarded_joins() -> str:
    return " union all ".join(
        f"""select '{e}' join_name, count(*) rows_in, count(*) filter (where a.admission_id is null) keyless, cast(sum(greatest(coalesce(n, 0), 1)) as bigint) rows_out,
          count(*) filter (where n is null) unmatched, count(*) filter (where n > 1) doubled, coalesce(max(n), 0) most_matches
        from {std('admissions')} a left join (select admission_id, count(*) n from {std(e)} where admission_id is not null group by 1) b on b.admission_id = a.admission_id"""
        for e in ("diagnoses", "billing")
    )


def deid_linked(entity: str) -> str:
    shift = f"cast(cast('0x' || left({_sha("('shift|' || d.admission_id)")}, 8) as bigint) % 7 - 3 as integer)"
    shown = {
        "keep": lambda c: f"d.{c} {c}",
        "patient": lambda c: f"{_sha(f'd.{c}')} patient_hash",
        "encounter": lambda c: f"{_encounter(f'd.{c}')} encounter_hash",
        "row": lambda c: f"{_sha(f"('{c}|' || d.{c})")} {c}_hash",
        "shift": lambda c: f"case when allowed then d.{c} + {shift} end {c}_shifted",
    }
    columns = ", ".join(shown[rule](c) for c, rule in POLICY[entity].items())
    return f"""with e as (select admission_id, bool_and(coalesce({_age(20240101)} between 0 and 88, false)) allowed
        from {std('admissions')} a left join {std('patients')} p on p.patient_id = a.patient_id group by 1)
      select {columns} from {std(entity)} d left join e on e.admission_id = d.admission_id"""


# Every spelling of every folded category ------------------------------------------------------------------

# The label of each known spelling, written out here so that a wrong label in the job shows.
LABELS = """
  ('admission_type', 'Emergency', ['EMERGENCY', 'ER', 'E.R', 'TRAUMA']), ('admission_type', 'Urgent', ['URGENT']),
  ('admission_type', 'Elective', ['ELECTIVE', 'PLANNED', 'SCHEDULED', 'ROUTINE']),
  ('admission_type', 'Observation', ['OBSERVATION', 'OBS', 'DAY CARE', 'DAYCARE']),
  ('admission_type', 'Maternity', ['MATERNITY', 'MATERNAL', 'DELIVERY']), ('admission_type', 'Newborn', ['NEWBORN', 'NB']),
  ('admission_type', 'Outpatient', ['OUTPATIENT', 'OP']),
  ('discharge_status', 'Discharged', ['DISCHARGED', 'HOME', 'STANDARD DISCHARGE']),
  ('discharge_status', 'Transferred', ['TRANSFERRED', 'TRANSFER', 'REFERRED', 'MOVED']),
  ('discharge_status', 'Left Against Medical Advice', ['AMA', 'LAMA', 'LEFT AGAINST MEDICAL ADVICE', 'LEFT_AGAINST_MEDICAL_ADVICE']),
  ('discharge_status', 'Expired', ['EXPIRED', 'DECEASED', 'DEAD']), ('discharge_status', 'Pending', ['PENDING', 'IN PROGRESS', 'ONGOING']),
  ('discharge_status', 'Hospice', ['HOSPICE']), ('discharge_status', 'Skilled Nursing Facility', ['SNF', 'SKILLED NURSING']),
  ('discharge_status', 'Rehabilitation', ['REHAB', 'REHABILITATION']),
  ('payment_status', 'Paid', ['PAID']), ('payment_status', 'Pending', ['PENDING']), ('payment_status', 'Partial', ['PARTIAL']),
  ('payment_status', 'Outstanding', ['OUTSTANDING']), ('payment_status', 'Waived', ['WAIVED']),
  ('diagnosis_type', 'Primary', ['PRIMARY']), ('diagnosis_type', 'Secondary', ['SECONDARY']),
  ('blood_group', 'A+', ['A+']), ('blood_group', 'A-', ['A -']), ('blood_group', 'B+', ['B+']), ('blood_group', 'B-', ['B-']),
  ('blood_group', 'AB+', ['AB +']), ('blood_group', 'AB-', ['AB-']), ('blood_group', 'O+', ['O+']), ('blood_group', 'O-', ['O -']),
  ('payer', 'Government', ['GOVERNMENT', 'GOV']), ('payer', 'Private', ['PRIVATE', 'PVT']),
  ('payer', 'Self Pay', ['SELF PAY', 'SELF-PAY', 'SELF  PAY', 'SELF']), ('payer', 'Corporate', ['CORPORATE', 'CORP']),
  ('gender', 'Male', ['M', 'MALE']), ('gender', 'Female', ['F', 'FEMALE']), ('gender', 'Other', ['OTHER', 'O']),
  ('accreditation', 'JCI', ['JCI']), ('accreditation', 'NABH', ['NABH']), ('accreditation', 'None', ['NONE'])
"""


def fold_spellings() -> str:
    dealt = " union all ".join(
        f"""select '{rule}' "rule", o_orderkey k, [{", ".join(f"'{w}'" for w in words)}][o_orderkey % {len(words)} + 1] w from orders""" for rule, words in SPELLINGS.items()
    )
    title = "array_to_string(list_transform(string_split(w, ' '), lambda x: upper(left(x, 1)) || lower(substring(x, 2))), ' ')"
    return f"""with known("rule", label, spellings) as (values {LABELS}),
      spelled as (select "rule", label, unnest(spellings) spelling from known),
      rows_ as (select "rule", case k % 3 when 0 then upper(w) when 1 then w else {title} end "input" from ({dealt})),
      counted as (select "rule", "input", count(*) n from rows_ group by 1, 2)
      select c."rule", c."input", n, case when upper(c."input") in ('NULL', 'N/A', 'TBD', '-') then null when label is not null then label
          when c."rule" in ('admission_type', 'discharge_status') then upper(left(c."input", 1)) || lower(substring(c."input", 2))
          when c."rule" = 'accreditation' then c."input" end label
      from counted c left join spelled s on s."rule" = c."rule" and s.spelling = upper(c."input")"""


CHECKS: dict[str, str] = {
    "conformed_lookup": f"select * from {LOOKUP}",
    "conformed_admissions": conformed_admissions(),
    "conformed_billing": conformed_billing(),
    "conformed_procedures": conformed_procedures(),
    **{f"conformed_{e}": conformed(e) for e in ("departments", "diagnoses", "hospitals", "lab_results", "patients", "providers")},
    "conformed_unmapped": conformed_unmapped(),
    "kpi_department_activity": kpi_department_activity(),
    "kpi_payer_amounts": kpi_payer_amounts(),
    "dim_patients_versions": dim_patients(DELIVERIES[2].isoformat()),
    "dim_patients_as_of": dim_patients(DELIVERIES[0].isoformat()),
    "dim_patients_history": dim_patients_history(),
    "profile_top_values": profile_top_values(),
    "sketched_days": sketched_days(),
    "profile_case_blind": profile_case_blind(),
    "losses": " union all ".join(losses_of(e) for e in STD),
    "health_daily": health_all(),
    "guarded_joins": guarded_joins(),
    **{f"deid_linked_{e}": deid_linked(e) for e in POLICY},
    "fold_spellings": fold_spellings(),
}
