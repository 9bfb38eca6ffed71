"""Raw hospital tables derived from the test tables.

Each text runs unchanged in Spark and DuckDB, so one text feeds both a job and its check. A table to
read from is written in braces. All output columns are text, apart from the two log tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medloom.sources.tables import table

RAW_SQL = {
    "raw_admissions": (
        "orders",
        """
with b as (select o_orderkey k, o_custkey c, o_orderstatus s, cast(year(o_orderdate) as string) y,
  lpad(cast(month(o_orderdate) as string),2,'0') m, lpad(cast(day(o_orderdate) as string),2,'0') d,
  substring('JanFebMarAprMayJunJulAugSepOctNovDec', month(o_orderdate)*3-2, 3) mon,
  cast(o_orderdate as date) + cast(o_orderkey % 15 as int) e from {orders})
select case k % 101 when 0 then '-' else cast(k as string) end admission_id,
  case k % 9 when 0 then 'N/A' when 1 then y||'/'||m||'/'||d when 2 then y||m||d when 3 then m||'/'||d||'/'||y
    when 4 then d||'/'||m||'/'||y when 5 then mon||' '||d||', '||y when 6 then chr(9)||y||'-'||m||'-'||d||' 10:11:12'
    when 7 then d||'-'||m||'-'||y else y||'-'||m||'-'||d end admission_date,
  cast(c as string) patient_id, cast(k % 5 as string) hospital_id, cast(k % 25 as string) department_id,
  case k % 7 when 0 then 'tbd' else cast(e as string) end discharge_date,
  case k % 8 when 0 then 'er' when 1 then 'Day Care' when 2 then 'PLANNED' when 3 then 'walk-in' when 4 then 'OP'
    when 5 then '' when 6 then 'E.R.' else 'newborn' end admission_type,
  case s when 'F' then 'HOME' when 'O' then 'in progress' else 'lama' end discharge_status,
  case k % 11 when 0 then 'x' else cast(k % 15 as string) end length_of_stay,
  case k % 13 when 0 then null else ' r-'||cast(k % 400 as string)||'b' end room_number,
  case k % 6 when 0 then 'dr. john SMITH' when 1 then 'Dr Jane' when 2 then 'Drake' when 3 then 'DR.' else 'ann LEE' end attending_physician
from b
""",
    ),
    "raw_billing": (
        "orders",
        """
with b as (select o_orderkey k, cast(o_totalprice as decimal(18,2)) t, cast(o_orderdate as date) d from {orders})
select case k % 103 when 0 then 'NULL' else cast(k as string) end bill_id, cast(k as string) admission_id,
  case k % 19 when 0 then 'pending' else cast(d as string) end bill_date, case k % 4 when 0 then 'TBD' else cast(d + cast(k % 60 as int) as string) end payment_date,
  case k % 6 when 0 then 'paid' when 1 then 'PENDING' when 2 then 'partial' when 3 then 'waived' when 4 then 'other' else 'Outstanding' end payment_status,
  case k % 17 when 0 then '1E3' else '1,'||lpad(cast(k % 1000 as string),3,'0')||'.50' end doctor_fees,
  cast(t as string) insurance_coverage, ' '||cast(k % 500 as string)||' ' lab_charges, '-' nursing_charges,
  cast(k % 300 as string)||'.125' pharmacy_charges, '1 000' procedure_charges, cast(k % 900 as string) room_charges,
  cast(t as string) total_amount, case when k % 5 = 0 then 'N/A' when k % 1013 = 7 then '9999999999999999.99' else cast(k % 777 as string)||'.10' end patient_due
from b
""",
    ),
    "raw_departments": (
        "nation",
        """
select cast(n_nationkey as string) department_id, cast(n_regionkey as string) hospital_id, lower(n_name) dept_name,
  'dr head '||cast(n_nationkey as string) hod, case n_nationkey % 9 when 0 then 'TBD' else cast(n_nationkey*24 as string) end bed_count,
  '0.'||lpad(cast((n_nationkey*37) % 100 as string),2,'0') avg_occupancy
from {nation}
""",
    ),
    "raw_diagnoses": (
        "lineitem",
        """
with b as (select l_orderkey o, l_linenumber n, l_orderkey*10+l_linenumber k, l_partkey p, cast(year(l_shipdate) as string) y,
  lpad(cast(month(l_shipdate) as string),2,'0') m, lpad(cast(day(l_shipdate) as string),2,'0') d from {lineitem})
select cast(k as string) diagnosis_id, cast(o as string) admission_id,
  case k % 6 when 0 then d||'/'||m||'/'||y when 1 then d||case k % 5 when 0 then '   -   ' else '-' end||m||' - '||substring(y,3,2) when 2 then y||'-'||m||'-'||d
    when 3 then m||'-'||d||'-'||y when 4 then '-' else y||'/'||m||'/'||d end diagnosis_date,
  case p % 7 when 0 then 'A1B2' when 1 then 'a'||lpad(cast(p % 100 as string),2,'0')||'.'||cast(p % 10 as string)
    when 2 then 'B12-3' else chr(65+cast(p % 26 as int))||lpad(cast(p % 100 as string),2,'0')||cast(p % 10 as string) end icd_code,
  case n % 3 when 0 then 'primary' when 1 then 'SECONDARY' else 'other' end diagnosis_type,
  'note   of '||chr(9)||cast(p as string) diagnosis_description
from b
""",
    ),
    "raw_hospitals": (
        "region",
        """
select cast(r_regionkey as string) hospital_id, lower(r_name)||' GENERAL' hospital_name, r_name branch_location,
  '1,'||lpad(cast(r_regionkey*7 as string),3,'0') total_beds, cast(r_regionkey*64 as string) ICU_bed_breakdown,
  '200' General_bed_breakdown, '-1' Private_bed_breakdown, 'n/a' Semi_Private_bed_breakdown,
  cast(r_regionkey as string)||'2.345' icu_percentage, cast(1950+r_regionkey as string) established_year,
  case r_regionkey % 4 when 0 then 'jci' when 1 then 'NONE' when 2 then 'Nabh' else 'Iso 9' end accreditation
from {region}
""",
    ),
    "raw_lab_results": (
        "events",
        """
with b as (select event_id k, user_id u, event_type t, cast(value as decimal(18,2)) v, cast(year(ts) as string) y,
  lpad(cast(month(ts) as string),2,'0') m, lpad(cast(day(ts) as string),2,'0') d from {events})
select cast(k as string) lab_result_id, case u % 19 when 0 then 'See Attached' else cast(u as string) end admission_id,
  case k % 5 when 0 then d||'/'||m||'/'||y when 1 then m||'-'||d||'-'||y when 2 then 'See Attached' when 3 then y||'/'||m||'/'||d
    else y||'-'||m||'-'||d end test_date,
  t||'    panel' test_name, case when k % 8 = 0 then 'see attached' when k % 1009 = 5 then '99999999999999.5' else cast(v as string) end result_value,
  case k % 3 when 0 then 'mg/dL' when 1 then '-' else 'mmol' end unit, '3.5 - '||cast(k % 9 as string)||'.0' reference_range,
  case k % 4 when 0 then 'h' when 1 then 'NORMAL' when 2 then 'low' else '' end status, 'tech '||cast(u as string) lab_technician
from b
""",
    ),
    "raw_patients": (
        "customer",
        """
with b as (select c_custkey k, c_name n, c_mktsegment g from {customer})
select case k % 97 when 0 then 'Unknown' else cast(k as string) end patient_id, n mrn,
  case k % 6 when 0 then 'm' when 1 then 'Female' when 2 then 'O' when 3 then '—' when 4 then 'x' else 'F' end gender,
  case k % 5 when 0 then 'a +' when 1 then 'O-' when 2 then 'ab+' when 3 then 'none' else 'C+' end blood_group,
  case g when 'BUILDING' then 'gov' when 'MACHINERY' then 'self-pay' when 'FURNITURE' then 'PVT' when 'HOUSEHOLD' then 'corp' else 'other' end insurance_type,
  'North   '||lower(g) area, case k % 4 when 0 then '560 '||lpad(cast(k % 1000 as string),3,'0') when 1 then '012345' when 2 then '12345' else '1,23,456' end pincode,
  case k % 4 when 0 then '1980-01-1'||cast(k % 10 as string) when 1 then '19700203' when 2 then '03/04/1965' else '25/12/1930' end date_of_birth,
  case k % 4 when 0 then '2001-07-20 08:09:10' when 1 then '2001-07-01T08:09:10' when 2 then '2001-05-01' else 'not provided' end created_date
from b
""",
    ),
    "raw_procedures": (
        "lineitem",
        """
with b as (select l_orderkey o, l_linenumber n, l_orderkey*10+l_linenumber k, l_partkey p, l_suppkey s, cast(l_extendedprice as decimal(18,2)) c,
  cast(year(l_shipdate) as string) y, lpad(cast(month(l_shipdate) as string),2,'0') m, lpad(cast(day(l_shipdate) as string),2,'0') d,
  substring('JanFebMarAprMayJunJulAugSepOctNovDec', month(l_shipdate)*3-2, 3) mon from {lineitem})
select cast(k as string) procedure_id, cast(o as string) admission_id, cast(s as string) provider_id,
  case p % 6 when 0 then 'A0001' when 1 then cast(p as string)||'.0' when 2 then '12.5' when 3 then '99,213' when 4 then '—' else cast(p as string) end cpt_code,
  case p % 4 when 0 then 'CT scan of chest' when 1 then 'chest x-ray, pa' when 2 then 'MRI,BRAIN' else 'tbd' end procedure_description,
  case k % 5 when 0 then d||'.'||m||'.'||y when 1 then m||'/'||d||'/'||y when 2 then mon||' '||d||', '||y when 3 then y||m||d else y||'-'||m||'-'||d||case k % 3 when 0 then 'T10:11:12' else '' end end procedure_date,
  ' '||cast(c as string) procedure_cost
from b
""",
    ),
    "raw_providers": (
        "supplier",
        """
select case s_suppkey % 31 when 30 then 'na' else cast(s_suppkey as string) end provider_id, cast(s_nationkey as string) department_id,
  case s_suppkey % 3 when 0 then 'dr JOHN  o. smith' when 1 then 'smith,john' else lower(s_name) end name,
  case s_suppkey % 3 when 0 then 'CARDIOLOGY' when 1 then 'internal   medicine' else 'unknown' end specialty,
  cast(s_suppkey % 70 as string) years_experience
from {supplier}
""",
    ),
    "run_log": (
        "events",
        """
select event_type object_name, '/*bench;obj:'||event_type||'*/ from '||event_type query_text,
  cast(cast(value as decimal(18,2))*100 as bigint) cpu_us, cast(cast(value as decimal(18,2))*300 as bigint) duration_us,
  user_id reads, event_id % 50 + 1 executions, cast(ts as timestamp) ended_at, event_id log_id
from {events}
""",
    ),
}

RAW_SQL["raw_patient_updates"] = (
    "orders",
    """
select cast(o_custkey as string) patient_id, 'Customer#'||lpad(cast(o_custkey as string),9,'0') mrn,
  case o_orderstatus when 'F' then 'female' when 'O' then 'M' else 'not provided' end gender,
  case substring(o_orderpriority,1,1) when '1' then 'A+' when '2' then 'b -' when '3' then 'AB+' else '—' end blood_group,
  case substring(o_orderpriority,1,1) when '1' then 'Government' when '2' then 'self' else 'corporate' end insurance_type,
  'Ward  '||cast(o_orderkey as string) area, '560'||lpad(cast(o_orderkey % 1000 as string),3,'0') pincode,
  '1975-06-07' date_of_birth, cast(cast(o_orderdate as date) as string) created_date
from {orders}
""",
)
RAW_SQL["old_metric_log"] = (
    "events",
    """
select 'stg_optimized.'||event_type||'_std' object_name, 'value_'||event_type metric,
  cast(cast(value as decimal(18,2)) as double) value_num, cast(cast(value as decimal(18,2)) as string) value_text,
  'decimal' value_type, cast(ts as timestamp) run_utc,
  case event_type when 'error' then null else 'run-'||cast(user_id as string) end run_id, cast(ts as date) run_date
from {events}
""",
)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table over the parquet files in ``sf_dir``."""
    source, sql = RAW_SQL[name]
    return spark.sql(sql, **{source: table(spark, sf_dir, source)})


def raw_duckdb(name: str) -> str:
    """The same raw table as a DuckDB query over views named like the test tables."""
    source, sql = RAW_SQL[name]
    return sql.replace("{" + source + "}", source).strip()
