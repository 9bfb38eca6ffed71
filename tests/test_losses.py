"""The account of losses: hand-made rows, limits as an option, one pass."""

import pytest
from conftest import SF_SMALL
from test_plans import COMPILED_SIZE, explained
from test_properties import COLUMNS

from medloom.operators import losses
from medloom.operators import standardize as Z
from medloom.plans import queries as Q
from medloom.sources.raw import raw_table


def frame(spark, entity, rows):
    names = COLUMNS[entity]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))


def counted(spark, entity, rows, **options):
    found = losses.account_of(spark, {entity: frame(spark, entity, rows)}, **options)
    return {(r.rule, r.column_name): r.n for r in found.collect() if r.n}


def test_what_is_lost_is_counted(spark):
    rows = [
        {"procedure_id": "1", "admission_id": "2", "procedure_date": "31-02-2021", "cpt_code": "A0001", "procedure_cost": "TBD"},
        {"procedure_id": "x", "admission_id": "2", "procedure_date": "2021-02-03", "procedure_cost": "1E3"},
        {"procedure_id": None, "admission_id": "n/a"},
        {"procedure_id": "3", "admission_id": "4", "procedure_description": "word " * 100},
    ]
    assert counted(spark, "procedures", rows) == {
        ("rows", None): 4, ("dropped", None): 2, ("failed", "procedure_id"): 1, ("failed", "procedure_date"): 1,
        ("failed", "cpt_code"): 1, ("failed", "procedure_cost"): 1, ("cut", "procedure_description"): 1,
    }


def test_whole_texts_unless_the_limits_are_asked_for(spark):
    rows = [{"lab_result_id": "1", "admission_id": "2", "test_name": "t" * 300, "unit": "u" * 30}]
    raw = frame(spark, "lab_results", rows)
    whole, cut = Z.standardize_lab_results(raw).first(), Z.standardize_lab_results(raw, source_limits=True).first()
    assert (len(whole.test_name), len(whole.unit)) == (300, 30) and (len(cut.test_name), len(cut.unit)) == (120, 20)
    for limits in (False, True):
        assert counted(spark, "lab_results", rows, source_limits=limits) == {("rows", None): 1, ("cut", "test_name"): 1, ("cut", "unit"): 1}
    room = frame(spark, "admissions", [{"admission_id": "1", "room_number": "a wing, second floor"}])
    assert Z.standardize_admissions(room).first().room_number == "A WING, SECOND FLOOR"
    assert Z.standardize_admissions(room, source_limits=True).first().room_number == "A WING, SECO"


@pytest.mark.parametrize("entity", sorted(COLUMNS))
def test_the_account_changes_no_row_and_no_pass(spark, tmp_path, entity):
    raw = raw_table(spark, SF_SMALL, f"raw_{entity}")
    std, account = losses.accounted(entity, raw)
    plan = explained(std, "simple")
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
    path = str(tmp_path / entity)
    std.write.parquet(path)
    assert spark.read.parquet(path).exceptAll(Q.std(spark, SF_SMALL, entity)).count() == 0
    found = {(rule, column): n for _, rule, column, n in losses.entries(entity, account)}
    assert found["rows", None] - found["dropped", None] == spark.read.parquet(path).count()


def test_an_empty_table_loses_nothing(spark):
    assert counted(spark, "billing", []) == {}


@pytest.mark.parametrize("entity", sorted(COLUMNS))
def test_registered_jobs_are_compiled(spark, entity):
    import re

    std, _ = losses.accounted(entity, raw_table(spark, SF_SMALL, f"raw_{entity}"))
    for df in (Q.QUERIES[f"std_{entity}"](spark, SF_SMALL), std):
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", explained(df, "codegen"))]
        assert sizes and max(sizes) < COMPILED_SIZE
