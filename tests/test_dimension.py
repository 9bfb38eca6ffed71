"""The versioned dimension: what it holds after any deliveries, what a refresh writes, and jobs that die."""

import datetime as dt
import random

import pytest

from medloom.operators import dimension

SCHEMA = "k int, seen int, v string"
DAY = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def latest(rows):
    out = {}
    for k, seen, v in rows:
        if k is not None:
            rank = (seen is not None, seen or 0, v is not None, v or "")
            if k not in out or rank > out[k][0]:
                out[k] = (rank, (k, seen, v))
    return {r for _, r in out.values()}


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


def drawn(rng, n):
    return [(rng.choice([None, 1, 1, 1, rng.randrange(40)]), rng.choice([None, rng.randrange(9)]), rng.choice(["a", "b", None])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_versions_hold_the_latest_rows(spark, tmp_path, seed):
    rng, path, given = random.Random(seed), str(tmp_path / "t"), []
    expected = {}
    for step in range(4):
        rows = drawn(rng, rng.choice([5, 60]))
        given += rows
        made = dimension.refresh(path, frame(spark, rows), "k", ("seen",), DAY + dt.timedelta(days=step))
        expected[made.number] = latest(given)
        assert rows_of(dimension.read(spark, path)) == latest(given)
        if step == 2:
            expected[dimension.compact(spark, path).number] = latest(given)
    for number, rows in expected.items():
        assert rows_of(dimension.read(spark, path, number)) == rows
    assert rows_of(dimension.read(spark, path, 3, DAY + dt.timedelta(days=1))) == expected[2]
    assert dimension.read(spark, path, as_of=DAY - dt.timedelta(days=1)).count() == 0
    gone = dimension.vacuum(spark, path, keep=1)
    assert gone and rows_of(dimension.read(spark, path)) == latest(given) and len(dimension.versions(spark, path)) == 1


def test_a_small_update_writes_little(spark, tmp_path):
    path = str(tmp_path / "t")
    dimension.refresh(path, frame(spark, [(i, 0, "first") for i in range(5000)]), "k", ("seen",), DAY)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    dimension.refresh(path, frame(spark, [(i, 1, "new") for i in range(0, 5000, 100)]), "k", ("seen",), DAY)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    assert all(after[p] == t for p, t in before.items())
    fresh = [p for p in after if p not in before]
    assert sum(spark.read.parquet(str(p)).count() for p in fresh) == 50
    assert dimension.read(spark, path).filter("v = 'new'").count() == 50
    assert [r.rows_written for r in dimension.history(spark, path).orderBy("version").collect()] == [5000, 50]


def test_a_job_that_dies_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    dimension.refresh(path, frame(spark, [(1, 1, "old")]), "k", ("seen",), DAY)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(dimension, "_commit", die)
        for job in (lambda: dimension.refresh(path, frame(spark, [(1, 2, "lost")]), "k", ("seen",), DAY), lambda: dimension.compact(spark, path)):
            try:
                job()
            except KeyboardInterrupt:
                pass
    assert rows_of(dimension.read(spark, path)) == {(1, 1, "old")} and dimension.versions(spark, path) == [1]
    dimension.vacuum(spark, path)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    assert rows_of(dimension.read(spark, path)) == {(1, 1, "old")}


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = dimension.refresh(path, frame(spark, [(1, 1, "a")]), "k", ("seen",), DAY)
    dimension.refresh(path, frame(spark, [(2, 1, "b")]), "k", ("seen",), DAY)
    with monkeypatch.context() as patch:
        patch.setattr(dimension, "version", lambda *_: first)  # the second writer has not seen the other's version
        with pytest.raises(dimension.ConflictError):
            dimension.refresh(path, frame(spark, [(3, 1, "c")]), "k", ("seen",), DAY)
    assert rows_of(dimension.read(spark, path)) == {(1, 1, "a"), (2, 1, "b")}


def test_odd_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        dimension.read(spark, path)
    none = frame(spark, [])
    assert dimension.refresh(path, none, "k", ("seen",), DAY).number == 1
    assert dimension.read(spark, path).count() == 0
    assert dimension.refresh(path, none, "k", ("seen",), DAY).number == 1  # nothing new
    assert dimension.refresh(path, frame(spark, [(None, 1, "x"), (4, None, None)]), "k", ("seen",), DAY).number == 2
    assert rows_of(dimension.read(spark, path)) == {(4, None, None)}
    with pytest.raises(ValueError):
        dimension.refresh(path, none.withColumn("more", none.k), "k", ("seen",), DAY)


def test_untouched_keys_pass_by_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    for step in range(2):
        dimension.refresh(path, frame(spark, [(i, step, "x") for i in range(0, 1000, 1 + 99 * step)]), "k", ("seen",), DAY)
    plan = dimension.read(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and plan.count("Exchange hashpartitioning(k") == 1
