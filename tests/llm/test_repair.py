"""Conversation repair against trying all edits."""

import random

import brute
import pytest
from conftest import SF
from pyspark.sql import functions as F

from medloom.llm import repair
from medloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
FAULTS = {None: 0, "blank": 1, "duplicate": 2, "truncated": 3}


def stretch(rows):
    out = repair.Stretch()
    for role, text, fault in rows:
        out.add(None, role, text, 1, FAULTS[fault])
    return out


def drawn(rng):
    roles = rng.choice([["user", "assistant"], ["user", "assistant", "system", "tool", ""], ["system"], ["assistant"], ["tool", "user"]])
    rows = [(rng.choice(roles), f"t{i}" + rng.choice("..! "), rng.choice([None] * 6 + ["blank", "duplicate"])) for i in range(rng.choice([1, 2, 3, 5, 8, 12, 70]))]
    return [(r, t, f or (None if t[-1] in ".!" else "truncated")) for r, t, f in rows]


@pytest.mark.parametrize("seed", range(8))
def test_cheapest_edits_and_blocks_of_any_size(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rows = drawn(rng)
        cost, audit, lines = brute.cheapest(rows)
        whole = repair._whole("x", stretch(rows))
        assert (whole["cost"], whole["audit"], whole["repaired_sha256"]) == (cost, audit, brute.sha("\n".join(lines)))
        size = rng.choice([1, 3, 7, 33])
        parts = [repair._part("x", stretch(rows[i : i + size]), 0, i) for i in range(0, len(rows), size)]
        ahead, prices = [], list(repair.ENDING)
        for part in reversed(parts):
            ahead.append(prices)
            prices = [min(repair.NEVER, min(part["costs"][4 * s + t] + prices[t] for t in range(4))) for s in range(4)]
        join = repair.Join("x")
        for part, after in zip(parts, reversed(ahead), strict=True):
            join.take(part, after)
        found = join.found()
        assert all(found[n] == whole[n] for n in ("cost", "audit", "repaired_sha256", "illegal", "blank", "duplicate", "truncated"))


def test_prices_never_exceed_what_an_arc_costs():
    rows = [("u", 0), ("u", 5), ("t", 0), ("", 5), ("a", 0)] * 5
    lattice = repair.Lattice(rows, repair.ENDING, (0, 1, 2, 3))
    for own, price in lattice.slices:
        for node in range(4 * len(own)):
            assert price[node] <= min(cost for _, cost, _ in repair._arcs(node, own, price))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert brute.same(QUERIES["op13_conversation_repair"](spark, SF).collect(), brute.mended(brute.damaged(rows), rows))


def odd_rows():
    rng = random.Random(7)
    texts = [None, "", " \n", "Yes.", "No", "long " * 9000 + ".", "a ", "x?\t", "é!"]
    roles = ["user", "assistant", "system", None, "", "tool", "USER"]
    rows = [(rng.choice([None, 1, 2, 3, 4, 50]), rng.choice([None, 0, 1, 2, 7, 10**12, -3]), rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    rows += [(9, i, ("user", "assistant")[i % 2], f"turn {i % 300}.") for i in range(9000)]
    return rows + [(7, 1, "user", "same.")] * 3000 + [(8, i, "user", "again.") for i in range(500)]


def test_odd_rows_and_conversations_over_many_tasks(spark, monkeypatch):
    rows = odd_rows()
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA).repartition(5))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = repair.repair(repair.damage(df), df).collect()
        plain = repair.repair(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert brute.same(got, brute.mended(brute.damaged(rows), rows))
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert brute.same(plain, brute.mended(spaced))


def test_empty_table_and_ids_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(none).count() == 0
    ids = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    assert brute.same(repair.repair(none, ids).collect(), [(i, 0, 0, 0, 0, 0, 0, "", brute.sha("")) for i in (1, None)])


def test_damage(spark):
    rows = [tuple(r) for r in spark.createDataFrame(odd_rows(), SCHEMA).collect()]
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA))
    assert brute.same(repair.damage(df).collect(), brute.damaged(rows))
    assert repair.damage(df.limit(0)).count() == 0
    assert repair.damage(df).select(F.count_if(F.col("role").isNull() | F.col("text").isNull())).first()[0] == 0
