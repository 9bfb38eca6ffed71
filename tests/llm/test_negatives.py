"""Hard negatives against plain integer arithmetic."""

import math

import brute
import numpy as np
import pytest
from conftest import SF

from medloom.llm import negatives
from medloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"
LIMIT = negatives.LIMIT


def mined(rows, every=50, positives=5, most=3):
    """Rows (id, vector, label); every distinct anchor against all rows."""
    sound = [
        (i, [math.floor(x * 256) if abs(x) < 1e290 else int(x) * 256 for x in v], l)
        for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, q, label in {(i, tuple(v), l) for i, v, l in sound if i % every == 0}:
        scored = [(max(-LIMIT, min(LIMIT, sum(x * y for x, y in zip(q, v, strict=False)))), i, l) for i, v, l in sound if i != a]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for ps, p, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [x for x in scored if x[2] != label and 50 * ps <= 100 * x[0] <= 95 * ps][:most]
            out += [(a, p, k + 1, n, ps, ns) for k, (ns, n, _) in enumerate(hard)]
    return out


@pytest.mark.parametrize("width,largest", [(1, 3), (8, 255), (13, 256), (64, 2**31), (5, 2**52), (3, 10**40)])
def test_lookups_give_inner_products(width, largest):
    rng = np.random.default_rng(width)
    draw = lambda n: np.array([[int(x * largest) for x in rng.uniform(-1, 1, width)] for _ in range(n)], object)
    a, b = draw(7), draw(9)
    bits = negatives.planes_for(max(abs(x) for x in b.ravel()))
    kind = np.int64 if bits < 63 else object
    planes = negatives.pack_planes(b.astype(kind), bits)
    assert (negatives.unpack_planes(planes)[:, :width] == b).all()
    full = np.zeros((7, 8 * planes.shape[2]), object)
    full[:, :width] = a
    assert (negatives.scores(negatives.subset_sums(full), planes) == (b @ a.T)).all()


def test_whole_table(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding], (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert brute.same(QUERIES["op11_hard_negatives"](spark, SF).collect(), mined(rows))


def odd_rows():
    rng = np.random.default_rng(3)
    rows = [(int(i), (np.abs(rng.normal(size=int(rng.integers(3, 20)))) / 3).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    same = rows[1][1]
    rows += [(1000 + i, same, i % 2) for i in range(200)] + [(2000, same, 1)] * 4 + [(150, same, 1)] * 3
    rows += [(3000, [1e200, 1.0], 1), (3050, [1e200, 0.5], 1), (3051, [1e155, 0.1], 2), (3100, [1e-200, 3e38], 1), (3101, [2.0**40] * 9, 2), (3150, [2.0**41] * 9, 1)]
    rows += [(None, same, 1), (3200, same, None), (3250, None, 1), (3300, [], 1), (3350, [0.0] * 9, 1), (3400, [1.0, None], 1)]
    return [*rows, (3450, [1.0, float("nan")], 1), (3500, [1.0, float("inf")], 1), (-50, same, 1)]


@pytest.mark.parametrize("block_rows", [20, negatives.BLOCK_ROWS])
def test_odd_rows_and_blocks_of_any_size(spark, block_rows):
    rows = odd_rows()
    df = brute.hostile(spark.createDataFrame(rows, SCHEMA).repartition(4)).drop("score")
    got = negatives.mine(df, df.filter("vec_id % 50 = 0"), block_rows=block_rows).collect()
    assert brute.same(got, mined(rows))
    assert len({r.anchor_id for r in got}) > 5


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(none, none).count() == 0
    one = spark.createDataFrame([(50, [1.0], 1)], SCHEMA)
    assert negatives.mine(one, one).count() == 0
    assert negatives.mine(one, none).count() == 0
