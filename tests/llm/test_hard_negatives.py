import math
import random

import pytest
from pyspark.sql import functions as F

from cardledger.llm import hard_negatives as op
from cardledger.llm.queries import op12_hard_negatives

VECTORS = "vec_id long, label long, vector array<double>, slot string, anchor_id string"


def brute(rows, every, count=5, best=3):
    """Hard negatives from the definition; rows (id, label, vector of whole numbers), ids differ."""
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b))
    out = []
    for a, label, v in rows:
        if a % every:
            continue
        scored = sorted((-dot(v, w), i, k) for i, k, w in rows if i != a)
        for minus, positive, _ in [s for s in scored if s[2] == label][:count]:
            fits = [(i, -m) for m, i, k in scored if k != label and 50 * -minus <= 100 * -m <= 95 * -minus]
            out += [(a, positive, r + 1, i, -minus, s) for r, (i, s) in enumerate(fits[:best])]
    return sorted(out)


@pytest.mark.parametrize("seed, cell", [(1, (8192, 8192)), (2, (4, 30)), (3, (1, 7))])
def test_against_every_pair(stored, seed, cell):
    rng = random.Random(seed)
    rows = []
    for i in range(-20, 180):  # few values, so that scores tie
        rows.append((i, rng.choice([0, 0, 0, 1, 2]), [float(rng.randint(-2, 3)) for _ in range(4)]))
    bad = [(None, 1, [1.0] * 4), (500, None, [1.0] * 4), (550, 1, None), (600, 1, [1.0, None, 1.0, 1.0])]
    bad += [(650, 0, [math.nan, 1.0, 1.0, 1.0]), (700, 0, [math.inf, 1.0, 1.0, 1.0])]
    again = [rows[5], rows[30], (rows[40][0], 9, [9.0] * 4)]  # equal rows, and a larger one of the same id
    docs = stored([(*r, "x", None) for r in rows + bad + again], VECTORS)
    got = sorted(map(tuple, op.mine(docs, F.col("vec_id") % 10 == 0, cell=cell).collect()))
    assert got and got == brute(rows, 10)


def test_large_components_and_other_lengths(stored):
    rng = random.Random(4)
    size = lambda: rng.choice([0, 2, 3])
    rows = [(i, i % 2, [float(rng.randint(0, 1 << 30)) for _ in range(size())]) for i in range(60)]
    got = op.mine(stored([(*r, None, None) for r in rows], VECTORS), F.col("vec_id") % 10 == 0).collect()
    filled = [(i, k, v + [0.0] * (3 - len(v))) for i, k, v in rows]
    assert sorted(map(tuple, got)) == brute(filled, 10)


def test_no_rows(stored):
    assert op.mine(stored([], VECTORS), F.col("vec_id") % 10 == 0).count() == 0
    one = stored([(10, 1, [1.0], None, None), (11, 2, [1.0], None, None)], VECTORS)
    assert op.mine(one, F.col("vec_id") % 10 == 0).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, rng.randint(0, 2), [rng.gauss(0.1, 0.3) for _ in range(6)]) for i in range(300)]
    rows += [(350, 1, [math.nan] * 6), (400, None, [0.1] * 6), (450, 2, None)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    import struct

    exact = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    prepared = [
        (i, (k + 1) % 10 if i % 7 == 0 else k, [float(math.floor(256 * exact(x))) for x in v]) for i, k, v in rows[:300]
    ]
    got = sorted(map(tuple, op12_hard_negatives(spark, str(tmp_path)).collect()))
    assert got and got == brute(prepared, 50)
