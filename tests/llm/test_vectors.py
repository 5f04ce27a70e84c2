import math
import random

import numpy as np
import pytest

from millrace.llm import neighbours
from millrace.llm.neighbours import near_duplicate_vectors

SCHEMA = "vec_id bigint, embedding array<{kind}>, component_id string, n_links string, id int"


def brute_force(rows, threshold=0.95):
    """Links of all pairs, and components by going along them."""
    good = {}
    for key, vector in rows:
        if key is None or key in good or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        x = np.asarray(vector, dtype=np.float64)
        x = x / np.abs(x).max()
        good[key] = x / np.linalg.norm(x)
    links = {k: set() for k, _ in rows if k is not None}
    keys = sorted(good)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = {}
    for k in sorted(links):
        if k not in out:
            seen, todo = {k}, [k]
            while todo:
                for n in links[todo.pop()] - seen:
                    seen.add(n)
                    todo.append(n)
            out |= dict.fromkeys(seen, k)
    return {k: (len(links[k]), out[k], out[k] == k) for k in links}


def found(spark, rows, kind="double"):
    schema = SCHEMA.format(kind=kind)
    table = spark.createDataFrame([(k, v, "x", None, 1) for k, v in rows], schema)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(table).collect() if r.vec_id is not None}


def turned(degrees, plane, size):
    x = [0.0] * size
    x[plane], x[plane + 1] = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return x


def test_the_smallest_chain(spark):
    rows = [(k, turned(d, 0, 2)) for k, d in ((1, 0), (4, 15), (3, 30), (2, 45))]
    assert found(spark, rows) == {1: (1, 1, True), 4: (2, 1, False), 3: (2, 1, False), 2: (1, 1, False)}


def test_chains_stars_and_rings_in_random_order(spark):
    rnd = random.Random(8)
    vectors = []
    for plane in range(0, 8, 2):  # chains of 10 with links to the next only
        vectors += [turned(d, plane, 32) for d in range(0, 150, 15)]
    for plane in (8, 10):  # rings
        vectors += [turned(d, plane, 32) for d in range(0, 360, 15)]
    for plane in (12, 14):  # stars: arms linked with the middle, not with each other
        middle = [0.0] * 32
        middle[plane] = 1.0
        for arm in range(16, 24):
            x = list(middle)
            x[arm] = math.tan(math.radians(17))
            vectors.append(x)
        vectors.append(middle)
    rng = np.random.default_rng(5)
    vectors += [v.tolist() for v in rng.standard_normal((60, 32))]
    ids = rnd.sample(range(10_000), len(vectors))
    rows = list(zip(ids, vectors))
    want = brute_force(rows)
    assert len({c for _, c, _ in want.values()}) == 4 + 2 + 2 + 60
    assert found(spark, rows) == want


def test_a_long_chain_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rnd = random.Random(3)
    vectors = [[*turned(d, 0, 2), h] for h in (0.0, 0.25, 0.5) for d in range(0, 360, 8)]
    rows = list(zip(rnd.sample(range(5000), len(vectors)), vectors))
    assert found(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    big, small = (1e30, 1e-30) if kind == "float" else (1e300, 1e-300)
    rows = [
        (1, [1.0, 0.0]),
        (2, [big, 0.0]),
        (3, [small, 0.0]),
        (4, [0.0, 0.0]),
        (5, []),
        (6, None),
        (7, [1.0, None]),
        (8, [1.0, math.nan]),
        (9, [math.inf, 0.0]),
        (10, [1.0]),
        (11, [-3.0]),
        (12, [5.0]),
        (None, [1.0, 0.0]),
        (13, [1.0, 0.0]),
        (13, [1.0, 0.0]),
    ]
    want = brute_force(rows)
    assert want[1] == (3, 1, True) and want[10] == (1, 10, True)
    assert found(spark, rows, kind) == want
