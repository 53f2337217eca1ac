"""The pigeonhole join against all pairs: spread and tight groups, odd vectors, cells in many parts."""

import numpy as np
import pytest

from filmweave.llm import embeddings

SCHEMA = "vec_id long, embedding array<double>, label int, node long, vec string, links int"


def frame(spark, rows, kind="double"):
    """Vectors with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, 2, "v", 3) for r in rows], SCHEMA.replace("double", kind))


def unit(vector):
    x = np.array(vector, dtype=np.float64)
    x /= np.abs(x).max()
    return x / np.sqrt((x * x).sum())


def brute(rows, cosine=0.95):
    sound = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = [unit(v) if ok else None for (_, v), ok in zip(rows, sound)]
    top, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for length in {len(u) for u in units if u is not None}:
        at = [i for i, u in enumerate(units) if u is not None and len(u) == length]
        near = np.array([units[i] for i in at]) @ np.array([units[i] for i in at]).T >= cosine
        for a, b in zip(*np.nonzero(near)):
            if a < b:
                links[at[a]] += 1
                links[at[b]] += 1
                top[root(at[a])] = root(at[b])
    groups = {}
    for i, (vec_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(vec_id)
    least = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return [(vec_id, links[i], least[root(i)], vec_id == least[root(i)]) for i, (vec_id, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    rows = []
    for i in range(700):
        # Spreads around the bound, so that chains of links form, and one tight group of a third.
        v = base[0] + rng.normal(size=16) * 0.1 if i % 3 == 0 else base[rng.integers(30)] + rng.normal(size=16) * rng.choice([0.15, 0.25, 0.3])
        rows.append((i, [float(x) for x in v]))
    rows += [(2000 + i, rows[3][1]) for i in range(20)] + [(7, rows[3][1]), (None, rows[3][1]), (None, None), (3000, []), (3001, [0.0] * 16)]
    rows += [(3002, [float("nan")] * 16), (3003, [None] * 16), (3004, [1.0, 2.0]), (3005, [2.0, 4.0]), (3006, [1e300] * 16)]
    return rows + [(3007, [1e-300] * 16), (3008, None), (3009, [float("inf")] + [1.0] * 15), (3010, [3.0]), (None, [-3.0])]


@pytest.mark.parametrize(("most", "blocks"), [(8192, 4), (40, 4), (40, 3), (64, 1)])
def test_against_all_pairs(spark, odd, most, blocks):
    got = [tuple(r) for r in embeddings.near_duplicates(frame(spark, odd), most=most, blocks=blocks).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(odd)))


def test_real_vectors_in_single_precision(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(300)
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    rows += [(5000 + i, [x + 0.01 * (i % 5) for x in v]) for i, (_, v) in enumerate(rows[:60])]
    got = [tuple(r) for r in embeddings.near_duplicates(frame(spark, rows, "float"), most=64).collect()]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute(rows)
    assert sorted(map(str, got)) == sorted(map(str, want)) and sum(r[1] for r in want) > 60


def test_no_rows(spark, odd):
    assert embeddings.near_duplicates(frame(spark, odd[:1]).limit(0)).count() == 0
    none = embeddings.near_duplicates(frame(spark, [(1, None), (2, [0.0])]))
    assert sorted(map(tuple, none.collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_every_near_pair_is_within_its_share_in_some_block():
    rng = np.random.default_rng(9)
    sample = rng.normal(size=(500, 24))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    spaces = embeddings.Subspaces(sample, 64)
    assert abs(spaces.shares.sum() - 0.1) < 1e-9 and np.allclose(spaces.rotation @ spaces.rotation.T, np.eye(24))
    a = sample
    b = a + rng.normal(size=a.shape) * 0.06
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = (a * b).sum(axis=1) >= 0.95
    ra, rb = a @ spaces.rotation, b @ spaces.rotation
    met = np.zeros(len(a), bool)
    for i, block in enumerate(spaces.blocks):
        row, cell = spaces.asked(i, ra[:, block])
        asked = set(zip(row.tolist(), cell.tolist()))
        met |= np.array([(k, h) in asked for k, h in enumerate(spaces.home(i, rb[:, block]).tolist())])
    assert near.sum() > 50 and met[near].all()


def test_vectors_travel_to_half_of_the_parts_and_every_near_pair_meets_in_one():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(4000, 16))
    vectors[:1500] = vectors[0] + rng.normal(size=(1500, 16)) * 0.05  # a hot region, in many parts
    vectors[1500:2500] = vectors[2500:3500] + rng.normal(size=(1000, 16)) * 0.05
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    regions = embeddings.Subspaces(vectors[::2], 16, blocks=1)
    points, nodes = vectors @ regions.rotation, np.arange(4000) * 7
    region, n = np.unique(regions.home(0, points), return_counts=True)
    parts = embeddings.Parts(regions, dict(zip(region.tolist(), n.tolist())), 150)
    own = parts.held(points, nodes)
    row, slot = parts.asked(points, own)
    assert parts.total > 16 and own.max() == parts.total - 1
    assert len(row) <= 4000 * (parts.total + 1) // 2 * 1.2
    asked = set(zip(row.tolist(), slot.tolist()))
    assert len(asked) == len(row) and not (asked & set(enumerate(own.tolist())))
    near = np.argwhere(np.triu(vectors @ vectors.T >= 0.95, 1))
    assert len(near) > 10000
    for a, b in near[:: len(near) // 5000].tolist():
        assert ((a, own[b]) in asked) + ((b, own[a]) in asked) + (own[a] == own[b]) == 1
