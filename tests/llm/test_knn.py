import numpy as np

from quarrymill.llm import knn


def truth(rows, k=5, least=0.85):
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None for x in v) and np.isfinite(v).all() and np.any(v)]
    ids = [i for i, _ in ok]
    m = np.array([v / np.linalg.norm(v) for _, v in ok])
    c = np.round(m @ m.T, 9)
    out = set()
    for x, i in enumerate(ids):
        best = sorted((j for j in range(len(ids)) if j != x), key=lambda j: (-c[x, j], ids[j]))[:k]
        out |= {(min(i, ids[j]), max(i, ids[j])) for j in best if c[x, j] >= least}
    return out


def data(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((60, 64))
    rows = []
    for b in base:
        rows.append(b)
        for scale in (0.05, 0.3, 0.5):
            rows.append(b + scale * rng.standard_normal(64))
    rows = [(i, [float(np.float32(x)) for x in r]) for i, r in enumerate(rows)]
    rows += [(1000 + i, rows[0][1]) for i in range(12)]  # copies
    rows += [(2000, None), (2001, [1.0] * 32), (2002, [0.0] * 64), (2003, [float("nan")] * 64), (2004, [float("inf")] + [1.0] * 63), (2005, [None] + [1.0] * 63)]
    return rows


def test_against_brute_force(spark):
    rows = data()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "row_id bigint, embedding array<float>, id string")
    got = {tuple(r) for r in knn.nearest_pairs(df).collect()}
    want = truth(rows)
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.02 * len(want) and len(want) > 100


def test_small_tables(spark):
    schema = "row_id bigint, embedding array<float>"
    assert knn.nearest_pairs(spark.createDataFrame([], schema)).count() == 0
    assert knn.nearest_pairs(spark.createDataFrame([(1, [1.0] * 64)], schema)).count() == 0
    got = knn.nearest_pairs(spark.createDataFrame([(2, [1.0] * 64), (1, [1.0] * 64)], schema)).collect()
    assert [tuple(r) for r in got] == [(1, 2)]


def test_plan_follows_size():
    """Longer substrings for more vectors, in about as many tables, since more bits are flipped in probing."""
    small, large = knn.plan(1000, 0.85, 0.95), knn.plan(10**10, 0.85, 0.95)
    assert small[0] == 14 and large[0] == 25 and large[2] > small[2]
    for rows in (10**3, 10**7, 10**8, 10**9, 10**10, 10**12):
        bits, tables, flips = knn.plan(rows, 0.85, 0.95)
        assert tables <= knn.MOST_TABLES and 1 - (1 - knn.meeting(bits, flips, np.arccos(0.85) / np.pi)) ** tables >= 0.95


def test_probes_meet_within_the_radius():
    rng = np.random.default_rng(4)
    import pyarrow as pa

    from collections import defaultdict

    subs = rng.integers(0, 1 << 10, (300, 2))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(subs.tolist(), pa.list_(pa.int64())), *(pa.array([0] * 300) for _ in knn._WORDS)], ["id", "subs", *knn._WORDS])
    at = defaultdict(set)
    for out in knn._probed(10, 2, 1)(iter([batch])):
        for bucket, i in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            at[i].add(bucket)
    for i in range(300):
        for j in range(i):
            within = any(bin(int(a ^ b)).count("1") <= 1 for a, b in zip(subs[i], subs[j]))
            assert not within or at[i] & at[j]


def test_recall_at_the_settings_of_large_tables(spark):
    """Substring lengths of 10^7 and of 10^9 vectors, forced on a small table."""
    rows = data(3)
    df = spark.createDataFrame(rows, "row_id bigint, embedding array<float>")
    want = truth(rows)
    for size in (10**7, 10**9):
        bits = knn.plan(size, 0.85, 0.95)[0]
        got = {tuple(r) for r in knn.nearest_pairs(df, bits=bits).collect()}
        assert len(got & want) >= 0.9 * len(want)
