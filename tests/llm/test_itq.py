import numpy as np
import pytest
from llm_cases import union_find

from wardstar.llm import itq
from wardstar.llm.common import read_table


def expected(ids, vectors):
    """(vec_id, n_links, component_id) by comparing all pairs."""
    n = len(ids)
    usable = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    unit = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if u else None for u, v in zip(usable, vectors)]
    links = [
        (i, j)
        for i in range(n)
        for j in range(i)
        if usable[i] and usable[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95
    ]
    roots, degree = union_find(n, links), [0] * n
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    least = {}
    for r, vec in zip(roots, ids):
        if vec is not None:
            least[r] = min(least.get(r, vec), vec)
    return sorted(((v, d, least.get(r)) for v, d, r in zip(ids, degree, roots)), key=repr), len(links)


def result(spark, ids, vectors, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, code string")
    rows = itq.near_duplicates(df, **options).collect()
    for r in rows:
        assert r.kept == (r.component_id == r.vec_id if r.component_id is not None else r.n_links == 0)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


def clouds(seed, n=400, d=64, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 8, d))
    x = centres[rng.integers(0, n // 8, n)] + spread * rng.standard_normal((n, d))
    x[: n // 3] = centres[0] + spread * rng.standard_normal((n // 3, d))  # a third in one group
    x[5] = x[6]
    return [list(map(float, np.float32(v))) for v in x]


@pytest.mark.parametrize("group_rows", [16, 2_048])
def test_equals_all_pairs_on_clouds(spark, group_rows):
    vectors = clouds(1)
    ids = list(range(len(vectors)))
    rows, n = expected(ids, vectors)
    assert result(spark, ids, vectors, group_rows=group_rows) == rows and n > 1_000


def test_odd_vectors(spark):
    x = clouds(2, n=24)
    vectors = x + [None, [], [0.0] * 64, [None, *x[0][1:]], [float("nan"), *x[0][1:]], [float("inf"), *x[0][1:]]]
    vectors += [x[0], [2 * c for c in x[0]], x[0][:32], x[0][:32], [1.0], [2.0], [-1.0], x[1], x[1]]
    ids = list(range(len(vectors) - 3)) + [None, None, 3]
    rows, _ = expected(ids, vectors)
    # A row without links keeps its own id, null or not.
    assert result(spark, ids, vectors) == rows
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert itq.near_duplicates(empty).count() == 0


def test_recall_near_the_threshold(spark):
    """Pairs at cosine 0.95 to 0.955, the hardest ones: recall of at least 0.9 over many pairs."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal((800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((800, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9501, 0.955, (800, 1))
    both = np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * side])
    vectors = [list(map(float, np.float32(v))) for v in both]
    ids = list(range(1_600))
    rows, n = expected(ids, vectors)
    got = result(spark, ids, vectors)
    assert sum(r[1] for r in got) / 2 >= 0.9 * n
    assert all(g[1] <= e[1] for g, e in zip(sorted(got), sorted(rows)))


def with_shared_direction(typical, cosine, n=500, d=64):
    """n pairs at the cosine, of vectors that have the typical cosine among themselves."""
    rng = np.random.default_rng(5)
    a, side = rng.standard_normal((2, n, d))
    a[:, 0], side[:, 0] = 0, 0
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    own = (cosine - typical) / (1 - typical)
    both = np.sqrt(1 - typical) * np.concatenate([a, own * a + np.sqrt(1 - own**2) * side])
    both[:, 0] = np.sqrt(typical)
    return [list(map(float, np.float32(v))) for v in both]


@pytest.mark.parametrize("typical", [0.3, 0.5, 0.7, 0.85])
def test_recall_with_a_shared_direction(spark, typical):
    vectors = with_shared_direction(typical, 0.9525)
    ids = list(range(len(vectors)))
    rows, n = expected(ids, vectors)
    got = result(spark, ids, vectors)
    assert n >= 500 and sum(r[1] for r in got) / 2 >= 0.9 * n
    assert all(g[1] <= e[1] for g, e in zip(sorted(got), sorted(rows)))


@pytest.mark.parametrize("group_rows", [64, 2_048])
def test_all_pairs_where_codes_do_not_tell_vectors_apart(spark, group_rows):
    vectors = with_shared_direction(0.93, 0.9525, n=150)
    x = itq._matrix(itq.pa.array(vectors, itq.pa.list_(itq.pa.float64())))
    assert itq.plan(x, 0.95)[0] is None
    ids = list(range(len(vectors)))
    rows, n = expected(ids, vectors)
    assert n >= 150 and result(spark, ids, vectors, group_rows=group_rows) == rows


def test_given_vectors(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    data = df.toPandas()
    rows, n = expected(list(data.vec_id), [list(v) for v in data.embedding])
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in itq.near_duplicates(df).collect()), key=repr)
    assert sum(r[1] for r in got) >= 0.9 * 2 * n
    assert got == rows or sum(r[1] for r in got) < 2 * n


def test_rotation_keeps_angles_and_balances_bits():
    x = np.array(clouds(4, n=500, spread=1.0))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centre, projection = itq.fit(x)
    assert np.allclose(projection.T @ projection, np.eye(64), atol=1e-8)
    bits = np.unpackbits(itq.encode(x, (centre, projection)).view(np.uint8).reshape(-1, 8), axis=1)
    assert abs(bits.mean() - 0.5) < 0.05
