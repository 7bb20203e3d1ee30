import numpy as np
import pytest

from orderwell.llm import vector_dedup

from . import brute
from .conftest import by_row

RESULT = ("vec_id", "n_links", "component_id", "kept")
VECTOR = "vec_id long, embedding array<float>, label int"


def unit(v):
    if v is None or not len(v) or any(x is None for x in v):
        return None
    v = np.asarray(v, dtype=np.float32).astype(np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    return v / np.linalg.norm(v)


def expected(rows):
    units = [unit(r[1]) for r in rows]

    def linked(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and len(a) == len(b) and float(a @ b) >= 0.9

    roots = brute.components(len(rows), linked)
    low = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            low[root] = min(low.get(root, r[0]), r[0])
    degrees = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    return sorted(
        [(r[0], d, low.get(root), r[0] == low.get(root)) for r, d, root in zip(rows, degrees, roots)], key=repr
    )


def groups(rng, n, dim=24):
    rows = []
    while len(rows) < n:
        centre = rng.normal(size=dim)
        for _ in range(rng.choice([1, 1, 2, 5, 25])):
            rows.append((centre + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 0.35])).tolist())
    return [(int(i), v, 0) for i, v in zip(rng.permutation(10 * n), rows[:n])]


def test_odd_vectors_match_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, None) for i, v in enumerate([
        None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.0], [1.0, 0.3],
        [-1.0, 0.0], [1.0], [1.0, 0.0, 0.0], [1e-30, 0.0], [3e38, 0.0],
    ])]
    rows += [(6, [1.0, 0.0], 1), (None, [0.0, 5.0], 1), (None, [0.0, 5.0], 1), (None, None, None), (40, [-1.0, -0.1], 2)]
    df = spark.createDataFrame(rows, VECTOR).selectExpr("*", "'own' AS class", "'own' AS unit", "1 AS shard")
    assert by_row(vector_dedup.near_copies(df.repartition(3)), *RESULT) == expected(rows)


@pytest.mark.parametrize("shard_rows", [1500, 60])
def test_groups_match_brute_force(spark, shard_rows):
    rows = groups(np.random.default_rng(3), 500)
    df = spark.createDataFrame(rows, VECTOR).repartition(4)
    got = by_row(vector_dedup.near_copies(df, shard_rows=shard_rows), *RESULT)
    want = expected(rows)
    if shard_rows > 500:
        assert got == want
    assert len(got) == len(want)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.95 * true <= found <= true


def test_no_vectors(spark):
    assert vector_dedup.near_copies(spark.createDataFrame([], VECTOR)).count() == 0


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").select("vec_id", "embedding").toPandas()
    units = np.stack([unit(v) for v in rows["embedding"]])
    degrees = np.zeros(len(units), dtype=int)
    for at in range(0, len(units), 500):  # a stated query set against all rows, in blocks
        degrees[at : at + 500] = (units[at : at + 500] @ units.T >= 0.9).sum(axis=1) - 1
    got = vector_dedup.near_copies(df).toPandas().sort_values("vec_id")["n_links"].to_numpy()
    assert (got <= degrees).all()
    assert got.sum() >= 0.95 * degrees.sum()


def test_pruned_graph_is_navigable():
    rng = np.random.default_rng(2)
    units = rng.normal(size=(600, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = vector_dedup.pruned_neighbours(units)
    assert ((near >= 0).sum(axis=1) >= 3).all() and (near < 600).all()
    rows, columns = np.nonzero(near >= 0)
    graph = vector_dedup.Graph(units, rows, near[rows, columns])
    ids, _ = graph.greedy(np.arange(600), 32)
    assert (ids == np.arange(600)[:, None]).any(axis=1).mean() > 0.97


@pytest.mark.parametrize("few", [64, 0])
def test_no_shard_is_above_its_bound(spark, monkeypatch, few):
    monkeypatch.setattr(vector_dedup, "MAX_CENTRES", 16)
    monkeypatch.setattr(vector_dedup, "FEW_SHARDS", few, raising=False)
    rng = np.random.default_rng(4)
    units = rng.normal(size=(4000, 8))
    units[:1500] = units[0] + 1e-9 * units[:1500]  # centres hardly part these
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows = [(i, 1, u.tolist()) for i, u in enumerate(units)]
    classes = spark.createDataFrame(rows, "class long, copies long, unit array<double>").repartition(4)
    dealt = vector_dedup.shards(classes, 20, 4).toPandas()
    assert dealt.groupby("shard").size().max() <= 2 * 20
    assert set(dealt["class"]) == set(range(4000)) and len(dealt) <= 8 * 4000
    assert (dealt[dealt["rank"] == 0].groupby("class").size() == 1).all()


def test_centres_part_no_large_shard(spark):
    rng = np.random.default_rng(6)
    units = rng.normal(size=(120, 8))
    units[:100] = units[0] + 1e-9 * units[:100]
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows = [(i, 1, u.tolist()) for i, u in enumerate(units)]
    classes = spark.createDataFrame(rows, "class long, copies long, unit array<double>").repartition(4)
    dealt = vector_dedup.shards(classes, 20, 4).toPandas()
    assert dealt.groupby("shard").size().max() <= 2 * 20
    assert sorted(dealt[dealt["rank"] == 0]["class"]) == list(range(120))


def test_dense_group_over_many_shards(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=32)
    units = centre / np.linalg.norm(centre) + rng.normal(size=(6000, 32)) * 0.05
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    units = units.astype(np.float32).astype(np.float64)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, u.tolist(), 0) for i, u in enumerate(units)], VECTOR).repartition(4)
    got = vector_dedup.near_copies(df, shard_rows=300).toPandas().sort_values("vec_id")
    true = sum(int((units[at : at + 500] @ units.T >= 0.9).sum()) for at in range(0, 6000, 500)) - 6000
    assert true > 0.5 * 6000**2
    assert 0.99 * true <= got["n_links"].sum() <= 1.0001 * true
    assert got["component_id"].nunique() == 1
