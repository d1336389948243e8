import numpy as np
import pytest
from pyspark.sql import functions as F

from railpulse.llm import embeddings, tables

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.95):
    """Links, components by brute force."""
    sound = {}
    for k, (vec_id, vector, _) in enumerate(rows):
        if vector is not None and None not in vector and np.isfinite(vector).all() and np.any(vector):
            v = np.array(vector, np.float32).astype(float)
            sound[k] = v / np.linalg.norm(v)
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sound:
        for j in sound:
            if j < i and sound[i] @ sound[j] >= cosine:
                links[i] += 1
                links[j] += 1
                root[max(top(i), top(j))] = min(top(i), top(j))
    names = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            names[top(k)] = min(row[0], names.get(top(k), row[0]))
    return [(row[0], links[k], names.get(top(k))) for k, row in enumerate(rows)]


def found(table):
    return sorted(str((r["vec_id"], r["n_links"], r["component_id"]))
                  for r in embeddings.near_duplicates(table).collect())


def clustered(n, dims=64, seed=0):
    source = np.random.default_rng(seed)
    centres = source.standard_normal((n // 4, dims))
    rows = []
    for k in range(n):
        noise = source.standard_normal(dims) * source.choice([0.0, 0.1, 0.2, 0.28, 0.6])
        rows.append((k, [float(x) for x in centres[k % len(centres)] + noise], k % 3))
    return rows


def test_against_brute_force(spark):
    rows = clustered(400)
    want, got = plain(rows), embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    linked = {r["vec_id"]: r["n_links"] for r in got}
    assert all(linked[k] <= n for k, n, _ in want)  # none below the threshold
    assert sum(linked.values()) >= 0.97 * sum(n for _, n, _ in want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_unusual_rows(spark):
    v = [float(x) for x in np.random.default_rng(1).standard_normal(64)]
    rows = [(1, v, 0), (2, v, 1), (2, v, 1), (3, [2 * x for x in v], 0), (4, None, 0), (5, [0.0] * 64, 0),
            (6, [None, *v[1:]], 0), (7, [float("nan"), *v[1:]], 0), (8, [float("inf"), *v[1:]], 0),
            (None, v, 0), (9, [-x for x in v], 0), (-5, [x + 0.01 for x in v], 2)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(table) == sorted(map(str, plain(rows)))
    clashing = table.withColumns({c: F.lit("x") for c in ("unit", "digest", "code", "group", "component", "kept")})
    assert found(clashing) == found(table)
    # Vectors of rarer lengths link among themselves.
    other = [(11, [1.0, 2.0], 0), (12, [], 0), (13, [1.1, 2.0], 0), (14, [-1.0, 2.0], 0), (15, [1.0, 2.0, 0.0], 0)]
    assert found(table.unionAll(spark.createDataFrame(other, SCHEMA))) == sorted(
        [*map(str, plain(rows)), "(11, 1, 11)", "(12, 0, 12)", "(13, 1, 11)", "(14, 0, 14)", "(15, 0, 15)"])


def near_pairs(n, dims, energy, seed=0):
    """Vectors about a mean with this share of the energy, each with a copy at a cosine of 0.95 to 0.97."""
    source = np.random.default_rng(seed)
    mean = np.zeros(dims)
    mean[:] = np.sqrt(energy / dims)
    one = mean + source.standard_normal((n, dims)) * np.sqrt((1 - energy) / dims)
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    away = source.standard_normal((n, dims))
    away -= (away * one).sum(1, keepdims=True) * one
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = source.uniform(0.95, 0.97, (n, 1))
    return one, cosine * one + np.sqrt(1 - cosine ** 2) * away


@pytest.mark.parametrize("energy", [0.0, 0.5, 0.7])
def test_recall_with_a_strong_mean(spark, energy):
    one, two = near_pairs(1500, 64, energy)
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(np.concatenate([one, two]))]
    vectors = np.array([v for _, v, _ in rows], np.float32).astype(float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    want = ((vectors @ vectors.T >= 0.95).sum(1) - 1).sum()
    got = sum(r["n_links"] for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert want >= 2000 and 0.97 * want <= got <= want, got / want


def test_bits_and_rotations_planned():
    share = embeddings.share_of_bits(np.array([1.0, np.sqrt(0.3), 0.1]))
    assert np.allclose(share[:2], [0.102, 0.195], atol=2e-3) and share[2] == 1
    chance = embeddings.retrieved_share(share, 64)
    assert chance[0] > 0.99 and 0.8 < chance[1] < 0.9 and chance[2] == 0
    for energy, wanted in ((0.0, 1), (0.7, 4)):
        assert len(embeddings.fit_rotations(near_pairs(2000, 64, energy)[0])[1]) == wanted


def test_least_hashes(spark):
    rows = spark.range(50_000)
    want = [r["id"] for r in rows.orderBy(F.xxhash64("id")).limit(700).collect()]
    sifted = tables.least_hashes(rows, 700, "id")
    assert [r["id"] for r in sifted.collect()] == want
    assert tables.least_hashes(spark.range(5), 700, "id").count() == 5


def test_small_tables(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None, 0)], SCHEMA)) == ["(1, 0, 1)"]
    assert found(spark.createDataFrame([(4, [1.0, 0.0], 0)], SCHEMA)) == ["(4, 0, 4)"]
    short = [(k, [float(np.cos(k / 20)), float(np.sin(k / 20))], 0) for k in range(30)]
    assert found(spark.createDataFrame(short, SCHEMA)) == sorted(map(str, plain(short)))


def test_tables_retrieve_every_near_code(spark):
    source = np.random.default_rng(3)
    codes = [int(x) for x in source.integers(0, 1 << 64, 150, dtype=np.uint64)]
    codes += [c ^ sum(1 << int(b) for b in source.choice(64, source.integers(0, 14), replace=False)) for c in codes]
    rows = [(k, 64, [int(np.array(c, np.uint64).view(np.int64))], 11) for k, c in enumerate(codes)]
    table = spark.createDataFrame(rows, "group long, size int, codes array<long>, reach int")
    pairs = embeddings.candidate_pairs(table).collect()
    got = [(r["a"], r["b"]) for r in pairs]
    want = [(a, b) for a in range(len(codes)) for b in range(a + 1, len(codes))
            if (codes[a] ^ codes[b]).bit_count() <= 11]
    assert sorted(got) == want  # each once


def test_rotation_balances_and_keeps_neighbours():
    source = np.random.default_rng(6)
    data = source.standard_normal((3000, 32)) * np.linspace(3, 0.2, 32)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    mean, matrix = embeddings.fit_rotation(data)
    codes = (data - mean) @ matrix >= 0
    assert np.abs(codes.mean(0) - 0.5).max() < 0.2
    assert np.allclose(matrix.T @ matrix, np.eye(32), atol=1e-8)
