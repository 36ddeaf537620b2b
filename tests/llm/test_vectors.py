"""Clusters by Walsh-Hadamard search and near-equal vectors, against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from millrace.llm.centroids import Search, clusters, coarse_to_fine, transformed, whole
from millrace.llm.near_vectors import Forest, bits_for, compare, near_vectors, tables_needed

DDL = "vec_id long, embedding array<float>, label int, cluster int, distance long, class long, component_id long, table int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, 1, 2, 3, 4, 5) for i, e in rows], DDL).repartition(3)


def clouds(n, dim, seed, spread=0.3, centres=9):
    rng = random.Random(seed)
    middle = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(centres)]
    return [[float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(middle)] for _ in range(n)]


def edge_vectors(dim):
    good = clouds(120, dim, 5)
    rows = [(i, e) for i, e in enumerate(good)]
    rows += [(i, good[i % 3]) for i in (1000, 1001, 1002, 1003)]  # copies
    rows += [(7, good[7]), (7, good[7]), (None, good[9]), (None, None), (200, None), (201, []), (202, [0.0] * dim)]
    rows += [(203, [math.nan] + [1.0] * (dim - 1)), (204, [math.inf] + [1.0] * (dim - 1)), (205, [None] + [1.0] * (dim - 1))]
    rows += [(206, [1.0] * (dim - 1)), (207, [1.0] * (2 * dim)), (208, [2.0] * (2 * dim))]
    return rows


def plain_clusters(rows, k, rounds, dim):
    sound = [(i, e) for i, e in rows if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    kept = [(i, tuple(math.floor(64 * float(np.float32(x))) if abs(x) < 2**40 else int(float(np.float32(x))) * 64 for x in e), e) for i, e in sound]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    centroids = [r[1] for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            centroids[j] = tuple(sum(col) // len(g) for col in zip(*g))
    final = [(i, *reversed(nearest(v))) for i, v, _ in kept]
    by = {j: sum(d for _, c, d in final if c == j) for j in range(len(centroids))}
    total = sum(by.values())
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(
        ((i, c, fits(d), fits(by[c]), fits(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in final), key=repr
    )


def test_transform_keeps_distances():
    order = coarse_to_fine(64)
    x = np.random.RandomState(1).randint(-(1 << 20), 1 << 20, (50, 64))
    w = transformed(x, order)
    assert sorted(order.tolist()) == list(range(64))
    assert ((w**2).sum(axis=1) == 64 * (x**2).sum(axis=1)).all()
    assert (w[:, 0] == x.sum(axis=1)).all()


def test_search_breaks_ties_by_number():
    search = Search([(0, 0), (2, 0), (0, 2), (2, 0)])
    cluster, distance = search.nearest(np.array([[1, 0], [2, 0], [1, 1], [-5, 9]]))
    assert cluster.tolist() == [0, 1, 0, 2] and distance.tolist() == [1, 0, 2, 74]


@pytest.mark.parametrize("k, rounds", [(16, 3), (3, 1), (500, 2), (4, 0)])
def test_clusters_match_plain_rounds(spark, k, rounds):
    rows = edge_vectors(16)
    got = sorted((tuple(r) for r in clusters(frame(spark, rows), k, rounds, 16).collect()), key=repr)
    assert got == plain_clusters(rows, k, rounds, 16)


def test_clusters_of_very_large_components(spark):
    rows = [(i, [float(np.float32(s * 10.0**p))] + [1.0] * 3) for i, (s, p) in enumerate([(1, 38), (-1, 38), (3, 37), (2, 12), (2.5, 12), (1, 1), (1, 2)])]
    got = sorted((tuple(r) for r in clusters(frame(spark, rows), 3, 3, 4).collect()), key=repr)
    assert got == plain_clusters(rows, 3, 3, 4)
    assert whole(np.array([[1e300, -0.001]])).tolist() == [[int(1e300) * 64, -1]]


def test_no_vectors(spark):
    for df in (frame(spark, []), frame(spark, [(1, None), (2, [0.0])])):
        assert clusters(df).collect() == []
    assert near_vectors(frame(spark, [])).collect() == []


def plain_near(rows, cosine=0.9):
    def sound(i, e):
        return i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)

    n = len(rows)
    ok = [sound(*r) for r in rows]
    links = [[] for _ in rows]
    for a in range(n):
        for b in range(n):
            if a != b and ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], dtype=float), np.array(rows[b][1], dtype=float)
                if float(x @ y) / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= cosine:
                    links[a].append(b)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = min((rows[b][0] for b in seen), default=None) if ok[a] else rows[a][0]
        out.append((rows[a][0], len(links[a]), least, rows[a][0] is not None and rows[a][0] == least))
    return sorted(out, key=repr)


def near_rows(seed=3):
    rng = random.Random(seed)
    base = clouds(60, 16, seed, spread=1.0, centres=60)
    rows = [(i, e) for i, e in enumerate(base)]
    for i in range(60, 400):  # chains of copies, each near the one before
        source = rows[rng.randrange(len(rows))][1]
        step = rng.choice([0.02, 0.1, 0.2])
        rows.append((i, [float(np.float32(x * 3 + rng.gauss(0, step * 3 * abs(x) + 0.01))) for x in source]))
    return rows


@pytest.mark.parametrize("bucket, block", [(256, 8192), (16, 8192), (8, 5), (256, 64)])
def test_near_vectors_match_brute_force(spark, bucket, block):
    rows = near_rows() + [(1000 + i if i is not None else None, e) for i, e in edge_vectors(16)]
    got = near_vectors(frame(spark, rows), recall=0.999999, bucket=bucket, block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_near(rows)


def test_equal_ids_with_other_vectors_stay_apart(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (5, [1.0, 0.01]), (6, [0.01, 1.0]), (0, [-1.0, 0.0])]
    got = sorted(tuple(r) for r in near_vectors(frame(spark, rows)).collect())
    assert got == plain_near(rows)


def test_recall_at_the_threshold():
    """Pairs exactly at the threshold meet in one of the tables as often as asked."""
    rng = np.random.RandomState(9)
    for bits in (6, 10, 16):
        tables = tables_needed(0.9, bits, 0.99)
        missed = 0
        for _ in range(300):
            a, b = rng.standard_normal((2, 64))
            a /= np.linalg.norm(a)
            b -= (a @ b) * a
            b = 0.9 * a + math.sqrt(1 - 0.81) * b / np.linalg.norm(b)
            planes = rng.standard_normal((64, bits * tables))
            same = ((a @ planes > 0) == (b @ planes > 0)).reshape(tables, bits).all(axis=1)
            missed += not same.any()
        assert missed <= 12
    assert tables_needed(0.9, 0, 0.9999) == 1
    assert [bits_for(n, 256) for n in (0, 1, 256, 257, 1 << 20, 10**9)] == [0, 0, 0, 1, 12, 22]


def test_a_pair_counts_in_its_first_table_only():
    vectors = np.array([[1.0, 0.0], [1.0, 0.1], [1.0, 0.2]])
    codes = np.array([[1, 5], [2, 5], [1, 5]], dtype=np.int32)
    links, tree = compare(vectors, codes, np.ones(3), 0, True, 1, 0.9)
    assert links.tolist() == [1, 2, 1] and tree.tolist() == [0, 0, 0]
    links, _ = compare(vectors, codes, np.ones(3), 0, True, 0, 0.9)
    assert links.tolist() == [2, 2, 2]


def test_forest_joins_all_linked_rows():
    rng = np.random.RandomState(4)
    for _ in range(30):
        mask = rng.rand(40, 30) < 0.04
        forest = Forest(70)
        forest.link(mask, np.arange(40), np.arange(40, 70))
        label = forest.labels()
        assert all(label[i] == label[40 + j] for i, j in zip(*np.nonzero(mask)))
        parts = set(map(tuple, np.argwhere(mask)))
        assert len(set(label.tolist())) >= 70 - len(parts)
