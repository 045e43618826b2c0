import numpy as np
import pytest

from mendframe.llm import near_embeddings as near


def brute(rows, threshold=0.9):
    """{position: (n_links, component)} over (id, vector) rows by comparing all."""
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, (_, v) in enumerate(rows) if usable(v)]
    links = {i: set() for i in range(len(rows))}
    for i in good:
        for j in good:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.asarray(rows[k][1], dtype=np.float64) for k in (i, j))
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].add(j), links[j].add(i)
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[i] = (rows[i][0], len(links[i]), min(ids, default=None))
    return sorted(out.values(), key=str)


def result(df, **options):
    return sorted(((r["id"], r["n_links"], r["component"]) for r in near.near_duplicates(df, **options).collect()), key=str)


def clustered(count, size, spread, seed):
    """Clusters of near vectors of several widths among single ones."""
    generator = np.random.default_rng(seed)
    rows = []
    for _ in range(count):
        centre = generator.standard_normal(size)
        for _ in range(int(generator.integers(1, 30))):
            rows.append(centre + spread * generator.random() * generator.standard_normal(size))
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rows)]


def test_recall_over_many_leaves(spark):
    rows = clustered(150, 32, 0.4, 1)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = result(frame, leaf=64), brute(rows)
    links, all_links = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all_links > 2000 and links >= 0.98 * all_links
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))  # none below the threshold, none twice
    assert sum(a[2] == b[2] for a, b in zip(got, want, strict=True)) >= 0.98 * len(want)


def test_recall_of_pairs_at_the_threshold_in_a_deep_forest():
    """Pairs of cosine 0.90 to 0.92 over ten levels of splits and more, routed as the forest does."""
    generator, size, leaf = np.random.default_rng(7), 32, 16
    rows = []
    for _ in range(6000):
        a, other = generator.standard_normal((2, size))
        a /= np.sqrt(a @ a)
        other -= (other @ a) * a
        cosine = generator.uniform(0.9, 0.92)
        rows += [a, cosine * a + np.sqrt(1 - cosine**2) * other / np.sqrt(other @ other)]
    x, met = np.array(rows), np.zeros(len(rows) // 2, dtype=bool)
    for tree in range(near.tree_count(len(x), leaf)):
        todo = [(tree + 1, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            bounds = near.fit_subtree(node, x[at][: near.SAMPLE], len(at), 0.9, leaf)
            if np.isnan(bounds[1, 0]):
                pairs, members = np.unique(at // 2, return_counts=True)
                met[pairs[members == 2]] = True
            else:
                todo += [(node * near.SLOTS + slot, at[part]) for slot, part in near.route(node, bounds, x[at])]
    assert met.mean() >= 0.97


def test_dense_group_is_counted_exactly(spark):
    """Hundreds of mutual links, far over the leaf size: compared in blocks, all found."""
    generator = np.random.default_rng(2)
    centre = generator.standard_normal(16)
    rows = [(i, (centre + 0.02 * generator.standard_normal(16)).tolist()) for i in range(300)]
    rows += [(300 + i, generator.standard_normal(16).tolist()) for i in range(100)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(frame, leaf=32) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (9, [2.0, 4.0]), (None, [1.0, 2.0]), (None, [3.0, -9.0]), (4, None), (6, []),
        (7, [0.0, 0.0]), (8, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, [1.0, 2.0, 0.0]), (13, [1e300, 2e300]), (14, [-1.0, -2.0]),
        (15, [0.0, 1.0]), (15, [1.0, 0.0]), (None, None),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cls string, n int")
    assert result(frame) == brute(rows)
    assert result(frame.where("false")) == []


@pytest.mark.parametrize("name", ["embeddings"])
def test_table(spark, folder, name):
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in table.collect()]
    assert result(table) == brute(rows)
