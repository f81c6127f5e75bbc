from __future__ import annotations

import numpy as np

from orderlayers.llm import embedding_dedup
from orderlayers.llm.embedding_dedup import embedding_components


def brute(rows, least=0.93):
    ids = [x[0] for x in rows]
    links = dict.fromkeys(ids, 0)
    label = {i: i for i in ids}
    for i, (a, u, k) in enumerate(rows):
        for b, v, m in rows[:i]:
            if k == m and len(u) == len(v) and np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) >= least:
                links[a] += 1
                links[b] += 1
                low, high = sorted((label[a], label[b]))
                label = {x: low if y == high else y for x, y in label.items()}
    return {i: (links[i], label[i]) for i in ids}


def test_links_and_components_equal_brute_force(spark):
    r = np.random.default_rng(3)
    rows = []
    for k in range(300):
        if k % 3 or not rows:
            vector = r.normal(size=16)
        else:
            vector = np.array(rows[r.integers(len(rows))][1]) + r.normal(size=16) * 0.05
        rows.append((k, [float(x) for x in vector.astype(np.float32)], int(k % 2)))
    rows.append((900, rows[10][1], rows[10][2]))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in embedding_components(frame, leaf=32).collect()}
    assert found == brute(rows)


def test_a_group_of_near_copies_is_compared_in_groups_of_bounded_size(spark, monkeypatch, tmp_path):
    r = np.random.default_rng(5)
    middle = r.normal(size=64)
    # Mutual cosines about 0.93: some pairs link, some do not, and no split divides the clump.
    clump = middle / np.linalg.norm(middle) + r.normal(size=(300, 64)) * 0.034
    rows = [(k, [float(x) for x in v.astype(np.float32)], 1) for k, v in enumerate(clump)]
    met = embedding_dedup._leaf_links

    def watched(least):
        work = met(least)

        def noting(key, leaf):
            (tmp_path / "-".join(str(k.as_py()) for k in key)).write_text(str(leaf.num_rows))
            return work(key, leaf)

        return noting

    monkeypatch.setattr(embedding_dedup, "_leaf_links", watched)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in embedding_components(frame, leaf=32).collect()}
    assert found == brute(rows)
    assert 0 < sum(n for n, _ in found.values()) < 300 * 299
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert len(sizes) == 55 and max(sizes) <= 4 * 32  # ten blocks, in one tree


def test_a_cell_is_split_on_another_direction_or_beside_the_median():
    # Two clumps of unequal size: the median lies in the larger one, where its overlap takes all.
    line = np.concatenate([np.full(49, -1.0), np.full(51, 1.0)])
    cut = embedding_dedup._best_cut(line, 0.1)
    assert cut is not None and -0.9 < cut < 0.9
    assert embedding_dedup._best_cut(np.zeros(100), 0.1) is None


def test_vectors_that_cannot_link(spark):
    one = [1.0, 0.0]
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [None, 1.0], 1), (5, [float("nan"), 1.0], 1),
        (6, one, None), (None, one, 1), (8, one, 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, one, 2),
        (12, [float("inf"), 1.0], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embedding_components(frame).collect()}
    assert found.pop(8) == (1, 8, True)
    assert found.pop(9) == (1, 8, False)
    assert found == {k: (0, k, True) for k in (1, 2, 3, 4, 5, 6, 10, 11, 12, None)}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_components(frame).count() == 0
