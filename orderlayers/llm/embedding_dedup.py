"""Near-duplicate embeddings by a forest of random-projection trees.

Only vectors of one label are compared. Each tree splits a label's vectors by where they fall on
random directions, each time at the median of a bounded sample; vectors near a split go to both
sides (spill), so that close pairs are rarely parted, and several trees with directions of their
own make up for those that are. Cells larger than LEAF are split further, in rounds of up to
DEPTH levels, by models fitted to their own samples, until all are small or no direction tried
would spare comparisons, as in a group of near copies. Within each leaf all pairs are compared
exactly, in double precision, by block products; a leaf larger than LEAF is dealt into blocks, and
each pair of its blocks is one group of bounded size. A pair that shares leaves is counted in the
first of them only, which each group can tell from the two vectors' leaf lists, so trees and spill
count no link twice. A label that no split divides in one tree is compared in that tree alone.

Equal vectors of a label are one class with a multiplicity. Leaves return no pairs but each
vector's number of links and one edge per linked group, and components come from those edges.

Defined results: a vector that is NULL, empty, zero, or holds a NULL or non-finite component, and
one with a NULL label or NULL ``vec_id``, links with nothing. Vectors of different lengths do not
link. Rows that repeat a ``vec_id`` are vectors of their own that share a component's name.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import mix, stored
from orderlayers.llm.components import connected_components

TREES, LEAF, DEPTH = 4, 2048, 6
#: Vectors of a cell that its splits are fitted to, about.
SAMPLE = 4096
#: Half the width of a split's overlap, in standard deviations of how far the two vectors of a
#: pair at the threshold lie apart on a random direction. A split parts about one in 200 of them.
SPILL = 0.9
#: A split is made when it leaves at most this share of the comparisons of the cell as a whole.
WORTH = 0.9
#: Evenly spaced cuts tried where the median is no good cut, as among clumps of unequal size.
CUTS = 31
BLOCK = 1024


def _can_link() -> F.Column:
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(vec, lambda x: x != 0)
    return (
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & vec.isNotNull()
        & F.coalesce(finite, F.lit(False)) & F.coalesce(nonzero, F.lit(False))
    )


def directions(seed: int, levels: int, width: int) -> np.ndarray:
    """Random unit directions of a cell's splits, one for each level."""
    generator = np.random.default_rng(seed & 0x7FFFFFFFFFFFFFFF)
    found = generator.normal(size=(levels, width))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    """Unit rows of a column of equally long lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _best_cut(line: np.ndarray, spill: float) -> float | None:
    """The median, or else the best of evenly spaced cuts; None where no cut spares enough."""

    def left_over(cut: float) -> float:
        left, right = np.count_nonzero(line <= cut + spill), np.count_nonzero(line >= cut - spill)
        return (left * left + right * right) / len(line) ** 2

    cut = float(np.median(line))
    if left_over(cut) > WORTH:
        cut = min(map(float, np.linspace(line.min(), line.max(), CUTS + 2)[1:-1]), key=left_over)
    return cut if left_over(cut) <= WORTH else None


def _fit_cells(reach: float):
    def work(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
        """Thresholds of a cell's splits, level by level, at the medians of its sample."""
        points = _matrix(cell["vec"])
        levels, spill = int(cell["levels"][0].as_py()), reach / np.sqrt(points.shape[1])
        lines = points @ directions(key[0].as_py(), levels, points.shape[1]).T
        cuts = np.full((1 << levels) - 1, np.nan)
        members: dict[int, np.ndarray] = {0: np.arange(len(points))}
        for node in range(len(cuts)):
            own = members.pop(node, np.empty(0, np.int64))
            level = (node + 1).bit_length() - 1
            if len(own) < 2:
                continue
            line = lines[own, level]
            cut = _best_cut(line, spill)
            if cut is None:
                if level + 1 < levels:  # one clump on this direction: the next level's is tried
                    members[2 * node + 1] = own
                continue
            cuts[node] = cut
            members[2 * node + 1], members[2 * node + 2] = own[line <= cut + spill], own[line >= cut - spill]
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int64()), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    return work


def _route_batches(reach: float):
    """Send each row of a cell down the cell's splits; it may come out in several new cells."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cell").to_numpy()
            out_rows, out_cells = [], []
            kinds, first, inverse = np.unique(cells, return_index=True, return_inverse=True)
            for k, cell in enumerate(kinds):
                cuts = np.array(batch.column("cuts")[int(first[k])].as_py(), float)
                levels = len(cuts).bit_length()
                rows = np.flatnonzero(inverse == k)
                points = _matrix(batch.column("vec").take(pa.array(rows)))  # of one length in one cell
                spill = reach / np.sqrt(points.shape[1])
                lines = points @ directions(int(cell), levels, points.shape[1]).T
                node = np.zeros(len(rows), np.int64)
                at = np.arange(len(rows))
                for level in range(levels):
                    cut, line = cuts[node], lines[at, level]
                    split = ~np.isnan(cut)
                    left = ~split | (line <= cut + spill)
                    right = split & (line >= cut - spill)
                    # An unsplit cell goes on whole in its left child.
                    node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
                    at = np.concatenate([at[left], at[right]])
                base = np.uint64(int(cell) * 0x9E3779B97F4A7C15 % (1 << 64))
                out_rows.append(rows[at])
                out_cells.append(mix(base + node.astype(np.uint64)).view(np.int64))
            take = pa.array(np.concatenate(out_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(take) for n in ("group", "tree", "cls", "n", "vec")]
                + [pa.array(np.concatenate(out_cells))],
                ["group", "tree", "cls", "n", "vec", "cell"],
            )

    return work


def _leaf_links(least: float):
    """Links between two blocks of a leaf, or within one, that no earlier common leaf has counted:
    counts, and edges of groups."""

    def work(key: tuple[pa.Scalar, ...], leaf: pa.Table) -> pa.Table:
        points = _matrix(leaf["vec"])
        names, many = leaf["cls"].to_numpy(), leaf["n"].to_numpy()
        lists = leaf["leaves"].combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        flat, marks = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
        here, low, high = (k.as_py() for k in key)
        part, count = leaf["part"].to_numpy(), len(names)
        links = np.zeros(count, np.int64)
        parent = np.arange(count)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        # The leaves before this one in each vector's sorted list.
        earlier = [flat[marks[i] : marks[i + 1]] for i in range(count)]
        earlier = [x[x < here] for x in earlier]
        width = max(map(len, earlier), default=0)
        table = np.full((count, width), np.iinfo(np.int64).min)
        for i, x in enumerate(earlier):
            table[i, : len(x)] = x
        empty = np.iinfo(np.int64).min
        rows, columns = np.flatnonzero(part == low), np.flatnonzero(part == high)
        across = points[columns].T
        for first in range(0, len(rows), BLOCK):
            block = rows[first : first + BLOCK]
            i, j = np.nonzero(points[block] @ across >= least)
            i, j = block[i], columns[j]
            if low == high:
                once = i < j
                i, j = i[once], j[once]
            for at in range(0, len(i), 1 << 18):
                a, b = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
                met = np.zeros(len(a), bool)
                for x in range(width):
                    for y in range(width):
                        met |= (table[a, x] == table[b, y]) & (table[a, x] != empty)
                a, b = a[~met], b[~met]
                links += np.bincount(a, weights=many[b], minlength=count).astype(np.int64)
                links += np.bincount(b, weights=many[a], minlength=count).astype(np.int64)
                # Rows come in order, so most pairs meet a group that is joined already.
                for x, y in zip(*_fresh(parent, a, b), strict=True):
                    rx, ry = root(int(x)), root(int(y))
                    if rx != ry:
                        parent[max(rx, ry)] = min(rx, ry)
                while (parent != parent[parent]).any():
                    parent = parent[parent]
        tops = np.array([root(i) for i in range(count)], np.int64)
        told = np.flatnonzero((links > 0) | (tops != np.arange(count)))
        return pa.table({"cls": names[told], "links": links[told], "top": names[tops[told]]})

    return work


def _fresh(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that could still join two groups: one for each second vector and group."""
    apart = parent[a] != parent[b]
    a, b = a[apart], b[apart]
    _, first = np.unique(parent[a] * len(parent) + b, return_index=True)
    return a[first], b[first]


def embedding_components(embeddings: DataFrame, least: float = 0.93, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``embeddings`` (vec_id, embedding, label)."""
    reach = SPILL * float(np.sqrt(2 - 2 * least))
    usable = embeddings.filter(_can_link()).select(
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.col("vec_id").cast("long").alias("vec_id"),
    )
    group = F.xxhash64("label", F.size("vec"))
    keyed = usable.select(group.alias("group"), "vec", "vec_id", F.xxhash64("label", "vec").alias("cls"))
    classes = stored(
        keyed.groupBy("group", "cls", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")),
        "embedding-classes",
    )
    members = stored(keyed.select("vec_id", "cls"), "embedding-members")
    rows = classes.select(
        "group", F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"), "cls", "n", "vec"
    ).withColumn("cell", F.xxhash64("group", "tree"))
    done: list[DataFrame] = []
    while True:
        sizes = stored(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size")), "embedding-sizes")
        large = sizes.filter(F.col("size") > leaf)
        if large.isEmpty():
            done.append(rows.withColumn("parts", F.lit(1).cast("long")))
            break
        done.append(rows.join(large, "cell", "left_anti").withColumn("parts", F.lit(1).cast("long")))
        # One level more than halves would need: overlaps make halves larger than half.
        levels = F.least(F.lit(DEPTH), F.ceil(F.log2(F.col("size") / leaf)) + 1).cast("int")
        share = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("size"))
        chosen = (
            rows.join(large.select("cell", share.alias("share"), levels.alias("levels")), "cell")
            .filter(F.pmod(F.xxhash64("cls", "cell"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
            .select("cell", "vec", "levels")
        )
        models = stored(
            chosen.groupBy("cell").applyInArrow(_fit_cells(reach), "cell long, cuts array<double>"),
            "embedding-models",
        )
        split = models.filter(F.exists("cuts", lambda x: ~F.isnan(x)))
        parts = F.ceil(F.col("size") / leaf).alias("parts")
        whole = models.filter(~F.exists("cuts", lambda x: ~F.isnan(x))).join(large, "cell").select("cell", parts)
        if len(done) == 1:  # still one cell a tree: where one stays whole, the other trees find nothing more
            enough = rows.join(whole, "cell").groupBy("group").agg(F.min("tree").alias("enough"))
            enough = stored(enough, "embedding-enough")
            rows = rows.join(enough, "group", "left").filter("enough is null or tree = enough").drop("enough")
        done.append(rows.join(whole, "cell").select(*done[0].columns))
        rows = stored(
            rows.join(split, "cell").mapInArrow(
                _route_batches(reach), "group long, tree int, cls long, n long, vec array<double>, cell long"
            ),
            "embedding-cells",
        )
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    placed = stored(placed.select("cls", "n", "cell", "parts", "vec"), "embedding-leaves")
    lists = stored(
        placed.groupBy("cls").agg(F.array_sort(F.collect_set("cell")).alias("leaves")), "embedding-lists"
    )
    # Each vector of a leaf of several blocks meets those of every block once.
    blocks = (
        placed.join(lists, "cls")
        .withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("cell", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "cls", "n", "vec", "leaves", "part")
    )
    found = stored(
        blocks.groupBy("cell", "low", "high").applyInArrow(_leaf_links(least), "cls long, links long, top long"),
        "embedding-links",
    )
    counts = stored(found.groupBy("cls").agg(F.sum("links").alias("links")), "embedding-counts")
    roots = connected_components(found.select("cls", "top"), "cls", "top")
    named = (
        classes.select("cls", "rep", "n")
        .join(counts, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "rep", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cls").alias("root"))
    )
    named = stored(named, "embedding-named")
    names = stored(named.groupBy("root").agg(F.min("rep").alias("component_id")), "embedding-names")
    known = stored(
        named.join(names, "root").select(
            "cls", "component_id", (F.col("links") + F.col("n") - 1).alias("n_links")
        ),
        "embedding-known",
    )
    linked = members.join(known, "cls").select("vec_id", "n_links", "component_id")
    alone = embeddings.filter(~_can_link()).select(F.col("vec_id").cast("long").alias("vec_id")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
