"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.common import Store, tasks_for
from skyloom.llm.components import components

#: Neighbours on either side that a pass compares.
WINDOW = 64
#: Members of a component that one comparison task reads from either side.
BLOCK = 512
HASH_BITS = 60
ROWS_PER_TASK = 100_000


def leading_bits(rows: int, window: int) -> int:
    """Leading bits by which ``rows`` vectors, if spread evenly, fall into runs of a window at most."""
    return min(HASH_BITS, max(1, math.ceil(math.log2(max(rows, 2) / window))))


def passes_for(rows: int, threshold: float, window: int, miss: float = 0.001) -> int:
    """Passes after which a pair exactly at the threshold is missed with probability ``miss`` at most.

    Two vectors at angle t fall on different sides of a random plane with probability t/pi. In each pass all vectors that
    share ``leading_bits`` are compared, by the window or, where more share them than it holds, by ``run_links``.
    """
    bits = leading_bits(rows, window)
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return max(2, math.ceil(math.log(miss) / math.log(1 - together))) if together < 1 else 2


def _unit(frame: pd.DataFrame) -> np.ndarray:
    vectors = np.array(frame["vector"].tolist(), np.float64).reshape(len(frame), -1)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _roots(rows: int, links: np.ndarray) -> np.ndarray:
    """Index of the first row each of ``rows`` rows is joined to by pairs of ``links``."""
    parent = list(range(rows))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links.tolist():
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(rows)], np.int64)


def classes(vectors: DataFrame) -> DataFrame:
    """(label, vector, least_id, copies): each distinct usable vector of a label, with its least id and number of copies."""
    usable = F.size("vector") > 0
    usable &= ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable &= F.exists("vector", lambda x: x != 0)
    return vectors.where("label is not null and vector is not null").where(usable).groupBy("label", "vector").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))


def _edges(rows: pd.DataFrame, threshold: float, window: int, crossing: bool) -> pd.DataFrame:
    """Edges (a, b) among rows in order, each compared with ``window`` followers of its pass, label and length.

    With ``crossing`` only pairs count that begin before place 0 and end there or later. Linked rows are given as
    edges to the first row of their group.
    """
    found = []
    for _, group in rows.groupby(["turn", "label", "dims"], sort=False):
        unit, ids, place, links = _unit(group), group["node"].to_numpy(), group["place"].to_numpy(), []
        for step in range(1, min(window, len(group) - 1) + 1):
            near = np.einsum("ij,ij->i", unit[:-step], unit[step:]) >= threshold
            if crossing:
                near &= (place[:-step] < 0) & (place[step:] >= 0)
            at = np.flatnonzero(near)
            links.append(np.stack([at, at + step], 1))
        if links:
            root = _roots(len(ids), np.concatenate(links))
            moved = root != np.arange(len(ids))
            found.append(pd.DataFrame({"a": ids[root[moved]], "b": ids[moved]}))
    return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []})


def _projected(distinct: DataFrame, passes: int, seed: int, *columns: str) -> DataFrame:
    """(turn, label, dims, bits, node, ``columns``): the sides of random planes each vector is on, a row for each pass."""
    types = {f.name: f.dataType.simpleString() for f in distinct.schema.fields}
    hashed = {"turn": "int", "label": types["label"], "dims": "int", "bits": "long", "node": types["node"]} | {c: types[c] for c in columns}

    def project(frames):
        for frame in frames:
            for dims, rows in frame.groupby(frame["vector"].map(len)):
                unit = _unit(rows)
                for turn in range(passes):
                    planes = np.random.default_rng([seed, turn, dims]).standard_normal((dims, HASH_BITS))
                    bits = (unit @ planes > 0) @ (1 << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64))
                    yield rows.assign(turn=turn, dims=dims, bits=bits)[list(hashed)]

    return distinct.select("node", "label", "vector").mapInPandas(project, ", ".join(f"{name} {kind}" for name, kind in hashed.items()))


def projection_links(distinct: DataFrame, store: Store, threshold: float, passes: int, window: int, seed: int, tasks: int) -> DataFrame:
    """Edges (a, b) between ids of vectors found at or above the threshold; as many as connect them, not all pairs.

    In each pass vectors get the bits of their sides of random planes; the table is sorted by label, length, bits and id, and each
    vector is compared with ``window`` followers. A task works along its stretch of the order; the rows at its ends
    are compared with those of the next stretch in a second step.
    """
    projected = _projected(distinct, passes, seed, "vector")
    hashed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in projected.schema.fields)
    node = projected.schema["node"].dataType.simpleString()

    def filled(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(**{name: None for name in names if name not in frame})[names]

    def along(frames):
        part, head, held = TaskContext.get().partitionId(), [], None
        for frame in frames:
            if (known := sum(map(len, head))) < window:
                head.append(frame.head(window - known))
            held = frame if held is None else pd.concat([held.tail(window), frame])
            held = held.assign(place=0)
            yield _edges(held, threshold, window, False).pipe(filled)
        if held is not None:
            head, tail = pd.concat(head), held.tail(window)
            yield head.assign(border=part - 1, place=np.arange(len(head))).pipe(filled)
            yield tail.assign(border=part, place=np.arange(-len(tail), 0)).pipe(filled)

    order = ["turn", "label", "dims", "bits", "node"]
    ordered = projected.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    out = f"a {node}, b {node}, border int, place int, {hashed}"
    names = [part.split()[0] for part in out.split(", ")]
    found = store.keep(ordered.mapInPandas(along, out))
    borders = found.where("border >= 0").groupBy("border").applyInPandas(
        lambda rows: _edges(rows.sort_values("place"), threshold, window, True), f"a {node}, b {node}"
    )
    return found.where("a is not null").select("a", "b").union(borders).distinct()


def _block_pairs(members: DataFrame, *columns: str) -> DataFrame:
    """``columns``, low, high, home, node, vector: members, in ``blocks`` by hash, once for each pair of blocks theirs is in."""
    home = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = members.withColumn("home", home).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.select(*columns, F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high"), "home", "node", "vector")


def _joined(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of ``near``, the first row they hang together with; a column without any has the number of rows."""
    many = len(near)
    first, across = np.arange(many), np.full(near.shape[1], many)
    while True:
        across = np.where(near, first[:, None], many).min(axis=0)
        closer = np.minimum(first, np.where(near, across[None, :], many).min(axis=1))
        if (closer == first).all():
            return first, across
        first = closer


def run_links(distinct: DataFrame, roots: DataFrame, store: Store, threshold: float, passes: int, window: int, seed: int, bits: int) -> DataFrame | None:
    """Edges (a, b) that join components (``roots``: node, root) by links within runs of equal leading bits longer than a window.

    Dense data fall into such runs, of any length. Each is dealt into blocks and each pair of blocks compared by one
    task; where the runs of a label and length take no fewer comparisons than all its vectors do, these are compared instead,
    exactly. The edges given connect what is linked and not yet joined, they do not list it. None without such runs.
    """
    key = ["turn", "label", "dims", "run"]
    sides = store.keep(_projected(distinct, passes, seed).withColumn("run", F.shiftright("bits", HASH_BITS - bits)).drop("bits"))
    long = store.keep(sides.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > window + 1))
    if long.isEmpty():
        return None
    # Whole labels are turn -1, run 0.
    sizes = distinct.groupBy("label", F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    spent = long.groupBy("label", "dims").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("spent"))
    whole = store.keep(sizes.join(spent, ["label", "dims"]).where(F.col("spent") >= F.col("n").cast("double") * F.col("n")).select(F.lit(-1).alias("turn"), "label", "dims", F.lit(0).cast("long").alias("run"), "n"))
    long = long.join(whole, ["label", "dims"], "left_anti").select(*key, "n").union(whole)
    sides = sides.select(*key, "node").union(distinct.select(F.lit(-1), "label", F.size("vector"), F.lit(0).cast("long"), "node"))
    long = long.select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    known = distinct.select("node", "vector").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = sides.join(long, key).join(known, "node")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        mine, theirs = rows[rows["home"] == low], rows[rows["home"] == high]
        if rows["root"].nunique() < 2 or not len(mine) or not len(theirs):
            return pd.DataFrame({"a": [], "b": []})
        first, across = _joined(_unit(mine) @ _unit(theirs).T >= threshold)
        root, found = mine["root"].to_numpy(), across < len(mine)
        ends = {"a": np.concatenate([root[first], root[across[found]]]), "b": np.concatenate([root, theirs["root"].to_numpy()[found]])}
        edges = pd.DataFrame(ends)
        return edges[edges["a"] != edges["b"]].drop_duplicates()

    kind = distinct.schema["node"].dataType.simpleString()
    return _block_pairs(members, *key, "root").groupBy(*key, "low", "high").applyInPandas(compare, f"a {kind}, b {kind}").distinct()


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(node, linked): copies of other vectors of the component at or above the threshold, exactly.

    ``members`` (component, node, vector, copies, blocks) are dealt into blocks by hash; each pair of blocks of a component is compared by one
    task, which gives counts, not pairs. No task reads more than two blocks, however large the component.
    """
    pairs = _block_pairs(members, "component", "copies")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        mine, theirs = rows[rows["home"] == low], rows[rows["home"] == high]
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"node": [], "linked": []})
        near = (_unit(mine) @ _unit(theirs).T >= threshold).astype(np.int64)
        if low == high:
            np.fill_diagonal(near, 0)
            return pd.DataFrame({"node": mine["node"], "linked": near @ theirs["copies"].to_numpy()})
        return pd.DataFrame({
            "node": pd.concat([mine["node"], theirs["node"]]),
            "linked": np.concatenate([near @ theirs["copies"].to_numpy(), near.T @ mine["copies"].to_numpy()]),
        })

    kind = members.schema["node"].dataType.simpleString()
    counted = pairs.groupBy("component", "low", "high").applyInPandas(compare, f"node {kind}, linked long")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, window: int = WINDOW, passes: int | None = None, seed: int = 17) -> DataFrame:
    """One row per row of (vec_id, vector, label): vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and their cosine, in double precision, is ``threshold`` or more. Equal vectors are one
    node with a number of copies; sorted projection passes (their number grows with the table, ``passes_for``), each compared by windows and, where
    vectors are dense, by whole runs of equal leading bits, find the edges that make the components, and the links of each vector are then counted within its component, exactly. A pair is lost only if no chain of
    found pairs joins it.

    Vectors that are null, empty, zero or hold null or non-finite parts, and vectors with a null label, have no links and are their own component;
    vectors of different lengths never link. A repeated vec_id is one row each time and its copies link. A null vec_id has no links and a null
    component, and is kept. Empty tables give no rows.
    """
    store = Store(vectors.sparkSession)
    vectors = vectors.select("vec_id", "vector", "label")
    # The number of a node is fixed once it is written.
    distinct = store.keep(classes(vectors.where("vec_id is not null")).withColumn("node", F.monotonically_increasing_id()))
    rows = distinct.count()
    passes = passes or passes_for(rows, threshold, window)
    edges = projection_links(distinct, store, threshold, passes, window, seed, tasks_for(vectors.sparkSession, rows * passes, ROWS_PER_TASK))
    roots = components(edges, store)
    if (more := run_links(distinct, roots, store, threshold, passes, window, seed, leading_bits(rows, window))) is not None:
        roots = components(roots.union(more), store)
    joined = store.keep(distinct.join(roots.toDF("node", "component"), "node"))
    sizes = joined.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.min("least_id").alias("component_id"))
    joined = store.keep(joined.join(sizes, "component"))
    linked = link_counts(joined, threshold).join(joined.select("node", "component_id"), "node")
    known = distinct.join(linked, "node", "left").select(
        "label", "vector", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id"),
    )
    found = vectors.join(known, ["label", "vector"], "left")
    return found.select(
        "vec_id", F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("n_links")), F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
