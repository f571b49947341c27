"""Embedding near-duplicates by spherical k-means cells.

Two vectors are linked when their cosine, in double precision, is at least
``threshold``; a class is what such links connect, and the row with the smallest
id stays as its representative. Every link is found (``reach`` = 1):

* Equal vectors are one vector with a number of copies.
* Spark ML's k-means with cosine distance is fitted on a bounded sample
  (about ``SAMPLE`` vectors for each cell, picked by hash). Every vector lives
  in the cell of its nearest centroid ``h``. Two vectors on either side of
  the plane between two centroids are at an angle of at least the sum of their
  own angles to the plane, so of a linked pair one is within half the threshold's
  angle of it: a vector visits each cell ``c`` with
  ``x.h - x.c <= sin(angle / 2) |h - c|``. Pairs that both sides' visits find
  are counted in the cell with the smaller number.
* Within a cell, members and visitors are cut into blocks of ``BLOCK`` vectors
  and multiplied block by block; a task holds two blocks and returns a number of
  links per vector and a spanning set of edges, never pairs.
* Members of the commonest length within half the angle of the centroid (the core)
  are linked to one another without any product: a dense group of near copies
  costs no more than its rows. Vectors further than one and a half angles from the
  centroid (far) cannot reach the core and aren't compared with it.

With ``reach`` < 1 the visits shrink in proportion: fewer products, and pairs
across a plane may be missed. Cells number one per ``CELL`` distinct vectors, at
most ``MAX_CELLS``: the centroids, the table of block counts and the core sums are
bounded. The work is quadratic in what shares a cell outside its core.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite
component is linked with nothing, not even its equals; vectors of different
lengths aren't linked; equal rows are linked as rows of their own; the component
of a class without any id is null and its rows stay; a row without links stays; an
empty table gives an empty result. A kept column with the name of a result comes
out with ``_in`` appended.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import checkpointed, free_names
from adpulse.llm.simhash import components

THRESHOLD = 0.9
CELL = 8000
MAX_CELLS = 1024
#: Vectors of the sample for each cell.
SAMPLE = 100
SEED = 7
ROUNDS = 10
BLOCK = 8192
#: Cosines that a task holds at a time.
STRIP = 1 << 22
#: Room for rounding in every decision that isn't the cosine itself.
SLACK = 1e-7
RESULTS = ["n_links", "component_id", "kept"]

CORE, RING, FAR, RING_VISIT, FAR_VISIT = range(5)
#: Roles whose blocks are multiplied with one another; core with core is linked as it is, core with far never.
MEETINGS = [(CORE, RING), (CORE, RING_VISIT), (RING, RING), (RING, FAR), (RING, RING_VISIT), (RING, FAR_VISIT),
            (FAR, FAR), (FAR, RING_VISIT), (FAR, FAR_VISIT)]


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, the largest component first so that no square overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of one matrix, shorter ones filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.repeat(np.arange(len(lists)), sizes),
        np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def fit_cells(vectors: DataFrame, count: int, width: int, cells: int) -> np.ndarray:
    """Unit centroids of at most ``cells`` cells, from about ``SAMPLE * cells`` of the ``count`` vectors."""
    filled = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector")))
    largest = F.array_max(F.transform("vector", F.abs))
    share = min(1 << 30, -(-(SAMPLE * cells << 30) // count))
    sample = checkpointed(vectors.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 30)) < share)
                          .select(array_to_vector(F.transform(filled, lambda x: x / largest)).alias("features")))
    if sample.isEmpty():
        sample = checkpointed(vectors.limit(1).select(array_to_vector(F.transform(filled, lambda x: x / largest))
                                                      .alias("features")))
    model = KMeans(k=cells, distanceMeasure="cosine", initMode="k-means||", maxIter=ROUNDS, seed=SEED).fit(sample)
    centres = np.array(model.clusterCenters(), dtype=np.float64)
    return _unit(centres[np.abs(centres).max(axis=1) > 0])


def _assign(centres: np.ndarray, usual: int, angle: float, reach: float):
    near = np.sin(angle / 2) * reach
    apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            dots = _unit(_matrix(b.column("vector"), centres.shape[1])) @ centres.T
            home = dots.argmax(axis=1)
            gap = dots[np.arange(len(home)), home][:, None] - dots
            goes = gap <= near * apart[home] + SLACK
            goes[np.arange(len(home)), home] = False
            row, cell = np.nonzero(goes)
            ends = np.concatenate(([0], np.cumsum(goes.sum(axis=1))))
            away = np.arccos(np.clip(dots, -1, 1))
            at_home = away[np.arange(len(home)), home]
            sizes = np.diff(b.column("vector").offsets.to_numpy())
            role = np.where((at_home <= angle / 2 - SLACK) & (sizes == usual), CORE, np.where(at_home <= 1.5 * angle + SLACK, RING, FAR))
            visit_role = np.where(away[row, cell] <= 1.5 * angle + SLACK, RING_VISIT, FAR_VISIT)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("uid", "vector", "w")], pa.array(home.astype(np.int32)),
                 pa.array(role.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cell.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(visit_role.astype(np.int32)))],
                names=["uid", "vector", "w", "home", "role", "visits", "visit_roles"])
    return run


_ASSIGNED = "uid string, vector array<double>, w long, home int, role int, visits array<int>, visit_roles array<int>"


def _tasks() -> Column:
    """The products ``(left role, right role, left block, right block)`` in which a row of ``role`` and
    ``block`` takes part; ``n`` holds its cell's number of blocks by role."""
    def others(role: int) -> Column:
        count = F.get("n", F.lit(role))
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def task(a: int, b: int, left, right) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), left.alias("left"), right.alias("right"))

    def side(role: int, partner: int, make) -> Column:
        return F.when(F.col("role") == role, F.transform(others(partner), lambda j: make(j)))

    def meeting(a: int, b: int) -> list[Column]:
        if a == b:
            return [side(a, a, lambda j: task(a, a, F.least(own, j), F.greatest(own, j)))]
        return [side(a, b, lambda j: task(a, b, own, j)), side(b, a, lambda j: task(a, b, j, own))]

    own = F.col("block")
    out = [column for a, b in MEETINGS for column in meeting(a, b)]
    return F.flatten(F.filter(F.array(*out), lambda x: x.isNotNull()))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels, each a node's smallest known companion, after linking the nodes ``a`` with ``b``."""
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _visited(visits: list[np.ndarray], cells: np.ndarray) -> np.ndarray:
    """By row of ``visits`` and by cell of the sorted ``cells``: whether it is among them."""
    row = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
    goal = np.concatenate([np.asarray(v, dtype=np.int64) for v in visits])
    at = np.minimum(np.searchsorted(cells, goal), len(cells) - 1)
    out = np.zeros((len(visits), len(cells)), dtype=bool)
    known = cells[at] == goal
    out[row[known], at[known]] = True
    return out


def _products(threshold: float, width: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cell, a, b = (int(rows[c].iloc[0]) for c in ("cell", "a", "b"))
        lo, hi = int(rows["left"].iloc[0]), int(rows["right"].iloc[0])
        is_left = ((rows["role"] == a) & (rows["block"] == lo)).to_numpy()
        is_right = ((rows["role"] == b) & (rows["block"] == hi)).to_numpy()
        if not is_left.any() or not is_right.any():
            return _NOTHING
        x = _unit(_matrix(pa.array(rows["vector"], pa.list_(pa.float64())), width))
        sizes, w = rows["vector"].map(len).to_numpy(), rows["w"].to_numpy()
        left, right = np.flatnonzero(is_left), np.flatnonzero(is_right)
        counted = None
        if b in (RING_VISIT, FAR_VISIT):
            # a visitor whose home the member visits too is met there as well: count it in the smaller cell
            home = rows["home"].to_numpy()[right]
            there, spot = np.unique(home, return_inverse=True)
            counted = ~_visited(rows["visits"][is_left].tolist(), there) | (there > cell)
        names, node = np.unique(rows["node"].to_numpy(dtype=str), return_inverse=True)
        label = np.arange(len(names))
        left_links, right_links = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        step = max(1, STRIP // len(right))
        for at in range(0, len(left), step):
            part = left[at:at + step]
            hit = x[part] @ x[right].T >= threshold
            if (sizes != sizes[0]).any():
                hit &= sizes[part][:, None] == sizes[right]
            if a == b and lo == hi:
                hit[np.arange(len(part)), at + np.arange(len(part))] = False
            if counted is not None:
                hit &= counted[at:at + step][:, spot]
            i, j = np.nonzero(hit)
            if not len(i):
                continue
            np.add.at(left_links, at + i, w[right[j]])
            if a != b or lo != hi:
                np.add.at(right_links, j, w[part[i]])
            label = _merge(label, node[part[i]], node[right[j]])
        if not left_links.any():
            return _NOTHING
        found = pd.DataFrame({"uid": np.concatenate([rows["uid"][is_left], rows["uid"][is_right]]),
                              "n": np.concatenate([left_links, right_links]).astype(np.int64),
                              "node": np.concatenate([node[left], node[right]])})
        found = found[found["n"] > 0]
        return pd.DataFrame({"uid": found["uid"], "n": found["n"], "a": names[label[found["node"]]].astype(object),
                             "b": names[found["node"].to_numpy()].astype(object)})
    return run


_NOTHING = pd.DataFrame({"uid": pd.Series(dtype=object), "n": pd.Series(dtype=np.int64),
                         "a": pd.Series(dtype=object), "b": pd.Series(dtype=object)})


def _links(vectors: DataFrame, count: int, width: int, usual: int, threshold: float, reach: float, cell: int,
           block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(numbers, edges, nodes)``: links per vector ``uid, n`` in rows to be summed, edges ``a, b``
    between nodes, and every vector's node: its core's smallest uid, or its own."""
    angle = float(np.arccos(threshold))
    centres = fit_cells(vectors, count, width, int(min(MAX_CELLS, max(2, count // cell))))
    assigned = checkpointed(vectors.select("uid", "vector", "w")
                            .mapInArrow(_assign(centres, usual, angle, reach), _ASSIGNED))
    # at most MAX_CELLS rows, as the other broadcast below
    core = F.broadcast(assigned.where(F.col("role") == CORE).groupBy(F.col("home").alias("cell")).agg(
        F.min("uid").alias("core"), F.sum("w").alias("core_w")))
    at_home = (assigned.withColumn("cell", F.col("home")).join(core, "cell", "left")
               .withColumn("node", F.when(F.col("role") == CORE, F.col("core")).otherwise(F.col("uid"))))
    nodes = at_home.select("uid", "node")
    whole = at_home.where(F.col("role") == CORE).select("uid", (F.col("core_w") - F.col("w")).alias("n"))

    stays = F.array(F.struct(F.col("home").alias("cell"), F.col("role")))
    goes = F.transform(F.arrays_zip("visits", "visit_roles"),
                       lambda e: F.struct(e["visits"].alias("cell"), e["visit_roles"].alias("role")))
    placed = (at_home.select("uid", "vector", "w", "home", "visits", "node",
                             F.explode(F.concat(stays, goes)).alias("p"))
              .select("uid", "vector", "w", "home", "visits", "node", "p.cell", "p.role"))
    sizes = placed.groupBy("cell", "role").agg(F.count("*").alias("rows"))
    sizes = sizes.select("cell", "role", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    by_role = F.broadcast(sizes.groupBy("cell").agg(F.array(*[
        F.coalesce(F.max(F.when(F.col("role") == r, F.col("blocks"))), F.lit(0)) for r in range(5)]).alias("n")))
    dealt = (placed.join(by_role, "cell")
             .withColumn("block", F.pmod(F.xxhash64("uid"), F.get("n", F.col("role"))).cast("int"))
             .withColumn("visits", F.when(F.col("role") < RING_VISIT, F.col("visits")))
             .withColumn("t", F.explode(_tasks()))
             .select("uid", "vector", "w", "home", "visits", "node", "cell", "role", "block", "t.*"))
    found = checkpointed(dealt.groupBy("cell", "a", "b", "left", "right").applyInPandas(
        _products(threshold, width), "uid string, n long, a string, b string"))
    return (whole.unionByName(found.select("uid", "n")),
            found.where("a <> b").select("a", "b").distinct(), nodes)


def near_duplicate_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           keep: tuple[str, ...] = (), threshold: float = THRESHOLD, reach: float = 1.0,
                           cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """One row per vector: id, ``keep``, ``n_links`` (other rows linked with it), ``component_id`` (the smallest
    id reachable) and ``kept`` (its id is its component's)."""
    spark = rows.sparkSession
    names = free_names([id_col, *keep], RESULTS)
    vector = F.col("_ed_vector")
    src = (rows.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(vector_col).cast("array<double>").alias("_ed_vector"))
           .withColumn("_ed_uid", F.when(_usable(vector), F.concat(F.hex(F.xxhash64(vector)),
                                                                  F.hex(F.xxhash64(F.lit(SEED), vector))))))
    key = names[id_col]
    src = src.withColumn("_ed_id", F.col(key))
    vectors = checkpointed(src.where("_ed_uid is not null").groupBy(F.col("_ed_uid").alias("uid")).agg(
        F.any_value("_ed_vector").alias("vector"), F.count("*").alias("w"), F.min("_ed_id").alias("first")))
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"),
                       F.mode(F.size("vector")).alias("usual")).first()
    shown = [F.col(n) for n in names.values()]
    alone = [F.lit(0).cast("long").alias("n_links"), F.col("_ed_id").alias("component_id"), F.lit(True).alias("kept")]
    if not size["n"]:
        return src.select(*shown, *alone)
    numbers, edges, nodes = _links(vectors, size["n"], size["width"], size["usual"], threshold, reach, cell, block)
    label = components(spark, checkpointed(edges)).withColumnRenamed("node", "at")
    member = nodes.join(label, nodes["node"] == label["at"], "left").select(
        "uid", F.coalesce("label", "node").alias("label"))
    member = checkpointed(member.join(vectors.select("uid", "first", "w"), "uid"))
    first = member.groupBy("label").agg(F.min("first").alias("component_id"))
    total = numbers.groupBy("uid").agg(F.sum("n").alias("n"))
    known = (member.join(first, "label").join(total, "uid", "left")
             .select(F.col("uid").alias("_ed_uid"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id"))
    linked = src.where("_ed_uid is not null").join(known, "_ed_uid").select(
        *shown, "n_links", "component_id",
        F.col("_ed_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.unionByName(src.where("_ed_uid is null").select(*shown, *alone))
