"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Equal vectors become one row with a weight. Cells are fitted on a bounded sample; every vector is
then placed in its ``probes`` nearest cells, and a pair is compared in the first cell that both are
in. A cell is cut into blocks by a hash of the id, and each pair of blocks is one matrix product in
double precision, so no task holds more than two blocks however full a cell is. A product gives link
counts per vector and a spanning forest of its links, never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import written
from gondola.llm.components import components

#: Rows of a cell in one block.
BLOCK = 2048
#: Vectors a cell should hold as nearest; more cells than MAX_CELLS are never fitted.
CELL_ROWS, MAX_CELLS = 800, 4096
#: Nearest cells a vector is placed in. Two vectors are compared when they share one of them.
PROBES = 6
#: Rows at most that the cells are fitted on (smallest hashes of the id).
SAMPLE = 16_384
ROUNDS = 8
#: Vector lengths at most; a table with more is refused, as nothing may be left out.
MAX_LENGTHS = 1000


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids by spherical k-means from spread-out rows of the sample, in fixed order."""
    rng = np.random.Generator(np.random.PCG64(5))
    k = max(1, min(k, len(sample)))
    c = sample[rng.permutation(len(sample))[:k]]
    for _ in range(ROUNDS if k > 1 else 0):
        own = (sample @ c.T).argmax(1)
        s = np.zeros_like(c)
        np.add.at(s, own, sample)
        norm = np.linalg.norm(s, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, s / np.maximum(norm, 1e-12), c)
    return c


def _place(cells: np.ndarray, probes: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column("vector").to_pylist())
            got = np.empty((len(x), probes), np.int32)
            for i in range(0, len(x), 1024):
                sim = x[i:i + 1024] @ cells.T
                near = np.argpartition(-sim, probes - 1, axis=1)[:, :probes] if probes < len(cells) else np.tile(np.arange(len(cells)), (len(sim), 1))
                got[i:i + 1024] = np.sort(near, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), batch.column("weight"),
                                              pa.array(list(got), pa.list_(pa.int32()))], names=["id", "vector", "weight", "cells"])

    return run


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> list[int]:
    """Indices of links that join something new, by union-find over n nodes."""
    root = list(range(n))

    def top(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    keep = []
    for i, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(i)
    return keep


def _products(least: float):
    def run(t: pa.Table) -> pa.Table:
        side, ids, weight = (t[c].to_numpy() for c in ("side", "id", "weight"))
        x = _unit(t["vector"].to_pylist())
        cells = np.array(t["cells"].to_pylist(), np.int32)
        here = t["cell"][0].as_py()
        same = t["bi"][0].as_py() == t["bj"][0].as_py()
        l = np.flatnonzero(side == 0)
        r = l if same else np.flatnonzero(side == 1)
        links = np.zeros(len(ids), np.int64)
        fa, fb = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(l), 256):
            li = l[i:i + 256]
            p, q = np.nonzero(x[li] @ x[r].T >= least)
            p, q = li[p], r[q]
            ok = p < q if same else np.ones(len(p), bool)
            p, q = p[ok], q[ok]
            # of the cells that both are in, the smallest number decides the pair
            first = np.full(len(p), np.iinfo(np.int32).max, np.int32)
            for c in range(cells.shape[1]):
                cp = cells[p, c]
                first = np.minimum(first, np.where((cells[q] == cp[:, None]).any(1), cp, first))
            p, q = p[first == here], q[first == here]
            np.add.at(links, p, weight[q])
            np.add.at(links, q, weight[p])
            keep = _forest(p, q, len(ids))
            fa.append(p[keep])
            fb.append(q[keep])
        a, b = np.concatenate(fa), np.concatenate(fb)
        keep = _forest(a, b, len(ids))
        hit = np.flatnonzero(links)
        return pa.table({
            "id": pa.array(np.concatenate([ids[hit], ids[a[keep]]]), pa.int64()),
            "n": pa.array(np.concatenate([links[hit], np.zeros(len(keep), np.int64)]), pa.int64()),
            "to": pa.array([None] * len(hit) + ids[b[keep]].tolist(), pa.int64())})

    return run


def embedding_dedup(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9,
                    probes: int = PROBES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_links`` (other rows linked directly), ``component_id``
    (smallest id reachable) and ``kept`` (id = component_id).

    Rows are linked when their cosine in double precision is ``least`` or more. A vector that is null,
    empty or zero, or holds a null or non-finite component, links with nothing, and vectors of different
    lengths are compared within their length only. A row without an id has no links, a null component and
    is kept. Rows that share id and vector count as separate copies of one node. An empty table gives
    an empty result; extra columns are ignored.
    """
    spark = df.sparkSession
    v = F.col(vector_col).cast("array<double>")
    src = df.select(F.col(id_col).cast("long").alias("id"), v.alias("vector"))
    good = src.where("id is not null and vector is not null and size(vector) > 0").where(
        ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).where(
        F.exists("vector", lambda x: x != 0))
    vectors = written(good.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")), "cells-vectors")
    lengths = [r[0] for r in vectors.select(F.size("vector")).distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"more than {MAX_LENGTHS} vector lengths; each gets cells of its own")
    edges = good.join(vectors.select(F.col("vector"), F.col("id").alias("a"), "weight"), "vector").where("id <> a or weight > 1").select(
        F.col("a"), F.col("id").alias("b"), "weight")
    edges = written(edges, "cells-copies")
    found = None
    for d in sorted(lengths):
        own = vectors.where(F.size("vector") == d)
        n = own.count()
        sample = _unit([r[0] for r in own.orderBy(F.xxhash64("id")).select("vector").limit(SAMPLE).collect()])
        cells = fit_cells(sample, min(MAX_CELLS, -(-n // cell_rows)))
        m = min(probes, len(cells))
        placed = written(own.mapInArrow(_place(cells, m), "id long, vector array<double>, weight long, cells array<int>"), "cells-placed")
        rows = placed.withColumn("cell", F.explode("cells"))
        sizes = rows.groupBy("cell").agg(F.expr(f"cast((count(1) - 1) div {BLOCK} + 1 as int)").alias("nb"))
        rows = rows.join(sizes, "cell").withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        rows = rows.select("cell", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                           (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "vector", "weight", "cells")
        got = written(rows.groupBy("cell", "bi", "bj").applyInArrow(_products(least), "id long, n long, to long"), "cells-links")
        found = got if found is None else found.union(got)
    if found is None:
        found = spark.createDataFrame([], "id long, n long, to long")
    # the copies of one vector: each links with the others, and with what the vector links to
    n_of = found.where("to is null").groupBy(F.col("id").alias("a")).agg(F.sum("n").alias("n"))
    copies = edges.groupBy("a", "b").agg(F.max("weight").alias("weight"))
    every = vectors.select(F.col("id").alias("a"), F.col("id").alias("b"), "weight").union(
        copies.where("a <> b").select("a", "b", "weight")).dropDuplicates(["a", "b"])
    counts = every.join(n_of, "a", "left").groupBy(F.col("b").alias("id")).agg(
        F.max(F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    links = found.where("to is not null").select(F.col("id").alias("a"), F.col("to").alias("b")).union(
        copies.where("a <> b").select("a", "b"))
    comps = components(links)
    out = src.select("id").join(counts, "id", "left").join(comps, F.col("id") == F.col("node"), "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("comp", "id").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("comp", "id"), F.lit(True)).alias("kept"))
