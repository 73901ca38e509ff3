"""Near-duplicate embeddings through a pivot-permutation index.

Reference points are a bounded sample of the vectors: ``4 * sqrt(n)``, at most
``MOST_PIVOTS`` and about ``PIVOT_BYTES``, the first by a hash, without those closer than
``APART`` to an earlier one (points inside one dense group would be ordered by
noise).  Every vector is described by its nearest pivots in order, six up to
``FEW_PIVOTS`` pivots and one more for each doubling: the more pivots, the more
of them lie between two near vectors.  The inverted file holds, for each pair of
pivots, the vectors that have both among theirs: vectors that meet there share
at least two pivots.  Each list verifies its vectors by cosine in double
precision; a pair that meets in several lists counts in the first of its
common ones only.  Lists return each vector's number of links and a star for
each connected part, not pairs.  Lists longer than ``LIST_ROWS`` are cut by hash
into slices, and every two slices meet in a task of their own.  Vectors of a
length with too few pivots form one list, compared in full the same way; a
sample of all vectors misses only lengths with few of them.

Equal vectors are one entry with a multiplicity.  Recall against brute force
is measured in the tests (at least 0.9, with pairs at a cosine just above 0.9
and as many pivots as a million vectors have).

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different length do not link; very long
vectors are compared whole; a null id gets a null component and is
not kept; repeated rows count as vectors of their own; pivots equally near
count in the order of their numbers' sort; other columns are not read, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import components, stored

#: beyond them lists grow with the table, and are cut in slices that all meet
MOST_PIVOTS = 1 << 16
#: of the broadcast pivots, at average length; no sampled vector is longer than ``LONGER`` averages, so the bound is ``LONGER`` times this
PIVOT_BYTES, LONGER = 16 << 20, 16
LEAST_NEAREST, FEW_PIVOTS = 6, 512
#: similarities held at once while the nearest pivots are sought
CELLS = 8_000_000
#: cosine that pivots must stay below among themselves
APART = 0.7
LIST_ROWS = 4000
PAIRS_AT_ONCE = 100_000


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name and components of every usable vector."""
    for batch in batches:
        names, vectors = [], []
        for v in batch.column(1):
            x = None if v.as_py() is None else v.values.to_numpy(zero_copy_only=False)
            usable = x is not None and len(x) and v.values.null_count == 0 and np.isfinite(x).all() and x.any()
            data = (x + x.dtype.type(0)).tobytes() if usable else None
            names.append(xxhash.xxh3_64_intdigest(data) - (1 << 63) if usable else None)
            vectors.append(data)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64()), pa.array(vectors, pa.binary())], names=["key", "name", "vector"])


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(v, kind) for v in vectors]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _separated(points: np.ndarray, block: int = 512) -> np.ndarray:
    """Points in turn, without those closer than ``APART`` to one that was kept."""
    kept, n = np.empty_like(points), 0
    for i in range(0, len(points), block):
        some = points[i:i + block]
        if n:
            some = some[(some @ kept[:n].T).max(axis=1) < APART]
        near, mine = some @ some.T >= APART, np.zeros(len(some), bool)
        for j in range(len(some)):
            mine[j] = not (near[j] & mine).any()
        kept[n:n + mine.sum()] = some[mine]
        n += int(mine.sum())
    return kept[:n].copy()


def sample_size(n: int) -> int:
    """Vectors of ``n`` that are drawn as reference points."""
    return max(32, int(4 * n ** 0.5))


def nearest(pivots: int) -> int:
    """Pivots that describe a vector."""
    return LEAST_NEAREST + max(0, (max(pivots, 1) - 1).bit_length() - FEW_PIVOTS.bit_length() + 1)


def _near(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Numbers of each vector's nearest points, ascending."""
    k, step, found = nearest(len(points)), max(1, CELLS // len(points)), []
    for i in range(0, len(x), step):
        far = -(x[i:i + step].astype(points.dtype) @ points.T)
        found.append(np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1))
    return np.concatenate(found).astype("<u4")


def _code(size: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Name of the list of two pivots and a vector length in bytes."""
    return (size << 34) + (p.astype(np.int64) << 17) + q.astype(np.int64)


def _post(pivots, kind: str):
    """Postings: a row for each pair of a vector's nearest pivots, with all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = pivots.value
        for batch in batches:
            names, times, vectors = (batch.column(i).to_pylist() for i in range(3))
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            for size, at in by_size.items():
                here = points.get(size)
                if here is None or len(here) < nearest(len(here)):  # one list for all of this length
                    near, pairs = np.broadcast_to(np.arange(2, dtype="<u4"), (len(at), 2)), np.array([[0, 1]])
                else:
                    near = _near(_unit([vectors[i] for i in at], kind), here)
                    pairs = np.array(list(combinations(range(near.shape[1]), 2)))
                marks = [row.tobytes() for row in near]
                for first in range(0, len(at), step := max(1, 20_000 // len(pairs))):
                    part = at[first:first + step]
                    lists = _code(size, near[first:first + step][:, pairs[:, 0]], near[first:first + step][:, pairs[:, 1]])
                    rows = np.repeat(np.arange(len(part)), len(pairs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lists.ravel()), pa.array([names[part[i]] for i in rows], pa.int64()), pa.array([times[part[i]] for i in rows], pa.int64()),
                         pa.array([vectors[part[i]] for i in rows], pa.binary()), pa.array([marks[first + i] for i in rows], pa.binary())],
                        names=["list", "name", "times", "vector", "near"])
    return run


def _first_list(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """List of the two smallest pivots that the descriptions, row by row, share."""
    shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
    rows = np.arange(len(a))
    p = shared.argmax(axis=1)
    shared[rows, p] = False
    return _code(size, a[rows, p], a[rows, shared.argmax(axis=1)])


def _parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each entry's connected part."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify(kind: str, least: float):
    def run(table: pa.Table) -> pa.Table:
        here = table["list"][0].as_py()
        names, times = table["name"].to_numpy(), table["times"].to_numpy()
        mine, other = table["slice"].to_numpy(), table["other"].to_numpy()
        x = _unit(table["vector"].to_pylist(), kind)
        size = len(table["vector"][0].as_py())
        near = np.stack([np.frombuffer(v, "<u4") for v in table["near"].to_pylist()])
        counts, a, b = np.zeros(len(names), np.int64), [], []
        step = max(1, 4_000_000 // len(names))
        for i in range(0, len(names), step):
            p, q = np.nonzero(x[i:i + step] @ x.T >= least)
            p += i
            # between two slices only pairs across them; a slice with itself has a task too
            keep = (p < q) & ((mine[p] != mine[q]) | (mine[p] == other[p]))
            p, q = p[keep], q[keep]
            a.append(p)
            b.append(q)
            for j in range(0, len(p), PAIRS_AT_ONCE):
                u, v = p[j:j + PAIRS_AT_ONCE], q[j:j + PAIRS_AT_ONCE]
                first = _first_list(size, near[u], near[v]) == here
                np.add.at(counts, u[first], times[v[first]])
                np.add.at(counts, v[first], times[u[first]])
        root = _parts(len(names), np.concatenate(a), np.concatenate(b))
        found = np.zeros(len(names), bool)
        for y in (*a, *b):
            found[y] = True
        return pa.table({"name": names[found], "links": counts[found], "root": names[root[found]]})
    return run


def near_duplicates(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", least: float = 0.9, list_rows: int = LIST_ROWS) -> DataFrame:
    """Per row: key, n_links, component_id, kept."""
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    typed = F.col(vector) if kind == "<f4" else F.col(vector).cast("array<double>")
    rows = stored(vectors.select(F.col(key).cast("long").alias("key"), typed.alias("v")).mapInArrow(_describe, "key long, name long, vector binary"), "pivot-rows")
    entries = rows.where("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector"), F.min("key").alias("least"))
    entries = stored(entries, "pivot-entries")
    n, bytes_each = entries.agg(F.count(F.lit(1)), F.avg(F.length("vector"))).first()
    wanted = min(MOST_PIVOTS, sample_size(n), 1 + int(PIVOT_BYTES / (bytes_each or 1)))
    sample = entries.where(F.length("vector") <= LONGER * (bytes_each or 1)).orderBy(F.xxhash64("name"), "name").limit(wanted).select("vector").collect()
    sample = [bytes(r[0]) for r in sample]
    points = {size: _separated(_unit([v for v in sample if len(v) == size], kind).astype(np.float32)) for size in {len(v) for v in sample}}
    pivots = spark.sparkContext.broadcast(points)
    postings = stored(entries.select("name", "times", "vector").mapInArrow(_post(pivots, kind), "list long, name long, times long, vector binary, near binary"), "pivot-postings")
    sizes = postings.groupBy("list").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("list", F.ceil(F.col("k") / list_rows).cast("int").alias("slices"))
    cut = postings.join(sizes, "list").withColumn("slice", F.pmod(F.xxhash64("name"), F.col("slices")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    cut = cut.withColumns({"low": F.least("slice", "other"), "high": F.greatest("slice", "other")}).drop("slices")
    # in the task of one slice with itself every row says so
    cut = cut.withColumn("other", F.when(F.col("low") == F.col("high"), F.col("slice")).otherwise(F.lit(-1)))
    found = stored(cut.groupBy("list", "low", "high").applyInArrow(_verify(kind, least), "name long, links long, root long"), "pivot-links")
    links = found.groupBy("name").agg(F.sum("links").alias("linked"))
    named = components(found.select(F.col("name").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "name")
    entry = entries.select("name", "times", "least").join(links, "name", "left").join(named, "name", "left").withColumn("group", F.coalesce("component", "name"))
    entry = stored(entry, "pivot-groups")
    smallest = entry.groupBy("group").agg(F.min("least").alias("component_id"))
    entry = entry.join(smallest, "group").select("name", (F.col("times") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("key", "name").join(entry, "name", "left")
    own = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("key") == own, F.lit(False)).alias("kept"))
