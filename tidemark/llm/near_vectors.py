"""Near-duplicate vectors through an inverted multi-index.

Two codebooks, one for each half of the unit vectors, form a product grid of cells. A vector's
multi-sequence lists the cells by the sum of its two halves' distances to their centroids. It
visits as many of the nearest cells as a calibration finds necessary for ``RECALL`` of pairs at
the threshold, and is compared with all vectors that live there, exactly.

* The codebooks and the number of visits are fitted on a bounded sample; all rows are indexed and
  all rows search. A visit counts for both ends of a link, so a pair is found if either end's
  visits reach the other, and links are symmetric.
* Equal vectors are one entry with a multiplicity. A cell's entries are dealt into parts of
  ``PART`` entries; the visitors stream past each part, so no task holds a crowded cell, and what
  leaves a task is a count for each vector and a spanning forest, never all pairs.
* Each length of vectors has its own index; vectors of different lengths never link. All lengths
  whose grid has one cell are searched in one job.
* Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and
  neither does a null id. Rows that repeat an id count as one
  vector (its smallest in array order). Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_partitions, stored
from tidemark.llm.components import components

THRESHOLD, RECALL = 0.9, 0.985
SAMPLE_ROWS, SAMPLE_BYTES, PROBES = 20_000, 64 << 20, 1500
#: Vectors a cell holds on average, and the most centroids of a codebook.
CELL, MAX_CENTROIDS = 512, 256
PART, VISITORS = 4096, 512
_TASK = "cell int, part int, visits boolean, id long, copies long, home int, reach binary, vector binary"


@dataclass(frozen=True)
class Index:
    """Codebooks of the two halves, and how many cells of its multi-sequence a vector visits."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return _squared(unit[:, :half], self.left), _squared(unit[:, half:], self.right)

    def homes(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return (a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)).astype(np.int32)

    def reach(self, unit: np.ndarray) -> list[np.ndarray]:
        """The visited cells of each vector, nearest first."""
        a, b = self.distances(unit)
        return [multi_sequence(x, y, self.visits) for x, y in zip(a, b)]


def _squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (rows**2).sum(axis=1)[:, None] - 2 * rows @ centroids.T + (centroids**2).sum(axis=1)[None, :]


def multi_sequence(left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Cells of the grid in ascending sum of the halves' distances: a frontier of at most one cell a row."""
    rows, columns = left.argsort(kind="stable"), right.argsort(kind="stable")
    frontier = [(left[rows[0]] + right[columns[0]], 0, 0)]
    out: list[int] = []
    while frontier and len(out) < most:
        _, i, j = heapq.heappop(frontier)
        out.append(int(rows[i]) * len(right) + int(columns[j]))
        if j + 1 < len(columns):
            heapq.heappush(frontier, (left[rows[i]] + right[columns[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(rows):
            heapq.heappush(frontier, (left[rows[i + 1]] + right[columns[0]], i + 1, 0))
    return np.array(out, dtype=np.int32)


def _centroids(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from distinct sampled rows."""
    random = np.random.default_rng(seed)
    centroids = rows[random.choice(len(rows), size=min(k, len(rows)), replace=False)].copy()
    for _ in range(12):
        nearest = _squared(rows, centroids).argmin(axis=1)
        for c in range(len(centroids)):
            members = rows[nearest == c]
            if len(members):
                centroids[c] = members.mean(axis=0)
    return centroids


def centroids_for(rows: int) -> int:
    """Centroids of a half's codebook in an index of so many vectors."""
    return int(np.clip(round((rows / CELL) ** 0.5), 1, MAX_CENTROIDS))


def fit(sample: np.ndarray, rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> Index:
    """Codebooks for an index of ``rows`` vectors; visits calibrated on pairs at just the threshold."""
    k = centroids_for(rows)
    half = max(1, sample.shape[1] // 2)
    left, right = _centroids(sample[:, :half], k, 1), _centroids(sample[:, half:], k, 2)
    whole = Index(left, right, len(left) * len(right))
    random = np.random.default_rng(3)
    probes = sample[random.choice(len(sample), size=min(PROBES, len(sample)), replace=False)]
    noise = random.normal(size=probes.shape)
    noise -= (noise * probes).sum(axis=1, keepdims=True) * probes
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    partners = threshold * probes + (1 - threshold**2) ** 0.5 * noise
    there, back = _places(whole, probes, whole.homes(partners)), _places(whole, partners, whole.homes(probes))
    visits = int(np.ceil(np.quantile(np.minimum(there, back), recall)))
    return Index(left, right, max(1, visits))


def _places(index: Index, queries: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """At which place of each query's multi-sequence its cell stands, from one."""
    a, b = index.distances(queries)
    sums = (a[:, :, None] + b[:, None, :]).reshape(len(queries), -1)
    return (sums < sums[np.arange(len(queries)), cells][:, None]).sum(axis=1) + 1


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large or small components neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): one row an id, doubles, finite, not zero."""
    vector = F.col(vector_col).cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col(vector_col).isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)
    rows = df.filter(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(vector).alias("vector"))


def entries(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(vector, rep, copies) of each different usable vector, ``rep`` its smallest id; and (id, vector) of all."""
    usable = stored(_usable(df, id_col, vector_col), "vectors")
    return stored(usable.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "entries"), usable


_KINDS = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]


def _task_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _TASK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], names=names)


def _one_cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of lengths whose grid is one cell, named after the length: each lives there and visits it."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            out = []
            for id_, n, vector in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns)):
                cell, data = len(vector), _unit(np.array([vector]))[0].tobytes()
                out.append((cell, 0, False, id_, n, cell, np.array([cell], dtype=np.int32).tobytes(), data))
                out.append((cell, 0, True, id_, n, cell, b"", data))
            yield _task_rows(out)


def _search_rows(index: Index, parts: dict[int, int]):
    """Each entry to its home cell's part, and as a visitor to all parts of the cells it visits."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                ids, copies = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                vectors = np.array(rows.column(2).to_pylist(), dtype=np.float64)
                unit = _unit(vectors)
                homes, out = index.homes(unit).tolist(), []
                for id_, n, home, reach, vector in zip(ids, copies, homes, index.reach(unit), unit):
                    data = vector.tobytes()
                    own = id_ % parts[home] if home in parts else 0
                    out.append((home, own, False, id_, n, home, np.sort(reach).tobytes(), data))
                    for cell in reach.tolist():
                        out += [(cell, part, True, id_, n, home, b"", data) for part in range(parts.get(cell, 0))]
                yield _task_rows(out)

    return deal


def _compare(threshold: float):
    """Streams sorted by (cell, part, visits): first the entries that live there, then the visitors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, homes, visitors = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if homes and visitors:
                yield _links(homes, visitors, threshold)
            visitors.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != key:
                    yield from flush()
                    key, homes = row[:2], []
                if row[2]:
                    visitors.append(row)
                    if len(visitors) >= VISITORS:
                        yield from flush()
                else:
                    homes.append(row)
        yield from flush()

    return task


def _matrix(rows: list[tuple]) -> np.ndarray:
    return np.frombuffer(b"".join(r[7] for r in rows), dtype=np.float64).reshape(len(rows), -1)


def _links(homes: list[tuple], visitors: list[tuple], threshold: float) -> pa.RecordBatch:
    """(id, links, root): counts of linked copies, and an edge of a spanning forest for each linked entry."""
    live, come = _matrix(homes), _matrix(visitors)
    home_ids, visitor_ids = np.array([r[3] for r in homes]), np.array([r[3] for r in visitors])
    q, x = np.nonzero(come @ live.T >= threshold)
    other = visitor_ids[q] != home_ids[x]
    q, x = q[other], x[other]
    home_copies, visitor_copies = np.array([r[4] for r in homes]), np.array([r[4] for r in visitors])
    # The visitor counts what it finds; what it finds counts the visitor unless it pays a visit itself.
    reaches = [frozenset(np.frombuffer(r[6], dtype=np.int32).tolist()) for r in homes]
    from_cell = np.array([r[5] for r in visitors])
    calls = {cell: np.array([cell in reach for reach in reaches]) for cell in set(from_cell[q].tolist())}
    unseen = ~np.array([calls[c][i] for c, i in zip(from_cell[q].tolist(), x.tolist())], dtype=bool) if len(q) else np.zeros(0, bool)
    found = np.bincount(q, weights=home_copies[x], minlength=len(visitors))
    called = np.bincount(x[unseen], weights=visitor_copies[q[unseen]], minlength=len(homes))
    root = _roots(q, len(homes), x, visitor_ids, home_ids)
    ids = np.concatenate([home_ids, visitor_ids])
    links = np.concatenate([called, found]).astype(np.int64)
    told = np.concatenate([np.bincount(x, minlength=len(homes)), np.bincount(q, minlength=len(visitors))]) > 0
    arrays = [pa.array(v[told], pa.int64()) for v in (ids, links, root)]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "links", "root"])


def _roots(q: np.ndarray, n_homes: int, x: np.ndarray, visitor_ids: np.ndarray, home_ids: np.ndarray) -> np.ndarray:
    """The smallest id each entry reaches within this comparison, homes before visitors."""
    label = np.concatenate([home_ids, visitor_ids])
    a, b = x, q + n_homes
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            return label
        label = new


def _compared(dealt: DataFrame, threshold: float) -> DataFrame:
    """(id, links, root) from entries dealt to cells."""
    # Explicitly many partitions: cells are few and differ in size.
    spread = dealt.repartition(4 * shuffle_partitions(dealt.sparkSession), "cell", "part")
    cells = spread.sortWithinPartitions("cell", "part", "visits", "id")
    return stored(cells.mapInArrow(_compare(threshold), "id long, links long, root long"), "vector-links")


def _search(distinct: DataFrame, width: int, rows: int, threshold: float, recall: float) -> DataFrame:
    """(id, links, root): the entries of one length searched through their index."""
    most = int(min(SAMPLE_ROWS, max(1000, SAMPLE_BYTES // (8 * width))))
    drawn = distinct.orderBy(F.xxhash64("rep"), "rep").limit(most).select("vector").toArrow()["vector"]
    sample = drawn.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(drawn), width)
    index = fit(_unit(sample), rows, threshold, recall)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = np.array(batch.column(0).to_pylist(), dtype=np.float64)
            if len(vectors):
                yield pa.RecordBatch.from_arrays([pa.array(index.homes(_unit(vectors)), pa.int32())], names=["cell"])

    crowds = distinct.select("vector").mapInArrow(locate, "cell int").groupBy("cell").count().collect()  # <= cells
    parts = {r["cell"]: -(-r["count"] // PART) for r in crowds}
    return _compared(distinct.select("rep", "copies", "vector").mapInArrow(_search_rows(index, parts), _TASK), threshold)


def linked_vectors(
    df: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    distinct, usable = entries(df, id_col, vector_col)
    every = df.select(F.col(id_col).cast("long").alias("vec_id"))
    lengths = distinct.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").collect()  # a row a length
    if not lengths:
        none = every.withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id")})
        return none.withColumn("kept", F.col("vec_id").isNotNull())
    # The most frequent length always has an index; of the others those whose grid has several cells.
    indexed = [r for k, r in enumerate(lengths) if k == 0 or centroids_for(r["count"]) > 1]
    searches = [_search(distinct.filter(F.size("vector") == r["n"]), r["n"], r["count"], threshold, recall) for r in indexed]
    if len(indexed) < len(lengths):
        rest = distinct.filter(~F.size("vector").isin([r["n"] for r in indexed]))
        searches.append(_compared(rest.select("rep", "copies", "vector").mapInArrow(_one_cell_rows, _TASK), threshold))
    found = reduce(DataFrame.unionByName, searches)
    copies = usable.join(distinct.select("vector", "rep", "copies"), "vector").select("id", "rep", "copies")
    direct = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(
        copies.select(F.col("id").alias("a"), F.col("rep").alias("b"))
    )
    labels = components(edges).select(F.col("node").alias("vec_id"), "component")
    counted = copies.join(direct.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("id").alias("vec_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = every.join(counted, "vec_id", "left").join(labels, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
