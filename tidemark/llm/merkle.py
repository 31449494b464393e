"""A Merkle manifest of a dataset: a tree a group, a tree over the groups, and a proof for every row.

Rows of a group ascend by id and are cut into partitions of ``16 ** 3`` leaves, aligned to the tree.
A partition is numbered globally (groups in order, then its place in the group), and so every node of
the tree stands for a range of consecutive partitions. Three steps:

1. each partition hashes its own three levels, from its leaves alone;
2. butterfly exchange: in each round the partitions of an aligned group of 16 nodes swap the
   nodes they have arrived at, and every one of them hashes the parent redundantly. A partition
   receives one message a sibling: from the partition of the sibling's range that has its own place
   in the range, counted round if the sibling's range is shorter (the last one of a level). Rounds
   go on from the partitions of a group to the groups. What a partition received on its way are
   the upper parts of its rows' proofs, so nothing is sent down again once the root is known;
3. each partition joins the upper parts to its own levels, a proof for each row.

A round is one shuffle of 16 short rows a partition, so the exchange moves about a hundredth of
what the leaves need. Leaves are hashed beside the scan; texts never move. A group with a third of all
rows is range-sorted like any other and has more partitions.

Nulls: a null value is hashed as ``-``, a null group is the first group, a null id comes first in
its group. Rows of one id are ordered by their leaves; rows that are equal altogether are separate,
equal leaves. An empty table has an empty manifest. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_partitions, stored

FANOUT = 16
#: Levels that a partition holds itself.
OWN_LEVELS = 3
BLOCK = FANOUT**OWN_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33  # of monotonically_increasing_id()
_UPPER = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf_of(*values: Column) -> Column:
    """Digest of a row: of each value its length in UTF-8 bytes, a colon and the value, or a dash for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _joined_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_over(n: int) -> int:
    """Levels of a tree above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def own_levels(leaves: list[str], height: int) -> list[list[str]]:
    """A partition's nodes, level by level, from its leaves."""
    levels = [leaves]
    for _ in range(height):
        below = levels[-1]
        levels.append([_joined_digest("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def around(nodes: list[str], at: int) -> tuple[str, str]:
    """Digests left and right of a node within its run of siblings."""
    first = at - at % FANOUT
    return "".join(nodes[first:at]), "".join(nodes[at + 1 : first + FANOUT])


# -- order: every row gets its partition and its place there ---------------------------------------


def _ordered(rows: DataFrame) -> DataFrame:
    """(grp, id, leaf, candidate, pid, row): rows in the order of the manifest, numbered within each task."""
    order = ["grp", "id", "leaf", "salt"]  # equal rows may be many: the salt lets them be split
    salted = stored(rows.withColumn("salt", F.monotonically_increasing_id()), "merkle-leaves")
    sorted_rows = salted.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    numbered = stored(sorted_rows.select("grp", "id", "leaf", "candidate", at.alias("at")), "merkle-ordered")
    return numbered.withColumns(
        {"pid": F.shiftright("at", _ROW_BITS), "row": F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}
    ).drop("at")


def _levels_of(count: Column) -> Column:
    """``levels_over`` of a column; a long has at most 16 such levels."""
    return sum((F.when(count > FANOUT**k, 1).otherwise(0) for k in range(16)), start=F.lit(0))


def _directory(runs: DataFrame) -> DataFrame:
    """(grp, rank, parts, first, height): the groups in order and the partitions they have.

    ``runs`` has a row for each group in each task of the order; a group belongs to the task it starts in.
    """
    groups = runs.groupBy("grp").agg(F.sum("n").alias("size"), F.min("pid").alias("home"))
    groups = groups.withColumns({"parts": F.ceil(F.col("size") / BLOCK), "height": F.least(F.lit(OWN_LEVELS), _levels_of(F.col("size")))})
    inside = Window.partitionBy("home").orderBy(F.asc_nulls_first("grp")).rowsBetween(Window.unboundedPreceding, -1)
    numbered = groups.withColumns(
        {"place": F.count("parts").over(inside), "ahead": F.coalesce(F.sum("parts").over(inside), F.lit(0))}
    )
    # Two numbers a task of the order.
    per_home = groups.groupBy("home").agg(F.count("*").alias("n"), F.sum("parts").alias("p")).orderBy("home").collect()
    starts, n, p = [], 0, 0
    for r in per_home:
        starts.append((r["home"], n, p))
        n, p = n + r["n"], p + r["p"]
    before = runs.sparkSession.createDataFrame(starts, "home long, rank_before long, first_before long")
    return numbered.join(before, "home").select(
        "grp", "parts", "height", (F.col("rank_before") + F.col("place")).alias("rank"),
        (F.col("first_before") + F.col("ahead")).alias("first"),
    )


def _placed(ordered: DataFrame, runs: DataFrame, directory: DataFrame) -> DataFrame:
    """(part, slot, height, id, leaf, candidate) of every row."""
    earlier = Window.partitionBy("grp").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("least_row")
    known = directory.select(F.col("grp").alias("g"), "first", "height")
    runs = runs.withColumn("start", start)
    runs = runs.join(known, runs["grp"].eqNullSafe(known["g"])).select(
        F.col("pid").alias("run_pid"), "g", "start", "first", "height"
    )
    met = (F.col("pid") == F.col("run_pid")) & F.col("grp").eqNullSafe(F.col("g"))
    rank = F.col("start") + F.col("row")
    return ordered.join(runs, met).select(
        (F.col("first") + F.floor(rank / BLOCK)).alias("part"), F.pmod(rank, F.lit(BLOCK)).cast("int").alias("slot"),
        "height", "id", "leaf", "candidate",
    )


# -- one pass over a partition's rows ---------------------------------------------------------------


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each partition, which arrive together and in order: a block of leaves at a time."""
    part, rows = None, []
    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if key != part:
                if rows:
                    yield part, rows
                part, rows = key, []
            rows.append(row)
    if rows:
        yield part, rows


def _own_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (part, slot, height, leaf): the root of each partition."""
    found = [(part, own_levels([r[2] for r in rows], rows[0][1])[-1][0]) for part, rows in _by_part(batches)]
    yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["part", "node"])


_PROVED_DDL = (
    "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, proof string"
)
_PROVED = pa.schema([("id", pa.int64()), *[(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_()), ("proof", pa.string())])


def _prove(with_proof: bool):
    """Of (part, slot, height, id, leaf, candidate, upper, subroot, root): the rows with their proofs.

    A partition's first row, of slot -1, brings what the exchange left it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (head, *rows) in _by_part(batches):
            _, height, _, _, _, upper, subroot, root = head
            levels = own_levels([r[3] for r in rows], height)[:height]
            above = [(u["left"], u["right"]) for u in upper]
            above_text = "".join(a + b for a, b in above)
            out = []
            for slot, _, id_, leaf, candidate, *_ in rows:
                path, at = [], slot
                for nodes in levels:
                    path.append(around(nodes, at))
                    at //= FANOUT
                proof = "".join(a + b for a, b in path) + above_text
                node = candidate
                for left, right in [*path, *above]:
                    node = _joined_digest(left + node + right)
                out.append((id_, leaf, subroot, root, _joined_digest(proof), node, node == root, proof if with_proof else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PROVED)], schema=_PROVED)

    return run


# -- butterfly exchange -----------------------------------------------------------------------------


def _round(state: DataFrame, active: Column, lo: Column, hi: Column, above: Column, end: Column, place: Column) -> DataFrame:
    """One round: partitions of the node over [lo, hi) swap it with the other children of the parent over [above, end).

    ``place`` is the node's place among the children. Partition p hears of each child from the
    one at (p - above) modulo the length of the child's range, which is one message a child.
    """
    marked = state.withColumns({"_active": active, "_place": place})
    heard_by = F.sequence(above + F.col("part") - lo, end - 1, hi - lo)
    sent = marked.filter("_active").select(F.explode(heard_by).alias("to"), F.struct(F.col("_place").alias("place"), "node").alias("child"))
    heard = sent.groupBy("to").agg(F.array_sort(F.collect_list("child")).alias("children"))
    text = lambda keep: F.array_join(F.transform(F.filter("children", keep), lambda c: c["node"]), "")
    siblings = F.struct(text(lambda c: c["place"] < F.col("_place")).alias("left"), text(lambda c: c["place"] > F.col("_place")).alias("right"))
    joined = marked.join(heard, F.col("part") == F.col("to"), "left")
    after = joined.withColumns(
        {
            "node": F.when(F.col("_active"), F.sha2(text(lambda c: F.lit(True)), 256)).otherwise(F.col("node")),
            "upper": F.when(F.col("_active"), F.concat("upper", F.array(siblings))).otherwise(F.col("upper")),
        }
    )
    return stored(after.select(*state.columns), "merkle-round")


def _exchange(directory: DataFrame, roots: DataFrame) -> DataFrame:
    """(part, height, upper, subroot, root) of every partition."""
    totals = directory.agg(F.count("*").alias("groups"), F.max("parts").alias("parts")).first()
    n_groups, most_parts = totals["groups"], totals["parts"] or 0
    rounds = levels_over(n_groups)
    spans = directory
    for k in range(rounds + 1):
        # The partitions below each node of level k over the groups.
        node = F.floor(F.col("rank") / FANOUT**k)
        bounds = directory.groupBy(node.alias("node")).agg(F.min("first").alias(f"lo{k}"), F.max(F.col("first") + F.col("parts")).alias(f"hi{k}"))
        spans = spans.join(bounds, node == F.col("node")).drop("node")
    parts = spans.select("*", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)).alias("part"))
    upper = F.array().cast("array<struct<left:string,right:string>>").alias("upper")
    state = stored(parts.join(roots, "part").select(*parts.columns, "node", upper), "merkle-round")

    first, count = F.col("first"), F.col("parts")
    chunk = F.col("part") - first
    for k in range(levels_over(most_parts)):
        width, wider = FANOUT**k, FANOUT ** (k + 1)
        child, parent = F.floor(chunk / width), F.floor(chunk / wider)
        state = _round(
            state, count > width, first + child * width, first + F.least((child + 1) * width, count),
            first + parent * wider, first + F.least((parent + 1) * wider, count), F.pmod(child, F.lit(FANOUT)),
        )
    state = state.withColumn("subroot", F.col("node"))
    for k in range(rounds):
        child = F.floor(F.col("rank") / FANOUT**k)
        state = _round(
            state, F.lit(True), F.col(f"lo{k}"), F.col(f"hi{k}"), F.col(f"lo{k + 1}"), F.col(f"hi{k + 1}"), F.pmod(child, F.lit(FANOUT))
        )
    return state.select("part", "height", "upper", "subroot", F.col("node").alias("root"))


def manifest(leaves: DataFrame, with_proof: bool = False) -> DataFrame:
    """Of (id, grp, leaf, candidate): the tree's answer for every row.

    ``subroot`` and ``root`` are those over ``leaf``. The proof has the siblings' digests, level by level up to the
    root, left to right; ``folded_root`` is what it makes of ``candidate``, and ``verified`` says
    whether that is the root. ``proof`` itself, 64 hex digits a sibling, only on demand.
    """
    ordered = _ordered(leaves.select("id", "grp", "leaf", "candidate"))
    runs = stored(ordered.groupBy("pid", "grp").agg(F.count("*").alias("n"), F.min("row").alias("least_row")), "merkle-runs")
    directory = stored(_directory(runs), "merkle-groups")
    placed = stored(_placed(ordered, runs, directory), "merkle-placed")
    n = shuffle_partitions(leaves.sparkSession)
    gathered = lambda df: df.repartition(n, "part").sortWithinPartitions("part", "slot")
    roots = gathered(placed.select("part", "slot", "height", "leaf")).mapInArrow(_own_roots, "part long, node string")
    heads = _exchange(directory, roots).withColumn("slot", F.lit(-1))
    together = placed.unionByName(heads, allowMissingColumns=True)
    together = together.select("part", "slot", "height", "id", "leaf", "candidate", "upper", "subroot", "root")
    proved = gathered(together).mapInArrow(_prove(with_proof), _PROVED_DDL)
    return proved if with_proof else proved.drop("proof")


def tampered(id_col: Column) -> Column:
    """Rows whose text the check changes; a null id's stays."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_manifest(docs: DataFrame) -> DataFrame:
    """Each document as a leaf in the tree of its source, and whether the manifest notices what was changed."""
    values = {name: F.col(name) for name in FIELDS}
    changed = values | {"text": F.when(tampered(F.col("doc_id")), lowered(F.col("text"))).otherwise(F.col("text"))}
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("source").alias("grp"),
        leaf_of(*values.values()).alias("leaf"), leaf_of(*changed.values()).alias("candidate"),
    )
    return manifest(leaves).withColumnRenamed("id", "doc_id")
