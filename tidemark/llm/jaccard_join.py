"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its hashed word shingles. Sizes fall into bands; sets of two
neighbouring bands that are similar enough differ in at most ``k`` elements, so if the feature
domain is cut into ``k + 1`` parts, some part holds the same elements in both. A set's
signatures are the hashes of its parts: of the subsets that PartEnum enumerates, those of one
part, the fewest rows. An element's part is the range its hash falls into, so a part is a slice of
the sorted hashes.

Empty parts say nothing, though similar sets may agree in them. So there are ``spare`` parts more
than ``k + 1``: ``spare + 1`` parts agree, and a set with at most ``spare`` empty ones shares a
filled one with every similar set. If both have more, both sign again with the domain cut anew.
Parts are left out the commonest first, as in a prefix filter: empty ones, and then, up to ``spare``
in all, the parts that most sets have. In one order of all parts the rarest of the ``spare + 1`` that
two similar sets share is left out by neither.

From signatures to links:

1. one pass over the texts stores size, digest, bucket counts and signatures. Signatures go from
   there straight into the order of (signature, half of the digest, salt): neighbours within a
   signature are joined by an edge between their digests, and a signature or a set with a third of
   all rows is spread over many tasks. Then the signatures, the bulk of that table, are removed.
   Equal sets become one node: from here on copies do not take part;
2. the ends of an edge are compared by the counts of hashes in buckets, whose minima bound every
   intersection from above. A set has ``BUCKETS`` buckets, or as many more as keep ``IN_BUCKET``
   hashes in each on average: fuller buckets tell large sets apart no more. Components of the edges
   that remain gather near copies by as many edges as they have signatures;
3. of a signature that more than two sets have, the pairs in different components are compared in
   the same way. Signatures of more than ``CROWD`` sets are left out first, as far as sets can spare
   them; what is left of them is compared in blocks. So the pairs are in proportion to
   the signatures, unless texts share more common parts than they have to spare;
4. each component's distinct sets are compared exactly, in blocks of bounded size: only pairs
   of blocks whose sizes allow a link meet, and a block pair yields a spanning forest of links;
5. components of the links are the result, which each row takes from its set by digest.

Null and empty texts have no shingles and link with nothing. A null id links with nothing and
has a null component. Rows that repeat an id have their own texts' numbers, and the links of all of
them are links of the id. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents_of, shuffle_partitions, slices, stored, stored_at
from tidemark.llm.components import components
from tidemark.sinks import folders

WORDS, LEAST = 3, (90, 100)
#: A block holds this many sets, or this many shingles, about.
BLOCK_SETS, BLOCK_SHINGLES = 2000, 1 << 20
RECUTS = 3
#: Fewest buckets of hashes, counted in a byte each, that bound intersections, and hashes in one on average, at most.
BUCKETS, IN_BUCKET = 256, 8
#: Bytes of a text whose words are hashed at a time.
PIECE = 1 << 20
#: Places that rows of one set and signature are dealt to.
SALTS = 256
#: Sets of one signature whose pairs are listed; a signature that more have is left out where it can be spared.
CROWD = 32
#: Bits of a signature that say which cut of which pair of bands it is of, and bits for the spare parts of each.
GROUP_BITS, SPARE_BITS = 3, 7
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = ~np.isin(_BYTES, [32, 9, 10, 11, 12, 13])
#: A word for each byte at each of 64 places; beyond them a place's 64-block multiplies it.
_PLACES = 64
_TABLE = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words in a text, A-Z taken as a-z. Works on slices of the text, cut between words."""
    found, begin = [], 0
    while begin < len(data):
        end = begin + PIECE
        while end < len(data) and _IN_WORD[data[end]]:
            end += 1
        found.append(_hashes_of_piece(np.frombuffer(data, dtype=np.uint8, count=min(end, len(data)) - begin, offset=begin)))
        begin = end
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def _hashes_of_piece(octets: np.ndarray) -> np.ndarray:
    inside = _IN_WORD[octets]
    turns = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    lengths = turns[1::2] - turns[::2]
    if not len(lengths):
        return np.empty(0, dtype=np.uint64)
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = _TABLE[(place % _PLACES) << 8 | _LOWER[octets[inside]]]
    if int(lengths.max()) > _PLACES:
        values = values * ((place // _PLACES).astype(np.uint64) * _U(2) + _U(1))
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word n-grams; keeps nothing between texts."""

    def __init__(self, words: int = WORDS):
        self.words = words

    def __call__(self, text: str) -> np.ndarray:
        h = word_hashes(text.encode("utf-8", "surrogatepass"))
        if not len(h):
            return h
        n = min(self.words, len(h))
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            out = mix(out * _U(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i])
        return np.unique(out)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share; signed."""
    a, b = mix(hashes ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64), mix(hashes + _U(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


class Layout:
    """How sets sign for a threshold numerator/denominator on their similarity."""

    def __init__(self, least: tuple[int, int] = LEAST):
        self.least, self.growth = least, least[1] / least[0]
        self._spare: dict[int, int] = {}

    def first_of(self, j: int) -> int:
        """The smallest size of band j. Bands are so wide that similar sets lie in one or in neighbours."""
        return math.ceil(self.growth**j - 1e-9)

    def band(self, size: int) -> int:
        j = int(math.log(size) / math.log(self.growth))
        while self.first_of(j) > size:
            j -= 1
        while self.first_of(j + 1) <= size:
            j += 1
        return j

    def differing(self, j: int) -> int:
        """Most elements in which similar sets of bands j and j + 1 can differ."""
        numerator, denominator = self.least
        # |A ^ B| <= (1 - t) / (1 + t) * (|A| + |B|)
        return (denominator - numerator) * 2 * (self.first_of(j + 2) - 1) // (denominator + numerator)

    def signatures(self, hashes: np.ndarray) -> np.ndarray:
        """PartEnum signatures of a set in both pairs of bands it belongs to; signed 64 bit."""
        return self.signed(hashes)[0]

    def signed(self, hashes: np.ndarray) -> tuple[np.ndarray, int]:
        """The signatures, and how many of each group (their last bits) need not be used, ``SPARE_BITS`` a group."""
        if not len(hashes):
            return np.empty(0, dtype=np.int64), 0
        own, left = self.band(len(hashes)), 0
        out: list[np.ndarray] = []
        for pair in (own - 1, own):
            if pair >= 0:
                left |= _sign(hashes, self.differing(pair) + 1, self.spare(pair), pair, out)
        return np.unique(np.concatenate(out)).view(np.int64), left

    def spare(self, j: int) -> int:
        """Parts beyond those that can differ: more than a set of bands j and j + 1 often has empty."""
        if j not in self._spare:
            # Any number is right; a few more parts save most sets the second cut.
            need, spare = self.differing(j) + 1, 0
            for _ in range(8):
                empty = (need + spare) * math.exp(-self.first_of(j) / (need + spare))
                spare = min(math.ceil(empty + 3 * math.sqrt(empty)), need // 6)
            self._spare[j] = spare
        return self._spare[j]


def _sign(hashes: np.ndarray, need: int, spare: int, pair: int, out: list[np.ndarray]) -> int:
    """Hashes of the filled parts of ``need + spare`` parts, at least ``1 + spare`` of which are equal in similar sets.

    Returns how many of them can be spared yet, at the place of their group.
    """
    parts = need + spare
    for cut in range(RECUTS + 1):
        salt = mix(np.array([(pair + 1) * (RECUTS + 1) + cut], dtype=np.uint64))[0]
        with np.errstate(over="ignore"):
            values = np.sort(mix(hashes + salt)) if cut else hashes
            bounds = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
            edges = np.concatenate([[0], np.searchsorted(values, bounds), [len(values)]])
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(values ^ salt), dtype=np.uint64)])
            numbers = np.arange(parts, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)
            signed_parts = mix(sums[edges[1:]] - sums[edges[:-1]] + mix(salt + numbers))
        group = (pair % 2) * (RECUTS + 1) + cut
        signed_parts = signed_parts >> _U(GROUP_BITS) << _U(GROUP_BITS) | _U(group)
        filled = edges[1:] > edges[:-1]
        # The last cut keeps empty parts too: from there on nothing is left to chance.
        out.append(signed_parts[filled] if cut < RECUTS else signed_parts)
        left = spare - (parts - int(filled.sum()))
        if left >= 0:
            return min(left, (1 << SPARE_BITS) - 1) << SPARE_BITS * group
    return 0


def bucket_counts(hashes: np.ndarray) -> bytes:
    """How many hashes each bucket has; empty if a byte cannot hold a count, and then nothing is ruled out.

    The number of buckets is a power of two, so counts of many buckets fold into those of fewer.
    """
    buckets = BUCKETS
    while buckets * IN_BUCKET < len(hashes):
        buckets *= 2
    counts = np.bincount((hashes >> _U(17)).astype(np.int64) % buckets, minlength=buckets)
    return counts.astype(np.uint8).tobytes() if len(hashes) and counts.max() < 256 else b""


def folded(counts: list[bytes]) -> np.ndarray:
    """Bucket counts of several sets as rows of one matrix, over as many buckets as the coarsest has."""
    width = min((len(c) for c in counts if c), default=BUCKETS)
    matrix = np.zeros((len(counts), width), dtype=np.uint16)
    for row, data in zip(matrix, counts):
        np.sum(np.frombuffer(data, dtype=np.uint8).reshape(-1, width), axis=0, dtype=np.uint16, out=row)
    return matrix


_SHINGLED = "doc_id long, n long, d1 long, d2 long, buckets binary, spare long, sigs array<long>"


def shingled(docs: DataFrame, words: int, layout: Layout) -> DataFrame:
    """(doc_id, n, d1, d2, buckets, spare, sigs): number, digest, bucket counts and signatures of the shingles of every whole text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in slices(batches):
            sets = [shingles(text) for text in batch.column(1).to_pylist()]
            sigs, spare = zip(*(layout.signed(s) for s in sets))
            digests = [digest(s) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in sigs])]).astype(np.int32)
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([d[0] for d in digests], pa.int64()),
                pa.array([d[1] for d in digests], pa.int64()),
                pa.array([bucket_counts(s) for s in sets], pa.binary()),
                pa.array(spare, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sigs), pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "d1", "d2", "buckets", "spare", "sigs"])

    return docs.mapInArrow(scan, _SHINGLED)


_EDGE, _END, _MEMBER = 0, 1, 2
_NEIGHBOURS = "kind byte, part int, a long, b long, sig long"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between rows that follow each other in one signature; the members of each signature that more than
    two nodes have here, or that may go on in another part; and the part's first and last row."""
    part = TaskContext.get().partitionId()
    # Of the last signature: its rows if they are not given out yet, two at most; else the last row, given out.
    sigs, nodes, given = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), False
    first: tuple[int, int] | None = None

    def rows(kind: int, a, b, sig) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(a), kind, dtype=np.int8))
        parts = pa.array(np.full(len(a), part, dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [kinds, parts, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sig, pa.int64())],
            names=["kind", "part", "a", "b", "sig"],
        )

    def members(sig: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return rows(_MEMBER, node, np.zeros(len(node), dtype=np.int64), sig)

    for batch in batches:
        if not batch.num_rows:
            continue
        sig, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        opening = first is None
        if first is None:
            first = int(sig[0]), int(node[0])
        sig, node = np.concatenate([sigs, sig]), np.concatenate([nodes, node])
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
        sig, node = sig[new], node[new]
        same = sig[1:] == sig[:-1]
        pairs = np.unique(np.stack([node[1:][same], node[:-1][same]]), axis=1)
        if pairs.shape[1]:
            yield rows(_EDGE, pairs[0], pairs[1], np.zeros(pairs.shape[1], dtype=np.int64))
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        counts = np.diff(np.concatenate([starts, [len(sig)]]))
        many = counts > 2
        many[0] |= opening or given
        give = np.repeat(many, counts)
        give[0] &= not given
        if give.any():
            yield members(sig[give], node[give])
        given = bool(many[-1])
        held = slice(len(sig) - 1 if given else int(starts[-1]), None)
        sigs, nodes = sig[held], node[held]
    if first is not None:
        if not given:
            yield members(sigs, nodes)
        # Two rows: (first node, 0, first signature), (last node, 1, last signature).
        yield rows(_END, [first[1], int(nodes[-1])], [0, 1], [first[0], int(sigs[-1])])


def signature_edges(rows: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Of (sig, node, salt): edges (a, b) that connect all sets of each signature; (sig, node) of the signatures that
    more than two sets have, and of some others, rarely twice; and the folder they are stored in."""
    spark = rows.sparkSession
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "sig", "node", "salt").sortWithinPartitions("sig", "node")
    found, folder = stored_at(ordered.select("sig", "node").mapInArrow(_neighbours, _NEIGHBOURS), "signature-edges")
    # Two rows a part: a signature that goes on in the next part is joined across the border.
    ends = found.filter(F.col("kind") == _END).orderBy("part", "b").select("a", "sig").collect()
    across = [(y["a"], x["a"]) for x, y in zip(ends[1::2], ends[2::2]) if x["sig"] == y["sig"] and x["a"] != y["a"]]
    edges = found.filter(F.col("kind") == _EDGE).select("a", "b").unionByName(spark.createDataFrame(across, "a long, b long"))
    return edges, found.filter(F.col("kind") == _MEMBER).select("sig", F.col("a").alias("node")), folder


def similar(inter: np.ndarray, left: np.ndarray, right: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    return least[1] * inter >= least[0] * (left + right - inter)


def links_within(sets: list[np.ndarray], sides: np.ndarray, least: tuple[int, int]) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets; with two sides, only of links across them."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    hashes, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    _, column, count = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    inter = np.zeros((m, m), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    columns = int(column[-1]) + 1 if len(column) else 0
    width = min(max(256, (32 << 20) // (4 * m)), columns)
    for start in range(0, columns, max(width, 1)):
        a, b = np.searchsorted(column, [start, start + width])
        block = np.zeros((m, width), dtype=np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        inter += block @ block.T
    linked = similar(inter.astype(np.int64), sizes[:, None], sizes[None, :], least)
    np.fill_diagonal(linked, False)
    if (sides != sides[0]).any():
        linked &= sides[:, None] != sides[None, :]
    return _forest(linked)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a breadth-first forest of a symmetric boolean matrix."""
    unseen = np.ones(len(linked), dtype=bool)
    edges: list[tuple[int, int]] = []
    for root in range(len(linked)):
        if not unseen[root]:
            continue
        unseen[root], queue = False, [root]
        while queue:
            at = queue.pop()
            found = np.flatnonzero(linked[at] & unseen)
            unseen[found] = False
            edges += [(int(x), at) for x in found]
            queue += found.tolist()
    return edges


def possible(counts: np.ndarray, sizes: np.ndarray, known: np.ndarray, sides: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """Which pairs of sets may be similar, judging by bucket counts (a row a set)."""
    rows = np.flatnonzero(sides == sides[0])
    across = len(rows) < len(sizes)
    columns = np.flatnonzero(sides != sides[0]) if across else rows
    most = np.zeros((len(rows), len(columns)), dtype=np.int32)
    for left, right in zip(np.ascontiguousarray(counts[rows].T), np.ascontiguousarray(counts[columns].T)):
        most += np.minimum(left[:, None], right[None, :])
    left, right = sizes[rows][:, None], sizes[columns][None, :]
    most = np.where(known[rows][:, None] & known[columns][None, :], most, np.minimum(left, right))
    pairs = np.zeros((len(sizes), len(sizes)), dtype=bool)
    pairs[np.ix_(rows, columns)] = similar(most.astype(np.int64), left, right, least)
    np.fill_diagonal(pairs, False)
    return pairs | pairs.T


def bounds(counts: tuple[pa.Array, pa.Array], sizes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The most that two sets of each row can have in common, judging by bucket counts."""
    most = np.minimum(*sizes)
    widths = [pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in counts]
    known = np.flatnonzero((widths[0] > 0) & (widths[1] > 0))
    if not len(known):
        return most
    # Rows of the same two numbers of buckets are one matrix a side.
    shapes, shape = np.unique(np.stack([w[known] for w in widths]), axis=1, return_inverse=True)
    for k, shaped in enumerate(shapes.T):
        at, width = known[shape.ravel() == k], int(shaped.min())
        sides = [np.frombuffer(b"".join(c.take(pa.array(at)).to_pylist()), dtype=np.uint8) for c in counts]
        left, right = (x.reshape(len(at), -1, width).sum(axis=1, dtype=np.uint16) for x in sides)
        most[at] = np.minimum(left, right).sum(axis=1, dtype=np.int64)
    return most


def possible_edges(pairs: DataFrame, sets: DataFrame, layout: Layout) -> DataFrame:
    """Those of the pairs (a, b) that may be similar, judging by size and bucket counts; sets: (node, n, buckets)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=2048):
            sizes = tuple(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            may = similar(bounds((batch.column(4), batch.column(5)), sizes), *sizes, layout.least)
            yield batch.select(["a", "b"]).filter(pa.array(may))

    once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()
    end = lambda name: sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("buckets").alias(f"in_{name}"))
    near = F.least("n_a", "n_b") * layout.least[1] >= F.greatest("n_a", "n_b") * layout.least[0]
    both = once.join(end("a"), "a").join(end("b"), "b").filter(near)
    return both.select("a", "b", "n_a", "n_b", "in_a", "in_b").mapInArrow(compare, "a long, b long")


def spared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The members (sig, node) without the commonest signatures of each set, as many as it can spare; sets: (node, spare)."""
    counted = members.groupBy("sig").agg(F.count("*").alias("m")).filter(F.col("m") > CROWD)
    common = stored(counted, "common-signatures")
    group = F.col("sig").bitwiseAND((1 << GROUP_BITS) - 1)
    commonest = Window.partitionBy("node", "group").orderBy(F.col("m").desc(), "sig")
    own = members.join(common, "sig").join(sets.select("node", "spare"), "node").withColumn("group", group)
    left = F.expr(f"shiftright(spare, int({SPARE_BITS} * group))").bitwiseAND((1 << SPARE_BITS) - 1)
    kept = own.withColumn("at", F.row_number().over(commonest)).filter(F.col("at") > left).select("sig", "node")
    return members.join(common.select("sig"), "sig", "left_anti").unionByName(kept)


def candidates(edges: DataFrame, members: DataFrame, sets: DataFrame, layout: Layout) -> DataFrame:
    """(node, component): components that hold every similar pair; sets that share no signature of use are in none.

    edges and members: as ``signature_edges`` has them; sets: (node, n, buckets, spare).
    """
    near = components(possible_edges(edges, sets, layout))
    component = F.coalesce("component", "node").alias("component")
    kept = spared(members, sets).join(near, "node", "left").select("sig", "node", component)
    kept = stored(kept, "signature-members")
    # Sets of one component are compared anyway.
    spread = kept.groupBy("sig").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.min("node").alias("least"), F.count("*").alias("m")
    )
    apart = kept.join(spread.filter("x < y").select("sig", "least", "m"), "sig")
    lists = apart.filter(F.col("m") <= CROWD).groupBy("sig").agg(F.collect_set(F.struct("node", "component")).alias("of"))
    others = "filter(of, y -> y.node > x.node AND y.component != x.component)"
    listed = F.expr(f"flatten(transform(of, x -> transform({others}, y -> struct(x.node AS a, y.node AS b))))")
    more = possible_edges(lists.select(F.explode(listed).alias("p")).select("p.a", "p.b"), sets, layout)
    known = near.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    crowded = stored(apart.filter(F.col("m") > CROWD), "crowded")
    if not crowded.isEmpty():
        known = known.unionByName(crowd_edges(_crowds(crowded), sets, layout))
    return components(known.unionByName(more))


def _crowds(crowded: DataFrame) -> DataFrame:
    """(crowd, node, component): sets to be compared with each other, from (sig, node, component, least, m).

    Signatures that have much the same sets, as those of a family of copies, are one crowd; signatures that
    only chain together are one each.
    """
    joint = components(crowded.select(F.col("node").alias("a"), F.col("least").alias("b"))).withColumnRenamed("component", "joint")
    sigs = crowded.select("sig", F.col("least").alias("node"), "m").distinct().join(joint, "node").select("sig", "joint", "m")
    alone = sigs.groupBy("joint").agg(F.sum(F.col("m").cast("double") * F.col("m")).alias("pairs"))
    whole = joint.groupBy("joint").agg(F.count("*").cast("double").alias("c"))
    best = whole.join(alone, "joint").select("joint", (F.col("c") * F.col("c") <= F.col("pairs")).alias("whole"))
    crowd = F.when(F.col("whole"), F.col("joint")).otherwise(F.col("sig")).alias("crowd")
    found = crowded.join(sigs.join(best, "joint").select("sig", crowd), "sig").select("crowd", "node", "component")
    return stored(found.distinct(), "crowds")


def crowd_edges(crowds: DataFrame, sets: DataFrame, layout: Layout) -> DataFrame:
    """Edges (a, b) that connect the sets of a crowd that may be similar, but for those already in one component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = None, []

        def found() -> pa.RecordBatch:
            edges = []
            if len(rows) > 1:
                sides, ids, labels, sizes, counts = zip(*rows)
                known = np.array([len(c) > 0 for c in counts])
                n = np.array(sizes, dtype=np.int64)
                pairs = _apart(folded(counts), n, known, np.array(sides), np.array(labels), layout.least)
                edges = [(ids[x], ids[y]) for x, y in _forest(pairs)]
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if key != task:
                    yield found()
                    task, rows = key, []
                rows.append(row)
        yield found()

    spark = crowds.sparkSession
    sized = crowds.join(sets.select("node", "n"), "node").select("node", F.col("crowd").alias("component"), "n")
    labels = crowds.select("node", F.col("component").alias("label")).distinct()
    routed = _blocks(sized, layout.growth).join(labels, "node").join(sets.select("node", "n", "buckets"), "node")
    keyed = routed.select(F.to_json("task").alias("task"), "side", "node", "label", "n", "buckets")
    ordered = keyed.repartition(shuffle_partitions(spark), "task").sortWithinPartitions("task", "side", "node")
    return ordered.mapInArrow(compare, "a long, b long")


def _apart(
    counts: np.ndarray, sizes: np.ndarray, known: np.ndarray, sides: np.ndarray, labels: np.ndarray, least: tuple[int, int]
) -> np.ndarray:
    """As ``possible``, but pairs within the label that most of the sets have are not looked at."""
    _, number = np.unique(labels, return_inverse=True)
    main, here = number == np.bincount(number).argmax(), sides == sides[0]
    if here.all():
        looks = [(here, main, True), (~main, here, False)]
    else:
        looks = [(~(main & here), here, True), (here == main, here, True)]
    pairs = np.zeros((len(sizes), len(sizes)), dtype=bool)
    for chosen, side, across in looks:
        at = np.flatnonzero(chosen)
        if len(at) > 1 and not (across and (side[at] == side[at[0]]).all()):
            pairs[np.ix_(at, at)] |= possible(counts[at], sizes[at], known[at], side[at], least)
    return pairs


def _blocks(members: DataFrame, growth: float) -> DataFrame:
    """(node, task, side): the block comparisons that each member of a candidate component takes part in.

    A component's members of one band are dealt into blocks by a hash of the id. A component of one
    block is one task; else blocks meet within a band and with the next band.
    """
    j = F.floor(F.log(F.col("n").cast("double")) / math.log(growth) + 1e-9).cast("int")
    banded = members.withColumn("band", j)
    per_band = banded.groupBy("component", "band").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    need = F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    sized = per_band.withColumn("blocks", need)
    whole = per_band.groupBy("component").agg(F.sum("c").alias("c"), F.sum("s").alias("s"))
    whole = whole.withColumn("single", need == 1).select("component", "single")
    blocks_of = lambda shift, name: sized.select("component", (F.col("band") - shift).alias("band"), F.col("blocks").alias(name))
    dealt = (
        banded.join(whole, "component")
        .join(sized.select("component", "band", "blocks"), ["component", "band"])
        .join(blocks_of(1, "above"), ["component", "band"], "left")
        .join(blocks_of(-1, "below"), ["component", "band"], "left")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    tag = lambda b1, k1, b2, k2, side: F.struct(
        b1.alias("band"), k1.alias("block"), b2.alias("other_band"), k2.alias("other"), F.lit(side).alias("side")
    )
    band_, block = F.col("band"), F.col("block")
    span = lambda last: F.sequence(F.lit(0), last)
    own = F.transform(span(F.col("blocks") - 1), lambda o: tag(band_, F.least(block, o), band_, F.greatest(block, o), 0))
    # Within one band the side is the block itself; a block meets itself with one side.
    own = F.transform(own, lambda t: t.withField("side", (t["block"] != block).cast("int")))
    up = F.when(F.col("above").isNotNull(), F.transform(span(F.col("above") - 1), lambda o: tag(band_, block, band_ + 1, o, 0)))
    down = F.when(F.col("below").isNotNull(), F.transform(span(F.col("below") - 1), lambda o: tag(band_ - 1, o, band_, block, 1)))
    none = F.array().cast("array<struct<band:int,block:int,other_band:int,other:int,side:int>>")
    one = F.array(tag(F.lit(-1), F.lit(0), F.lit(-1), F.lit(0), 0))
    tasks = F.when(F.col("single"), one).otherwise(F.concat(own, F.coalesce(up, none), F.coalesce(down, none)))
    return dealt.select("node", "component", F.explode(tasks).alias("t")).select(
        "node", F.struct("component", "t.band", "t.block", "t.other_band", "t.other").alias("task"), "t.side"
    )


def verified_links(docs: DataFrame, members: DataFrame, classes: DataFrame, words: int, layout: Layout) -> DataFrame:
    """(a, b): a spanning forest of the exact links within each candidate component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        task, ids, sets, sides = None, [], [], []

        def found() -> pa.RecordBatch:
            edges = links_within(sets, np.array(sides), layout.least) if len(sets) > 1 else []
            pairs = [(ids[x], ids[y]) for x, y in edges]
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

        for batch in slices(batches):
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for key, side, node, d1, d2, text in zip(*columns):
                if key != task:
                    yield found()
                    task, ids, sets, sides = key, [], [], []
                if ids and ids[-1] == node:
                    continue
                hashes = shingles(text)
                if digest(hashes) == (d1, d2):  # rows of the same id may have other texts
                    ids.append(node)
                    sides.append(side)
                    sets.append(hashes)
        yield found()

    spark = docs.sparkSession
    chosen = classes.select("node", "d1", "d2", F.col("first").alias("doc_id"))
    routed = _blocks(members, layout.growth).join(chosen, "node").join(docs, "doc_id")
    rows = routed.select(F.to_json("task").alias("task"), "side", "node", "d1", "d2", "text")
    ordered = rows.repartition(shuffle_partitions(spark), "task").sortWithinPartitions("task", "side", "node")
    return ordered.mapInArrow(compare, "a long, b long")


def _numbered(filled: DataFrame) -> DataFrame:
    """(node, n, d1, d2, first): the different sets, numbered; ``first`` is the smallest id that has one."""
    least = filled.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("first"))
    return stored(least.withColumn("node", F.monotonically_increasing_id()), "numbered")


def _classes(filled: DataFrame, numbered: DataFrame) -> DataFrame:
    """The numbered sets with bucket counts and what they can spare, from one row of their first id.

    Found by id and digest, so the rows of a large family of copies do not meet in one place.
    """
    own = numbered.select("node", "first", *[F.col(c).alias(f"{c}_") for c in ("n", "d1", "d2")])
    same = [F.col(c) == F.col(f"{c}_") for c in ("n", "d1", "d2")]
    found = filled.join(own, (F.col("doc_id") == F.col("first")) & same[0] & same[1] & same[2])
    once = found.dropDuplicates(["doc_id", "n", "d1", "d2"])
    return stored(once.select("node", "n", "d1", "d2", "first", "buckets", "spare"), "sets")


def _shared_ids(rows: DataFrame) -> DataFrame:
    """(a, b): links between different sets that rows of one id have."""
    least = rows.groupBy("doc_id").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    return rows.join(least, "doc_id").filter("node > least").select(F.col("node").alias("a"), F.col("least").alias("b"))


def linked_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: tuple[int, int] = LEAST
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; ``least`` is the threshold as a fraction."""
    layout, docs = Layout(least), documents_of(df, id_col, text_col)
    with_words = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    signed, folder = stored_at(shingled(docs, words, layout), "shingled")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("short").alias("salt")
    # Sets that share half a digest by chance would be candidates of each other's partners: harmless.
    rows = signed.filter(with_words).select(F.explode("sigs").alias("sig"), F.col("d1").alias("node"), salt)
    edges, sharers, edge_folder = signature_edges(rows)
    sized = stored(signed.drop("sigs"), "sized")
    folders.remove(docs.sparkSession, folder)
    filled = sized.filter(with_words)
    numbered = _numbered(filled)
    classes = _classes(filled, numbered)
    found = candidates(edges, sharers, classes.select(F.col("d1").alias("node"), "n", "buckets", "spare"), layout)
    folders.remove(docs.sparkSession, edge_folder)
    members = numbered.select("node", "n", "d1").join(found.withColumnRenamed("node", "d1"), "d1")
    members = stored(members.select("node", "component", "n"), "candidates")
    links = verified_links(docs.filter(F.col("doc_id").isNotNull()), members, classes, words, layout)

    same_set = ["n", "d1", "d2"]
    rows = filled.select("doc_id", *same_set).join(numbered.select("node", *same_set), same_set)
    labels = components(links.unionByName(_shared_ids(rows)))
    # Copies take the answer of their set: no star of copies is ever walked.
    known = numbered.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    answers = stored(known.join(smallest, "component").select(*same_set, "component_id"), "set-answers")
    out = sized.select("doc_id", *same_set).join(answers, same_set, "left")
    found = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(found, "doc_id").alias("component_id"))
