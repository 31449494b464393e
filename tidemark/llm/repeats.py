"""Repeated byte strings across a corpus, by prefix-free parsing.

A rolling hash picks triggers in the text: every 200-byte string has exactly one, the smallest
hash among its first 161 twelve-byte grams. The strings that share a trigger form a phrase, and
phrases overlap by 199 bytes, so that each 200-byte string lies in one phrase and no phrase
begins inside another of the same trigger. Which strings occur twice then depends on the
dictionary of phrases alone. It is brought into one order for the whole corpus and neighbours
are compared:

1. Phrases are sorted by (bytes from the trigger that all their strings have, whole phrase). A
   phrase equal to a neighbour holds repeated strings only; one whose neighbours do not even
   share the bytes from the trigger holds none. Those beside a different phrase with the same
   bytes from the trigger, at the borders of repeats, are split.
2. Their suffixes, in blocks of 16 starts aligned to the trigger, are sorted likewise;
3. and so is each 200-byte suffix of the blocks still open. Equal neighbours are repeated.

Every order is a range partitioning of 128-bit ranks with the document as the last key, so a
phrase that a third of all documents share is spread over tasks, and a task needs a row and its
neighbours only. Ranks are hashes of the bytes: the order among different strings is of no
use here, only where equal ones meet.

Texts are judged as UTF-8. Null counts as empty. Texts under 200 bytes repeat nothing. Rows that
repeat, id included, are separate occurrences; a null id is an id. Extra columns are ignored.
Very long texts are parsed piecewise, in memory that does not grow with them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents_of, shuffle_partitions, slices, stored

LENGTH, GRAM, SPAN = 200, 12, 160
#: Bytes from a trigger that all strings of its phrase have.
CORE = LENGTH - SPAN
BLOCK = 16
#: Starts of strings that are parsed at a time.
CHUNK = 1 << 20
_U = np.uint64
_PLACES = _U(0x7FFFFFFF)
_ROWS = "core long, whole long, doc_id long, place long"
_KEY = [("doc_id", pa.int64()), ("mark", pa.int32())]


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _rolling(data: bytes) -> np.ndarray:
    """Mixed hashes of all twelve-byte grams: eight bytes by doubling, then four more."""
    grams = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + _U(1)
    factor, width = 0x9E3779B97F4A7C15, 1
    fours = grams
    for _ in range(3):
        grams = grams[:-width] * _U(factor) + grams[width:]
        factor, width = factor * factor % (1 << 64), width * 2
        fours = grams if width == 4 else fours
    mixed = grams[:-4] * _U(0xD6E8FEB86659FD93) + fours[8 : 8 + len(grams) - 4]
    return (mixed ^ (mixed >> _U(29))) * _U(0xBF58476D1CE4E5B9)


def phrases(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(first start, last start, trigger) of each phrase's strings."""
    for begin in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[begin : begin + CHUNK + LENGTH - 1]
        hashes = _rolling(part)
        # Of equal hashes the leftmost is the trigger.
        keyed = (hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64)
        trigger = (_least_of(keyed, SPAN + 1)[: len(part) - LENGTH + 1] & _PLACES).astype(np.int64)
        turns = np.flatnonzero(trigger[1:] != trigger[:-1]) + 1
        first = np.concatenate([[0], turns])
        last = np.concatenate([turns, [len(trigger)]]) - 1
        yield from zip((first + begin).tolist(), (last + begin).tolist(), (trigger[first] + begin).tolist())


def pack(first: int, last: int, trigger: int, mark: int) -> int:
    return first << 32 | (last - first) << 24 | (trigger - first) << 16 | mark


def unpack(place: int) -> tuple[int, int, int]:
    first = place >> 32
    return first, first + (place >> 24 & 0xFF), first + (place >> 16 & 0xFF)


def mark_of(data: bytes) -> int:
    """Sixteen bits of the text beside the 64 of a row's key."""
    return zlib.crc32(data) & 0xFFFF


def _hash(data: bytes, seed: int = 0) -> int:
    value = xxhash.xxh3_64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def _ranked(rows: Iterable[tuple[int, int, int | None, int]]) -> Iterator[pa.RecordBatch]:
    names, columns = [f.split()[0] for f in _ROWS.split(", ")], ([], [], [], [])
    for row in rows:
        for column, value in zip(columns, row):
            column.append(value)
        if len(columns[0]) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
            columns = ([], [], [], [])
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _phrase_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in slices(batches):
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mark = mark_of(data) if len(data) >= LENGTH else 0
                for first, last, trigger in phrases(data):
                    core, whole = data[trigger : trigger + CORE], data[first : last + LENGTH]
                    yield _hash(core), _hash(whole), doc, pack(first, last, trigger, mark)

    yield from _ranked(rows())


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, mark, z, open): the open phrases' starts in blocks counted from the trigger."""

    def rows():
        for doc, mark, data, places in _opened(batches):
            for first, last, trigger in map(unpack, places):
                for block in range((trigger - last) // BLOCK, (trigger - first) // BLOCK + 1):
                    high = trigger - block * BLOCK
                    low = high - BLOCK + 1
                    a, b = max(first, low), min(last, high)
                    core, whole = data[high : low + LENGTH], data[a : b + LENGTH]
                    yield _hash(core, block + 1), _hash(whole, block + 1), doc, pack(a, b, b, mark)

    yield from _ranked(rows())


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, mark, z, open): each string of the open blocks."""

    def rows():
        for doc, mark, data, places in _opened(batches):
            for first, last, _ in map(unpack, places):
                for at in range(first, last + 1):
                    string = data[at : at + LENGTH]
                    yield _hash(string, 101), _hash(string, 202), doc, pack(at, at, at, mark)

    yield from _ranked(rows())


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, bytes, list[int]]]:
    unzip = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches):
        for doc, mark, z, places in zip(*(batch.column(i).to_pylist() for i in range(4))):
            yield doc, mark, unzip(z), places


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that equal a neighbour, or share only the core with one; the part's ends go out undecided.

    A run of equal rows beside a different row of the same core keeps a witness at its border, so
    that what is split further meets each different whole of its core.
    """
    part = TaskContext.get().partitionId()
    names = ["part", "core", "whole", "doc_id", "place", "open", "repeated"]

    def out(rows: pa.Table, at: np.ndarray, open_: np.ndarray, repeated: np.ndarray, end: bool) -> pa.RecordBatch:
        parts = pa.array(np.full(len(at), part if end else -1, dtype=np.int32))
        columns = [c.combine_chunks().take(pa.array(at)) for c in rows.columns]
        return pa.RecordBatch.from_arrays([parts, *columns, pa.array(open_[at]), pa.array(repeated[at])], names=names)

    held: pa.Table | None = None  # the last row so far, and its flags from the row before it
    held_flags, started = (False, False), False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        core, whole = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        beside = core[1:] == core[:-1]
        same = beside & (whole[1:] == whole[:-1])
        open_, repeated = np.append(held_flags[0], beside & ~same), np.append(held_flags[1], same)
        open_[:-1] |= beside & ~same
        repeated[:-1] |= same
        begin, last = 0, len(core) - 1
        if not started and last > 0:
            started, begin = True, 1
            yield out(rows, np.array([0]), open_, repeated, True)
        inner = np.flatnonzero((open_ | repeated)[begin:last]) + begin
        if len(inner):
            yield out(rows, inner, open_, repeated, False)
        held, held_flags = rows.slice(last).combine_chunks(), (bool(open_[-1]), bool(repeated[-1]))
    if held is not None:
        yield out(held, np.array([0]), np.array([held_flags[0]]), np.array([held_flags[1]]), True)


def in_corpus_order(rows: DataFrame, label: str) -> DataFrame:
    """(doc_id, mark, place, repeated, open) of the rows that equal a neighbour or share a core with one."""
    spark = rows.sparkSession
    order = ["core", "whole", "doc_id", "place"]
    ordered = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    schema = "part int, core long, whole long, doc_id long, place long, open boolean, repeated boolean"
    compared = stored(ordered.mapInArrow(_compare_neighbours, schema), label)
    ends = [list(r) for r in compared.filter("part >= 0").orderBy("part", *order).collect()]  # two a part at most
    for x, y in zip(ends, ends[1:]):
        if x[0] != y[0] and x[1] == y[1]:
            flag = 6 if x[2] == y[2] else 5
            x[flag] = y[flag] = True
    decided = spark.createDataFrame([tuple(r) for r in ends], schema).filter("open or repeated")
    found = compared.filter("part < 0").unionByName(decided)
    mark = F.col("place").bitwiseAND(0xFFFF).cast("int")
    return found.select("doc_id", mark.alias("mark"), "place", "repeated", "open")


def _per_document(found: DataFrame) -> DataFrame:
    """(doc_id, mark, repeated, open): the places of each document; as many as its length allows."""
    places = lambda which: F.collect_list(F.when(which, F.col("place")))
    return found.groupBy("doc_id", "mark").agg(
        places(F.col("repeated")).alias("repeated"), places(F.col("open")).alias("open")
    )


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    on = left["doc_id"].eqNullSafe(right["doc_id"]) & (left["mark"] == right["mark"])
    return left.join(right, on, how).drop(right["doc_id"], right["mark"])


def runs_of(places: Iterable[int]) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of bytes that strings starting in the places cover."""
    out: list[list[int]] = []
    for first, last, _ in sorted(map(unpack, places)):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + LENGTH)
        else:
            out.append([first, last + LENGTH])
    return [(a, b) for a, b in out]


def _digest(data: bytes, places: Iterable[int]) -> dict:
    runs = runs_of(places)
    kept, at = hashlib.sha256(), 0
    for start, end in runs:
        kept.update(data[at:start])
        at = end
    kept.update(data[at:])
    return {
        "n_bytes": len(data),
        "n_removed": sum(b - a for a, b in runs),
        "n_spans": len(runs),
        "kept_sha256": kept.hexdigest(),
        "runs": [x for run in runs for x in run],
    }


_DIGEST = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("runs", pa.list_(pa.int64()))]
_DIGEST_DDL = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, runs array<long>"
_ID = ("id", pa.int64())
_STAGED = pa.schema([*_KEY, _ID, *_DIGEST, ("z", pa.binary()), ("repeated", pa.list_(pa.int64())), ("open", pa.list_(pa.int64()))])
_STAGED_DDL = f"doc_id long, mark int, id long, {_DIGEST_DDL}, z binary, repeated array<long>, open array<long>"
_DONE = pa.schema([_ID, *_DIGEST])


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, data, id): texts travel compressed."""
    pack_text = zstandard.ZstdCompressor(level=3).compress
    for batch in slices(batches):
        texts = batch.column(1).to_pylist()
        marks = [mark_of(t) if len(t) >= LENGTH else 0 for t in texts]
        columns = [batch.column(0), pa.array(marks, pa.int32()), pa.array([pack_text(t) for t in texts], pa.binary()), batch.column(2)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "z", "id"])


def _stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without open phrases are done; of the others the text goes on."""
    unzip = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches):
        rows = []
        for doc, mark, z, repeated, open_, id_ in zip(*(batch.column(i).to_pylist() for i in range(6))):
            row = {"doc_id": doc, "mark": mark, "id": id_}
            rows.append(row | ({"z": z, "repeated": repeated or [], "open": open_} if open_ else _digest(unzip(z), repeated or [])))
        yield pa.RecordBatch.from_pylist(rows, schema=_STAGED)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unzip = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches):
        columns = (batch.column(i).to_pylist() for i in range(4))
        rows = [{"id": id_} | _digest(unzip(z), [*a, *(b or [])]) for id_, z, a, b in zip(*columns)]
        yield pa.RecordBatch.from_pylist(rows, schema=_DONE)


def repeated_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs (also as start, end, start, ...) and the hash of the rest."""
    named = documents_of(df, id_col, text_col)
    # Rows of one id, or without one, may have different texts: a row goes by a digest of both.
    docs = named.select(F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("binary").alias("data"), F.col("doc_id").alias("id"))
    first = in_corpus_order(docs.select("key", "data").mapInArrow(_phrase_rows, _ROWS), "phrases")
    texts = docs.mapInArrow(_compress, "doc_id long, mark int, z binary, id long")
    marked = _joined(texts, _per_document(first), "left").select("doc_id", "mark", "z", "repeated", "open", "id")
    staged = stored(marked.mapInArrow(_stage, _STAGED_DDL), "staged")
    going = staged.filter(F.col("z").isNotNull())

    blocks = in_corpus_order(going.select("doc_id", "mark", "z", "open").mapInArrow(_block_rows, _ROWS), "blocks")
    open_blocks = _per_document(blocks.filter("open")).select("doc_id", "mark", "open")
    strings = in_corpus_order(
        _joined(going.select("doc_id", "mark", "z"), open_blocks, "inner").mapInArrow(_string_rows, _ROWS), "strings"
    )
    later = _per_document(blocks.unionByName(strings).filter("repeated"))
    later = later.select("doc_id", "mark", F.col("repeated").alias("later"))
    rest = _joined(going.select("doc_id", "mark", "z", "repeated", "id"), later, "left").select("id", "z", "repeated", "later")
    ready = rest.mapInArrow(_finish, f"id long, {_DIGEST_DDL}")
    return staged.filter(F.col("z").isNull()).select(ready.columns).unionByName(ready).withColumnRenamed("id", "doc_id")


def without_repeats(df: DataFrame, runs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeated runs cut out of the text; a cut may part a character, whose bytes then go too."""

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for text, run in zip(texts, spans):
            data, at, kept = text.encode() if text is not None else b"", 0, []
            for start, end in zip(run[::2], run[1::2]) if run is not None else ():
                kept.append(data[at:start])
                at = end
            out.append(None if text is None else b"".join([*kept, data[at:]]).decode("utf-8", "ignore"))
        return pd.Series(out)

    spans = runs.filter("n_spans > 0").select(F.col("doc_id").alias("_id"), F.col("runs").alias("_runs")).distinct()
    joined = df.join(spans, df[id_col] == spans["_id"], "left")
    return joined.withColumn(text_col, F.when(F.col("_runs").isNull(), F.col(text_col)).otherwise(cut(text_col, "_runs"))).drop("_id", "_runs")


def digests(docs: DataFrame) -> DataFrame:
    return repeated_runs(docs).drop("runs")
