"""Packing token sequences: vector bin packing with a dot-product heuristic.

Examples become token ids and are placed into sequences under three limits at once: tokens,
segments, and tokens that bear loss. A sequence is filled by the waiting example whose demand
vector has the largest dot product with the room left, so a sequence short of segments takes
few large examples and one short of loss room takes prompts.

* Every example ends with a separator id. What exceeds a sequence is cut off in full sequences
  first; only the rest, shorter than a sequence, competes for places.
* Each task packs its own part of the input as it streams by. It holds ``POOL`` rests at most.
  Sequences that come out badly filled go back to the pool; at the end of the part the rests in
  them are laid end to end and cut, so a part leaves one or two padded sequences.
* A task's result depends on its input split alone: a retried task writes the same sequences.
* Null text counts as empty (the separator alone); repeated rows are packed once each; a null id
  stays null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents_of, slices

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, loss_tokens long"
)
SEPARATOR = 0
#: Rests that wait at once in a task, and the share of them that may wait again.
POOL = 4096
#: A sequence at or above this fill is final.
FULL = 0.985


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 128
    loss: int = 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.float64)


@dataclass(frozen=True)
class Piece:
    key: int | None
    start: int
    ids: np.ndarray
    loss: np.ndarray
    total: int

    def demand(self) -> tuple[int, int, int]:
        return len(self.ids), 1, int(self.loss.sum())

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, self.ids[:at], self.loss[:at], self.total),
            Piece(self.key, self.start + at, self.ids[at:], self.loss[at:], self.total),
        )


@lru_cache(maxsize=4)
def encoder(path: str, added: bool = False) -> Callable[[str], list[int]]:
    """Ids of text under a byte-level BPE given as a tokenizer's JSON file.

    With ``added``, the strings of the tokens that the JSON file adds to its vocabulary get those
    tokens' ids, as in a tokenizer's default setting; otherwise they are ordinary text. The ranks
    beside the JSON file hold the same vocabulary in the form the faster library reads; texts that
    may have added tokens are left to the JSON file's own. Tests hold both to equal ids.
    """
    import public_tokenizers
    import tiktoken

    ranks_path = path.removesuffix(".json") + ".tiktoken"
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    if not added:
        return encoding.encode_ordinary
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    literals = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if any(literal in text for literal in literals):
            return tokenizer.encode(text, add_special_tokens=False).ids
        return encoding.encode_ordinary(text)

    return encode


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def choose(demands: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Indices of the items of each bin, bin by bin, by the largest dot product with the room left."""
    shares = demands / limits
    weights = shares.mean(axis=0)
    alive = np.arange(len(shares))
    bins: list[list[int]] = []
    while len(alive):
        room, rows, members = np.ones(3), shares[alive], []
        free = np.ones(len(alive), dtype=bool)
        while True:
            fits = free & (rows <= room + 1e-12).all(axis=1)
            if not fits.any():
                break
            best = int(np.where(fits, rows @ (weights * room), -1.0).argmax())
            members.append(int(alive[best]))
            free[best] = False
            room = room - rows[best]
        bins.append(members)
        alive = alive[free]
    return bins


def _fits(used: np.ndarray, limits: Limits) -> bool:
    return used[0] < limits.tokens and used[1] < limits.segments and used[2] < limits.loss


def _laid_out(pieces: Iterable[Piece], limits: Limits) -> Iterator[list[Piece]]:
    """Pieces end to end, cut wherever a limit is reached."""
    sequence: list[Piece] = []
    used = np.zeros(3, dtype=np.int64)
    for piece in pieces:
        while len(piece.ids):
            if not _fits(used, limits):
                yield sequence
                sequence, used = [], np.zeros(3, dtype=np.int64)
            loss_room = np.searchsorted(np.cumsum(piece.loss), limits.loss - used[2], side="right")
            at = int(min(len(piece.ids), limits.tokens - used[0], max(1, loss_room)))
            head, piece = piece.cut(at)
            sequence.append(head)
            used += head.demand()
    if sequence:
        yield sequence


def packed(examples: Iterable[tuple[int | None, np.ndarray, np.ndarray]], limits: Limits) -> Iterator[list[Piece]]:
    """Sequences of pieces from (key, ids, loss mask); each id lies in exactly one piece."""
    pool: list[Piece] = []
    for key, ids, loss in examples:
        rest, loss_left = Piece(key, 0, ids, loss, len(ids)), int(loss.sum())
        while len(rest.ids) >= limits.tokens or loss_left > limits.loss:
            loss_fits = np.searchsorted(np.cumsum(rest.loss[: limits.tokens]), limits.loss, side="right")
            full, rest = rest.cut(int(max(1, loss_fits)))
            loss_left -= int(full.loss.sum())
            yield [full]
        if len(rest.ids):
            pool.append(rest)
        if len(pool) >= POOL:
            pool = yield from _placed(pool, limits, keep=POOL // 2)
    pool = yield from _placed(pool, limits, keep=len(pool))
    yield from _laid_out(pool, limits)


def _placed(pool: list[Piece], limits: Limits, keep: int) -> Iterator[list[Piece]]:
    """Yields well filled sequences; returns the pieces, ``keep`` at most, that wait for better company."""
    if not pool:
        return pool
    demands = np.array([p.demand() for p in pool], dtype=np.float64)
    bins = choose(demands, limits.vector())
    fill = [max(demands[b].sum(axis=0) / limits.vector()) for b in bins]
    waiting: list[int] = []
    for k in np.argsort(fill, kind="stable"):
        if fill[k] < FULL and len(waiting) + len(bins[k]) <= keep:
            waiting += bins[k]
        else:
            yield [pool[i] for i in bins[k]]
    return [pool[i] for i in sorted(waiting)]


def _rows(sequences: Iterable[list[Piece]], first_id: int) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    columns: list[list] = [[] for _ in names]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    for sequence_id, sequence in enumerate(sequences, first_id):
        offset = 0
        for p in sequence:
            crc = zlib.crc32(p.ids.astype("<u4").tobytes())
            row = (p.key, p.start, len(p.ids), crc, p.total, sequence_id, offset, int(p.loss.sum()))
            for column, value in zip(columns, row):
                column.append(value)
            offset += len(p.ids)
        if len(columns[0]) >= 10_000:
            yield batch()
            columns = [[] for _ in names]
    if columns[0]:
        yield batch()


def _pack_with(examples_of: Callable[[pa.RecordBatch], Iterator], limits: Limits):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = (e for batch in slices(batches) for e in examples_of(batch))
        # A task numbers its sequences in a range of its own.
        yield from _rows(packed(examples, limits), TaskContext.get().partitionId() << 40)

    return pack


def pack_documents(
    df: DataFrame, tokenizer: str | None = None, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
    added: bool = False,
) -> DataFrame:
    """Whole documents, each with a separator at its end; all ids but the separator bear loss.

    With ``added``, strings of added tokens in a text get those tokens' ids (see ``encoder``).
    """
    path = tokenizer or tokenizer_path()

    def examples(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray, np.ndarray]]:
        encode = encoder(path, added)
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.array([*encode(text), SEPARATOR], dtype=np.uint32)
            loss = np.ones(len(ids), dtype=bool)
            loss[-1] = False
            yield key, ids, loss

    return documents_of(df, id_col, text_col).mapInArrow(_pack_with(examples, limits), SCHEMA)


def pack_conversations(
    df: DataFrame, tokenizer: str | None = None, limits: Limits = Limits(loss=768), trained_role: str = "assistant"
) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as examples: only the trained role's turns bear loss."""
    path = tokenizer or tokenizer_path()

    def examples(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray, np.ndarray]]:
        encode = encoder(path)
        for key, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            coded = [(encode(t["text"] or ""), t["role"] == trained_role) for t in turns]
            ids = np.array([i for ids, _ in coded for i in ids] + [SEPARATOR], dtype=np.uint32)
            yield key, ids, np.array([bears for ids, bears in coded for _ in ids] + [False], dtype=bool)

    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    grouped = df.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(turns.alias("turns"))
    return grouped.mapInArrow(_pack_with(examples, limits), SCHEMA)
