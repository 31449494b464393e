"""Fill-in-the-middle transformation over lines, with memoised content-defined chunks.

A text is cut into lines, the line feed included, and two line borders drawn from the document's
id part it into prefix, middle and suffix. To find them nobody needs the lines themselves:

1. a rolling hash over 48 bytes cuts the text into chunks at places that depend on the content
   alone, so that equal passages of different documents fall into equal chunks;
2. a chunk's summary says how many characters and line feeds it has and where the line feeds lie.
   Each task keeps the summaries of chunks it has seen. An entry is found by a digest and counts
   only if its content equals the chunk's byte for byte; the cache is bounded in bytes, and the
   entries used least recently go first;
3. the counts of a document's chunks, added up, tell its number of lines, and by binary search the
   chunk in which a border lies; the summary has its place there.

The text itself stays in the JVM, where the pieces are cut out of its bytes and put together. Rows
are independent: nothing is shuffled, and a hot source or a family of copies is spread as the table
is. A very long text is hashed in slices, with memory for its bytes and a few numbers a chunk.

A null text counts as empty. An empty text, and one that holds a marker, stays plain. A null id draws
as the text ``null`` would. Repeated rows are transformed alike. An empty table stays empty. Other columns are
kept as they are; result columns replace input columns of their name.
"""

from __future__ import annotations

import bisect
from collections import OrderedDict
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Of a hundred documents, how many are transformed, and how many of those get the suffix first.
RATE, SPM_RATE = 100, 50

WINDOW = 48
#: A window whose hash has this many leading zeros ends a chunk: 2 KB on average.
CUT_BITS = 11
LEAST, MOST = 512, 16_384
#: Bytes of a text that are hashed at a time.
SLICE = 1 << 20
CACHE_BYTES = 32 << 20
_U = np.uint64


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """A polynomial hash of each 48 bytes: 16 by doubling, then three of those."""
    sums, factor, width = data.astype(np.uint64) + _U(1), 0x9E3779B97F4A7C15, 1
    while width < WINDOW // 3:
        sums = sums[:-width] * _U(factor) + sums[width:]
        factor, width = factor * factor % (1 << 64), width * 2
    far = len(sums) - 2 * width
    sums = (sums[:far] * _U(factor) + sums[width : width + far]) * _U(factor) + sums[2 * width :]
    return (sums ^ (sums >> _U(31))) * _U(0xBF58476D1CE4E5B9)


def borders(data: bytes) -> list[int]:
    """Ends of the chunks; each depends on the bytes before it, back to the chunk's start or a window."""
    n = len(data)
    found: list[np.ndarray] = []
    for begin in range(0, n - WINDOW + 1, SLICE):
        part = np.frombuffer(data, dtype=np.uint8, count=min(SLICE + WINDOW - 1, n - begin), offset=begin)
        found.append(np.flatnonzero(_window_hashes(part) >> _U(64 - CUT_BITS) == 0) + (begin + WINDOW))
    ends, last = [], 0
    for end in np.concatenate(found).tolist() if found else ():
        while end - last > MOST:
            last += MOST
            ends.append(last)
        if end - last >= LEAST:
            ends.append(end)
            last = end
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


class Summary(NamedTuple):
    content: bytes
    chars: int
    #: Bytes and characters up to each line feed, itself included.
    feeds: np.ndarray
    feed_chars: np.ndarray

    @property
    def cost(self) -> int:
        return len(self.content) + self.feeds.nbytes + self.feed_chars.nbytes + 300


def summarise(content: bytes) -> Summary:
    octets = np.frombuffer(content, dtype=np.uint8)
    starts = (octets & 0xC0) != 0x80  # a character counts where it starts
    feeds = np.flatnonzero(octets == 10) + 1
    return Summary(content, int(starts.sum()), feeds, np.cumsum(starts)[feeds - 1])


class ChunkMemo:
    """Summaries of chunks by content, at most ``limit`` bytes of them."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.used, self.hits, self.entries = limit, 0, 0, OrderedDict()

    def __call__(self, content: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(content)
        entry = self.entries.get(key)
        if entry is not None and entry.content == content:
            self.entries.move_to_end(key)
            self.hits += 1
            return entry
        if entry is not None:  # another content of the same digest gives way
            self.used -= self.entries.pop(key).cost
        fresh = summarise(content)
        self.entries[key] = fresh
        self.used += fresh.cost
        while self.used > self.limit:
            self.used -= self.entries.popitem(last=False)[1].cost
        return fresh


class Lines:
    """A text's line borders, from the summaries of its chunks."""

    def __init__(self, data: bytes, memo: ChunkMemo):
        ends = borders(data)
        self.starts = [0, *ends[:-1]]
        self.parts = [memo(data[a:b]) for a, b in zip(self.starts, ends)]
        self.feeds = list(accumulate((len(p.feeds) for p in self.parts), initial=0))
        self.chars = list(accumulate((p.chars for p in self.parts), initial=0))
        self.size = len(data)
        self.count = self.feeds[-1] + (1 if data and not data.endswith(b"\n") else 0)

    def end_of(self, lines: int) -> tuple[int, int]:
        """Bytes and characters of the first ``lines`` lines."""
        if lines <= 0:
            return 0, 0
        if lines > self.feeds[-1]:
            return self.size, self.chars[-1]
        at = bisect.bisect_left(self.feeds, lines) - 1
        part, within = self.parts[at], lines - self.feeds[at] - 1
        return self.starts[at] + int(part.feeds[within]), self.chars[at] + int(part.feed_chars[within])


_CUTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "first_byte", "second_byte", "prefix_chars", "middle_chars")])


@F.pandas_udf(_CUTS)
def _cuts(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Of (bytes, draw, draw): number of lines, and where prefix and middle end."""
    memo = ChunkMemo()
    for texts, draws, others in rows:
        out = []
        for data, x, y in zip(texts, draws, others):
            lines = Lines(bytes(data), memo)
            low, high = sorted((int(x) % (lines.count + 1), int(y) % (lines.count + 1)))
            (a, a_chars), (b, b_chars) = lines.end_of(low), lines.end_of(high)
            out.append((lines.count, a, b, a_chars, b_chars - a_chars))
        yield pd.DataFrame(out, columns=_CUTS.names)


def _draw(hexed: Column, k: int) -> Column:
    return F.conv(F.substring(hexed, 8 * k - 7, 8), 16, 10).cast("long")


def _piece(data: Column, start: Column, end: Column) -> Column:
    return F.substring(data, (start + 1).cast("int"), (end - start).cast("int"))


def _spans_markers(text: Column) -> Column:
    return F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))


def transformed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """The rows with ``n`` lines, ``form`` (psm, spm or plain), ``prefix_chars``, ``middle_chars`` and the text to train on, ``output``."""
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    inner = "_fim"
    while inner in df.columns:
        inner += "_"
    text = F.coalesce(F.col(text_col), F.lit(""))
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), 256)
    plain = (text == "") | _spans_markers(text) | (F.pmod(_draw(hexed, 3), F.lit(100)) >= rate)
    form = F.when(plain, "plain").when(F.pmod(_draw(hexed, 4), F.lit(100)) < spm_rate, "spm").otherwise("psm")
    data = text.cast("binary")
    cut = df.withColumn(inner, F.struct(form.alias("form"), _cuts(data, _draw(hexed, 1), _draw(hexed, 2)).alias("at")))
    at, is_plain = F.col(inner)["at"], F.col(inner)["form"] == "plain"
    prefix = _piece(data, F.lit(0), at["first_byte"])
    middle = _piece(data, at["first_byte"], at["second_byte"])
    suffix = _piece(data, at["second_byte"], F.octet_length(text).cast("long"))
    mark = lambda m: F.lit(m).cast("binary")
    psm = F.concat(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle)
    spm = F.concat(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle)
    output = F.when(is_plain, data).when(F.col(inner)["form"] == "psm", psm).otherwise(spm).cast("string")
    values = [at["n"], F.col(inner)["form"], *[F.when(~is_plain, at[c]) for c in names[2:4]], output]
    return cut.select(*[c for c in df.columns if c not in names], *[v.alias(c) for c, v in zip(names, values)])


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. No text that is taken apart holds a marker, so each occurs once."""
    pieces = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(pieces, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))


def document_digests(docs: DataFrame) -> DataFrame:
    """Digests of every document's transformed text, and of what is rebuilt from that text alone."""
    rows = transformed(docs.select("doc_id", "text"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
