"""Document fingerprints: threshold-scaled sketches, in DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range. The fraction does
not depend on the document, so sketches of any two documents, or of unions of documents, are
comparable: the shared part of two sketches estimates containment even where one text is a
thousand times longer. Sketches of parts merge by set union.

* Words are runs of anything but space and U+0009..U+000D, lower-cased; a shingle is five
  consecutive words; a text of one to four words is one shingle.
* A text whose shingles all lie above the threshold keeps its smallest hash, so that only a
  text without words has an empty sketch. That hash is a stand-in, no part of anybody else's sketch:
  it is looked up among all shingles of the other text, and merging drops it once a hash below the
  threshold is there.
* Null text counts as empty. Two empty sketches have likeness 1, an empty and a filled one 0.
* Repeated rows and equal texts give equal fingerprints; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import documents_of, shuffle_partitions

WORDS = 5
#: One hash in SCALE is kept.
SCALE = 4
#: Ranges of ids dealt out at once: a bound on the driver's list of range starts.
MAX_RANGES = 4096
_LEAST = -(1 << 63)


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all shingles (signed 64 bit), in the order of the text; empty without words."""
    tokens = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def shingles(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(h) - words, F.lit(0)))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]))

    return _bound(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) > 0, shingles(h)).otherwise(_none()))


def sketch(text: Column, words: int = WORDS, scale: int = SCALE) -> Column:
    """Sorted distinct shingle hashes in the lowest 1/scale of the range, or the smallest hash alone."""
    return F.coalesce(_bound(shingle_hashes(text, words), lambda h: _kept(h, scale)), _none())


def _kept(hashes: Column, scale: int) -> Column:
    low = F.filter(hashes, lambda h: h < _threshold(scale))
    least = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(_none())
    return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).otherwise(least)


def _threshold(scale: int) -> Column:
    return F.lit(_LEAST + (1 << 64) // scale)


def _none() -> Column:
    return F.array().cast("array<bigint>")


def stands_in(hashes: Column, scale: int = SCALE) -> Column:
    """Whether a sketch is but the smallest hash of a text that has none below the threshold."""
    return F.coalesce(F.get(hashes, 0) >= _threshold(scale), F.lit(False))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a lambda's parameter is a variable, a column is not."""
    return F.transform(F.array(value), use)[0]


def merged(left: Column, right: Column, scale: int = SCALE) -> Column:
    """The sketch of both texts' shingles together."""
    return _bound(F.array_union(left, right), lambda h: _kept(h, scale))


def fingerprint(hashes: Column) -> Column:
    """A sketch as text: sixteen hexadecimal digits a hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def containment(part: Column, whole: Column, whole_text: Column, words: int = WORDS, scale: int = SCALE) -> Column:
    """Estimated share of the shingles of ``part`` that ``whole`` has too; its text is read if ``part`` is a stand-in."""
    shared = F.size(F.array_intersect(part, whole)).cast("double")
    there = F.array_contains(shingle_hashes(whole_text, words), F.get(part, 0)).cast("double")
    return (
        F.when((F.size(part) == 0) & (F.size(whole) == 0), F.lit(1.0))
        .when((F.size(part) == 0) | (F.size(whole) == 0), F.lit(0.0))
        .when(stands_in(part, scale), there)
        .otherwise(shared / F.size(part))
    )


def likeness(left: Column, right: Column, left_text: Column, right_text: Column) -> Column:
    """Containment of the smaller sketch in the larger; a stand-in counts as smaller, and two of them are looked up both ways."""
    forth, back = containment(left, right, right_text), containment(right, left, left_text)
    one, other = stands_in(left), stands_in(right)
    return (
        F.when(one & other, F.greatest(forth, back))
        .when(one | (~other & (F.size(left) <= F.size(right))), forth)
        .otherwise(back)
    )


def _range_of(key: Column, starts: list[int]) -> Column:
    """Number of range starts at or below the key, by binary search in a literal array."""
    if not starts:
        return F.lit(0)
    bounds = F.array(*[F.lit(s).cast("long") for s in starts])
    steps = [1 << b for b in range(len(starts).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(starts)) & (F.get(bounds, low + step - 1) <= key), low + step
        ).otherwise(low),
    )


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Each row with ``next_<c>`` of the row that follows in ascending doc_id; the first follows the last.

    Ids are cut into ranges at their quantiles, so each range is sorted by itself; a copy of the
    row that begins the following range closes each range. Null ids come first; rows of one id
    are in order of the carried columns.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(_LEAST).cast("long"))
    count = min(MAX_RANGES, 8 * shuffle_partitions(spark))
    quantiles = docs.select("doc_id").stat.approxQuantile("doc_id", [i / count for i in range(1, count)], 0.1 / count)
    starts = sorted({int(q) for q in quantiles})
    keyed = docs.select(key.alias("_key"), *docs.columns).withColumn("_range", _range_of(F.col("_key"), starts))
    firsts = [tuple(r) for r in keyed.groupBy("_range").agg(F.min("_key")).orderBy("_range").collect()]  # <= MAX_RANGES
    if not firsts:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    closing = [(before, first, before == firsts[-1][0]) for (before, _), (_, first) in zip(firsts, firsts[1:] + firsts[:1])]
    closers = spark.createDataFrame(closing, "_range int, _key long, _wraps boolean")
    rows = keyed.withColumns({"_wraps": F.lit(False), "_closer": F.lit(False)})
    copies = keyed.drop("_range").join(F.broadcast(closers), "_key").withColumn("_closer", F.lit(True))
    order = Window.partitionBy("_range").orderBy("_wraps", "_closer", "_key", *carried)
    ordered = rows.unionByName(copies).withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
    return ordered.filter(~F.col("_closer")).drop("_key", "_range", "_wraps", "_closer")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text and of the text whose second half the next document's beginning replaces."""
    docs = documents_of(df, id_col, text_col).withColumn("sketch", sketch(F.col("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    paired = with_next(docs, ["text", "sketch"]).withColumn("edited", edited)
    sketched = paired.withColumn("edited_sketch", sketch(F.col("edited")))
    return sketched.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), F.col("text"), F.col("edited")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), F.col("text"), F.col("next_text")).alias("near_next"),
    )
