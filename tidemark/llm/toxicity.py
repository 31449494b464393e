"""Toxicity: logistic regression trained by FTRL-proximal over hashed word n-grams and skip-grams.

A text's features are its distinct words and word beginnings (four letters, so that inflected
forms share one), word pairs, and pairs with one or two words between them, hashed to ``DIMENSIONS`` coordinates. FTRL-proximal keeps a learning rate per coordinate
and sets a coordinate to exactly zero until its gradients outweigh the L1 penalty, so the
weights that are broadcast are few and never more than ``DIMENSIONS``.

* Training reads labelled rows that are not held out, ``TRAIN_ROWS`` of each label drawn by a hash
  of the id. Coordinates that few of them have, or toxic and other texts alike, stay zero. Shards of them are fitted in parallel tasks and averaged, ``ROUNDS`` times.
* Where the draw takes a larger part of one label than of the other, the bias gives back the log of
  their quotient: a score is the probability at the labels' own ratio, whatever the table's size.
* Labels, language, source and id never enter a score: it depends on the text alone.
* Null and empty texts have the bias as their only feature; without training rows every score is
  0.5 less the smallest step, so nothing is predicted toxic. A label of null is no label; of
  several labels of one id the largest holds. Repeated rows get equal scores; extra columns are
  ignored; very long texts are read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents_of, held_out, slices, stored

DIMENSIONS = 1 << 20
#: Labelled rows of each label that a model is fitted on.
TRAIN_ROWS = 8000
#: A coordinate is learned if this many training texts have it, and if its share of toxic ones
#: differs from the usual share by so many standard deviations.
LEAST_TEXTS, LEAST_DEVIATIONS = 4, 2.0
#: Rows of a shard, passes over each.
SHARD_ROWS, ROUNDS = 2000, 8
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.01
#: Letters of a word's beginning.
STEM = 4
THRESHOLD = 0.5
_WORD = re.compile(r"\w+")
_MEMO = 200_000
#: Odd multipliers, one pair a kind of feature: word, neighbours, one between, two between.
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
     0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64,
)


class Features:
    """Hashed features of texts, with a memo of word hashes."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.shift = np.uint64(64 - (dimensions.bit_length() - 1))
        self.memo: dict[str, tuple[int, int]] = {}

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct coordinates; coordinate 0 is the bias."""
        words = _WORD.findall(text.lower())
        if len(self.memo) > _MEMO:
            self.memo = {}
        memo = self.memo
        for word in words:
            if word not in memo:
                data = word.encode("utf-8", "surrogatepass")
                stem = word[:STEM].encode("utf-8", "surrogatepass") + b"*"
                memo[word] = zlib.crc32(data) << 32 | zlib.adler32(data), zlib.crc32(stem) << 32 | zlib.adler32(stem)
        both = np.array([memo[w] for w in words], dtype=np.uint64).reshape(-1, 2)
        h = both[:, 0]
        kinds = [h * _MIX[0], both[:, 1] * _MIX[0]]
        for gap in (1, 2, 3):
            if len(h) > gap:
                kinds.append(h[:-gap] * _MIX[2 * gap - 1] + (h[gap:] ^ (h[gap:] >> np.uint64(29))) * _MIX[2 * gap])
        mixed = np.concatenate(kinds)
        mixed ^= mixed >> np.uint64(31)
        return np.unique(np.append((mixed * _MIX[0]) >> self.shift, np.uint64(0))).astype(np.int64)


class State:
    """FTRL-proximal accumulators of one model."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z.copy(), n.copy()

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0))))


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_ROWS) -> tuple[DataFrame, int, float]:
    """(doc_id, text, toxic): a bounded draw of labelled rows of either label, none held out; about how many;
    and by how much the draw raises the log odds of the toxic label."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # 0 and 1
    draw = F.pmod(F.xxhash64(F.lit("toxic"), F.col("doc_id")), F.lit(1 << 20)) / float(1 << 20)
    toxic = counts.get(1, 0)
    others = sum(counts.values()) - toxic
    toxic_share, other_share = min(1.0, per_label / max(toxic, 1)), min(1.0, per_label / max(others, 1))
    share = F.when(F.col("toxic") == 1, toxic_share).otherwise(other_share)
    drawn = marked.filter(draw < share)  # about 2 * per_label short rows, whatever the corpus
    size = min(per_label, toxic) + min(per_label, others)
    rows = documents_of(docs).join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic")
    return rows, size, math.log(toxic_share / other_share)


def train(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) that are not zero. Parallel FTRL over shards, averaged after each round."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            coordinates = [features(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(coordinates, pa.list_(pa.int32())), batch.column(2)],
                names=["doc_id", "features", "toxic"],
            )

    spark = docs.sparkSession
    drawn, size, raised = training_rows(docs, labels, per_label)
    shards = max(1, round(size / SHARD_ROWS))
    order = F.xxhash64(F.lit("order"), "doc_id")
    rows = drawn.mapInArrow(hashed, "doc_id long, features array<int>, toxic int").withColumn("order", order)
    sharded = stored(rows.withColumn("shard", F.pmod("order", F.lit(shards))), "toxicity-features")
    rate = sharded.agg(F.avg("toxic")).first()[0] or 0.0
    per_coordinate = sharded.select(F.explode("features").alias("i"), "toxic").groupBy("i").agg(
        F.count("*").alias("texts"), F.sum("toxic").alias("toxic")
    )
    telling = F.abs(F.col("toxic") - F.col("texts") * rate) >= LEAST_DEVIATIONS * F.sqrt(F.col("texts") * rate * (1 - rate))
    informed = per_coordinate.filter((F.col("i") == 0) | (telling & (F.col("texts") >= LEAST_TEXTS)))
    kept_ones = informed.select("i").toArrow()  # <= DIMENSIONS numbers
    learned = np.sort(kept_ones["i"].to_numpy().astype(np.int64))
    if not len(learned):
        return learned, np.empty(0)
    packed = stored(_packed(sharded, learned), "toxicity-shards")
    state = State(np.zeros(len(learned)), np.zeros(len(learned)))
    for _ in range(ROUNDS):
        state = _averaged(spark, packed, state)
    weights = state.weights()
    weights[0] -= raised  # the bias: coordinate 0, which every text has and every model learns
    kept = np.flatnonzero(weights)
    return learned[kept], weights[kept]


def _packed(sharded: DataFrame, learned: np.ndarray) -> DataFrame:
    """One row a shard: places among the learned coordinates of all its texts, in the order of learning."""
    shared = sharded.sparkSession.sparkContext.broadcast(learned)

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        known, places = shared.value, []
        rows = rows.sort_values(["order", "doc_id"])
        for features in rows["features"]:
            coordinates = np.asarray(features, dtype=np.int64)
            at = np.minimum(np.searchsorted(known, coordinates), len(known) - 1)
            places.append(at[known[at] == coordinates].astype(np.int32))
        data = [np.concatenate(places), np.array([len(p) for p in places], dtype=np.int32), rows["toxic"].to_numpy(dtype=np.int32)]
        return pd.DataFrame([[d.tobytes() for d in data]], columns=["places", "lengths", "toxic"])

    # A shard is a bounded part of a bounded draw.
    return sharded.groupBy("shard").applyInPandas(gather, "places binary, lengths binary, toxic binary")


def _averaged(spark: SparkSession, packed: DataFrame, state: State) -> State:
    """One pass of every shard from the common state; accumulators are averaged over the shards."""
    shared = spark.sparkContext.broadcast((state.z, state.n))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                own = State(*shared.value)
                places, lengths, toxic = (np.frombuffer(shard[c], dtype=np.int32) for c in ("places", "lengths", "toxic"))
                for at, label in zip(np.split(places, np.cumsum(lengths)[:-1]), toxic.tolist()):
                    own.learn(at, int(label == 1))
                moved = [(x - y).astype(np.float32).tobytes() for x, y in zip((own.z, own.n), shared.value)]
                yield pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in moved], names=["z", "n"])

    # Of each of the few shards, two numbers a learned coordinate.
    steps = packed.mapInArrow(fit, "z binary, n binary").collect()
    out = State(state.z, state.n)
    for column, values in (("z", out.z), ("n", out.n)):
        moved = sorted(bytes(r[column]) for r in steps)  # the same sum in whatever order tasks end
        values += np.mean([np.frombuffer(m, dtype=np.float32) for m in moved], axis=0, dtype=np.float64)
    shared.unpersist()
    return out


def scorer(spark: SparkSession, model: tuple[np.ndarray, np.ndarray]):
    """The model as a column function: text to a probability."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = np.zeros(DIMENSIONS)
        weights[shared.value[0]] = shared.value[1]
        fitted, features = len(shared.value[0]) > 0, Features()
        for texts in batches:
            yield pd.Series([sigmoid(weights[features(t or "")].sum()) if fitted else float(np.nextafter(0.5, 0)) for t in texts])

    return lambda text: score(text)


def with_score(df: DataFrame, model: tuple[np.ndarray, np.ndarray], text: Column, name: str = "score") -> DataFrame:
    return df.withColumn(name, scorer(df.sparkSession, model)(text))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every whole text scored by a model of the labelled rows that are not held out."""
    scored = with_score(documents_of(docs), train(docs, labels), F.col("text"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
