"""Mixing sources to target weights by iterative proportional fitting (raking).

Token counts are raked to three marginals at once: source, language and topic. A document of a
cell (source, language, topic) gets the weight of its three factors; its ratio is the raked over
the actual share of its cell. There are two samples, both of which meet the targets:

* ``mix_selected`` takes a document once at most. Its probability is ratio times a budget; where the
  largest ratio would lift that above one, the budget is one over that ratio, so no cell is clipped.
* ``mix_copies`` takes a document as often as the whole part of ratio times the budget asked for says, and
  once more with the remainder as probability, so the sample is as large as asked for.

A uniform number from a hash of the id decides, so the samples do not depend on the run.

* The factors of languages and topics are a few numbers on the driver. Sources may be millions:
  theirs stay in Spark, each computed from its own few cells, and a round of fitting is one
  aggregation over the sources that returns languages x topics sums.
* Without given targets a marginal's target is its token share to a power below one, which lifts
  small members (``TEMPERATURES``).
* Null language, source or topic form members of their own, the empty name. Null and empty texts
  have no tokens: their weight is their cell's, and a cell without any tokens has probability 0.
  A null id draws like the text ``null``. Repeated rows share one fate. Very long texts are only counted.
  Extra columns stay; those with the names of the new columns give way to them in ``mixed``, and stay in ``sampled``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

ROUNDS, BUDGET, SEED = 25, 1.0, "mix"
TEMPERATURES = {"source": 0.8, "lang": 0.8, "topic": 0.9}
#: Languages times topics that a round may return.
MAX_PAIRS = 100_000


def token_count(text: Column) -> Column:
    """Words: runs of anything but space and U+0009..U+000D."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.size(words).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A stand-in for a topic label where a table has none: the form of a text."""
    return (
        F.when(text.contains("|"), "table")
        .when(text.contains("!!"), "shout")
        .when(text.rlike("[#$%&*]{3}"), "noise")
        .when(tokens < 100, "note")
        .when(tokens < 1000, "article")
        .otherwise("book")
    )


def draw(id_col: Column, seed: str = SEED) -> Column:
    """A uniform number in [0, 1) from 52 bits of a hash of the id."""
    text = F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":" + seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / float(1 << 52)


def _targets(shares: dict[str, float], power: float, given: dict[str, float] | None) -> dict[str, float]:
    """Targets for the members that hold tokens, summing to one."""
    raw = {k: (given.get(k, 0.0) if given else v**power) for k, v in shares.items() if v > 0}
    total = sum(raw.values())
    return {k: v / total for k, v in raw.items()} if total else {}


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, ratio) from token sums m of the cells: raked over actual share."""
    targets = targets or {}
    cells = cells.filter("m > 0")
    total = cells.agg(F.sum("m")).first()[0]
    if not total:
        return cells.select("source", "lang", "topic", F.lit(0.0).alias("ratio"))
    share = F.col("m") / F.lit(float(total))
    pairs = cells.groupBy("lang", "topic").agg(F.sum("m").alias("m")).limit(MAX_PAIRS + 1).collect()
    if len(pairs) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of language and topic")
    margins = {"lang": {}, "topic": {}}
    for row in pairs:
        for name, margin in margins.items():
            margin[row[name]] = margin.get(row[name], 0.0) + row["m"] / total
    want = {name: _targets(margin, TEMPERATURES[name], targets.get(name)) for name, margin in margins.items()}
    factors = {name: dict.fromkeys(margin, 1.0) for name, margin in want.items()}

    # One row a source with its cells, of which there are at most languages x topics.
    sources = cells.groupBy("source").agg(
        F.sum(share).alias("share"), F.collect_list(F.struct("lang", "topic", share.alias("m"))).alias("cells")
    )
    wanted = _given(F.col("source"), targets["source"]) if targets.get("source") else F.pow("share", F.lit(TEMPERATURES["source"]))
    sources = stored(sources.select("source", "cells", wanted.alias("wanted")), "raking")
    scale = sources.agg(F.sum("wanted")).first()[0] or 1.0

    def own_factor() -> Column:
        b, c = _map(factors["lang"]), _map(factors["topic"])
        held = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + x["m"] * b[x["lang"]] * c[x["topic"]])
        return F.when(held > 0, F.col("wanted") / F.lit(scale) / held).otherwise(0.0)

    for _ in range(rounds):
        exploded = sources.select(own_factor().alias("a"), F.explode("cells").alias("x"))
        sums = exploded.groupBy("x.lang", "x.topic").agg(F.sum(F.col("a") * F.col("x.m")).alias("g")).collect()
        for name, other in (("lang", "topic"), ("topic", "lang")):
            held: dict[str, float] = dict.fromkeys(want[name], 0.0)
            for row in sorted(sums, key=lambda r: (r["lang"], r["topic"])):
                held[row[name]] += row["g"] * factors[other][row[other]]
            factors[name] = {k: want[name][k] / h if h > 0 else 0.0 for k, h in held.items()}
    b, c = _map(factors["lang"]), _map(factors["topic"])
    last = sources.select("source", own_factor().alias("a"), F.explode("cells").alias("x"))
    ratio = F.col("a") * b[F.col("x.lang")] * c[F.col("x.topic")]
    return last.select("source", "x.lang", "x.topic", ratio.alias("ratio"))


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for item in values.items() for x in item])


def _given(member: Column, targets: dict[str, float]) -> Column:
    return F.coalesce(_map(targets)[member], F.lit(0.0))


_ADDED = ["mix_tokens", "mix_topic", "mix_ratio", "mix_probability", "mix_selected", "mix_copies"]


def _weighed(docs: DataFrame, targets: dict[str, dict[str, float]] | None, budget: float, rounds: int, topic: Column | None) -> DataFrame:
    """Each input row whole in ``row``, so that no name of its columns can clash, with the columns of ``_ADDED``."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = [F.coalesce(topic, F.lit("")).alias("topic")] if topic is not None else []
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("string").alias("id"), name("source").alias("source"),
        name("lang").alias("lang"), token_count(F.col("text")).alias("mix_tokens"), *given,
    )
    if topic is None:  # from the count as a column: spelled out here, words would be counted for each mention
        rows = rows.withColumn("topic", topic_of(F.coalesce("row.text", F.lit("")), F.col("mix_tokens")))
    cells = stored(rows.groupBy("source", "lang", "topic").agg(F.sum("mix_tokens").alias("m")), "cells")
    ratios = rake(cells, targets, rounds)
    largest = ratios.agg(F.max("ratio")).first()[0] or 0.0
    chance = min(budget, 1.0 / largest) if largest else budget
    # As many rows as cells; Spark broadcasts them by their measured size or splits a hot cell.
    joined = rows.join(ratios, ["source", "lang", "topic"], "left")
    ratio = F.coalesce("ratio", F.lit(0.0))
    probability = F.round(F.least(F.lit(1.0), ratio * chance), 6)
    often = F.round(ratio * budget, 6)
    again = F.when(draw(F.col("id")) < often - F.floor(often), 1).otherwise(0)
    return joined.select(
        "row", "mix_tokens", F.col("topic").alias("mix_topic"), ratio.alias("mix_ratio"), probability.alias("mix_probability"),
        (draw(F.col("id")) < probability).alias("mix_selected"), (F.floor(often) + again).alias("mix_copies"),
    )


def mixed(
    docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET, rounds: int = ROUNDS,
    topic: Column | None = None,
) -> DataFrame:
    """The rows with ``mix_tokens``, ``mix_topic``, ``mix_ratio``, ``mix_probability``, ``mix_selected`` and ``mix_copies``."""
    own = [c for c in docs.columns if c.lower() not in _ADDED]
    return _weighed(docs, targets, budget, rounds, topic).select(*[F.col("row")[c].alias(c) for c in own], *_ADDED)


def mixture(docs: DataFrame) -> DataFrame:
    """Every document with its tokens, topic, and calibrated probability and outcome of being in the sample."""
    return mixed(docs.select("doc_id", "text", "lang", "source")).select(
        "doc_id",
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_topic").alias("topic"),
        F.col("mix_probability").alias("probability"),
        F.col("mix_selected").alias("selected"),
    )


def sampled(docs: DataFrame) -> DataFrame:
    """The sample by copies, with the columns of the input; a row stands there as often as it was drawn."""
    drawn = _weighed(docs, None, BUDGET, ROUNDS, None).filter("mix_copies > 0")
    copies = drawn.select("row", F.explode(F.sequence(F.lit(1), "mix_copies")))
    return copies.select(*[F.col("row")[c].alias(c) for c in docs.columns])
