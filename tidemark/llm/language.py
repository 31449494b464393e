"""Language identification: known words first, then ever shorter character n-grams.

A text's words vote with the log frequencies they have in each language. A word the model has
never kept is spelled out: its longest known n-grams stand in for it, at every position the
longest first, and a letter that no language knows votes for none.

* Training reads text and language of rows that are not held out, ``TRAIN_ROWS`` of each language
  drawn by a hash of the id. Spark counts words and n-grams; the most frequent ``MAX_WORDS`` and
  ``MAX_GRAMS`` of each order stay, so the model that is broadcast has a bound.
* A word is a run of letters, lower-cased. Text without letters, empty or null: ``und``, score 0.
* Ties between languages go to the first in alphabetical order. Repeated rows get equal results.
  Without any training row every text is ``und``. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents_of, held_out, slices, stored

SCHEMA = "doc_id long, lang_pred string, score double"
#: Bounds of the model: words, n-grams of each order, and the languages for which it keeps all of them.
MAX_WORDS, MAX_GRAMS, MAX_LANGUAGES = 100_000, 30_000, 200
#: Documents of each language that a model is fitted on.
TRAIN_ROWS = 4000
ORDERS = (4, 3, 2, 1)
UNKNOWN = "und"
#: A backed-off word counts less than a known one.
BACKOFF = 0.4
_WORD = re.compile(r"[^\W\d_]+")
#: Memoised word scores in a task before the memo starts anew.
_MEMO = 200_000


def runs_of(text: str) -> list[str]:
    """Runs of letters, lower-cased, in which fractions, raised digits and the like may stand too."""
    return _WORD.findall(text.lower())


def words_in(run: str) -> list[str]:
    """The runs of letters alone."""
    return [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()


class Model:
    """Per-language log frequencies: ``tables[0]`` of words, ``tables[n]`` of n-grams."""

    def __init__(self, languages: list[str], tables: dict[int, dict[str, np.ndarray]]):
        self.languages, self.tables = languages, tables

    def word(self, word: str) -> np.ndarray:
        known = self.tables[0].get(word)
        return known if known is not None else BACKOFF * self.spelled(word)

    def spelled(self, word: str) -> np.ndarray:
        """Longest known n-grams from left to right, the word's ends marked, averaged to one vote."""
        marked, at, total, votes = f"<{word}>", 0, np.zeros(len(self.languages)), 0
        while at < len(marked):
            for n in ORDERS:
                found = self.tables[n].get(marked[at : at + n]) if at + n <= len(marked) else None
                if found is not None:
                    total, votes = total + found, votes + 1
                    break
            at += max(1, n - 1) if found is not None else 1
        return total / max(votes, 1)


def _tallied(trained: DataFrame) -> DataFrame:
    """(size, item, lang, n): words as size 0, and the n-grams of each word with its ends marked."""

    def rows(seen: dict[tuple[int, str, str], int]) -> pa.RecordBatch:
        sizes, items, langs = zip(*seen) if seen else ((), (), ())
        columns = [pa.array(sizes, pa.int32()), pa.array(items, pa.string()), pa.array(langs, pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(seen.values(), pa.int64())], names=["size", "item", "lang", "n"])

    def spelled(seen: dict[tuple[int, str, str], int]) -> dict[tuple[int, str, str], int]:
        out: dict[tuple[int, str, str], int] = {}
        for (_, run, lang), n in seen.items():
            for word in words_in(run):
                out[0, word, lang] = out.get((0, word, lang), 0) + n
        for (_, word, lang), n in list(out.items()):
            marked = f"<{word}>"
            for size in ORDERS:
                for at in range(len(marked) - size + 1):
                    key = size, marked[at : at + size], lang
                    out[key] = out.get(key, 0) + n
        return out

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, str, str], int] = {}
        for batch in slices(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in runs_of(text):
                    seen[0, word, lang] = seen.get((0, word, lang), 0) + 1
            if len(seen) > _MEMO:
                yield rows(spelled(seen))
                seen = {}
        yield rows(spelled(seen))

    return trained.mapInArrow(tally, "size int, item string, lang string, n long")


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most about ``per_language`` rows of each language, chosen by a hash of the id, none held out."""
    rows = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().limit(MAX_LANGUAGES + 1).collect()}
    rows = rows.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
        (F.pmod(F.xxhash64(F.lit("train"), F.col(id_col)), F.lit(1 << 20)) / float(1 << 20)).alias("draw"),
    )
    if not counts:
        return rows.select("text", "lang")
    if len(counts) > MAX_LANGUAGES:  # too many for the plan: the shares come by a join
        shares = rows.groupBy("lang").agg(F.least(F.lit(1.0), per_language / F.count("*")).alias("share"))
        return rows.join(shares, "lang").filter("draw < share").select("text", "lang")
    share = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, min(1.0, per_language / n))])
    return rows.filter(F.col("draw") < share[F.col("lang")]).select("text", "lang")


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_ROWS
) -> Model:
    """Word and n-gram counts of the training rows; what is broadcast later is bounded by the three limits.

    Beyond ``MAX_LANGUAGES`` languages fewer words and n-grams are kept, so that the model stays as large.
    """
    tallied = _tallied(training_rows(docs, id_col, text_col, lang_col, per_language))
    summed = tallied.groupBy("size", "item", "lang").agg(F.sum("n").alias("n"))
    by_lang = F.map_from_entries(F.collect_list(F.struct("lang", "n")))  # one entry a language
    items = stored(summed.groupBy("size", "item").agg(F.sum("n").alias("total"), by_lang.alias("by_lang")), "language-counts")
    n_languages = items.filter("size = 1").select(F.explode(F.map_keys("by_lang"))).distinct().count()
    kept_share = min(1.0, MAX_LANGUAGES / max(n_languages, 1))
    kept = {
        size: items.filter(F.col("size") == size).orderBy(F.desc("total"), "item").limit(math.ceil(most * kept_share)).select("item", "by_lang").collect()
        for size, most in {0: MAX_WORDS, **dict.fromkeys(ORDERS, MAX_GRAMS)}.items()
    }
    languages = sorted({g for row in kept[1] for g in row["by_lang"]})
    return Model(languages, {size: _logs(rows, languages) for size, rows in kept.items()})


def _logs(rows: list, languages: list[str]) -> dict[str, np.ndarray]:
    """Log of each item's smoothed frequency in each language, less its mean over the languages."""
    counts = np.array([[r["by_lang"].get(g, 0) for g in languages] for r in rows], dtype=np.float64)
    if not counts.size:
        return {}
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(rows)))
    logs -= logs.mean(axis=1, keepdims=True)
    return {r[0]: logs[i].astype(np.float32) for i, r in enumerate(rows)}


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Most likely language of every whole text, with its posterior under equal priors."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, memo = shared.value, {}
        silent = np.zeros(len(fitted.languages))
        for batch in slices(batches):
            langs, scores = [], []
            for text in batch.column(1).to_pylist():
                words = runs_of(text)
                if not any(map(str.isalpha, words)):
                    words = [w for run in words for w in words_in(run)]
                if not words or not fitted.languages:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                for word in words:
                    if word not in memo:
                        memo[word] = sum(map(fitted.word, words_in(word)), silent)
                votes = np.array([memo[w] for w in words], dtype=np.float64).sum(axis=0)
                best = int(votes.argmax())
                langs.append(fitted.languages[best])
                scores.append(1.0 / sum(math.exp(max(v - votes[best], -700.0)) for v in votes))
                if len(memo) > _MEMO:
                    memo = {}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return documents_of(df, id_col, text_col).mapInArrow(predict, SCHEMA)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Trained on the rows that are not held out, applied to all."""
    predicted = identify(docs, train(docs))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
