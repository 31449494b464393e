"""Licence scan: sparse TF-IDF cosine of passages to templates, then inheritance along directories.

Each passage (line or sentence) of a file that has a cue word is compared with the templates'
notices. So are the sentences of its paragraphs, whose lines are joined, and windows of two or three
neighbouring lines, if they have a cue word or a licence's name: notices may be wrapped, and inline
tags like links stand inside of them. A file's own licence is its best passage's template at cosine ``THRESHOLD`` or above.
A licence file, or the index page of a directory, also licenses its directory. A file without
a licence of its own inherits that of the nearest directory above it that has one, found by
joining the directories above each file with the licensed directories.

* Document frequencies are counted over all passages, for the templates' words; any other word
  weighs as much as one that a single passage has.
* The work is in DataFrame functions; only the templates' vocabulary and its frequencies (a few
  hundred numbers) are literals.
* Null text has no passages and may inherit; a null path has no directories. Of equal scores the
  alphabetically first licence wins. Repeated rows get equal results. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

THRESHOLD = 0.75

# Notices by which well-known licences are declared.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Distributed under the terms of the BSD 2-Clause License."),
    ("BSD-3-Clause", "Distributed under the terms of the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, v. 2.0."),
]
CUES = ["license", "licensed", "licence", "licenced", "licenses", "dedicated", "copyright"]
#: Names that, beside the cues, let a window be scored ("mit" is a German word, and never stands alone).
NAMES = ["apache", "bsd", "cc", "cc0", "gnu", "gpl", "lgpl", "mozilla", "mpl"]
#: Lines or sentences that a window joins at most.
WINDOW = 3
_INLINE = (
    "a|abbr|acronym|b|bdi|bdo|big|cite|code|data|dfn|em|font|i|ins|kbd|mark|q|s|samp|small|span|strike|strong|sub|sup|"
    "time|tt|u|var|wbr"
)
_LICENCE_FILE = r"^(licen[sc]e|copying|notice|legal|index|readme)([.-].*)?$"

SPACE = r"[ \t\r\n]+"


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def passages(text: Column) -> Column:
    """Lower-cased lines and sentences."""
    cut = F.regexp_replace(F.lower(text), "([.!?])" + SPACE, "$1\n")
    return F.filter(F.split(cut, "\n+"), lambda p: p != "")


def plain_text(html: Column) -> Column:
    """Markup out: scripts and styles with their content, tags as line breaks."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", "\n")
    return F.regexp_replace(bare, r"<[^>]*>", "\n")


def joined_text(html: Column) -> Column:
    """Markup out: inline tags leave nothing, ``br`` a line break, all others a paragraph's end."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", "\n\n")
    bare = F.regexp_replace(bare, rf"(?i)</?({_INLINE})(\s[^>]*|/)?>", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?i)<br(\s[^>]*|/)?>", "\n"), r"<[^>]*>", "\n\n")


def windows(text: Column) -> Column:
    """Lower-cased sentences over the lines of a paragraph, and neighbouring lines or sentences joined."""
    paragraphs = F.split(text, r"\r?\n[ \t\r]*\n\s*")
    sentences = F.flatten(F.transform(paragraphs, lambda p: passages(F.regexp_replace(p, SPACE, " "))))
    lines = F.filter(passages(text), lambda p: p.rlike("[a-z0-9]"))

    out, widest = [sentences], lines
    for n in range(2, WINDOW + 1):
        # One element each for both sides; a lambda that held the lines would cut the text again for every window.
        widest = F.zip_with(widest, F.slice(lines, n, F.size(lines)), lambda p, following: F.concat_ws(" ", p, following))
        out.append(widest)
    return F.concat(*out)


def passage_words(passage: Column) -> Column:
    return F.regexp_extract_all(passage, F.lit("([a-z0-9]+)"))


def _weights(frequencies: dict[str, int], total: int) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of the templates' words, and of any other."""
    weigh = lambda n: math.log((1 + total) / (1 + n)) + 1.0
    return {w: weigh(frequencies.get(w, 0)) for t in TEMPLATES for w in words_of(t[1])}, weigh(1)


def _worded_passages(files: DataFrame) -> DataFrame:
    """(file_id, at, words) of every passage that has a word."""
    cut = files.select("file_id", F.posexplode(passages(F.coalesce("text", F.lit("")))).alias("at", "passage"))
    return cut.select("file_id", "at", passage_words(F.col("passage")).alias("words")).filter(F.size("words") > 0)


def _may_be_cued(source: Column) -> Column:
    """Whether the letters of a cue word stand anywhere; few files have them, and only those are cut for cues."""
    shortest = [c for c in CUES if not any(o != c and o in c for o in CUES)]
    return reduce(Column.__or__, [F.contains(F.lower(source), F.lit(c)) for c in shortest])


def own_licences(files: DataFrame, joined: str = "text", source: str = "text") -> DataFrame:
    """(file_id, path, licence, score): the best template of each file's passages, null below the threshold.

    Windows are taken from the column ``joined``. The column ``source`` holds every word of ``text``
    unbroken, as the page does from which the text was taken.
    """
    words = _worded_passages(files)
    vocabulary = sorted({w for _, t in TEMPLATES for w in words_of(t)})
    known = F.array(*map(F.lit, vocabulary))
    # One pass over all passages: their number, and in how many each template word occurs.
    marked = F.concat(F.array(F.lit("")), F.array_intersect(F.array_distinct("words"), known))
    counted = words.select(F.explode(marked).alias("word")).groupBy("word").count().collect()
    frequencies = {r["word"]: r["count"] for r in counted}
    idf, other = _weights(frequencies, frequencies.pop("", 0))

    cued = _worded_passages(files.filter(_may_be_cued(F.col(source)))).filter(F.arrays_overlap("words", F.array(*map(F.lit, CUES))))
    told = CUES + NAMES
    hinted = files.filter(F.col(joined).rlike(rf"(?i)(?<![a-z0-9])({'|'.join(told)})(?![a-z0-9])"))
    wide = hinted.select("file_id", F.posexplode(windows(F.col(joined))).alias("at", "passage"))
    wide = wide.select("file_id", (-1 - F.col("at")).alias("at"), passage_words(F.col("passage")).alias("words"))
    cued = cued.unionByName(wide.filter(F.arrays_overlap("words", F.array(*map(F.lit, told)))))
    counts = cued.select("file_id", "at", F.explode("words").alias("word")).groupBy("file_id", "at", "word").count()
    weights = F.create_map(*[F.lit(x) for item in sorted(idf.items()) for x in item])
    weighed = counts.withColumn("v", F.col("count") * F.coalesce(weights[F.col("word")], F.lit(other)))
    dots = []
    for licence, text in TEMPLATES:
        vector = {w: n * idf[w] for w, n in Counter(words_of(text)).items()}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        entry = F.create_map(*[F.lit(x) for item in sorted(vector.items()) for x in (item[0], item[1] / norm)])
        dots.append(F.sum(F.col("v") * F.coalesce(entry[F.col("word")], F.lit(0.0))).alias(licence))
    scored = weighed.groupBy("file_id", "at").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), *dots)
    cosines = F.array(*[F.struct(F.round(F.col(f"`{n}`") / F.col("norm"), 6).alias("score"), F.lit(n).alias("licence")) for n, _ in TEMPLATES])
    best = scored.select("file_id", F.explode(cosines).alias("c")).filter(F.col("c.score") >= THRESHOLD)
    # Highest score, then first name.
    chosen = best.groupBy("file_id").agg(F.min(F.struct((-F.col("c.score")).alias("s"), F.col("c.licence").alias("licence"))).alias("b"))
    found = chosen.select("file_id", F.col("b.licence").alias("own_licence"), (-F.col("b.s")).alias("own_score"))
    keyed = files.select("file_id", "path").distinct()
    return keyed.join(found, "file_id", "left")


def directories(path: Column) -> Column:
    """All directories above a path, the nearest last: ``a/b/c`` has ``a`` and ``a/b``."""
    parts = F.split(path, "/")
    ends = F.sequence(F.lit(1), F.size(parts) - 1)
    return F.when(F.size(parts) > 1, F.transform(ends, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))


def url_path(url: Column) -> Column:
    """Host and path of a URL without query and fragment; a trailing slash leaves an empty last part."""
    bare = F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    return F.regexp_replace(bare, r"[?#].*$", "")


def scan(files: DataFrame, joined: str = "text", source: str = "text") -> DataFrame:
    """(file_id, own_licence, own_score, licence, origin, directory) of every file (file_id, path, text)."""
    own = stored(own_licences(files, joined, source), "own-licences")
    above = directories(F.col("path"))
    name = F.element_at(F.split("path", "/"), -1)
    # Index pages (nothing after the last slash) and licence files speak for their directory.
    speaks = F.col("own_licence").isNotNull() & ((name == "") | F.lower(name).rlike(_LICENCE_FILE))
    speakers = own.filter(speaks).select(F.element_at(above, -1).alias("directory"), "own_licence", "own_score")
    licensed = speakers.filter("directory IS NOT NULL").groupBy("directory").agg(
        F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own_licence").alias("licence"))).alias("b")
    )
    bare = own.filter(F.col("own_licence").isNull()).select("file_id", F.explode(above).alias("directory"))
    nearest = (
        bare.join(licensed, "directory")
        .groupBy("file_id")
        .agg(F.max_by(F.struct("directory", "b.licence"), F.length("directory")).alias("n"))
    )
    out = own.join(nearest, "file_id", "left")
    return out.select(
        "file_id",
        "own_licence",
        "own_score",
        F.coalesce("own_licence", "n.licence").alias("licence"),
        F.when(F.col("own_licence").isNotNull(), "own").when(F.col("n").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.col("n.directory").alias("directory"),
    )


def scan_pages(pages: DataFrame) -> DataFrame:
    """Pages as files: the path is the URL's host and path, the text the page without markup."""
    files = pages.select(
        F.col("page_id").alias("file_id"),
        url_path(F.col("url")).alias("path"),
        plain_text(F.col("html")).alias("text"),
        joined_text(F.col("html")).alias("joined"),
        "html",
    )
    return scan(files, "joined", "html").withColumnRenamed("file_id", "page_id")
