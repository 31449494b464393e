"""Secret scan over the versions of files, with an incremental ledger of blobs.

Every version is addressed by the SHA-256 of its text. The ledger says which rule, in which of its
versions, has read which blob and what it found there. A scan then

1. addresses all given versions beside the scan of the table, and reduces them to distinct blobs;
2. takes away the pairs of blob and rule version that the ledger knows. Of what is left, one
   version stands for each blob: its text moves to the task that scans it, copies do not;
3. runs the missing rules over those texts, whole, and commits the findings under a label. A
   commit counts from the moment its mark is stored; one that failed is written anew, and one
   that is complete is left alone, so a repeated scan stores nothing twice;
4. joins the findings back to every path that has the blob. Only blobs with a finding take part,
   as short rows; a blob that a third of all paths share is a skewed side of that join, which adaptive
   execution splits (measured in the skewed run of the check tool).

A new rule, or a new version of one, is read over the blobs of the versions given, all other rules'
findings are taken from the ledger.

A null text is the empty blob. A null path is a path. Repeated rows are answered each, and scanned
once a blob. An empty table commits nothing found and answers nothing. Extra columns are ignored.
Texts of any length are scanned whole; every rule reads in linear time, as what it repeats without
bound is one class of characters, and all else has a limit.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, stored
from tidemark.session import new_shared_path


@dataclass(frozen=True)
class Rule:
    """A pattern of code points; a match counts if ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def finder(self):
        flags = re.ASCII | (re.IGNORECASE if self.any_case else 0)
        find = re.compile(self.pattern, flags).finditer
        least, group = self.least, self.group

        def spans(text: str) -> list[tuple[int, int]]:
            return [m.span() for m in find(text) if m.end(group) - m.start(group) >= least]

        return spans


#: The first three are the fixed base; a match that fails its length is dropped without a second try.
#: Of AKIA and of hex runs the shorter ones, which fail, cannot hide a longer one, so the pattern itself asks for the length.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("key_block", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,900}\.eyJ[A-Za-z0-9_-]{8,900}\.[A-Za-z0-9_-]{16,900}"),
    Rule("hosted_token", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("url_login", r"(https?|ftp|ssh|git|amqp|redis|mysql|mongodb|postgresql)://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,128}@"),
)
RULES = (*BASE, *ADDED)

_FINDINGS = "blob string, rules array<string>, spans array<struct<rule:string,start:long,end:long>>"
_SPAN = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.schema([("blob", pa.string()), ("rules", pa.list_(pa.string())), ("spans", _SPAN)])


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class Ledger:
    """What has been scanned: findings by commit below ``root``, and a mark for each complete commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> list[str]:
        """Folders of the complete commits, in no order; one short row a scan."""
        try:
            marks = self.spark.read.schema("folder string").json(f"{self.root}/marks/*")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({r["folder"] for r in marks.collect()})

    def findings(self) -> DataFrame:
        """(blob, rules, spans): a row for each blob in each complete commit that read it."""
        paths = [f"{self.root}/findings/{folder}" for folder in self.commits()]
        if not paths:
            return self.spark.createDataFrame([], _FINDINGS)
        return self.spark.read.schema(_FINDINGS).parquet(*paths)

    def commit(self, label: str, found: DataFrame) -> None:
        folder = quote(label, safe="")
        if folder in self.commits():
            return
        found.write.mode("overwrite").parquet(f"{self.root}/findings/{folder}")
        mark = self.spark.createDataFrame([(folder,)], "folder string")
        mark.coalesce(1).write.mode("overwrite").json(f"{self.root}/marks/{folder}")


def _run_rules(rules: tuple[Rule, ...]):
    """Of (blob, text, rules to run): the findings."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = {r.key: r.finder() for r in rules}
        for batch in slices(batches):
            blobs, texts, todo = (batch.column(i).to_pylist() for i in range(3))
            spans = [
                [{"rule": key, "start": a, "end": b} for key in keys for a, b in finders[key](text)]
                for text, keys in zip(texts, todo)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.string()), pa.array(todo, pa.list_(pa.string())), pa.array(spans, _SPAN)], schema=_FOUND)

    return scan


def unseen(addressed: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, path, rules): each blob that some rule version has not read yet, those rules, and a path that has it."""
    wanted = F.array(*[F.lit(r.key) for r in rules])
    known = ledger.findings().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known"))
    blobs = addressed.groupBy("blob").agg(F.min("path").alias("path")).join(known, "blob", "left")
    missing = F.coalesce(F.array_except(wanted, "known"), wanted)
    return blobs.select("blob", "path", missing.alias("rules")).filter(F.size("rules") > 0)


def scan(
    versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, label: str | None = None, path_col: str = "path", text_col: str = "text"
) -> DataFrame:
    """(path, blob, spans) of every version; ``spans`` are (start, order, kind, end) by start, then rule.

    Blobs and rule versions that ``ledger`` does not know are scanned first and committed under ``label``.
    """
    own = versions.select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    addressed = stored(own.select("path", blob_of(F.col("text")).alias("blob")), "blobs")
    todo = unseen(addressed, ledger, rules).select(F.col("blob").alias("b"), F.col("path").alias("p"), "rules")
    texts = own.select("path", blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = texts.join(todo, (texts["blob"] == F.col("b")) & texts["path"].eqNullSafe(F.col("p")))
    found = chosen.select("blob", "text", "rules").mapInArrow(_run_rules(rules), _FINDINGS)
    # A path may hold the same text in several rows.
    ledger.commit(label or uuid.uuid4().hex, found.dropDuplicates(["blob"]))
    return addressed.join(findings_of(ledger, rules), "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(_ORDERED)).alias("spans")
    )


_ORDERED = "array<struct<start:long,order:int,kind:string,end:long>>"


def findings_of(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the blobs in which a rule, in its present version, found something."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def shaped(s: Column) -> Column:
        order = F.array_position(keys, s["rule"]).cast("int")
        return F.struct(s["start"].alias("start"), order.alias("order"), F.element_at(kinds, order).alias("kind"), s["end"].alias("end"))

    present = F.filter("spans", lambda s: F.array_contains(keys, s["rule"]))
    rows = ledger.findings().select("blob", present.alias("spans")).filter(F.size("spans") > 0)
    rows = rows.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))  # a commit a rule version at most
    return rows.select("blob", F.array_sort(F.transform("spans", shaped)).cast(_ORDERED).alias("spans"))


def of_kinds(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first stays."""

    def step(state: Column, s: Column) -> Column:
        kept = F.concat(state["text"], F.substring(text, state["at"] + 1, (s["start"] - state["at"]).cast("int")), F.lit("<"), s["kind"], F.lit(">"))
        return F.when(s["start"] < state["at"], state).otherwise(F.struct(kept.alias("text"), s["end"].cast("int").alias("at")))

    end = F.aggregate(spans, F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), step)
    return F.concat(end["text"], F.substring(text, end["at"] + 1, F.length(text)))


def document_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every document; its row is a version of the path ``doc_id``, in a ledger of its own."""
    spark = docs.sparkSession
    ledger = Ledger(spark, new_shared_path(spark, "secret-ledger"))
    rows = scan(docs, ledger, path_col="doc_id")
    base = [r.kind for r in BASE]
    counts = [F.size(of_kinds("spans", kind)).cast("long").alias(f"n_{kind}") for kind in base]
    digest = F.sha2(span_text(of_kinds("spans", *base)), 256).alias("base_sha256")
    return rows.select(F.col("path").alias("doc_id"), *counts, digest, span_text(F.col("spans")).alias("spans"))
