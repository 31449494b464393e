"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers in their usual
spelling. The random field scores whole candidate segments of the stretches of text that hold
digits, an @ sign or a spelled-out @: shape, number of digits, checksums, neighbours. A dynamic
program over segmentations, whose entities are at most ``MAX_UNITS`` units long, chooses borders
and kinds together. A chosen segment becomes a span if its posterior is at least ``POSTERIOR``
and no pattern span touches it. Pattern spans always stay.

The field is trained here: on the patterns' own finds in ``TRAIN_ROWS`` documents, as they are
and re-spelled (without a plus sign, with dots, with the @ and the dot written out), against
everything else in those stretches.

* Offsets are code points, ends exclusive. Null text counts as empty and has no spans.
* Repeated rows get equal results; extra columns are ignored; texts are read whole, and work
  grows with their length: stretches are cut into windows only between entities' reach.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents_of, slices

KINDS = ("email", "ip", "card", "phone")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
#: Documents whose stretches the field is fitted on, at most about; and stretches of them.
TRAIN_ROWS, TRAIN_STRETCHES = 4000, 3000
EPOCHS, RATE, L2 = 4, 0.2, 1e-4
MAX_UNITS, WINDOW = 16, 200
POSTERIOR = 0.9

# Fixed patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot begin inside a run of digits whose start failed: the look-behind saves the retries.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_MARKS = re.compile(r"[0-9@]+")
_SPACE = re.compile(r"\s")
_SPELLED = re.compile(r"[(\[]at[)\]]| at (?=\S{1,64} dot \S)")
_DOMAIN_WORDS = re.compile(r"\s?\S{1,64}(?: dot \S{1,64})*")
_UNIT = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        d = int(digit)
        total += d if place % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Pattern spans: by kind in the order of ``KINDS``, then by start."""
    spans = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37 and 13 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def _chunk_start(text: str, at: int, least: int) -> int:
    """Where the run of visible characters that holds ``at`` begins, not before ``least``."""
    while at > least and not text[at - 1].isspace():
        at -= 1
    return at


def _chunks(text: str) -> Iterator[tuple[int, int]]:
    """Parts where an entity may lie, one pass over the text: chunks with marks, and spelled-out addresses."""
    end = 0
    for m in _MARKS.finditer(text):
        if m.start() >= end:
            start = _chunk_start(text, m.start(), max(end, m.start() - WINDOW))
            space = _SPACE.search(text, m.end())
            end = space.start() if space else len(text)
            yield start, end
    for m in _SPELLED.finditer(text):
        words = _DOMAIN_WORDS.match(text, m.end())
        yield _chunk_start(text, m.start(), max(0, m.start() - 64)), words.end() if words else m.end()


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Chunks with one white space at most between them, and a little of what stands around."""
    joined: list[list[int]] = []
    for start, end in sorted(_chunks(text)):
        if joined and start <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    for start, end in joined:
        # A long stretch is read in windows that overlap by more than the longest entity.
        for at in range(start, end, WINDOW // 2):
            yield max(at - 12, 0), min(at + WINDOW, end + 12)
            if at + WINDOW >= end:
                break


def units_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _UNIT.finditer(text)]


def shape(text: str) -> str:
    """Runs of digits as their length, runs of letters as ``a``, spaces as ``_``, other signs as they are."""
    out = []
    for m in _UNIT.finditer(text):
        u = m.group()
        out.append(str(min(len(u), 9)) if u[0] in "0123456789" else "a" if u[0].isalpha() else "_" if u.isspace() else u)
    return "".join(out)


def segment_features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole candidate segment; a field has one weight for each of them and kind."""
    body = text[start:end]
    digits = _digits(body)
    n = len(digits)
    signs = "".join(sorted(set(c for c in body if not c.isalnum())))
    groups = re.findall("[0-9]+", body)
    before, after = text[start - 1 : start], text[end : end + 1]
    octets = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    lower = body.lower()
    return [
        "bias",
        "shape=" + re.sub("[0-9]", "9", shape(body))[:40],
        "sizes=" + shape(body)[:40],
        f"digits={n}",
        "signs=" + signs[:8],
        f"octets={octets and n == sum(map(len, groups))}",
        f"luhn={13 <= n <= 19 and luhn(digits)}",
        f"at={'@' in body or ' at ' in lower or '(at)' in lower or '[at]' in lower}",
        f"letters={any(c.isalpha() for c in body)}",
        "before=" + (before if before and not before.isalnum() else "a" if before.isalpha() else "9" if before else "^"),
        "after=" + (after if after and not after.isalnum() else "a" if after.isalpha() else "9" if after else "$"),
        f"groups={min(len(groups), 6)}",
    ]


class Field:
    """Semi-Markov conditional random field: linear scores of whole segments, kinds independent of neighbours."""

    def __init__(self, weights: dict[tuple[str, str], float]):
        self.weights = weights

    def lattice(self, text: str, units: list[tuple[int, int]]) -> list[list[tuple[int, str, list[str], float]]]:
        """Segments that end after each unit: (first unit, kind, features, score). Kind ``O`` has length one, score 0."""
        out: list[list[tuple[int, str, list[str], float]]] = []
        for last, (_, end) in enumerate(units):
            ending = [(last, "O", [], 0.0)]
            if text[end - 1].isalnum():
                for first in range(max(0, last - MAX_UNITS + 1), last + 1):
                    start = units[first][0]
                    opens = text[start].isalnum() or text[start] in "+("
                    if not opens or not re.search(r"[0-9@]|\bat\b", text[start:end]):
                        continue
                    features = segment_features(text, start, end)
                    for kind in KINDS:
                        score = sum(self.weights.get((kind, f), 0.0) for f in features)
                        ending.append((first, kind, features, score))
            out.append(ending)
        return out

    @staticmethod
    def marginals(lattice: list) -> tuple[list[float], list[float]]:
        """Log sums of all segmentations before each border, and after it."""
        n = len(lattice)
        forward, backward = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
        for last, ending in enumerate(lattice):
            forward[last + 1] = _log_sum([forward[first] + score for first, _, _, score in ending])
        for last in range(n - 1, -1, -1):
            for first, _, _, score in lattice[last]:
                backward[first] = _log_sum([backward[first], backward[last + 1] + score])
        return forward, backward

    def learn(self, text: str, gold: list[Span], rate: float) -> None:
        """A gradient step on the log likelihood of the segmentation that has exactly the gold spans."""
        units = units_of(text)
        lattice = self.lattice(text, units)
        forward, backward = self.marginals(lattice)
        wanted = set(gold)
        for last, ending in enumerate(lattice):
            for first, kind, features, score in ending:
                if kind == "O":
                    continue
                expected = math.exp(min(0.0, forward[first] + score + backward[last + 1] - forward[-1]))
                step = rate * (((kind, units[first][0], units[last][1]) in wanted) - expected)
                if abs(step) > 1e-4 * rate:
                    for f in features:
                        key = kind, f
                        self.weights[key] = self.weights.get(key, 0.0) * (1 - rate * L2) + step

    def decode(self, text: str) -> list[tuple[str, int, int, float]]:
        """The best segmentation's entities with their posteriors."""
        units = units_of(text)
        lattice = self.lattice(text, units)
        best, back = [0.0] + [-math.inf] * len(units), [None] * (len(units) + 1)
        for last, ending in enumerate(lattice):
            for segment in ending:
                if best[segment[0]] + segment[3] > best[last + 1]:
                    best[last + 1], back[last + 1] = best[segment[0]] + segment[3], segment
        forward, backward = self.marginals(lattice)
        found, at = [], len(units)
        while at:
            first, kind, _, score = back[at]
            if kind != "O":
                posterior = math.exp(min(0.0, forward[first] + score + backward[at] - forward[-1]))
                found.append((kind, units[first][0], units[at - 1][1], posterior))
            at = first
        return found[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def respelled(kind: str, body: str) -> list[str]:
    """Other spellings of a pattern's find, for training."""
    if kind == "phone":
        return [body.lstrip("+"), "00" + body.lstrip("+")]
    if kind == "card":
        digits = _digits(body)
        return [".".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    if kind == "ip":
        return [body.replace(".", "[.]"), body.replace(".", " . ")]
    local, domain = body.split("@", 1)
    return [f"{local}{at}{domain}" for at in (" @ ", "(at)", "[at]", " at ")] + [f"{local} at {domain.replace('.', ' dot ')}"]


def training_stretches(docs: DataFrame, id_col: str, text_col: str) -> list[tuple[str, list[Span]]]:
    """Bounded: (stretch, its gold spans) from a draw of documents by a hash of the id."""
    rows = documents_of(docs, id_col, text_col)
    share = min(1.0, TRAIN_ROWS / max(rows.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            parts = []
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                for a, b in stretches(text):
                    inside = [{"kind": k, "start": s - a, "end": e - a} for k, s, e in base if a <= s and e <= b]
                    parts.append({"body": text[a:b], "gold": inside, "positive": bool(inside)})
            yield pa.RecordBatch.from_pylist(parts, schema=_STRETCH_SCHEMA)

    found = rows.filter(draw < share).select("text").mapInArrow(
        cut, "body string, gold array<struct<kind: string, start: long, end: long>>, positive boolean"
    )
    half = TRAIN_STRETCHES // 2
    order = F.xxhash64("body")
    found = found.distinct().withColumn("order", order).cache()
    drawn = [
        row
        for positive in (True, False)
        for row in found.filter(F.col("positive") == positive).orderBy("order", "body").limit(half).collect()
    ]
    found.unpersist()
    return [(r["body"], [(g["kind"], g["start"], g["end"]) for g in r["gold"]]) for r in drawn]


_STRETCH_SCHEMA = pa.schema(
    [
        ("body", pa.string()),
        ("gold", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("positive", pa.bool_()),
    ]
)


def _disjoint(spans: list[Span]) -> list[Span]:
    """Spans that a segmentation can hold together: earlier and longer ones first."""
    out: list[Span] = []
    for span in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if not out or out[-1][2] <= span[1]:
            out.append(span)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fitted on the patterns' finds in a bounded draw of documents, as spelled and re-spelled."""
    examples: list[tuple[str, list[Span]]] = []
    for body, spans in training_stretches(docs, id_col, text_col):
        gold = _disjoint(spans)
        examples.append((body, gold))
        if len(gold) == 1:
            kind, start, end = gold[0]
            for other in respelled(kind, body[start:end]):
                examples.append((body[:start] + other + body[end:], [(kind, start, start + len(other))]))
    field = Field(defaultdict(float))
    if any(gold for _, gold in examples):
        for epoch in range(EPOCHS):
            for i in sorted(range(len(examples)), key=lambda i: hashlib.md5(f"{epoch}:{i}".encode()).digest()):
                field.learn(*examples[i], RATE / (1 + epoch))
    return Field({key: w for key, w in field.weights.items() if abs(w) > 1e-3})


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(pattern spans, added spans): an added one touches no pattern span and no other added one."""
    base = base_spans(text)
    if not field.weights:
        return base, []
    taken = sorted((a, b) for _, a, b in base)
    added: dict[tuple[int, int], str] = {}
    for a, b in stretches(text):
        body = text[a:b]
        for kind, start, end, posterior in field.decode(body):
            # What touches the border of a window may go on beyond it.
            inner = (start > 0 or a == 0) and (end < len(body) or b == len(text))
            if posterior >= POSTERIOR and inner:
                added[a + start, a + end] = kind
    out: list[Span] = []
    reach = 0
    for (start, end), kind in sorted(added.items()):
        if start >= reach and not any(s < end and start < e for s, e in taken):
            out.append((kind, start, end))
            reach = end
    return base, out


def listed(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def find(df: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and positions of personal data in every whole text."""
    shared = df.sparkSession.sparkContext.broadcast(field)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = all_spans(text, shared.value)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*counts, digest, listed(base + added), len(added)))
            columns = zip(*rows) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in SCHEMA.split(", ")])

    return documents_of(df, id_col, text_col).mapInArrow(scan, SCHEMA)


def redactor(spark: SparkSession, field: Field):
    """A column function that puts ``<KIND>`` in place of every span."""
    shared = spark.sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: None if t is None else redacted(t, shared.value))

    return lambda text: redact(text)


def redacted(text: str, field: Field) -> str:
    base, added = all_spans(text, field)
    out, at = [], 0
    for kind, start, end in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_in_documents(docs: DataFrame) -> DataFrame:
    return find(docs, train(docs))


def with_redaction(df: DataFrame, field: Field, text: Column, name: str = "text") -> DataFrame:
    return df.withColumn(name, redactor(df.sparkSession, field)(text))
