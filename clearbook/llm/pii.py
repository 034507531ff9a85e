"""Personal data by candidate gradient boosting.

High-recall generators propose spans, many of them overlapping or wrong. Format
and context features describe each one, boosted trees give it a probability, and
a threshold per kind, calibrated on held-out candidates, decides. Strict matches
of the base patterns are always kept; candidates only add to them.

There are no hand-made labels. The trees learn from two bounded samples of
documents, one of all and one of those that hold strict matches: strict matches,
and the same strings rewritten in looser ways within their own context, are
positive; other candidates of the text and made-up strings that are no personal
data are negative. The thresholds come from histograms of the scores in
all other documents. A kind without a threshold is decided by a fixed rule.

Scoring is one pass over the documents in place: the trees are small enough to
go to every task, and nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearbook.llm.common import arrow_schema, tidy, unused_name
from clearbook.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")

SAMPLE_ROWS = 20_000  # documents that the trees learn from, about
STRICT_SHARE = 0.25  # of that number are drawn besides, from the documents that hold strict matches
LEAST_HELD_OUT = 20  # candidates that a threshold rests on; a kind with fewer is decided by its rule
BINS = 1024  # of scores; a power of two, so that their edges are exact
TREES, DEPTH = 20, 4
PRECISION = 0.99  # that the threshold of a kind reaches on held-out candidates
RULE_SCORE = 0.5  # of a span that a rule adds

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits that does not match from its first digit matches from none
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT = r"(?:\s{0,2}@\s{0,2}|\s{0,2}[(\[{]\s?at\s?[)\]}]\s{0,2}|\sat\s)"
_DOT = r"(?:\s{0,2}\.\s{0,2}|\s{0,2}[(\[{]\s?dot\s?[)\]}]\s{0,2}|\sdot\s)"
_LOOSE = {
    "email": re.compile(
        rf"(?<![\w.%+-])[\w.%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}", re.IGNORECASE
    ),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?[\[(]?[.,][\])]?\s?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])[+(]{0,2}[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9])"),
}
_HINTS = {
    "email": re.compile(r"mail|contact|write to|@", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|host|server|addr", re.IGNORECASE),
    "card": re.compile(r"card|visa|credit|debit|pay", re.IGNORECASE),
    "phone": re.compile(r"tel|phone|call|mobile|fax", re.IGNORECASE),
}
_DATE = re.compile(r"(?:19|20)\d\d[-./]\d\d?[-./]\d\d?|\d\d?[-./]\d\d?[-./](?:19|20)?\d\d(?!\d)")
_NUMBERS = re.compile(r"[0-9]+")
_DOT_WORD = re.compile(r"\bdot\b", re.IGNORECASE)
# every candidate has a digit or some form of "at"; texts with neither need no generator
_BARE_AT = re.compile(r"\sat\s", re.IGNORECASE)
_SPACED_STOP = re.compile(r"\s\.|\.\s")
_MAY_HOLD = re.compile(r"[0-9@]|[(\[{]\s?at\s?[)\]}]|\sat\s", re.IGNORECASE)


_RULE_EMAIL = re.compile(
    r"[\w.%+-]+(?:\s{0,2}@\s{0,2}|\s{0,2}[(\[{]\s?at\s?[)\]}]\s{0,2}|\sat\s(?=\S+(?:\sdot\s|\s?[(\[{]\s?dot)))"
    r"[A-Za-z0-9-]+(?:(?:\.|\s{0,2}[(\[{]\s?dot\s?[)\]}]\s{0,2}|\sdot\s)[A-Za-z0-9-]+)*"
    r"(?:\.|\s{0,2}[(\[{]\s?dot\s?[)\]}]\s{0,2}|\sdot\s)[A-Za-z]{2,}",
    re.IGNORECASE,
)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, in time linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The strict matches of all kinds: (kind, start, end) in code points, by kind, then start."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the generators propose; spans of different kinds may overlap."""
    return [(kind, m.start(), m.end()) for kind, pattern in _LOOSE.items() for m in pattern.finditer(text)]


def _class_of(char: str) -> int:
    return 0 if not char or char.isspace() else 3 if char.isdigit() else 2 if char.isalpha() else 1


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span and its surroundings, as numbers."""
    span = text[start:end]
    digits = _digits(span)
    groups = [len(g) for g in _NUMBERS.findall(span)] or [0]
    separators = [c for c in span if not c.isalnum()]
    before, after = text[max(0, start - 30) : start], text[end : end + 30]
    around = before + after
    numbers = _NUMBERS.findall(span)
    tail = re.split(r"[^A-Za-z0-9]+", span)[-1]
    return [
        float(KINDS.index(kind)),
        len(span),
        len(digits),
        len(separators),
        len(set(separators)),
        float(len(digits) >= 13 and luhn(digits)),
        float(len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)),
        float(span.startswith("+")),
        float("(" in span or "[" in span),
        _class_of(text[start - 1 : start]),
        _class_of(text[end : end + 1]),
        sum(c.isalpha() for c in span) / len(span),
        float("@" in span),
        float(bool(_DOT_WORD.search(span))),
        len(tail) if tail.isalpha() else 0,
        len(groups),
        max(groups),
        min(groups),
        float(bool(_HINTS[kind].search(before))),
        sum(c.isdigit() for c in around) / (len(around) or 1),
        float(bool(_DATE.search(span))),
        # the end of one sentence and the beginning of the next look like a spaced-out domain
        float(bool(_BARE_AT.search(span))),
        len(_SPACED_STOP.findall(span)),
    ]


def rule_end(text: str, kind: str, start: int, end: int) -> int | None:
    """Where a candidate ends that is personal data by its form alone; None if it is not."""
    span = text[start:end]
    digits, numbers = _digits(span), _NUMBERS.findall(span)
    if kind == "email":  # a candidate may run on into the next sentence
        found = _RULE_EMAIL.match(text, start, end)
        return found.end() if found else None
    if kind == "ip":
        sure = "," not in span and all(int(n) <= 255 for n in numbers)
    elif kind == "card":
        sure = luhn(digits) and len(set(_NUMBERS.split(span)[1:-1])) <= 1
    else:
        hint = bool(_HINTS[kind].search(text[max(0, start - 30) : start]))
        sure = not _DATE.search(span) and (hint or 9 <= len(digits) <= 15 and span.startswith(("+", "(", "00")))
    return end if sure else None


def _loosened(kind: str, span: str, turn: int) -> str:
    """The same personal data as people write it to please themselves or to hide it."""
    if kind == "email":
        if turn % 2:  # many addresses have no digits
            span = _NUMBERS.sub("", span)
        name, _, domain = span.partition("@")
        name = name.strip("._%+-") or "me"
        return [f"{name} at {domain.replace('.', ' dot ')}", f"{name}(at){domain}", f"{name} @ {domain}"][turn // 2 % 3]
    if kind == "ip":
        return [span.replace(".", "[.]"), span.replace(".", " . "), span.replace(".", ",")][turn % 3]
    digits = _digits(span)
    if kind == "card":
        joint = (".", "/", "_", "  ")[turn % 4]
        return joint.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, first, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"00{digits}", f"{area}.{first}.{last}"][turn % 4]


def _harmless(digits: str, turn: int) -> str:
    """Text that looks like personal data and is none, made from the digits of a span."""
    d = (digits * 24)[:24]
    year = 1900 + int(d[:3]) % 130
    return [
        f"{year}-{int(d[3:5]) % 12 + 1:02d}-{int(d[5:7]) % 28 + 1:02d} {int(d[7:9]) % 24:02d}:{int(d[9:11]) % 60:02d}",
        f"{d[0]}.{d[1]}.{d[2]}",
        f"{d[:3]},{d[3:6]},{d[6:9]}.{d[9:11]}",
        f"{year}-{year + int(d[5])}",
        f"no. {d[:8]}",
        f"{d[:2]}.{d[2:12]}",
        f"{int(d[3:5]) % 28 + 1}/{int(d[5:7]) % 12 + 1}/{year}",
        f"{d[:3]}-{d[3]}-{d[4:6]}-{d[6:12]}-{d[12]}",
        f"at {('the', 'a', 'that', 'every', 'one')[int(d[0]) % 5]} dot",
    ][turn % 9]


def _examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Labelled candidates of one document."""
    strict = base_spans(text)
    covered = sorted((a, b) for _, a, b in strict)
    for kind, a, b in candidates(text):
        at = bisect_left(covered, (a, a))
        near = covered[max(0, at - 1) : at + 1] + covered[at : at + 2]
        if (a, b) in near and (kind, a, b) in strict:
            yield features(text, kind, a, b), 1
        elif all(b <= x or y <= a for x, y in near):
            yield features(text, kind, a, b), 0
    for turn, (kind, a, b) in enumerate(strict):
        left, right = text[max(0, a - 60) : a], text[b : b + 60]
        key = turn + a
        for shown, label in ((_loosened(kind, text[a:b], key), 1), (_harmless(_digits(text[a:b]) or "5", key), 0)):
            changed = left + shown + right
            c, d = len(left), len(left) + len(shown)
            for other, x, y in candidates(changed):
                if label and other == kind and abs(x - c) + abs(y - d) <= 1 or not label and x < d and c < y:
                    yield features(changed, other, x, y), label


class Trees:
    """Boosted trees as plain arrays, and the thresholds of the kinds that have one."""

    def __init__(self, trees: list[list[tuple[int, float, int, int, float]]], weights: list[float]) -> None:
        self.trees, self.weights = trees, weights
        self.thresholds: dict[str, float] = {}

    def probability(self, rows: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(rows))
        for nodes, weight in zip(self.trees, self.weights, strict=True):
            feature, split, left, right, value = (np.array(column) for column in zip(*nodes, strict=True))
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                inner = feature[at] >= 0
                goes_left = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= split[at]
                at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def _flat(node) -> list[tuple[int, float, int, int, float]]:
    """A fitted tree as (feature, threshold, left, right, value); feature -1 marks a leaf."""
    rows: list = []

    def add(node) -> int:
        at = len(rows)
        rows.append((-1, 0.0, 0, 0, node.prediction()))
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at] = (split.featureIndex(), split.threshold(), add(node.leftChild()), add(node.rightChild()), 0.0)
        return at

    add(node)
    return rows


def _examples_of(rows: DataFrame, schema: str, packed, shares: tuple[int, int], fitted: bool) -> DataFrame:
    """What ``packed`` makes of the labelled candidates of all texts, those the trees learn from or all others.

    ``rows`` has text, order and held_out. A document is learned from if it is not
    held out and its order is below the first share, or below the second if it
    holds a strict match.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[list[tuple[list[float], int]]]:
            for batch in batches:
                examples = []
                for text, order, held_out in zip(*(batch.column(c) for c in ("text", "order", "held_out")), strict=True):
                    text, order = text.as_py(), order.as_py()
                    if text and _MAY_HOLD.search(text):
                        learned = order < shares[0] or order < shares[1] and bool(base_spans(text))
                        if (learned and not held_out.as_py()) == fitted:
                            examples += _examples(text)
                if examples:
                    yield examples

        yield from packed(found())

    return rows.mapInArrow(tidy(run), schema)


def train(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_rows: int = SAMPLE_ROWS
) -> Trees | None:
    """Trees fitted on the candidates of about ``sample_rows`` documents, and STRICT_SHARE as many with strict matches.

    Both samples are chosen by a hash of id and text, without a quarter of all
    texts, which is held out. All documents that are not in a sample set the
    thresholds. None if a class has no examples; the rules decide then.
    """
    ticks = 1 << 30
    text, whole = F.col(f"`{text_column}`").cast("string"), (F.col(f"`{id_column}`"), F.col(f"`{text_column}`"))
    rows = documents.select(
        text.alias("text"),
        F.pmod(F.xxhash64(*whole), F.lit(ticks)).alias("order"),
        (F.pmod(F.xxhash64(text), F.lit(4)) == 0).alias("held_out"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(bool(base_spans(t.as_py())) for batch in batches for t in batch.column("text"))
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    possible = F.col("text").rlike("[0-9@]")  # a strict match has either
    strict = rows.where(possible).select("text").mapInArrow(tidy(count), "n long").agg(F.sum("n")).first()[0] or 0
    shares = (
        ticks * sample_rows // max(documents.count(), 1),
        ticks * int(sample_rows * STRICT_SHARE) // max(strict, 1),
    )

    schema = arrow_schema("features array<double>, label int")

    def listed(found: Iterator[list]) -> Iterator[pa.RecordBatch]:
        for examples in found:
            yield pa.record_batch([[list(map(float, f)) for f, _ in examples], [y for _, y in examples]], schema=schema)

    sample = rows.where(~F.col("held_out") & ((F.col("order") < shares[0]) | ((F.col("order") < shares[1]) & possible)))
    learned = stage(_examples_of(sample, "features array<double>, label int", listed, shares, True), "examples")
    if learned.select("label").distinct().count() < 2:
        return None
    training = learned.select(array_to_vector("features").alias("features"), F.col("label").cast("double"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(training.coalesce(4))
    trees = Trees([_flat(t._java_obj.rootNode()) for t in model.trees], list(model.treeWeights))

    def binned(found: Iterator[list]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(KINDS) * BINS * 2, dtype=np.int64)
        for examples in found:
            features = np.array([f for f, _ in examples], dtype=np.float64)
            bins = np.minimum(np.floor(trees.probability(features) * BINS), BINS - 1).astype(np.int64)
            slots = (features[:, 0].astype(np.int64) * BINS + bins) * 2 + np.array([y for _, y in examples])
            counts += np.bincount(slots, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], names=["slot", "n"])

    histogram = _examples_of(rows, "slot long, n long", binned, shares, False).groupBy("slot").agg(F.sum("n").alias("n"))
    _calibrate(trees, [tuple(row) for row in histogram.collect()])  # at most two rows for each kind and bin
    return trees


def _calibrate(trees: Trees, histogram: list[tuple[int, int]]) -> None:
    """The lowest threshold of each kind from which on held-out candidates reach the precision, if enough of them do."""
    counts = np.zeros(len(KINDS) * BINS * 2, dtype=np.int64)
    for slot, n in histogram:
        counts[slot] = n
    for kind, (harmless, personal) in zip(KINDS, counts.reshape(len(KINDS), BINS, 2).transpose(0, 2, 1), strict=True):
        right, wrong = np.cumsum(personal[::-1])[::-1], np.cumsum(harmless[::-1])[::-1]
        enough = (right >= PRECISION * (right + wrong)) & (right + wrong >= LEAST_HELD_OUT)
        good = np.flatnonzero(enough & (personal + harmless > 0))
        if len(good):
            trees.thresholds[kind] = max(0.5, int(good[0]) / BINS)


def spans_of(text: str, trees: Trees | None) -> list[tuple[str, int, int, bool, float]]:
    """All spans of a text by kind, then start; an added one overlaps neither a strict one nor a better added one."""
    strict = base_spans(text)
    spans = [(kind, a, b, True, 1.0) for kind, a, b in strict]
    proposed = candidates(text)
    passed = []
    if trees and proposed:
        scores = trees.probability(np.array([features(text, *c) for c in proposed], dtype=np.float64)).tolist()
        passed = [(s, c) for s, c in zip(scores, proposed, strict=True) if s >= trees.thresholds.get(c[0], 2.0)]
    for kind, a, b in proposed:
        if (not trees or kind not in trees.thresholds) and (end := rule_end(text, kind, a, b)):
            passed.append((RULE_SCORE, (kind, a, end)))
    if passed:
        taken = sorted((a, b) for _, a, b in strict)
        best = sorted(passed, key=lambda x: (-x[0], x[1][1] - x[1][2], x[1]))
        for score, (kind, a, b) in best:
            at = bisect_left(taken, (a, b))
            free = (at == len(taken) or b <= taken[at][0]) and (at == 0 or max(y for _, y in taken[max(0, at - 4) : at]) <= a)
            if free:
                spans.append((kind, a, b, False, score))
                taken.insert(at, (a, b))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(documents: DataFrame, trees: Trees | None, text_column: str = "text", spans_column: str = "spans") -> DataFrame:
    """All columns and ``spans_column``: kind, start and end in code points, whether strict, and score.

    A null or empty text has no spans. An older column of that name is replaced.
    """
    kept = documents.drop(spans_column)
    schema = StructType([*kept.schema.fields, *StructType.fromDDL(f"`{spans_column}` {SPANS}").fields])
    arrow = arrow_schema(schema)
    names = ("kind", "start", "end", "base", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(text_column):
                text = value.as_py()
                hit = text and _MAY_HOLD.search(text)
                found.append([dict(zip(names, s, strict=True)) for s in spans_of(text, trees)] if hit else [])
            yield pa.record_batch([*batch.columns, pa.array(found, arrow.field(spans_column).type)], schema=arrow)

    return kept.mapInArrow(tidy(run), schema)


def redact(found: DataFrame, text_column: str = "text", spans_column: str = "spans") -> DataFrame:
    """The text with every span replaced by its kind in brackets, all other columns as they are.

    Spans that overlap or touch are replaced together, by the kind of the first.
    """
    schema = StructType([f for f in found.schema.fields if f.name != spans_column])
    arrow = arrow_schema(schema)
    place = schema.names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.drop_columns([spans_column]).columns)
            texts = []
            for text, spans in zip(columns[place], batch.column(spans_column), strict=True):
                pieces, done = [], 0
                value = text.as_py()
                for s in sorted(spans.as_py() or [], key=lambda s: (s["start"], s["end"])):
                    if s["start"] >= done:
                        pieces += [value[done : s["start"]], f"[{s['kind'].upper()}]"]
                    done = max(done, s["end"])
                texts.append(value if value is None else "".join([*pieces, value[done:]]))
            columns[place] = pa.array(texts, arrow.field(place).type)
            yield pa.record_batch(columns, schema=arrow)

    return found.mapInArrow(tidy(run), schema)


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: strict spans by kind, the SHA-256 of their list, and all spans as text."""

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number_of(kind):
        return F.size(F.filter(strict, lambda s: s["kind"] == kind)).cast("long")

    strict = F.filter("spans", lambda s: s["base"])
    counts = [number_of(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        F.col(f"`{id_column}`"), *counts, F.sha2(listed(strict), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def redacted(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with all personal data replaced by its kind, all other columns as they are."""
    spans = unused_name("_spans", documents.columns)
    return redact(find(documents, train(documents, id_column, text_column), text_column, spans), text_column, spans)
