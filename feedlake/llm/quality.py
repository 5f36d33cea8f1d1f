"""Quality rules: lines labelled by a linear-chain conditional random field.

Every line with a word gets features in [0, 1]; a chain with the states content and
boilerplate scores them, and Viterbi decoding finds the best labelling of all lines of
a document. The document is kept if the words on content lines make up at least
`CONTENT_SHARE` of its words, and if the base rules hold: 50 words or more, and at
most half of them in three-word windows that the text repeats.

The field is fitted piecewise: emissions by a logistic regression of weakly labelled
lines, transitions by how often labels follow each other. Lines of documents labelled
quality 1 count as content, those of quality 0 as boilerplate where the first
fit agrees. Features only ever speak for boilerplate (weights are kept
non-negative) and the fit is held to stated prior weights, which alone decide where there
are no labels. The fit reads at most `SAMPLE_DOCS` labelled documents of at most
`SAMPLE_LINES` lines each, those with the smallest hash of their id; everything else
covers all rows and whole texts.

Defined results: null text has no words; a text without words is not kept;
repeated rows are judged alike; other columns are passed through by `kept_documents`
and ignored otherwise; without a labels table, or with an empty one, the prior weights hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage, ids_and_texts, map_rows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
SAMPLE_DOCS = 2000
SAMPLE_LINES = 200

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_SHOUTS = b"!?"
_SPACES = b" \t\n\x0b\x0c\r"

FEATURES = ("symbols", "upper", "digits", "shouts", "no_letters", "repeated", "short")
# Log-odds of boilerplate: the constant, then one weight per feature at its full value.
PRIOR = np.array([-3.0, 6.0, 1.5, 1.5, 1.5, 2.0, 1.0, 0.5])
PRIOR_STRENGTH = 0.02
# Log-odds by which a label prefers to stay as it is, without labels.
PRIOR_STAY = 1.0
# Words whose number a task remembers for the repeat count.
VOCABULARY = 400_000


@dataclass
class Field:
    """Weights of the chain: emission of boilerplate against content, and transition scores."""

    emission: np.ndarray
    transition: np.ndarray  # [from, to]; 0 content, 1 boilerplate


def prior_field() -> Field:
    return Field(PRIOR, np.array([[PRIOR_STAY, 0.0], [0.0, PRIOR_STAY]]))


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(features, words) of the lines with a word, and the number of repeated lines."""
    rows, words, seen, repeats = [], [], set(), 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if not n:
            continue
        again = line in seen
        seen.add(line)
        repeats += again
        size = len(line) - line.count(b" ")
        letters = len(line) - len(line.translate(None, _LETTERS))
        upper = len(line) - len(line.translate(None, _UPPER))
        rows.append(
            (
                10 * (len(line) - len(line.translate(None, SYMBOLS))) / size,
                2 * upper / letters - 0.6 if letters else 0.0,
                2 * (len(line) - len(line.translate(None, _DIGITS))) / size,
                10 * (len(line) - len(line.translate(None, _SHOUTS))) / size,
                0.0 if letters else 1.0,
                float(again),
                float(n < 3),
            )
        )
        words.append(n)
    if not rows:
        return np.empty((0, len(FEATURES))), np.empty(0, np.int64), 0
    return np.clip(np.array(rows), 0.0, 1.0), np.array(words), repeats


def viterbi(field: Field, features: np.ndarray) -> np.ndarray:
    """The labels with the highest total score; content wins ties."""
    odds = (features @ field.emission[1:] + field.emission[0]).tolist()
    (cc, cb), (bc, bb) = field.transition.tolist()
    content, boiler, back = 0.0, odds[0], []
    for odd in odds[1:]:
        from_c = (content + cc >= boiler + bc, content + cb >= boiler + bb)
        content, boiler = max(content + cc, boiler + bc), max(content + cb, boiler + bb) + odd
        back.append(from_c)
    label = int(boiler > content)
    labels = [label]
    for from_c in reversed(back):
        label = 0 if from_c[label] else 1
        labels.append(label)
    return np.array(labels[::-1])


class Numbers(dict):
    """Word -> small number, anew once there are too many; numbers are comparable within a text."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def repeated_words(words: list[bytes], numbers: Numbers) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    if len(numbers) > VOCABULARY:
        numbers.clear()
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    if len(numbers) >= 1 << 21:  # one text with more different words than 21 bits hold
        ids = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        pairs = np.unique(ids[:-1] << 32 | ids[1:], return_inverse=True)[1].astype(np.int64)
        windows = pairs[:-1] << 32 | ids[2:]
    else:
        windows = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
    ordered = np.sort(windows)
    common = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(common):
        return 0
    at = np.flatnonzero(np.isin(windows, common))
    covered = np.zeros(len(words), bool)
    covered[at] = covered[at + 1] = covered[at + 2] = True
    return int(covered.sum())


def judge(text: str, field: Field, numbers: Numbers) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_words, kept)"""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    chars = len(text) - (len(raw) - len(raw.translate(None, _SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeat = repeated_words(words, numbers)
    features, per_line, dup_lines = line_features(raw)
    content = int(per_line[viterbi(field, features) == 0].sum()) if n else 0
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    kept = not failed and content >= CONTENT_SHARE * n
    return n, chars, symbols, dup_lines, repeat, failed, content, kept


def _sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(quality, lines) of the sample, the lines as rows of features and words."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("quality IN (0, 1) AND doc_id IS NOT NULL").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "quality").limit(SAMPLE_DOCS)
    texts = ids_and_texts(docs).join(F.broadcast(chosen), "doc_id")
    texts = texts.filter(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) < SAMPLE_LINES)
    # An id may occur in very many rows: equal ones count once, and what is sampled is bounded after the join.
    texts = cut_lineage(texts.withColumn("_hash", F.xxhash64("text")), "quality-labelled")
    row = ["doc_id", "quality", "_hash"]
    picked = texts.select(*row).distinct().orderBy(F.xxhash64("doc_id"), "quality", "_hash").limit(SAMPLE_DOCS)
    texts = texts.join(F.broadcast(picked), row, "left_semi").dropDuplicates(row)

    def task():
        def each(rows):
            out = {"doc_id": [], "quality": [], "lines": []}
            for doc, quality, text in zip(rows["doc_id"], rows["quality"], rows["text"], strict=True):
                features = line_features(text.encode("utf-8", "replace"))[0]
                if len(features):
                    out["doc_id"].append(doc)
                    out["quality"].append(quality)
                    out["lines"].append(np.round(features, 6).ravel())
            return out

        return each

    arrow = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("lines", pa.list_(pa.float64()))])
    return map_rows(texts.select("doc_id", "quality", "text"), task, "doc_id long, quality int, lines array<double>", arrow)


def _logistic(features: np.ndarray, labels: np.ndarray, weight: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weighted logistic regression, held to the prior; feature weights stay non-negative."""
    x = np.concatenate([np.ones((len(features), 1)), features], axis=1)
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - labels)) / weight.sum() + PRIOR_STRENGTH * (w - PRIOR)
        w = w - 2.0 * gradient
        w[1:] = np.maximum(w[1:], 0)
    return w


def fit(docs: DataFrame, labels: DataFrame | None) -> Field:
    """The field of a corpus, from a bounded sample of its labelled rows."""
    rows = _sampled(docs, labels).collect() if labels is not None else []
    rows = sorted(rows, key=lambda row: (row["doc_id"], row["quality"], row["lines"]))
    if len({row["quality"] for row in rows}) < 2:
        return prior_field()
    parts = [np.array(row["lines"]).reshape(-1, len(FEATURES)) for row in rows]
    sizes = np.array([len(p) for p in parts])
    features = np.concatenate(parts)
    weak = np.repeat([1.0 - row["quality"] for row in rows], sizes)
    weight = np.repeat(1.0 / sizes, sizes)  # a document counts once, however long
    first = _logistic(features, weak, weight)
    agreed = weak * (features @ first[1:] + first[0] > 0)
    emission = _logistic(features, agreed, weight)
    inside = np.ones(len(weak) - 1, bool)
    inside[np.cumsum(sizes)[:-1] - 1] = False
    counts = np.full((2, 2), 5.0)
    np.add.at(counts, (agreed[:-1][inside].astype(int), agreed[1:][inside].astype(int)), 1)
    share = counts / counts.sum(axis=1, keepdims=True)
    transition = np.log(share) - np.log(counts.sum(axis=0) / counts.sum())
    return Field(emission, np.clip(transition, -2.0, 2.0))


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_words long, kept boolean"
)


def judged(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document row: the base counts, the words on content lines, the verdict."""
    kinds = {"long": pa.int64(), "boolean": pa.bool_()}
    fields = [part.split() for part in RESULT.split(", ")]
    arrow = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def task():
        numbers = Numbers()

        def each(rows):
            found = [judge(text, field, numbers) for text in rows["text"]]
            return dict(zip(arrow.names, [rows["doc_id"], *zip(*found, strict=True)], strict=True))

        return each

    return map_rows(ids_and_texts(docs), task, RESULT, arrow)


def kept_documents(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""

    def each(texts: pd.Series) -> pd.Series:
        numbers = Numbers()
        return pd.Series([judge(text, field, numbers)[-1] for text in texts], dtype=bool)

    return docs.filter(F.pandas_udf(each, "boolean")(F.coalesce(docs["text"], F.lit(""))))
