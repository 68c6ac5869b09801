"""Quality rules, and an isolation forest on their statistics.

The rule statistics of a text are counted from all its words and lines. The forest
is grown on a bounded sample of documents (``TREES`` times ``SAMPLE`` rows, those
with the smallest hashes), as isolation forests are; every document is scored, and
the threshold is set on all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradeflow.session import pin

TREES, SAMPLE, BINS = 100, 256, 4000
MAX_LOSS = 0.01  # of the rows labelled good
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_distinct", "n_upper", "n_marks"]
FEATURES = 7


def repeat_words(words: list) -> int:
    """Words inside three-word windows that occur twice or more in the list."""
    n = len(words)
    if n < 4:
        return 0
    number = dict(zip(words, range(n)))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    if n < 2_000_000:
        keys = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        _, pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)
        keys = pairs * n + ids[2:]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[at + shift] = True
    return int(covered.sum())


def rule_counts(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` and ``MORE`` of a text; a null has none of anything."""
    if not text:
        return (0,) * (len(COUNTS) + len(MORE))
    raw = text.encode()
    words = raw.split()
    # Equality of a line holds its ends, so only the test for a word strips it.
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(set(words)),
        len(words) - sum(map(bytes.islower, words)),
        sum(map(text.count, "!?:;")),
    )


def features(counts: np.ndarray) -> np.ndarray:
    """Rates that do not grow with the text, one row per document."""
    words = np.maximum(counts[:, 0], 1.0)
    return np.column_stack(
        [
            counts[:, 1] / words,
            np.log1p(counts[:, 2] / words),
            np.log1p(counts[:, 3]),
            counts[:, 4] / words,
            # Distinct words against what texts of this length usually have left.
            np.log(np.maximum(counts[:, 5], 1.0)) / np.maximum(np.log(words), 1.0),
            counts[:, 6] / words,
            np.log1p(counts[:, 7] / words),
        ]
    )


def grow(rows: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """A tree of random splits as (feature, value, left, right, depth) nodes."""
    nodes: list[tuple] = []

    def build(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, at, at, depth + unsplit(len(part))))
        low, high = (part.min(0), part.max(0)) if len(part) else (0, 0)
        open_ = np.flatnonzero(np.asarray(high) > np.asarray(low))
        if depth < limit and len(part) > 1 and len(open_):
            f = int(rng.choice(open_))
            value = float(rng.uniform(low[f], high[f]))
            left = part[:, f] <= value
            nodes[at] = (f, value, build(part[left], depth + 1), build(part[~left], depth + 1), 0.0)
        return at

    build(rows, 0)
    return nodes


def unsplit(n: float) -> float:
    """Mean path length of a search tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


class Forest:
    def __init__(self, rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = min(sample, len(rows))
        limit = max(1, math.ceil(math.log2(max(size, 2))))
        self.norm = max(unsplit(size), 1.0)
        self.trees = []
        for _ in range(trees if len(rows) else 0):
            part = rows[rng.choice(len(rows), size, replace=False)]
            f, v, a, b, d = zip(*grow(part, rng, limit))
            self.trees.append(tuple(map(np.array, (f, v, a, b, d))))
        self.limit = limit

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; the shorter the mean path, the higher."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for f, v, a, b, d in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.limit):
                left = rows[every, f[at]] <= v[at]
                at = np.where(f[at] < 0, at, np.where(left, a[at], b[at]))
            total += d[at]
        return 2.0 ** (-total / max(1, len(self.trees)) / self.norm)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every whole text."""
    names = COUNTS + MORE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rule_counts(t.as_py()) for t in batch.column(1)]
            columns = zip(*found) if found else [[] for _ in names]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *names])

    rows = docs.select("doc_id", F.col(f"`{text}`").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names))


def fit(counts: DataFrame, trees: int = TREES, sample: int = SAMPLE) -> Forest:
    usable = counts.filter("n_words > 0").withColumn("_h", F.xxhash64(F.lit("forest"), "doc_id"))
    # The hash's range that holds about twice the sample goes ahead, so that tasks
    # send the driver few rows each, however many there are; the sample is the same.
    wanted, n = trees * sample, usable.count()
    few = usable.filter(F.col("_h") < int((2.0 * wanted / n * 2 - 1) * 2.0**63)) if n > 4 * wanted else usable
    if few.count() >= min(wanted, n):
        usable = few
    chosen = (
        usable.orderBy("_h", "doc_id", *COUNTS, *MORE)
        .limit(wanted)
        .select(*COUNTS, *MORE)
        .collect()
    )
    rows = np.array([tuple(r) for r in chosen], float).reshape(-1, len(COUNTS + MORE))
    return Forest(features(rows), trees, sample)


def with_score(counts: DataFrame, forest: Forest) -> DataFrame:
    names = COUNTS + MORE

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = np.column_stack([batch.column(n).to_numpy().astype(float) for n in names])
                found = forest.score(features(rows))
                yield batch.append_column("anomaly", pa.array(found))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema.fields)
    return counts.mapInArrow(score, f"{kinds}, anomaly double")


def threshold(scored: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """The score that parts good from bad rows best while losing at most
    ``max_loss`` of the good ones; infinite where either kind has no labelled row."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("_good"))
    found = (
        scored.join(known.filter("_good IS NOT NULL"), "doc_id")
        .groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
        .agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad"))
        .collect()
    )
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for r in found:
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    if not good.sum() or not bad.sum():
        return math.inf
    # Share of each kind at or above the bin.
    loss, gain = (x[::-1].cumsum()[::-1] / x.sum() for x in (good, bad))
    best = max(range(BINS + 1), key=lambda b: (gain[b] - loss[b] if loss[b] <= max_loss else -1, b))
    return best / BINS


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    trees: int = TREES,
    sample: int = SAMPLE,
    max_loss: float = MAX_LOSS,
) -> DataFrame:
    """``doc_id``, ``COUNTS``, ``base_failed``, ``anomaly``, ``threshold`` and ``kept``.

    A text fails the base rules with fewer than 50 words, or with more than half of
    its words in repeated three-word windows. ``kept`` is false for these and for
    texts whose anomaly reaches the threshold. Null and empty texts have no words,
    so they fail. Labels may be missing, null or repeated; without good and bad
    ones there is no threshold and only the base rules decide. Each row of ``docs``
    gives a row; an empty table gives an empty one; other columns are not read.
    """
    counts = pin(with_counts(docs, text), "quality-counts")
    scored = pin(with_score(counts, fit(counts, trees, sample)), "quality-scores")
    limit = threshold(scored, labels, max_loss)
    failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return scored.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), "anomaly", F.lit(limit).alias("threshold"),
        (~failed & (F.col("anomaly") < F.lit(limit))).alias("kept"),
    )
