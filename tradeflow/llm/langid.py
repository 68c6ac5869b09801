"""Languages of the words of a text by a linear-chain conditional random field.

Features of a word are the n-grams of its bytes between two marks, so those at the
marks are affixes, longer affixes, and its shares over the languages in a lexicon.
Weights and the transitions between the languages of neighbouring words are fitted
together by the gradient of the likelihood, on sequences that switch between
sentences of several languages. Words are labelled by forward-backward.

The model is fitted on a bounded sample, ``SAMPLE`` documents per language and of
each at most ``SPANS`` spans of ``SPAN`` words; every document is then labelled over its whole text where it lies, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeflow.llm.workers import lean
from tradeflow.session import pin

SAMPLE, SEQUENCES, STEPS = 150, 1000, 60
SPAN, SPANS = 40, 50  # words of a span; spans of a document that the model may learn from
BUCKETS = 1 << 16
BLOCK = 64
CHARS = 1_000_000  # of a batch labelled at once
MEMO = 300_000  # words
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


class Words:
    """Distinct words with their hashed features and lexicon rows."""

    def __init__(self, words: list[bytes]):
        self.words = words
        marked = b"".join(b"\x02" + w + b"\x03" for w in words)
        raw = np.frombuffer(marked, np.uint8).astype(np.uint64)
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        owner = np.repeat(np.arange(len(words)), sizes)
        at = np.arange(len(raw))
        room = ends[owner] - at  # bytes from here to the end of the word
        owners, codes = [], []
        code = np.zeros(len(raw), np.uint64)
        for n in range(1, 6):
            code = code[: len(raw) - n + 1] * np.uint64(257) + raw[n - 1 :]
            if n == 1:
                continue
            if n == 3:
                fits = np.flatnonzero(room[: len(code)] >= n)
            else:  # affixes only
                long_enough = np.flatnonzero(sizes >= n)
                fits = np.concatenate([starts[long_enough], ends[long_enough] - n])
            owners.append(owner[fits])
            codes.append(code[fits] + np.uint64(n))
        owner, code = np.concatenate(owners), np.concatenate(codes)
        order = np.argsort(owner, kind="stable")
        self.owner = owner[order]
        mixed = code[order] * np.uint64(0x9E3779B97F4A7C15)
        self.features = (mixed >> np.uint64(64 - 16)).astype(np.int64)
        counts = np.bincount(self.owner, minlength=len(words))
        self.first = np.cumsum(counts) - counts
        self.scale = 1.0 / np.sqrt(np.maximum(counts, 1))
        self.letters = self._letters(raw, np.repeat(np.arange(len(words)), sizes))

    def _letters(self, raw: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Letters of each word; beyond ASCII and the accented Latin ones (two bytes
        from 0xC3 on), a pattern counts them."""
        n = len(self.words)
        lead = raw >= 0xC0
        plain = (raw >= ord("a")) & (raw <= ord("z"))
        odd = (lead & (raw != 0xC3)) | (raw == 0x97) | (raw == 0xB7)
        out = np.bincount(owner, plain | lead, n)
        for i in np.flatnonzero(np.bincount(owner, odd, n)):
            out[i] = len(LETTER.findall(self.words[i].decode()))
        return out

    def sums(self, weights: np.ndarray) -> np.ndarray:
        if not self.words:
            return np.zeros((0, weights.shape[1]))
        return np.add.reduceat(weights[self.features], self.first) * self.scale[:, None]

    def spread(self, grad: np.ndarray) -> np.ndarray:
        each = (grad * self.scale[:, None])[self.owner]
        return np.column_stack([np.bincount(self.features, each[:, k], BUCKETS) for k in range(grad.shape[1])])


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # features x languages
    lexicon: dict[bytes, int]  # row of a word in ``shares``
    shares: np.ndarray  # of each language in a word's uses; the last row is of unknown words
    lexical: np.ndarray  # lexicon share x languages
    moves: np.ndarray  # languages x languages

    def share(self, words: list[bytes]) -> np.ndarray:
        rows = map(self.lexicon.get, words, repeat(len(self.shares) - 1))
        return self.shares[np.fromiter(rows, np.int64, len(words))]

    def emissions(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the languages, and the number of letters, of each word."""
        known = Words(words)
        return known.sums(self.weights) + self.share(words) @ self.lexical, known.letters


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Marginals of each word, for texts that lie in a row in ``emissions``.

    Texts are cut into blocks; all blocks multiply their transfer matrices at once,
    a short run over the blocks of each text carries the messages, and a second
    pass inside the blocks gives the marginals. The result is that of one pass.
    """
    total, n = emissions.shape
    if not total:
        return emissions
    blocks = -(-lengths // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    starts = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(total) - starts[text]
    row, column = first_block[text] + inside // BLOCK, inside % BLOCK
    nb = int(blocks.sum())
    psi = np.ones((BLOCK, nb, n))
    psi[column, row] = np.exp(emissions - emissions.max(1, keepdims=True))
    step = np.zeros((BLOCK, nb, 1), bool)  # whether the word follows another one
    step[column, row, 0] = inside > 0
    a = np.exp(moves - moves.max())

    product = np.broadcast_to(np.eye(n), (nb, n, n)).copy()
    for t in range(BLOCK):
        moved = (product.reshape(-1, n) @ a).reshape(product.shape)
        product = np.where(step[t][:, :, None], moved, product) * psi[t][:, None, :]
        if t % 8 == 7:  # often enough for doubles
            product /= product.max((1, 2), keepdims=True)
    enter, leave = np.full((nb, n), 1.0 / n), np.full((nb, n), 1.0)
    most = int(blocks.max())
    for j in range(1, most):
        at = first_block[blocks > j] + j
        x = np.einsum("bi,bij->bj", enter[at - 1], product[at - 1])
        enter[at] = x / x.sum(1, keepdims=True)
    for j in range(most - 2, -1, -1):
        at = first_block[blocks > j + 1] + j
        x = np.einsum("bij,bj->bi", product[at + 1], leave[at + 1])
        leave[at] = x / x.sum(1, keepdims=True)
    forward = np.empty((BLOCK, nb, n))
    x = enter
    for t in range(BLOCK):
        x = np.where(step[t], x @ a, x) * psi[t]
        x /= x.sum(1, keepdims=True)
        forward[t] = x
    x = leave
    for t in range(BLOCK - 1, -1, -1):
        forward[t] *= x
        x = x * psi[t]
        x = np.where(step[t], x @ a.T, x)
        x /= x.sum(1, keepdims=True)
    found = forward[column, row]
    return found / found.sum(1, keepdims=True)


def sequences(texts: list[tuple[str, int]], count: int, rng) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, languages and lengths of sequences that switch between sentences."""
    spans: dict[int, list[list[bytes]]] = {}
    for text, lang in texts:
        found = words_of(text)
        for at in range(0, len(found), SPAN):
            spans.setdefault(lang, []).append(found[at : at + SPAN])
    langs = sorted(k for k, v in spans.items() if v)
    words: list[bytes] = []
    gold: list[int] = []
    lengths = []
    for _ in range(count if langs else 0):
        before = len(words)
        for lang in rng.choice(langs, int(rng.integers(1, 4))):
            span = spans[lang][int(rng.integers(len(spans[lang])))]
            low = int(rng.integers(0, max(1, len(span) - 5)))
            part = span[low : low + int(rng.integers(5, SPAN + 1))]
            words += part
            gold += [int(lang)] * len(part)
        lengths.append(len(words) - before)
    return words, np.array(gold, np.int64), np.array(lengths, np.int64)


def expected_moves(emissions, lengths, moves, marginals) -> np.ndarray:
    """Sum of the posterior of each pair of neighbouring labels.

    Given the marginals, p(i, j) at a step is proportional to the forward message
    times the move times what follows; both messages are recovered by one loop over
    the padded sequences, which are short in training.
    """
    total, n = emissions.shape
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(total) - (np.cumsum(lengths) - lengths)[text]
    most = int(lengths.max())
    psi = np.zeros((most, len(lengths), n))
    psi[inside, text] = np.exp(emissions - emissions.max(1, keepdims=True))
    there = np.zeros((most, len(lengths), n))
    there[inside, text] = marginals
    a = np.exp(moves - moves.max())
    out = np.zeros((n, n))
    x = psi[0] / psi[0].sum(1, keepdims=True)
    for t in range(1, most):
        live = lengths > t
        ahead = x[live] @ a * psi[t][live]
        # What follows, up to a factor: marginal over forward message.
        after = there[t][live] / np.maximum(ahead, 1e-300)
        pair = x[live][:, :, None] * a[None] * (psi[t][live] * after)[:, None, :]
        out += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        x = np.zeros_like(x)
        x[live] = ahead / ahead.sum(1, keepdims=True)
    return out


def fit(texts: list[tuple[str, str]], count: int = SEQUENCES, steps: int = STEPS, seed: int = 7) -> Model:
    """Maximum likelihood with a small quadratic penalty, by Adam."""
    langs = sorted({lang for _, lang in texts})
    number = {lang: i for i, lang in enumerate(langs)}
    n, rng = len(langs), np.random.default_rng(seed)
    words, gold, lengths = sequences([(t, number[x]) for t, x in texts], count, rng)
    model = Model(langs, np.zeros((BUCKETS, n)), {}, np.zeros((1, n)), np.zeros((n, n)), np.zeros((n, n)))
    lengths = lengths[lengths > 0]
    if n < 2 or not words:
        return model
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([place[w] for w in words])
    # The lexicon comes from the texts' other half, so that its weight is learned
    # on words it may not know, as it meets them later.
    tally: dict[bytes, np.ndarray] = {}
    for k, (text, lang) in enumerate(sorted(texts)):
        if k % 2:
            for w in words_of(text):
                tally.setdefault(w, np.zeros(n))[number[lang]] += 1
    often = {w: c / (c.sum() + 1.0) for w, c in tally.items() if c.sum() > 1}
    model.lexicon = {w: i for i, w in enumerate(often)}
    model.shares = np.vstack([*often.values(), np.zeros(n)])
    known = Words(list(place))
    share = model.share(known.words)
    one = np.zeros((len(gold), n))
    one[np.arange(len(gold)), gold] = 1.0
    follows = np.ones(len(gold), bool)
    follows[np.cumsum(lengths) - lengths] = False
    at = np.flatnonzero(follows)
    seen = np.zeros((n, n))
    np.add.at(seen, (gold[at - 1], gold[at]), 1.0)
    values = [model.weights, model.lexical, model.moves]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        emissions = (known.sums(model.weights) + share @ model.lexical)[ids]
        marginals = forward_backward(emissions, lengths, model.moves)
        miss = one - marginals
        by_word = np.column_stack([np.bincount(ids, miss[:, k], len(place)) for k in range(n)])
        grads = [
            known.spread(by_word) - 0.1 * model.weights,
            share.T @ by_word - 0.1 * model.lexical,
            seen - expected_moves(emissions, lengths, model.moves, marginals) - 0.1 * model.moves,
        ]
        for v, g, m, s in zip(values, grads, first, second):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


class Labeller:
    """A model with the emissions of the words met so far; a full memo is emptied."""

    def __init__(self, model: Model, memo: int = MEMO):
        self.model, self.memo = model, memo
        self.clear()

    def clear(self) -> None:
        n = max(1, len(self.model.langs))
        self.place: dict[bytes, int] = {}
        self.emissions, self.letters = np.empty((self.memo, n), np.float32), np.empty(self.memo, np.float32)

    def ids(self, words: list[bytes]) -> np.ndarray:
        new = list(set(words).difference(self.place))
        if len(self.place) + len(new) > self.memo:
            self.clear()
            new = list(set(words))
            if len(new) > self.memo:
                self.memo = len(new)
                self.clear()
        if new:
            low, high = len(self.place), len(self.place) + len(new)
            self.place.update(zip(new, range(low, high)))
            found, letters = self.model.emissions(new)
            found[letters == 0] = 0.0
            self.emissions[low:high], self.letters[low:high] = found, letters
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[str, int]]]]:
        """Per text its language, that language's share, and runs of (language, words)."""
        langs = self.model.langs
        if not langs:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        split = [words_of(t) for t in texts]
        lengths = np.array([len(ws) for ws in split], np.int64)
        ids = self.ids([w for ws in split for w in ws])
        if not len(ids):
            return [(UNKNOWN, 0.0, [])] * len(texts)
        full = np.flatnonzero(lengths)
        marginals = forward_backward(self.emissions[ids], lengths[full], self.model.moves)
        starts = (np.cumsum(lengths) - lengths)[full]
        totals = np.add.reduceat(marginals * self.letters[ids][:, None], starts)
        best = marginals.argmax(1)
        change = np.flatnonzero(np.diff(best)) + 1
        out: list = [(UNKNOWN, 0.0, [])] * len(texts)
        for i, start, total in zip(full, starts, totals):
            if total.sum() > 0:
                k = int(total.argmax())
                end = start + lengths[i]
                inner = change[np.searchsorted(change, start, "right") : np.searchsorted(change, end)]
                cuts = [int(start), *inner.tolist(), int(end)]
                runs = [(langs[best[x]], y - x) for x, y in zip(cuts, cuts[1:])]
                out[i] = (langs[k], float(total[k] / total.sum()), runs)
        return out


def excerpt(text: str) -> str:
    """A text of at most ``SPANS`` spans, and of a longer one that many spans, spread
    evenly over the whole text."""
    words = text.split()
    if len(words) <= SPANS * SPAN:
        return text
    starts = [i * (len(words) - SPAN) // (SPANS - 1) for i in range(SPANS)]
    return "\n".join(" ".join(words[s : s + SPAN]) for s in starts)


def sample(docs: DataFrame, learn: Column, doc_id: str, text: str, lang: str, per_lang: int):
    """Excerpts of up to ``per_lang`` different rows of each language, by the smallest
    hash of id, language and text.

    Only hashes are ranked; each task keeps the first of each language before the
    shuffle. Then the excerpts are cut where the chosen texts lie, so what comes to
    the driver has a bound in rows and in words.
    """
    usable = docs.filter(learn & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    row = [F.col(f"`{c}`").cast("string") for c in (doc_id, lang, text)]
    usable = usable.select(
        row[1].alias("_lang"), row[2].alias("_text"), F.xxhash64(*row).alias("_h1"), F.xxhash64(F.lit("second"), *row).alias("_h2")
    )
    order = Window.partitionBy("_lang").orderBy("_h1", "_h2")
    chosen = (
        usable.groupBy("_lang", "_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= per_lang)
        .select("_h1", "_h2")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([excerpt(t.as_py()) for t in batch.column("_text")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], batch.schema.names)

    # A table, so that its size is known to the join.
    rows = usable.join(pin(chosen, "language-sample"), ["_h1", "_h2"]).select("_h1", "_h2", "_lang", "_text")
    rows = rows.mapInArrow(lean(cut), "_h1 bigint, _h2 bigint, _lang string, _text string")
    rows = rows.groupBy("_h1", "_h2").agg(F.first("_text"), F.first("_lang")).collect()
    return sorted((r[2], r[3]) for r in rows)


def identify(
    docs: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_lang: int = SAMPLE,
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``runs``.

    The model learns from the text and non-null language of rows that satisfy
    ``learn``, and predicts from the text alone. ``lang_pred`` is the language with
    most letters, each word counted by its marginals; ``score`` is its share of the
    letters; ``runs`` are the most likely languages along the words. A text that is
    null or has no letter is ``und`` with score 0, as is every text where nothing
    can be learned. Rows with equal ids or texts get the same result; an empty
    table stays empty; columns of ``docs`` named like a new one are replaced.
    """
    new = ["lang_pred", "score", "runs"]
    keep = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    model = fit(sample(docs, learn, doc_id, text, lang, per_lang))
    runs = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for batch in batches:
            for low, high in parts(batch.column(text)):
                rows = batch.slice(low, high - low)
                found = labeller.label([t or "" for t in rows.column(text).to_pylist()])
                arrays = [
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([[{"lang": a, "words": b} for a, b in x[2]] for x in found], runs),
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns, *arrays], [*rows.schema.names, *new])

    kinds = keep.schema.simpleString()[len("struct<") : -1]
    return keep.mapInArrow(lean(predict), _ddl(keep) + ", lang_pred string, score double, runs array<struct<lang:string,words:int>>") if kinds else keep


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHARS`` characters each."""
    low = size = 0
    for i, t in enumerate(column):
        size += len(t.as_py() or "")
        if size >= CHARS:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(column):
        yield low, len(column)
