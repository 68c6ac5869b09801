"""Packing token sequences by exact complements.

The tokens are counted in one pass over the texts; the rest works on lengths. How
often each length occurs is at most 2048 numbers, whatever the corpus: the plan is
made from these. Index of single, pair and triple length sums: for the longest
length left, a combination that fills its gap exactly is looked up and consumed as
often as the counts allow; what has none is packed by best fit. A plan's pattern
stands for any number of equal sequences, so the plan's size does not grow with
the corpus. Pieces find their place by their number among those of their length.
"""

from __future__ import annotations

import bisect
import os
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tradeflow.llm.bpe import byte_of
from tradeflow.llm.shingles import batches_of
from tradeflow.llm.workers import kept, lean
from tradeflow.session import pin

LENGTH = 2048
MEMO = 500_000  # words of a generation of a worker's memo
CALL = 400  # new words of a call; many more cost the tokenizer a quarter of its time
HIGH = "\u0250"  # below, categories are the same in all versions of Unicode that libraries use
STAND_INS = {b: c for c, b in byte_of().items()}  # characters that stand for bytes in the vocabulary
Pattern = list[tuple[int, int]]  # (length, how often), in order of place


class Memo(dict):
    """Ids of words as bytes. Words of low letters, of ASCII marks or of the ones before
    the others get theirs from the model when they are first asked for: the vocabulary
    cuts only between the two. Any other word goes to ``later`` and gets none. ``old`` is
    the memo before; its words move on when they are met again."""

    def __init__(self, model, old: dict[str, bytes]):
        self.model, self.old, self.later = model, old, []

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word) or self._ids(word)
        if ids is None:
            self.later.append(word)
            return b""
        self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes | None:
        stem = word.rstrip(punctuation)
        body = stem.lstrip(" ")
        letters = body.isalpha() and (body.isascii() or max(body) < HIGH)
        if letters and len(stem) < len(word):
            return self[stem] + self[word[len(stem) :]]
        if not letters and body not in ("", "\n"):
            return None
        if letters and body.isascii():
            stand = word.replace(" ", STAND_INS[ord(" ")])
        else:
            stand = word.encode().decode("latin-1").translate(STAND_INS)
        return array("I", [t.id for t in self.model.tokenize(stand)]).tobytes()


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    Where words are parted by single spaces and newlines only, the ids of a text
    are those of its words in a row (the vocabulary never joins across them), and
    words are encoded once: plain ones by the ``Memo``, the other new ones of some texts
    by ``CALL`` at once. Any other text is encoded as it is. The memo has two generations:
    when the young one is full it becomes the old one, and the frequent words stay.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.memo = Memo(self.tokenizer.model, {})

    def _raw(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return array("I", found.ids).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, from one text of lines: newlines keep ids of their own."""
        raw = self._raw("\n".join(words))
        ends = 4 * np.flatnonzero(np.frombuffer(raw, "<u4") == self.newline)
        return [raw[a:b] for a, b in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)])]

    def _units(self, text: str) -> list[str] | None:
        spaced = text.replace("\n", " ")
        # Of all white space only the plain space counts as printable.
        if not spaced.isprintable() or "  " in spaced or spaced[0] == " " or spaced[-1] == " ":
            return None
        if any(s in text for s in self.special):
            return None
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.memo) > MEMO:
            self.memo.old = {}
            self.memo = Memo(self.memo.model, self.memo)
        get, later = self.memo.__getitem__, self.memo.later
        units = [self._units(text) if text else [] for text in texts]
        out: list[bytes | None] = []
        for words in units:
            known = len(later)
            ids = None if words is None else b"".join(map(get, words))
            out.append(ids if len(later) == known else None)
        new = list(dict.fromkeys(later))
        for at in range(0, len(new), CALL):
            part = new[at : at + CALL]
            self.memo.update(zip(part, self._words(part)))
        later.clear()
        for text, words, ids in zip(texts, units, out):
            if words is None:
                yield self._raw(text)
            else:
                yield b"".join(map(get, words)) if ids is None else ids


def encoder_of(path: str) -> Encoder:
    """One encoder for the tasks of a worker, so that its memo stays warm."""
    return kept(("encoder", path), lambda: Encoder(path))


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` ids: full ones, a shorter one first."""
    first = n % length or min(n, length)
    starts = [0, *range(first, n, length)]
    return [(s, first if s == 0 else length) for s in starts]


def pieces(docs: DataFrame, path: str, text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per piece, with ``_part`` and ``_nth``: its number among the pieces
    of its length that the same task has cut."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_nth"]
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = encoder_of(path), Counter()
        part = TaskContext.get().partitionId()
        for some in (x for batch in batches for x in batches_of(batch, 1)):
            at, out = [], []
            encoded = encoder.encode([t.as_py() for t in some.column(1)])
            for i, ids in enumerate(encoded):
                ids += b"\0\0\0\0"
                for k, (s, n) in enumerate(cut(len(ids) // 4, length)):
                    at.append(i)
                    out.append((k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), part, seen[n]))
                    seen[n] += 1
            columns = [pa.array(c, t) for c, t in zip(zip(*out), KINDS)]
            yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(at)), *columns], names)

    return rows.mapInArrow(
        lean(run, keeps=True),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, _part int, _nth bigint",
    )


KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def _times(counts: np.ndarray, lengths: list[int]) -> int:
    need = Counter(lengths)
    return min(int(counts[n]) // k for n, k in need.items())


def _pair(counts: np.ndarray, total: int) -> list[int] | None:
    """Two available lengths with this sum, the longer one as long as possible."""
    if total < 2:
        return None
    low = np.arange(1, total // 2 + 1)
    high = total - low
    fits = (counts[low] > 0) & (counts[high] > 0) & ((low != high) | (counts[low] > 1))
    at = int(np.argmax(fits))
    return [int(high[at]), int(low[at])] if fits[at] else None


def _complement(counts: np.ndarray, gap: int) -> list[int] | None:
    """One to three available lengths that fill ``gap`` exactly."""
    if counts[gap] > 0:
        return [gap]
    if two := _pair(counts, gap):
        return two
    for longest in np.flatnonzero(counts[: gap - 1] > 0)[::-1]:
        if 3 * longest < gap:
            break
        counts[longest] -= 1
        two = _pair(counts, gap - int(longest))
        counts[longest] += 1
        if two:
            return [int(longest), *two]
    return None


def plan(available: dict[int, int], length: int = LENGTH) -> list[tuple[int, Pattern]]:
    """How many sequences of which pattern hold these pieces."""
    counts = np.zeros(length + 1, np.int64)
    for n, k in available.items():
        counts[n] = k
    patterns: list[tuple[int, list[int]]] = []
    left: dict[int, int] = {}
    for first in range(length, 0, -1):
        while counts[first] > 0:
            fill: list[int] | None = []
            if first < length:
                counts[first] -= 1
                fill = _complement(counts, length - first)
                counts[first] += 1
            if fill is None:
                left[first] = int(counts[first])
                counts[first] = 0
                break
            times = _times(counts, [first, *fill])
            patterns.append((times, [first, *fill]))
            for n in [first, *fill]:
                counts[n] -= times
    return [(k, runs(p)) for k, p in patterns] + best_fit(left, length)


def runs(lengths: list[int]) -> Pattern:
    return sorted(Counter(lengths).items(), reverse=True)


def best_fit(left: dict[int, int], length: int = LENGTH) -> list[tuple[int, Pattern]]:
    """Longest first, each piece into the fullest sequence that still holds it;
    equal sequences are filled together."""
    open_: dict[int, list[tuple[int, Pattern]]] = {}  # by gap
    gaps: list[int] = []

    def put(gap: int, times: int, pattern: Pattern) -> None:
        if gap not in open_:
            open_[gap] = []
            bisect.insort(gaps, gap)
        open_[gap].append((times, pattern))

    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                put(length, max(1, todo // (length // n)), [])
                continue
            gap = gaps[at]
            times, pattern = open_[gap].pop()
            if not open_[gap]:
                del open_[gap], gaps[at]
            each = min(gap // n, todo)
            used = min(times, todo // each)
            if times > used:
                put(gap, times - used, pattern)
            put(gap - each * n, used, [*pattern, (n, each)])
            todo -= used * each
    return [p for group in open_.values() for p in group if p[1]]


def slots(patterns: list[tuple[int, Pattern]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from, to, first sequence, place, copies in a sequence): the pieces
    of this length numbered ``from`` to ``to`` fill these places."""
    taken: Counter = Counter()
    out, sequence = [], 0
    for times, pattern in patterns:
        offset = 0
        for n, each in pattern:
            out.append((n, taken[n], taken[n] + times * each, sequence, offset, each))
            taken[n] += times * each
            offset += n * each
        sequence += times
    return out


def pack(docs: DataFrame, path: str, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and
    ``offset`` of every piece.

    A document is the ids of its text and then id 0; a null text counts as empty,
    so it is one id. Documents longer than ``length`` are cut into full pieces and
    a shorter first one. Sequences are filled without gaps from 0 on. Rows with
    equal ids or texts are packed each on its own; an empty table gives an empty
    one; other columns are not read.
    """
    spark = docs.sparkSession
    cut_up = pin(pieces(docs, path, text, length), "pack-pieces")
    sums = cut_up.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = pin(sums.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "pack-bases")
    # At most ``length`` rows, whatever the corpus.
    counts = {r[0]: r[1] for r in sums.groupBy("length").agg(F.sum("_n")).collect()}
    places = spark.createDataFrame(
        slots(plan(counts, length)),
        "length bigint, _from bigint, _to bigint, _sequence bigint, _place bigint, _each bigint",
    )
    rows = cut_up.join(sums.drop("_n"), ["length", "_part"])
    rows = rows.withColumn("_at", F.col("_base") + F.col("_nth"))
    # The plan has a few slots for each length, so its size has a bound.
    rows = rows.join(
        F.broadcast(places), (rows["length"] == places["length"]) & F.col("_at").between(F.col("_from"), F.col("_to") - 1)
    ).drop(places["length"])
    at = F.col("_at") - F.col("_from")
    return rows.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_sequence") + F.floor(at / F.col("_each")).cast("bigint")).alias("sequence_id"),
        (F.col("_place") + F.pmod(at, F.col("_each")) * F.col("length")).alias("offset"),
    )
