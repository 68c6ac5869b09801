"""Byte-pair encoding by a table of distinct words, and decoding by a table of pieces.

Pre-tokenization cuts texts into words that are encoded each on its own, so a word's
ids do not depend on its place. The rows that a task reads form blocks of bounded
size. A block sends each of its distinct words once to the bucket of the word's hash;
there each distinct word of the corpus is encoded once, and its ids go back to the
blocks that asked. The distinct ids of a block are joined with the vocabulary's table
of id and piece. Last, the texts come to their block's ids and pieces as sequences of
word numbers, frequent words first, in one to three bytes a word: ids and decoded
bytes are put in place by position. No word or id moves once per occurrence.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeflow.session import pin

BLOCK_CHARS = 32_000_000  # of the texts of a block; a longer text is a block of its own
PART_CHARS = 1_000_000  # of a text that are cut into words at once
MEMO = 1_000_000  # words of a generation of a task's memo
TEXTS, BUCKETS = -1, -2  # in the place of a bucket: a text's words; buckets of a block's words

# Texts of these characters are cut by an expression of the standard library. Their
# categories are the same in all versions of Unicode that libraries use.
LOW = [chr(c) for c in range(0x250)]
SPACE = "".join(c for c in LOW if re.match(r"[\t-\r \x85\xa0]", c))
LETTER, NUMBER = (re.escape("".join(c for c in LOW if unicodedata.category(c)[0] == k)) for k in "LN")
LOW_WORD = (
    rf"'(?:[stmd]|re|ve|ll)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Words:
    """Cuts texts into words as the pre-tokenizer of a vocabulary does.

    Only byte-level vocabularies without normalizer, prefix space and flags on added
    tokens are taken; another one is refused. Added tokens are words of their own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Cuts and padding of the file itself are not applied.
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        told = json.loads(self.tokenizer.to_str())
        cut, flags = told["pre_tokenizer"] or {}, ("single_word", "lstrip", "rstrip", "normalized")
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if not plain or told["normalizer"] or any(t[f] for t in told["added_tokens"] for f in flags):
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        added = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.low, self.high = re.compile(LOW_WORD), re.compile("[^\0-ɏ]")
        self.gap = re.compile(r"(?<=\S) ")

    def of(self, text: str) -> Iterator[list[str]]:
        """The words of a text, in lists of bounded size."""
        for i, part in enumerate(self.added.split(text) if self.added else [text]):
            if i % 2:
                yield [part]
                continue
            at = 0
            while at < len(part):
                # No word goes on over the start of a run of white space, and none
                # looks back beyond it.
                gap = self.gap.search(part, at + PART_CHARS) if len(part) - at > PART_CHARS else None
                end = gap.start() if gap else len(part)
                yield self._cut(part[at:end])
                at = end

    def _cut(self, text: str) -> list[str]:
        if self.high.search(text) is None:
            return self.low.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def ids(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


class Memo:
    """Ids of words as little-endian 32-bit bytes; when a generation is full it
    becomes the old one, and words that are met again move on."""

    def __init__(self, words: Words):
        self.words, self.young, self.old = words, {}, {}

    def __call__(self, words: list[str]) -> list[bytes]:
        if len(self.young) > MEMO:
            self.young, self.old = {}, self.young
        new = [w for w in words if w not in self.young]
        self.young.update((w, self.old[w]) for w in new if w in self.old)
        new = [w for w in new if w not in self.old]
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            self.young.update((w, np.array(i, "<u4").tobytes()) for w, i in zip(part, self.words.ids(part)))
        return [self.young[w] for w in words]


def varints(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in seven bits a byte, the last byte of each below 128, and the sizes."""
    size = 1 + sum((numbers >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    start = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for k in range(5):
        has = np.flatnonzero(size > k)
        more = np.where(size[has] > k + 1, 128, 0)
        out[start[has] + k] = (numbers[has] >> 7 * k & 127) | more
    return out, size


def numbers_of(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = raw < 128
    if last.all():
        return raw.astype(np.int64)
    end = np.flatnonzero(last)
    start = np.concatenate([[0], end[:-1] + 1])
    shift = np.arange(len(raw)) - np.repeat(start, end - start + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * shift, start)


class Block:
    """Words of a block in the order of their numbers: frequent ones first, equally
    frequent ones by their first place. ``mark`` is the same for the same words."""

    def __init__(self, words: list[str], counts: np.ndarray, buckets: int):
        self.order = np.argsort(-counts, kind="stable")
        self.raw = [words[i].encode() for i in self.order.tolist()]
        self.mark = zlib.crc32(b"\0".join(self.raw))
        self.bucket = np.fromiter((zlib.crc32(w) % buckets for w in self.raw), np.int32, len(words))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows by block: the number of the block and its slices of batches."""
    part, k, size, held = TaskContext.get().partitionId() << 32, 0, 0, []
    for batch in batches:
        low = 0
        for i, n in enumerate(pc.utf8_length(batch.column(1)).to_pylist()):
            size += n
            if size >= BLOCK_CHARS:
                yield part + k, [*held, batch.slice(low, i + 1 - low)]
                k, size, held, low = k + 1, 0, [], i + 1
        if low < batch.num_rows:
            held.append(batch.slice(low))
    if held:
        yield part + k, held


ASKED = "block bigint, mark bigint, bucket int, data binary, sizes array<int>"


def asked_words(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """One row per block and bucket with the block's distinct words of that bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for number, slices in blocks(batches):
            seen: Counter = Counter()
            for s in slices:
                for text in s.column(1):
                    for found in words.of(text.as_py()):
                        seen.update(found)
            block = Block(list(seen), np.fromiter(seen.values(), np.int64, len(seen)), buckets)
            by = np.argsort(block.bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(block.bucket[by])) + 1
            for at in np.split(by, cuts) if len(by) else []:
                own = [block.raw[i] for i in at.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]), pa.array([block.mark]), pa.array([block.bucket[at[0]]]),
                        pa.array([b"".join(own)], pa.binary()),
                        pa.array([[len(w) for w in own]], pa.list_(pa.int32())),
                    ],
                    ["block", "mark", "bucket", "data", "sizes"],
                )

    return rows.mapInArrow(run, ASKED)


def encoded_words(asked: DataFrame, path: str, buckets: int) -> DataFrame:
    """The same rows with the words' ids, one after the other, in the place of the
    words. All rows of a bucket meet in one task, which encodes a word when it first
    comes; a word may be encoded again only where ``MEMO`` others came in between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(Words(path))
        for batch in batches:
            data, sizes = [], []
            for raw, lengths in zip(batch.column("data"), batch.column("sizes")):
                raw, ends = raw.as_py(), np.cumsum(lengths.values.to_numpy()).tolist()
                found = memo([raw[a:b].decode() for a, b in zip([0, *ends], ends)])
                data.append(np.frombuffer(b"".join(found), "<u4").astype(np.int32))
                sizes.append(np.fromiter((len(f) // 4 for f in found), np.int32, len(found)))
            kept = [batch.column(c) for c in ("block", "mark", "bucket")]
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (data, sizes)]
            yield pa.RecordBatch.from_arrays([*kept, *lists], ["block", "mark", "bucket", "ids", "sizes"])

    kind = "block bigint, mark bigint, bucket int, ids array<int>, sizes array<int>"
    return asked.repartition(buckets, "bucket").mapInArrow(run, kind)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``id`` and ``piece``, the bytes that the id stands for; one row per id."""
    from tokenizers import Tokenizer

    byte = byte_of()
    found = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    rows = [(i, bytes(map(byte.get, t)) if all(c in byte for c in t) else t.encode()) for t, i in found.items()]
    return spark.createDataFrame(rows, "id int, piece binary")


def sequences(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """One row per text with the numbers of its words in its block, and one per block
    with the buckets of its words."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for number, slices in blocks(batches):
            place: defaultdict = defaultdict()
            place.default_factory = place.__len__
            found: list[np.ndarray] = []
            lengths: list[int] = []
            for s in slices:
                for text in s.column(1):
                    n = 0
                    for part in words.of(text.as_py()):
                        found.append(np.fromiter(map(place.__getitem__, part), np.int32, len(part)))
                        n += len(part)
                    lengths.append(n)
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            del found
            block = Block(list(place), np.bincount(flat, minlength=len(place)), buckets)
            rank = np.empty(len(place), np.int32)
            rank[block.order] = np.arange(len(place))
            names = ["block", "mark", "bucket", "doc_id", "data", "sizes"]
            at = low = 0
            for s in slices:
                # Texts of about a million words at a time.
                own = lengths[at : at + s.num_rows]
                groups = np.cumsum(own) // 1_000_000
                for rows_of in np.split(np.arange(len(own)), np.flatnonzero(np.diff(groups)) + 1):
                    part, n = s.slice(int(rows_of[0]), len(rows_of)), len(rows_of)
                    words_in = np.cumsum([0, *own[rows_of[0] : rows_of[0] + n]])
                    data, size = varints(rank[flat[low : low + words_in[-1]]])
                    ends = np.concatenate([[0], np.cumsum(size)])[words_in].tolist()
                    low += int(words_in[-1])
                    cut = [data[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(number, n), pa.repeat(block.mark, n), pa.repeat(pa.scalar(TEXTS, pa.int32()), n),
                            part.column(0), pa.array(cut, pa.binary()), pa.nulls(n, pa.list_(pa.int32())),
                        ],
                        names,
                    )
                at += s.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.array([block.mark]), pa.array([BUCKETS], pa.int32()),
                    pa.nulls(1, slices[0].column(0).type), pa.nulls(1, pa.binary()),
                    pa.array([block.bucket], pa.list_(pa.int32())),
                ],
                names,
            )

    return rows.mapInArrow(run, f"block bigint, mark bigint, bucket int, doc_id {kind}, data binary, sizes array<int>")


class Found:
    """The ids and the bytes of each word of a block, by its number."""

    def __init__(self, buckets: np.ndarray, ids: dict[int, tuple[np.ndarray, np.ndarray]], piece: dict[int, bytes]):
        self.ids: list = [b""] * len(buckets)
        self.bytes: list = [b""] * len(buckets)
        by = np.argsort(buckets, kind="stable")
        for at in np.split(by, np.flatnonzero(np.diff(buckets[by])) + 1) if len(by) else []:
            bucket = int(buckets[at[0]])
            if bucket not in ids or len(ids[bucket][1]) != len(at):
                raise ValueError("the texts changed between two reads; write them to a table first")
            flat, sizes = ids[bucket]
            raw, pieces = flat.astype("<u4").tobytes(), list(map(piece.__getitem__, flat.tolist()))
            ends = np.cumsum(sizes).tolist()
            for i, a, b in zip(at.tolist(), [0, *ends], ends):
                self.ids[i] = raw[4 * a : 4 * b]
                self.bytes[i] = pieces[a] if b - a == 1 else b"".join(pieces[a:b])


def _text(raw: bytes) -> bytes:
    """As it is, or with U+FFFD for what is no UTF-8."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def placed(table: pa.Table) -> pa.Table:
    """``doc_id``, ``ids`` and ``decoded`` of the texts of one block."""
    kinds = table.column("bucket").combine_chunks().to_numpy()
    ids, piece, buckets = {}, {}, np.empty(0, np.int32)
    for i in np.flatnonzero(kinds != TEXTS).tolist():
        row = {c: table.column(c)[i] for c in ("ids", "sizes", "pieces")}
        lists = {c: np.asarray(row[c].values.to_numpy()) for c in ("ids", "sizes") if row[c].is_valid}
        if row["pieces"].is_valid:
            piece.update(zip(lists["ids"].tolist(), row["pieces"].as_py()))
        elif kinds[i] == BUCKETS:
            buckets = lists["sizes"]
        else:
            ids[int(kinds[i])] = (lists["ids"], lists["sizes"])
    found = Found(buckets, ids, piece)
    texts = table.filter(pa.array(kinds == TEXTS)).select(["doc_id", "data"])
    kind = [("doc_id", texts.schema.field(0).type), ("ids", pa.binary()), ("decoded", pa.string())]
    out = []
    for batch in texts.to_batches(max_chunksize=500):
        data = batch.column("data").to_pylist()
        numbers = numbers_of(b"".join(data)).tolist()
        raw = np.concatenate([np.frombuffer(d, np.uint8) for d in data])
        ends = np.cumsum(raw < 128)
        ends = [0, *np.concatenate([[0], ends])[np.cumsum([len(d) for d in data])].tolist()]
        own = [numbers[a:b] for a, b in zip(ends, ends[1:])]
        columns = [
            pa.array([b"".join(map(found.ids.__getitem__, n)) for n in own], pa.binary()),
            pa.array([_text(b"".join(map(found.bytes.__getitem__, n))) for n in own], pa.binary()).cast(pa.string()),
        ]
        out.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=pa.schema(kind)))
    return pa.Table.from_batches(out, pa.schema(kind))


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (little-endian 32-bit bytes) and ``decoded`` of every text.

    The ids are those of the tokenizers library for the byte-level vocabulary at
    ``path``, without special tokens of its own; a special token's string in a text is
    its id. ``decoded`` is made of the ids alone: bytes that are no UTF-8 become
    U+FFFD. A null or empty text has no ids and decodes to the empty text. Rows with
    equal or null ids of documents are encoded each on its own, an empty table gives
    an empty one, and other columns are not read. The texts are read twice; rows that
    change between the two reads raise an error.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    found = pin(encoded_words(asked_words(rows, path, buckets), path, buckets), "bpe-words")
    pieces = pin(vocabulary(spark, path), "bpe-vocabulary")  # so that its size is known to the join
    # Of each block as many as it has words at most, and as the vocabulary has ids.
    used = found.groupBy("block", "mark").agg(F.flatten(F.collect_list(F.array_distinct("ids"))).alias("_ids"))
    used = used.select("block", "mark", F.explode(F.array_distinct("_ids")).alias("id"))
    used = used.join(pieces, "id").groupBy("block", "mark").agg(F.collect_list(F.struct("id", "piece")).alias("_all"))
    used = used.select(
        "block", "mark", F.lit(BUCKETS).alias("bucket"), F.col("_all.id").alias("ids"), F.col("_all.piece").alias("pieces")
    )
    of_block = sequences(rows, path, buckets)
    all_rows = of_block.unionByName(found, allowMissingColumns=True).unionByName(used, allowMissingColumns=True)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return all_rows.groupBy("block", "mark").applyInArrow(placed, f"doc_id {kind}, ids binary, decoded string")
