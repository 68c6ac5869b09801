"""Ranked lexical search by range-maximum tables over posting lists.

The rows that a task reads form shards of bounded size. A shard's documents are put
in the order of their most frequent term and their length, so that those of similar
impacts lie together, and each term has the list of its documents and counts. A first
pass over the lists gives the statistics of the corpus; with these every posting has
its exact impact, and a sparse table over each list answers which posting of any
range has the greatest one. A query's search goes best first over intervals of
documents: the answers of its terms, summed up, bound the score of every document in
the interval. The interval with the highest bound is split at the document of its
greatest impact, which is scored exactly, or scored whole if it holds few postings.
It ends when no bound reaches the last of the best documents found. The best of all
shards are then ranked together.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tradeflow.llm.common import LOWER, UPPER, ascii_lower, power_of_two
from tradeflow.session import pin

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
SHARD_CHARS = 16_000_000  # of the texts of a shard; a longer text is a shard of its own
SHARD_DOCS = 1 << 18
ITEMS = 512  # queries, on average, that search a shard together
LEAF = 4096  # postings of an interval that is scored whole

# Of ASCII only digits and letters stay, lower-cased; bytes of other characters stay.
_KEPT = {ord(c): ord(c) for c in "0123456789" + LOWER} | {ord(u): ord(c) for u, c in zip(UPPER, LOWER)}
_BYTES = bytes(_KEPT.get(b, 0x20) if b < 0x80 else b for b in range(256))


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows by shard: its number and its slices of batches."""
    part, k, docs, chars, held = TaskContext.get().partitionId() << 32, 0, 0, 0, []
    for batch in batches:
        low = 0
        for i, n in enumerate(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()):
            docs, chars = docs + 1, chars + n
            if chars >= SHARD_CHARS or docs >= SHARD_DOCS:
                yield part + k, [*held, batch.slice(low, i + 1 - low)]
                k, docs, chars, held, low = k + 1, 0, 0, [], i + 1
        if low < batch.num_rows:
            held.append(batch.slice(low))
    if held:
        yield part + k, held


def _index(slices: list[pa.RecordBatch]):
    """The shard's document ids and lengths in its order of documents, and its terms
    with their documents and counts."""
    place: defaultdict = defaultdict()
    place.default_factory = place.__len__
    found = []
    for s in slices:
        for text in s.column(1):
            terms = (text.as_py() or "").encode().translate(_BYTES).split()
            found.append(np.fromiter(map(place.__getitem__, terms), np.int64, len(terms)))
    lengths = np.array([len(f) for f in found], np.int64)
    n, terms = len(found), len(place)
    doc = np.repeat(np.arange(n), lengths)
    keys, counts = np.unique(np.concatenate(found) * n + doc, return_counts=True)
    term, doc = keys // n, keys % n
    most = np.zeros(n, np.int64)  # the count and the number of the most frequent term
    np.maximum.at(most, doc, counts * max(1, terms) + term)
    order = np.lexsort((lengths, most % max(1, terms)))
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    doc = place_of[doc]
    by = np.lexsort((doc, term))
    ids = pa.concat_arrays([s.column(0) for s in slices]).take(pa.array(order))
    starts = np.searchsorted(term, np.arange(terms + 1))
    return ids, lengths[order], list(place), doc[by].astype("<i4"), counts[by].astype("<i4"), starts


def postings(docs: DataFrame, text: str) -> DataFrame:
    """One row per shard and term with its documents and counts; one per shard,
    without a term, with the shard's document ids and lengths."""
    rows = docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["shard", "term", "docs", "counts", "ids", "lengths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, slices in shards(batches):
            ids, lengths, terms, docs, counts, starts = _index(slices)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([lengths], pa.list_(pa.int64())),
                ],
                names,
            )
            ends = pa.array(4 * starts, pa.int32())
            for low in range(0, len(terms), 10_000):
                n = min(10_000, len(terms) - low)
                lists = [
                    pa.Array.from_buffers(pa.binary(), n, [None, ends.slice(low, n + 1).buffers()[1], pa.py_buffer(x)], offset=low)
                    for x in (docs, counts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(number, n), pa.array([t.decode() for t in terms[low : low + n]]), *lists,
                        pa.nulls(n, pa.list_(ids.type)), pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names,
                )

    return rows.mapInArrow(run, f"shard bigint, term string, docs binary, counts binary, ids array<{kind}>, lengths array<bigint>")


def sparse_table(impacts: np.ndarray, longest: int) -> np.ndarray:
    """Row k holds for each place the place of the greatest of the next 2**k impacts.
    The lists lie one after the other; a range inside one never looks beyond it."""
    n = len(impacts)
    table = np.empty((power_of_two(longest) + 1, n), np.int32)
    table[0] = np.arange(n)
    for k in range(1, len(table)):
        half = 1 << (k - 1)
        a, b = table[k - 1][: max(0, n - half)], table[k - 1][half:]
        table[k] = table[k - 1]
        table[k][: len(b)] = np.where(impacts[a] >= impacts[b], a, b)
    return table


class Shard:
    """Posting lists with exact impacts. ``keys`` are list and document in one number."""

    def __init__(self, ids: list, weights: list[int], docs: list[bytes], counts: list[bytes], norms: np.ndarray):
        self.ids = ids
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))
        self.rank = np.empty(len(ids), np.int64)  # place among the ids, for ties
        self.rank[order] = np.arange(len(ids))
        sizes = np.array([len(d) // 4 for d in docs], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.docs = np.frombuffer(b"".join(docs), "<i4").astype(np.int64)
        tf = np.frombuffer(b"".join(counts), "<i4").astype(np.int64)
        weight = np.repeat(np.array(weights, np.int64), sizes)
        self.impacts = weight * (1_000_000_000 * tf // (1000 * tf + 20 * norms[self.docs]))
        self.keys = np.repeat(np.arange(len(docs)), sizes) << 32 | self.docs
        self.table = sparse_table(self.impacts, int(sizes.max(initial=1)))

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each range from ``a`` to before ``b``."""
        k = np.frexp((b - a).astype(np.float64))[1] - 1
        left, right = self.table[k, a], self.table[k, b - (1 << k)]
        return np.where(self.impacts[left] >= self.impacts[right], left, right)

    def best(self, lists: np.ndarray, top: int) -> list[tuple[int, int]]:
        """(document, score) of the ``top`` best ones, equal scores by smaller id."""
        found_docs, found = np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[tuple[int, int]] = []  # scored one by one, not yet among the found
        last = 1  # the least score that can still be among the best
        queue: list[tuple] = []

        def put(low: int, high: int, lists: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            full = b > a
            if not full.all():
                lists, a, b = lists[full], a[full], b[full]
            if len(a):
                at = self.greatest(a, b)
                impacts = self.impacts[at]
                bound = int(impacts.sum())
                if bound >= last:
                    split = int(self.docs[at[impacts.argmax()]])
                    heapq.heappush(queue, (-bound, low, high, split, lists, a, b))

        def merge(docs: np.ndarray, scores: np.ndarray) -> None:
            nonlocal found_docs, found, last
            more = [np.array(x, np.int64) for x in zip(*held)] if held else [docs[:0], docs[:0]]
            held.clear()
            docs, scores = np.concatenate([found_docs, more[0], docs]), np.concatenate([found, more[1], scores])
            fit = scores >= last
            docs, scores = docs[fit], scores[fit]
            by = np.lexsort((self.rank[docs], -scores))[:top]
            found_docs, found = docs[by], scores[by]
            if len(found) == top:
                last = max(last, int(found[-1]))

        none = np.empty(0, np.int64)
        put(0, len(self.ids), lists, self.starts[lists], self.starts[lists + 1])
        while queue and -queue[0][0] >= last:
            _, low, high, split, lists, a, b = heapq.heappop(queue)
            if int((b - a).sum()) <= LEAF:
                # Places of all postings of the interval.
                size = b - a
                at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                docs, of = np.unique(self.docs[at], return_inverse=True)
                scores = np.zeros(len(docs), np.int64)
                np.add.at(scores, of, self.impacts[at])
                merge(docs, scores)
                continue
            key = lists << 32 | split
            middle = np.clip(np.searchsorted(self.keys, key), a, b)
            has = middle < b
            has[has] = self.keys[middle[has]] == key[has]
            held.append((split, int(self.impacts[middle[has]].sum())))
            if len(held) >= top:
                merge(none, none)
            put(low, split, lists, a, middle)
            put(split + 1, high, lists, middle + has, b)
        merge(none, none)
        return list(zip(found_docs.tolist(), found.tolist()))


def norms_of(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Per document 50 and its length in halves of a hundredth of the mean."""
    if int(lengths.max(initial=0)) * 50 * n_docs < 1 << 63:
        return 50 + 50 * lengths * n_docs // max(1, n_terms)
    return np.array([50 + 50 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, text: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each query's ``top`` best documents.

    ``queries`` has ``item_id`` and ``text``; rows with an equal id are one query with
    the terms of all of them. A query without terms that occur, and a null text, has
    no rows. Documents with equal ids or texts are ranked each on its own; equal
    scores rank by ascending id, a null id first. Ids are numbers or strings. An empty
    table on either side gives an empty result; other columns are not read.
    """
    lists = postings(docs, text)
    doc_kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (queries, "item_id")))
    terms = F.regexp_extract_all(ascii_lower(F.col("text").cast("string")), F.lit(TERM), 0)
    asked = pin(queries.select("item_id", F.explode(terms).alias("term")).distinct(), "lexical-asked")
    wanted = pin(asked.select(F.col("term").alias("_asked")).distinct(), "lexical-terms")
    lists = lists.join(wanted, F.col("term") == F.col("_asked"), "left")
    lists = pin(lists.filter("term IS NULL OR _asked IS NOT NULL").drop("_asked"), "lexical-lists")
    of_docs = lists.filter("term IS NULL")
    add = lambda s, x: s + x
    total = F.aggregate("lengths", F.lit(0).cast("bigint"), add)
    some = F.size(F.filter("lengths", lambda x: x > 0))
    n_docs, n_terms = of_docs.agg(F.coalesce(F.sum(some), F.lit(0)), F.coalesce(F.sum(total), F.lit(0))).first()
    df = lists.filter("term IS NOT NULL").groupBy("term").agg((F.sum(F.octet_length("docs")) / 4).alias("_df"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("_df") + 1))).cast("bigint")
    blocks = -(-asked.select("item_id").distinct().count() // ITEMS) or 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")
    # About ``ITEMS`` queries share a row.
    asked = asked.join(df, "term").groupBy("term", block).agg(
        F.first(weight).alias("weight"), F.collect_list(F.struct("item_id")).alias("items")
    )
    rows = lists.filter("term IS NOT NULL").select("shard", "term", "docs", "counts").join(asked, "term").drop("term")
    each = of_docs.select("shard", "ids", "lengths", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    rows = rows.unionByName(each, allowMissingColumns=True)
    names = ["item_id", "doc_id", "score"]

    def run(table: pa.Table) -> pa.Table:
        own = table.filter(pc.is_valid(table.column("ids")))
        table = table.filter(pc.is_valid(table.column("docs")))
        of_query = defaultdict(list)
        for i, items in enumerate(table.column("items").to_pylist()):
            for item in items:
                of_query[item["item_id"]].append(i)
        shard = Shard(
            own.column("ids")[0].as_py(), table.column("weight").to_pylist(),
            table.column("docs").to_pylist(), table.column("counts").to_pylist(),
            norms_of(np.asarray(own.column("lengths")[0].values.to_numpy()), n_docs, n_terms),
        )
        out = [(q, shard.ids[d], s) for q, at in of_query.items() for d, s in shard.best(np.array(at, np.int64), top)]
        kinds = [table.schema.field("items").type.value_type.field(0).type, own.schema.field("ids").type.value_type, pa.int64()]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    found = rows.groupBy("shard", "block").applyInArrow(run, f"item_id {item_kind}, doc_id {doc_kind}, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return found.select("item_id", "rank", "doc_id", "score")
