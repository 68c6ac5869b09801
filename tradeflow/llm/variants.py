"""Spelling variants by a dictionary of pairs of trie nodes.

The words are sorted, so the new nodes of a word in the trie of all prefixes are those
beyond what it shares with the word before: they are numbered on the way through each
sorted slice, and the path that a slice shares with the ones before it is put in
afterwards, one row per slice. Sorted by their reversed letters the words number the
trie of suffixes in the same way. A word that leaves out its letter ``i`` is then the
pair of integers (node of what is before, node of what is after), and a word with room
for a letter at ``i`` is the pair (node of what is before, node of the rest). Equal
pairs are exactly the words that differ by one replaced, deleted or inserted letter,
so nothing is left to verify. A pair has at most as many words as there are letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tradeflow.llm.common import ascii_lower
from tradeflow.session import pin

MIN_LENGTH = 5
MIN_COUNT = 3
SLICE_BITS = 40  # of a number: the place in its slice; the slice is above


def typed_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of the words that the texts hold ``MIN_COUNT`` times or more.

    A word is a run of letters of at least ``MIN_LENGTH`` with only A-Z lower-cased.
    Of one in 97, by the hash of document and run, one letter is left out.
    """
    runs = F.regexp_extract_all(ascii_lower(F.col(f"`{text}`").cast("string")), F.lit(rf"[a-zÀ-ÿ]{{{MIN_LENGTH},}}"), 0)
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("_run"))
    rows = rows.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary")))
    at = F.pmod(F.col("_h"), F.length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    words = rows.select(F.when(F.col("_h") % 97 == 0, cut).otherwise(F.col("_run")).alias("word"))
    words = words.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.filter(F.col("n") >= MIN_COUNT)


def _shared(a: str, b: str) -> int:
    """Number of first letters that both have."""
    if b.startswith(a):
        return len(a)
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to sorted keys their place, their nodes of each depth, and the number of
    letters shared with the slice's first key. The root is 0."""
    part = TaskContext.get().partitionId()
    base, place, nodes = part << SLICE_BITS, 0, 0
    first, before, path = None, "", [0]
    for batch in batches:
        paths, places, shared = [], [], []
        for key in batch.column("_key").to_pylist():
            first = key if first is None else first
            path = path[: _shared(before, key) + 1]
            new = len(key) + 1 - len(path)
            path = path + [base + nodes + k for k in range(1, new + 1)]
            nodes += new
            paths.append(path)
            places.append(base + place)
            shared.append(_shared(first, key))
            place, before = place + 1, key
        more = [pa.array(x, t) for x, t in ((paths, pa.list_(pa.int64())), (places, pa.int64()), (shared, pa.int32()))]
        slice_of = pa.repeat(pa.scalar(part, pa.int32()), batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns, *more, slice_of], [*batch.schema.names, "_path", "_place", "_same", "_slice"])


def trie(words: DataFrame, key: Column, nodes: str, place: str | None = None) -> DataFrame:
    """``words`` with the numbers of the nodes on the way along ``key``, a text that is
    distinct: entry ``d`` is the node of its first ``d`` letters. ``place`` is the
    name of a column for the place in the order of keys, if wanted."""
    spark = words.sparkSession
    rows = words.withColumn("_key", key)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = rows.repartitionByRange("_key").sortWithinPartitions("_key").mapInArrow(
        _number, f"{kinds}, _path array<bigint>, _place bigint, _same int, _slice int"
    )
    rows = pin(rows, f"trie-{nodes}")
    last = F.max_by(F.struct("_key", "_path", "_same"), "_place")
    ends = rows.groupBy("_slice").agg(F.min_by("_key", "_place").alias("first"), last.alias("last"))
    # One row per slice: what its first key shares with the keys before it.
    taken, before, path = [], "", [0]
    for row in sorted(ends.collect(), key=lambda r: r["_slice"]):
        path = path[: _shared(before, row["first"]) + 1]
        taken.append((row["_slice"], path))
        own, of_earlier = row["last"], min(row["last"]["_same"], len(path) - 1)
        before, path = own["_key"], path[: of_earlier + 1] + own["_path"][of_earlier + 1 :]
    fixed = spark.createDataFrame(taken, "_slice int, _taken array<bigint>")
    rows = rows.join(fixed, "_slice")
    known = F.least(F.col("_same") + 1, F.size("_taken"))
    whole = F.concat(F.slice("_taken", F.lit(1), known), F.slice("_path", known + 1, F.size("_path")))
    more = [F.col("_place").alias(place)] if place else []
    return rows.select(*words.columns, whole.alias(nodes), *more)


def _pairs(words: DataFrame) -> DataFrame:
    """One row per word and pair of nodes, as ``_m``: less than nothing its count, its
    id, whether it has a letter there, and whether the pair counts for a letter more
    or less. Of equal letters in a row only the first counts there, since leaving out
    any of them gives the same word."""
    n = F.length("word")
    letter = F.col("_i") < n
    starts = (F.col("_i") == 0) | (F.substring("word", F.col("_i"), F.lit(1)) != F.substring("word", F.col("_i") + 1, F.lit(1)))

    def pairs(last: Column, skip: Column, starts: Column) -> DataFrame:
        rows = words.withColumn("_i", F.explode(F.sequence(F.lit(0), last)))
        after = F.element_at("suffixes", n - F.col("_i") + F.when(skip, 0).otherwise(1))
        member = F.struct((-F.col("n")).alias("neg"), F.col("id"), skip.alias("skips"), starts.alias("one"))
        return rows.select(F.element_at("prefixes", F.col("_i") + 1).alias("_p"), after.alias("_s"), member.alias("_m"))

    return pairs(n - 1, F.lit(True), starts).unionByName(pairs(n, F.lit(False), F.lit(True)))


def neighbours(words: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best`` (less than nothing the count, and the id) of
    the words that have near ones. ``words`` has ``id, word, n, prefixes, suffixes``."""
    groups = _pairs(words).groupBy("_p", "_s").agg(F.sort_array(F.collect_list("_m")).alias("_all"))
    groups = groups.filter(F.size("_all") > 1).select(
        "_all",
        F.filter("_all", lambda m: m["skips"]).alias("_skips"),
        F.filter("_all", lambda m: ~m["skips"]).alias("_whole"),  # one at most
    )
    groups = groups.withColumn("_ones", F.filter("_skips", lambda m: m["one"]))
    own = F.col("_own")
    found = groups.select("_skips", "_whole", "_ones", F.explode("_all").alias("_own"))
    # Sorted, so the best other one is the first or the second.
    other = F.when(F.get("_skips", F.lit(0))["id"] != own["id"], F.get("_skips", F.lit(0))).otherwise(F.get("_skips", F.lit(1)))
    near = F.when(own["skips"], F.size("_skips") - 1 + F.when(own["one"], F.size("_whole")).otherwise(0)).otherwise(F.size("_ones"))
    longer = F.when(own["one"] & own["skips"], F.get("_whole", F.lit(0))).when(~own["skips"], F.get("_ones", F.lit(0)))

    def key(m: Column) -> Column:
        return F.when(m.isNotNull(), F.struct(m["neg"].alias("neg"), m["id"].alias("id")))

    best = F.array_min(F.array_compact(F.array(key(F.when(own["skips"], other)), key(longer))))
    found = found.select(own["id"].alias("id"), near.alias("_near"), best.alias("_best")).filter("_near > 0")
    return found.groupBy("id").agg(F.sum("_near").cast("bigint").alias("n_near"), F.min("_best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``id`` and ``root``: the last of the forms that follow each other from ``id``.

    ``forms`` has ``id`` and ``form``; ids without a form are left out. A form is at
    least twice as frequent, so a way has at most 63 steps, and each round doubles
    the steps that are behind it.
    """
    now = pin(forms.select("id", F.col("form").alias("root")), "variants-roots")
    while True:
        on = now.select(F.col("id").alias("_at"), F.col("root").alias("_to"))
        after = now.join(on, F.col("root") == F.col("_at"), "left")
        after = pin(after.select("id", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("_moved")), "variants-roots")
        now = after.select("id", "root")
        if after.filter("_moved").isEmpty():
            return now


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each frequent word of the texts.

    Two words are near if one replaced, inserted or deleted letter makes them equal.
    The form is the near word with the greatest ``n``, the smallest of equal ones, if
    it has at least twice the word's own; ``root`` is where forms lead to. A null text
    has no words; a null id counts as an empty one; rows with equal ids or texts all
    count; an empty table gives an empty one; other columns are not read.
    """
    words = pin(typed_words(docs, doc_id, text), "variants-words")
    words = trie(words, F.col("word"), "prefixes", place="id")
    words = pin(trie(words, F.reverse("word"), "suffixes"), "variants-tries")
    found = neighbours(words)
    frequent = -F.col("best.neg") >= 2 * F.col("n")
    found = words.select("id", "word", "n").join(found, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(frequent, F.col("best.id")).alias("form"), F.when(frequent, -F.col("best.neg")).alias("form_n"),
    )
    found = pin(found, "variants-found")
    ends = roots(found.filter("form IS NOT NULL").select("id", "form"))

    def named(id_: str, name: str) -> DataFrame:
        return found.select(F.col("id").alias(id_), F.col("word").alias(name))

    rows = found.join(ends, "id", "left").withColumnsRenamed({"form": "_form", "root": "_root"})
    rows = rows.join(named("_form", "form"), "_form", "left").join(named("_root", "root"), "_root", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
