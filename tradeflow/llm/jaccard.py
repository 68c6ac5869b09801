"""Exact Jaccard join of shingle sets in their metric space.

The Jaccard distance is a metric, and documents far from everything must not cost
anything. So the join runs in three steps.

1. *Loners.* Of 3/8 of all shingles, chosen by hash and so alike in every text, it
   is counted which occur in one set only. A set with more such shingles than the
   distance allows has no partner; most texts end here. Shingles travel as packed
   arrays of 4 bytes each; a hot one costs each task no more than any other.
2. *Candidates.* The sets left over, one per group of equal sets, are indexed by
   the shingles that they share with others, rare ones first and only as many as a
   partner cannot avoid. Two sets within the distance meet in one of these groups,
   and a shingle of very many texts makes a group of few of them.
3. *Regions.* In each group, documents with the most shared shingles become pivots
   and get their exact distances to the documents around them. Those within the
   distance join the pivot's component; each document stays in the region of its
   nearest pivot. What is outside the largest component of its group recurses with
   more pivots, against the documents that the triangle inequality leaves: of a
   common region's, those whose distances to its pivot differ by no more than the
   bound. A group ends when all its documents are connected, or all others have
   been its pivots; so every link between different components was looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tradeflow.llm.members import marked
from tradeflow.llm.shingles import batches_of, fingerprint, shingle_sets
from tradeflow.llm.workers import lean
from tradeflow.session import collect_garbage, drop_tables, noted, pin, pin_by

WORDS, PERCENT = 4, 85
SAMPLED, OF = 3, 8  # shingles that step 1 counts
GROWTH = 16  # pivots per group from round to round
SLACK = 1e-9
# A set's shared shingles as 1024 bits; two sets differ in one shingle at least for
# each bit in which these differ.
SKETCH = [f"b{i}" for i in range(16)]

KINDS = (
    "doc_id {id}, n bigint, fp binary, part bigint, place int, "
    "bucket int, keys binary, sizes binary, owners binary, places binary"
)


def _scan(docs: DataFrame, words: int, buckets: int) -> DataFrame:
    """One row per document, and packed sampled shingles by bucket.

    ``part`` numbers the slices of about a megabyte that the tasks work on, and
    ``place`` the documents in one. A packed row has the shingles' low 32 bits in the
    order of documents and, for these, the place, 64 bits of the fingerprint and in
    ``sizes`` how many of the shingles are theirs. So a row's size follows its shingles,
    however many buckets there are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "fp", "part", "place", "bucket", "keys", "sizes", "owners", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in batches_of(batch, 1):
                sets = list(shingle_sets([t or "" for t in rows.column(1).to_pylist()], words))
                prints = [fingerprint(s) for s in sets]
                m = len(sets)
                yield _record(
                    names,
                    rows.column(0),
                    [[len(s) for s in sets], prints, [part] * m, range(m), *[[None] * m] * 5],
                )
                owners = np.frombuffer(b"".join(p[:8] for p in prints), "<u8")
                chosen = [s[s % np.uint64(OF) < SAMPLED] for s in sets]
                keys = np.concatenate(chosen) if m else np.empty(0, np.uint64)
                places = np.repeat(np.arange(m, dtype="<u4"), [len(c) for c in chosen])
                bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                keys, places, bucket = keys[order].astype("<u4"), places[order], bucket[order]
                found, at = np.unique(bucket, return_index=True)
                ends = [*at[1:].tolist(), len(keys)]
                k = len(found)
                used = [np.unique(places[a:b], return_counts=True) for a, b in zip(at, ends)]
                yield _record(
                    names,
                    pa.nulls(k, rows.column(0).type),
                    [
                        [m] * k, [None] * k, [part] * k, [None] * k, found,
                        [keys[a:b].tobytes() for a, b in zip(at, ends)],
                        [size.astype("<u4").tobytes() for _, size in used],
                        [owners[place].tobytes() for place, _ in used],
                        [place.tobytes() for place, _ in used],
                    ],
                )
                part += 1

    return docs.select("doc_id", "text").mapInArrow(lean(run), KINDS.format(id=kind))


TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]


def _record(names, ids, columns) -> pa.RecordBatch:
    arrays = [pa.array(list(c), t) for c, t in zip(columns, TYPES)]
    return pa.RecordBatch.from_arrays([ids, *arrays], names)


def _lone_counts(blobs: pa.Table) -> pa.Table:
    """Per slice, how many of each document's shingles in this bucket occur in no
    other set."""
    keys, owners, own, sizes = [], [], [], []
    for k, a, o in zip(*(blobs.column(c).to_pylist() for c in ("keys", "sizes", "owners"))):
        size = np.frombuffer(a, "<u4")
        at = np.repeat(np.arange(len(size)), size)
        keys.append(np.frombuffer(k, "<u4"))
        owners.append(np.frombuffer(o, "<u8")[at])
        own.append(at)
        sizes.append(len(size))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1) != 0) if len(key) else np.empty(0, int)
    same = np.minimum.reduceat(owner[order], first) == np.maximum.reduceat(owner[order], first)
    lone = np.empty(len(key), bool)
    lone[order] = np.repeat(same, np.diff(first, append=len(key)))
    counts = []
    for flags, at, m in zip(np.split(lone, np.cumsum([len(k) for k in keys])[:-1]), own, sizes):
        counts.append(np.bincount(at[flags], minlength=m).astype("<u4").tobytes())
    return pa.table({"part": blobs.column("part"), "places": blobs.column("places"), "counts": pa.array(counts, pa.binary())})


def _sum_counts(rows: pa.Table) -> pa.Table:
    place, count = (np.frombuffer(b"".join(rows.column(c).to_pylist()), "<u4") for c in ("places", "counts"))
    total = np.bincount(place, count)
    part = [rows.column("part")[0].as_py()] * len(total)
    return pa.table(
        {
            "part": pa.array(part, pa.int64()),
            "place": pa.array(np.arange(len(total)), pa.int32()),
            "lone": pa.array(total.astype(np.int64), pa.int64()),
        }
    )


def _may_link(percent: int, a: Column, b: Column, common: Column) -> Column:
    """Whether sets of these sizes with at most ``common`` in common reach the bound."""
    return F.lit(100) * common >= F.lit(percent) * (a + b - common)


def candidates(scanned: DataFrame, percent: int) -> DataFrame:
    """``fp``, ``rep`` and ``n`` of each different set that may have a partner."""
    blobs = scanned.filter("keys IS NOT NULL").select("part", "bucket", "keys", "sizes", "owners", "places")
    lone = (
        blobs.groupBy("bucket")
        .applyInArrow(_lone_counts, "part bigint, places binary, counts binary")
        .groupBy("part")
        .applyInArrow(_sum_counts, "part bigint, place int, lone bigint")
    )
    docs = scanned.filter("fp IS NOT NULL AND n > 0").select("doc_id", "n", "fp", "part", "place")
    rows = docs.join(lone, ["part", "place"], "left").withColumn("lone", F.coalesce("lone", F.lit(0)))
    common = F.col("n") - F.col("lone")
    open_ = rows.filter(_may_link(percent, F.col("n"), common, common))
    return open_.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batches_of(batch, 0):
                sets = list(shingle_sets([t or "" for t in rows.column(0).to_pylist()], words))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([fingerprint(s) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["fp", "shingles"],
                )

    return docs.select("text").mapInArrow(lean(run), "fp binary, shingles array<bigint>")


def shared_sets(docs: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """``fp``, ``rep``, ``n`` and ``shared``: the candidates' shingles that other
    candidates have too, for those that have enough of them."""
    # Null ids too: a set may have no other; rows of other sets go with the join on fp.
    reps = found.select(F.col("rep").alias("_rep")).distinct()
    # Most texts are no candidate's, and do not move for the join that makes sure.
    maybe = marked(docs, "doc_id", found.select("rep"), "jaccard-bits").filter("_maybe").select("doc_id", "text")
    texts = maybe.join(reps, F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi")
    sets = _sets(texts, words).dropDuplicates(["fp"]).join(found.select("fp"), "fp", "left_semi")
    each = sets.select("fp", F.explode("shingles").alias("s"))
    often = each.withColumn("_df", F.count(F.lit(1)).over(Window.partitionBy("s"))).filter("_df > 1")
    lists = often.groupBy("fp").agg(F.sort_array(F.collect_list(F.struct("_df", "s"))).alias("shared"))
    lists = lists.withColumn("shared", F.transform("shared", lambda x: x["s"]))
    shared = lists.join(found, "fp").withColumn("m", F.size("shared").cast("bigint"))
    shared = shared.filter(_may_link(percent, F.col("n"), F.col("m"), F.col("m")))
    # Whole lists are met twice in each round: bucketed, they do not move.
    return pin_by(_sketched(shared), "fp", "jaccard-shared")


def _sketched(shared: DataFrame) -> DataFrame:
    """Adds the columns of ``SKETCH``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((batch.num_rows, len(SKETCH)), np.int64)
            for row, s in zip(bits, batch.column("shared")):
                s = s.values.to_numpy()
                np.bitwise_or.at(row, (s >> 14) & (len(SKETCH) - 1), np.int64(1) << ((s >> 8) & 63))
            columns = [*batch.columns, *[pa.array(c, pa.int64()) for c in bits.T]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *SKETCH])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in shared.schema]
    return shared.mapInArrow(lean(run), ", ".join([*kinds, *[f"{b} bigint" for b in SKETCH]]))


def index(shared: DataFrame, percent: int) -> DataFrame:
    """``s``, ``fp`` and ``pos``: a document under the first of its shared shingles, in
    the order of frequency, that a partner has at least one of."""
    needed = F.ceil(F.col("n") * F.lit(percent) / F.lit(100)).cast("int")
    prefix = F.slice("shared", 1, F.size("shared") - needed + 1)
    rows = shared.select("fp", F.posexplode(prefix).alias("pos", "s"))
    # Shingles of the same documents make the same pairs, so the first one of them does
    # for all: it is ahead of the others in each of these documents.
    members = [F.bit_xor(F.xxhash64(F.lit(mark), "fp")).alias(f"_{mark}") for mark in ("first", "second")]
    met = rows.groupBy("s").agg(F.count(F.lit(1)).alias("_n"), F.sum("pos").alias("_place"), *members)
    first = F.min(F.struct("_place", "s"))["s"].alias("s")
    met = met.filter("_n > 1").groupBy("_n", "_first", "_second").agg(first).select("s")
    return rows.join(met, "s")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``v`` and the smallest ``label`` reachable over the edges (``a``, ``b``).

    Each round takes the neighbours' smallest label and then that label's own, so
    stars end after two rounds and paths after about the logarithm of their length.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = pin(both, "component-edges")
    labels = pin(nodes.select("v", F.col("v").alias("label")), "component-round")
    while True:
        around = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("label").alias("_near"))
        near = labels.join(around, labels["v"] == around["a"], "left").select(
            "v", F.col("label").alias("_was"), F.least("label", F.coalesce("_near", "label")).alias("label")
        )
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("_far"))
        step = near.join(jump, "label", "left").select(
            "v", "_was", F.least("label", F.coalesce("_far", "label")).alias("label")
        )
        labels = pin(step, "component-round")
        collect_garbage(nodes.sparkSession)
        if labels.filter("label != _was").isEmpty():
            return labels.select("v", "label")


def link_components(shared: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """``fp`` and ``comp``: equal for sets that links connect."""
    members = shared.select(
        "fp", "n", "m", *SKETCH, F.col("fp").alias("comp"),
        F.lit(None).cast("binary").alias("cell"), F.lit(None).cast("double").alias("dist"),
    )
    members, per_group, links = pin(members, "jaccard-members"), 1, []
    groups = groups.withColumn("done", F.lit(False))
    while True:
        state = groups.join(members, "fp")
        by_comp = state.groupBy("s", "comp").agg(F.count(F.lit(1)).alias("_n"))
        home = by_comp.groupBy("s").agg(
            F.max(F.struct("_n", "comp"))["comp"].alias("_home"), F.count(F.lit(1)).alias("_comps")
        )
        # Groups that are one component are finished.
        state = pin(state.join(home.filter("_comps > 1").drop("_comps"), "s"), "jaccard-groups")
        open_ = state.filter("comp != _home AND NOT done")
        order = Window.partitionBy("s").orderBy(F.desc(F.col("m") / F.col("n")), F.xxhash64("fp"), "fp")
        pivots = open_.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_group)
        # A pivot of one group asks in that group only: most documents are the pivot of some
        # group, and asking in all of theirs would compare a large cluster with itself.
        pivots = pin(pivots.select("s", "fp"), "jaccard-pivots")
        if pivots.isEmpty():
            break
        found = pin(_distances(state, pivots, shared, percent), "jaccard-distances")
        union = F.col("n") + F.col("p_n") - F.col("common")
        close = found.filter(F.lit(100) * F.col("common") >= F.lit(percent) * union)
        links.append(close.select("fp", "p_fp"))
        members = _advance(members, pivots, found, close)
        asked = state.select("s", "fp", "pos", "done").join(pivots.withColumn("_asked", F.lit(True)), ["s", "fp"], "left")
        groups = asked.select("s", "fp", "pos", (F.col("done") | F.col("_asked").isNotNull()).alias("done"))
        per_group *= GROWTH
        collect_garbage(shared.sparkSession)
    return _united(members, links)


def _united(members: DataFrame, links: list[DataFrame]) -> DataFrame:
    """The components of all links, beyond those already in ``comp``."""
    comp = members.select("fp", "comp")
    if not links:
        return comp
    edges = pin(_edges(comp, reduce(DataFrame.union, links)), "jaccard-edges")
    nodes = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
    labels = components(nodes, edges).select(F.col("v").alias("comp"), "label")
    return comp.join(labels, "comp", "left").select("fp", F.coalesce("label", "comp").alias("comp"))


def _edges(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Links between different components, as pairs ``a``, ``b`` of these."""
    ends = links.join(comp, "fp").select(F.col("comp").alias("a"), F.col("p_fp").alias("fp"))
    return ends.join(comp, "fp").select("a", F.col("comp").alias("b")).filter("a != b").distinct()


def _distances(state: DataFrame, pivots: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Exact common shingles of the pivots and the documents of their groups, but for
    those that cannot link. Shown by the triangle inequality, for documents of one
    region; by the number of shingles from the common one on; or by sketches."""
    own = ["fp", "n", "m", "pos", "comp", "cell", "dist", *SKETCH]
    asks = state.join(pivots, ["s", "fp"]).select("s", *[F.col(c).alias(f"p_{c}") for c in own])
    sizes = F.col("n") + F.col("p_n")
    near = F.abs(F.col("dist") - F.col("p_dist")) <= 1.0 - percent / 100.0 + SLACK
    window = F.coalesce((F.col("cell") != F.col("p_cell")) | near, F.lit(True))
    rest = F.least(F.col("m") - F.col("pos"), F.col("p_m") - F.col("p_pos"))
    differ = sizes - F.col("m") - F.col("p_m")
    for b in SKETCH:
        differ = differ + F.bit_count(F.col(b).bitwiseXOR(F.col(f"p_{b}")))
    pairs = asks.join(state, "s").filter(
        (F.col("comp") != F.col("p_comp"))
        & (F.lit(100 + percent) * rest >= F.lit(percent) * sizes)
        & (F.lit(100 + percent) * differ <= F.lit(100 - percent) * sizes)
        & window
    )
    pairs = pairs.groupBy("p_fp", "fp").agg(F.first("n").alias("n"), F.first("p_n").alias("p_n"))
    theirs = shared.select("fp", F.col("shared").alias("_theirs"))
    own_set = shared.select(F.col("fp").alias("p_fp"), F.col("shared").alias("_own"))
    both = pairs.join(theirs, "fp").join(own_set, "p_fp")
    common = F.size(F.array_intersect("_own", "_theirs")).cast("bigint")
    return both.select("p_fp", "fp", "n", "p_n", common.alias("common"))


def _advance(members: DataFrame, pivots: DataFrame, found: DataFrame, close: DataFrame) -> DataFrame:
    """Unites components over the new links, and moves documents to the region of
    the nearest pivot.

    Stars, which is what pivots make, unite at once; what takes more steps is left
    to the end. Until then equal components are surely connected, and only pairs of
    different ones are compared, so nothing is lost.
    """
    edges = pin(_edges(members.select("fp", "comp"), close.select("fp", "p_fp")), "jaccard-edges")
    both = edges.union(edges.select("b", "a")).distinct()
    labels = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("_b"))
    labels = labels.select("v", F.least("v", "_b").alias("label"))
    ahead = labels.select(F.col("v").alias("b"), "label")
    labels = both.join(ahead, "b").groupBy(F.col("a").alias("comp")).agg(F.min("label").alias("_comp"))
    labels = labels.select("comp", F.least("comp", "_comp").alias("_comp"))
    union = F.col("n") + F.col("p_n") - F.col("common")
    distance = F.lit(1.0) - F.col("common") / union
    nearest = found.groupBy("fp").agg(F.min(F.struct(distance.alias("d"), F.col("p_fp").alias("p"))).alias("_near"))
    centres = pivots.select("fp").distinct().withColumn("_centre", F.lit(True))
    rows = members.join(labels, "comp", "left").join(nearest, "fp", "left").join(centres, "fp", "left")
    closer = F.col("_near").isNotNull() & (F.col("dist").isNull() | (F.col("_near.d") < F.col("dist")))
    centre = F.col("_centre").isNotNull()
    return pin(
        rows.select(
            "fp", "n", "m", *SKETCH, F.coalesce("_comp", "comp").alias("comp"),
            F.when(centre, F.col("fp")).when(closer, F.col("_near.p")).otherwise(F.col("cell")).alias("cell"),
            F.when(centre, F.lit(0.0)).when(closer, F.col("_near.d")).otherwise(F.col("dist")).alias("dist"),
        ),
        "jaccard-members",
    )


def jaccard_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document.

    Two documents link when their shingle sets' intersection is at least ``percent``
    hundredths of the union; ``component_id`` is the smallest id reachable over
    links. A text with fewer words than a shingle is one shingle; one that is null
    or has no word has none and links with nothing. Equal sets are one class, so
    copies, ties and repeated rows cost one row each. Null ids take part but name
    no component unless all its ids are null. An empty table gives an empty one;
    other columns are not read. Shingles are compared as 64-bit hashes.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with noted() as packed:
        scanned = pin(_scan(rows, words, buckets), "jaccard-scan")
    found = pin(candidates(scanned, percent), "jaccard-candidates")
    known = pin(scanned.filter("fp IS NOT NULL").select("doc_id", "n", "fp"), "jaccard-documents")
    drop_tables(spark, packed)
    collect_garbage(spark)
    shared = shared_sets(rows, found, words, percent)
    groups = pin(index(shared, percent), "jaccard-index")
    comps = link_components(shared, groups, percent)

    linked = shared.select("fp", "rep").join(comps, "fp")
    heads = linked.groupBy("comp").agg(F.min("rep").alias("head"))
    heads = linked.join(heads, "comp").select("fp", "head")
    classes = known.filter("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = classes.join(heads, "fp", "left").select("fp", F.coalesce("head", "least").alias("component_id"))
    out = known.filter("n > 0").join(classes, "fp", "left").select("doc_id", "n", "component_id")
    alone = known.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
