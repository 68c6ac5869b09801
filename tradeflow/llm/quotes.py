"""Quotations in messages, linked to the messages they come from.

A quoted passage is a paragraph of lines with equally many ``>``. Its text, without
line breaks and case, is hashed, and so is each of its lines; originals are indexed
by the same hashes of their own paragraphs and lines, and the index counts the
messages that hold each.

A reply's original is chosen among all earlier messages that hold something of what
it quotes. Passages of up to ``HOT`` holders are joined with every holder. For the
frequent ones holders are put together that hold the same set of them, and replies
that quote the same: these classes are compared once, and a reply meets the earliest
message for each set that it can have in common with one. So a passage common to a
third of all messages makes one row per message, and no holder is left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeflow.session import pin

QUOTED = re.compile(r"^ {0,3}((?:>[ \t]?)+)(.*)$", re.S)
# Lines that introduce a quotation.
INTRODUCES = re.compile(r"\b(?:wrote|writes|said|schrieb|a écrit|escribió)\b[^\n]{0,20}:\s*$", re.I)

HOT = 8  # holders, one at least, beyond which a passage is matched by classes

Passage = tuple[int, str]


def split_quotes(text: str | None) -> tuple[str | None, list[Passage]]:
    """The text without quotes, and the quoted lines with their levels."""
    if text is None:
        return None, []
    lines = []
    for line in text.split("\n"):
        found = QUOTED.match(line)
        lines.append((found[1].count(">"), found[2]) if found else (0, line))
    own = [
        line
        for i, (level, line) in enumerate(lines)
        if not level
        and not (i + 1 < len(lines) and lines[i + 1][0] and INTRODUCES.search(line))
    ]
    return "\n".join(own).strip("\n"), [x for x in lines if x[0]]


def normal(text: str) -> str:
    return " ".join(text.split()).casefold()


def _hash(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=16).digest()


def passages(lines: list[Passage]) -> Iterator[tuple[int, int, bytes, int]]:
    """(level, passage, hash, characters): paragraphs, and their lines."""
    number = 0
    for (level, filled), part in groupby(lines, key=lambda x: (x[0], bool(normal(x[1])))):
        if not filled:
            continue
        clean = [normal(line) for _, line in part]
        for text in {" ".join(clean), *clean}:
            yield level, number, _hash(text), len(text)
        number += 1


PARSED = (
    "_body string, _n int, _own array<binary>, "
    "_quoted array<struct<level:int,passage:int,hash:binary,chars:int>>"
)


def parse(messages: DataFrame) -> DataFrame:
    """``_id``, ``_scope``, ``_sent``, the body, and hashes of own and quoted passages."""
    names = ["_id", "_scope", "_sent"]
    quoted = pa.list_(
        pa.struct([("level", pa.int32()), ("passage", pa.int32()), ("hash", pa.binary()), ("chars", pa.int32())])
    )

    def run(batches):
        for batch in batches:
            found = [split_quotes(t.as_py()) for t in batch.column(3)]
            own = [list({p[2] for p in passages([(0, x) for x in (b or "").split("\n")])}) for b, _ in found]
            held = [list(passages(q)) for _, q in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(3)],
                    pa.array([b for b, _ in found], pa.string()),
                    pa.array([len({p[1] for p in h}) for h in held], pa.int32()),
                    pa.array(own, pa.list_(pa.binary())),
                    pa.array([[dict(zip(("level", "passage", "hash", "chars"), p)) for p in h] for h in held], quoted),
                ],
                [*names, "_body", "_n", "_own", "_quoted"],
            )

    return messages.mapInArrow(run, f"_id string, _scope string, _sent bigint, {PARSED}")


def parents(parsed: DataFrame, apart: bool = True) -> DataFrame:
    """``_id``, ``_parent`` and ``_linked``: the original that the outermost linked
    passages come from, and how many passages were found."""
    known = parsed.filter("_id IS NOT NULL AND _sent IS NOT NULL")
    # One time per id, so that links always lead to an earlier one.
    first = known.groupBy("_id").agg(F.min("_sent").alias("_sent"))
    known = known.drop("_sent").join(first, "_id")
    key = F.concat(F.unhex(F.md5("_scope")), "_hash") if apart else F.col("_hash")
    own = known.select("_id", "_sent", "_scope", F.explode("_own").alias("_hash")).select(
        "_id", "_sent", key.alias("_key")
    )
    index = own.groupBy("_key").agg(
        F.min(F.struct("_sent", "_id")).alias("_first"), F.count(F.lit(1)).alias("_holders")
    )
    asked = known.select("_id", "_sent", "_scope", F.explode("_quoted").alias("q")).select(
        "_id", "_sent", "_scope", "q.level", "q.passage", "q.chars", F.col("q.hash").alias("_hash")
    )
    asked = asked.select("_id", "_sent", "level", "passage", "chars", key.alias("_key"))
    hits = asked.join(index, "_key").filter(F.col("_first") < F.struct("_sent", "_id"))
    hits = pin(hits, "quotes-hits")
    # The outermost level; there, the message that most of the text comes from. Of
    # those that hold the same passages the earliest, among other equals the latest.
    outer = hits.groupBy("_id").agg(
        F.min("level").alias("level"), F.size(F.collect_set("passage")).alias("_linked")
    )
    wanted = hits.join(outer.select("_id", "level"), ["_id", "level"]).groupBy("_id", "_sent", "_key")
    wanted = wanted.agg(
        F.sum("chars").alias("_chars"), F.first("_first").alias("_from"), F.first("_holders").alias("_holders")
    )
    votes = _votes(pin(wanted, "quotes-wanted"), own)
    best = votes.groupBy("_id", "_chars", "_set").agg(F.min("_from").alias("_from"))
    best = best.groupBy("_id").agg(F.max(F.struct("_chars", "_from")).alias("_best"))
    return outer.join(best, "_id").select("_id", F.col("_best._from._id").alias("_parent"), "_linked")


def _votes(wanted: DataFrame, own: DataFrame) -> DataFrame:
    """``_id``, ``_from``, ``_chars`` and ``_set``: earlier messages (time and id), how many
    of the wanted characters each holds, and a hash of the passages. Of messages that
    have the same frequent passages and none of the others, the earliest is there."""
    keys = wanted.filter("_holders > 1").select("_key", "_holders").distinct()
    held = pin(own.join(keys, "_key"), "quotes-held").distinct()
    holder = F.struct(F.col("h._sent").alias("_sent"), F.col("h._id").alias("_id"))
    rare = wanted.filter(f"_holders > 1 AND _holders <= {HOT}").alias("w").join(held.alias("h"), "_key")
    rare = rare.filter(holder < F.struct("w._sent", "w._id"))
    rare = rare.select("w._id", "_key", holder.alias("_from"), "w._chars")
    single = wanted.filter("_holders = 1").select("_id", "_key", "_from", "_chars")
    same = [F.sum("_chars").alias("_chars"), F.bit_xor(F.xxhash64("_key")).alias("_set")]
    votes = single.unionByName(rare).groupBy("_id", "_from").agg(*same)
    often = F.col("_holders") > HOT
    if wanted.filter(often).isEmpty():
        return votes

    asks = wanted.filter(often).groupBy("_id", "_sent")
    asks = asks.agg(F.sort_array(F.collect_list(F.struct("_key", "_chars"))).alias("_all"))
    asks = pin(asks.withColumn("_asks", _name("_all")), "quotes-asks")
    holds = held.filter(often).groupBy("_id", "_sent").agg(F.sort_array(F.collect_list("_key")).alias("_all"))
    holds = pin(holds.withColumn("_holds", _name("_all")), "quotes-holds")
    ask = asks.groupBy("_asks").agg(F.first("_all").alias("_all"))
    ask = ask.select("_asks", F.explode("_all").alias("_p")).select("_asks", "_p._key", "_p._chars")
    hold = holds.groupBy("_holds").agg(F.first("_all").alias("_all"), F.min(F.struct("_sent", "_id")).alias("_from"))
    hold = hold.select("_holds", "_from", F.explode("_all").alias("_key"))
    common = pin(ask.join(hold, "_key").groupBy("_asks", "_holds", "_from").agg(*same), "quotes-common")

    more = common.select("_asks", "_holds", F.col("_chars").alias("_more"), F.col("_set").alias("_with"))
    votes = votes.join(asks.select("_id", "_asks"), "_id", "left").withColumn("_by", F.col("_from._id"))
    votes = votes.join(holds.select(F.col("_id").alias("_by"), "_holds"), "_by", "left")
    votes = votes.join(more, ["_asks", "_holds"], "left").select(
        "_id", "_from", (F.col("_chars") + F.coalesce("_more", F.lit(0))).alias("_chars"),
        F.col("_set").bitwiseXOR(F.coalesce("_with", F.lit(0))).alias("_set"),
    )
    earliest = common.groupBy("_asks", "_chars", "_set").agg(F.min("_from").alias("_from"))
    met = asks.join(earliest, "_asks").filter(F.col("_from") < F.struct("_sent", "_id"))
    return votes.unionByName(met.select("_id", "_from", "_chars", "_set"))


def _name(column: str) -> Column:
    """A set's hash."""
    return F.md5(F.to_json(F.struct(column)))


def trees(nodes: DataFrame) -> DataFrame:
    """``_id``, ``_root`` and ``_depth`` from ``_id`` and ``_parent``.

    Each round every message that has not reached its root skips to its ancestor's
    ancestor, so a thread of depth n takes about log2(n) joins of ever fewer rows;
    each round is a table in the shared folder.
    """
    at = nodes.select(
        "_id",
        F.coalesce("_parent", "_id").alias("_root"),
        F.col("_parent").isNotNull().cast("bigint").alias("_depth"),
        F.col("_parent").isNotNull().alias("_open"),
    )
    at = pin(at, "thread-round")
    while not (open_ := at.filter("_open")).isEmpty():
        up = at.select(
            F.col("_id").alias("_root"), F.col("_root").alias("_up"), F.col("_depth").alias("_more"), F.col("_open").alias("_on")
        )
        step = open_.drop("_open").join(up, "_root").select(
            "_id", F.col("_up").alias("_root"), (F.col("_depth") + F.col("_more")).alias("_depth"), F.col("_on").alias("_open")
        )
        at = pin(at.filter("NOT _open").unionByName(step), "thread-round")
    return at.drop("_open")


def link_quotes(
    messages: DataFrame,
    msg_id: str = "msg_id",
    sent: str = "sent",
    text: str = "text",
    scope: str | None = None,
    apart: bool = True,
) -> DataFrame:
    """``msg_id``, ``scope``, ``sent``, ``body``, ``n_quotes``, ``n_linked``, ``parent``,
    ``root`` and ``depth`` of every message.

    ``body`` is the text without quoted lines and the lines that introduce them.
    A passage is linked when a message, sent before this one and in the same scope,
    has it as a paragraph or line of its own text. ``parent`` is, of all these
    messages, the one that holds most characters of the outermost linked passages: of
    several with the same ones the earliest, among other equals the latest; ``root`` and ``depth`` follow from the parents.
    A reply comes after its original in the order of ``depth`` and ``sent``. Unless
    ``apart``, passages are looked up in all scopes.

    A null text has a null body and no quotes. Messages with a null id or time are
    linked with nothing and are their own root; a null scope is a scope of its
    own. Repeated rows stay; of messages sharing an id the links are united. An
    empty table gives an empty one; further columns are not read.
    """
    where = F.col(f"`{scope}`").cast("string") if scope else F.lit("")
    rows = messages.select(
        F.col(f"`{msg_id}`").cast("string").alias("_id"),
        F.coalesce(F.concat(F.lit("s"), where), F.lit("n")).alias("_scope"),
        F.col(f"`{sent}`").cast("bigint").alias("_sent"),
        F.col(f"`{text}`").cast("string"),
    )
    parsed = pin(parse(rows), "quotes-parsed")
    links = pin(parents(parsed, apart), "quotes-links")
    ids = parsed.filter("_id IS NOT NULL").select("_id").distinct()
    placed = trees(ids.join(links, "_id", "left")).join(links, "_id", "left")
    out = parsed.select("_id", "_scope", "_sent", "_body", "_n").join(placed, "_id", "left")
    shown = F.when(F.col("_scope") != "n", F.substring("_scope", 2, 1 << 30))
    return out.select(
        F.col("_id").alias("msg_id"), shown.alias("scope"), F.col("_sent").alias("sent"),
        F.col("_body").alias("body"), F.col("_n").alias("n_quotes"),
        F.coalesce("_linked", F.lit(0)).alias("n_linked"),
        F.col("_parent").alias("parent"), F.coalesce("_root", "_id").alias("root"),
        F.coalesce("_depth", F.lit(0).cast("bigint")).alias("depth"),
    )


def placed(linked: DataFrame) -> DataFrame:
    """Adds ``place``, the number of a message in the reply order of its conversation,
    from 0; a message without a root has 0."""
    order = ["root", "depth", "sent", "msg_id"]
    # The cut points are sampled, so the slices are written out once.
    rows = linked.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    rows = pin(rows, "quotes-places")
    inside = F.row_number().over(Window.partitionBy("_slice", "root").orderBy(*order[1:]))
    earlier = Window.partitionBy("root").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.filter("root IS NOT NULL").groupBy("root", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    base = base.select("root", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    rows = rows.withColumn("_inside", inside - 1).join(base, ["root", "_slice"], "left")
    place = F.coalesce(F.col("_base") + F.col("_inside"), F.lit(0))
    return rows.select(*linked.columns, place.alias("place"))


def conversations(linked: DataFrame) -> DataFrame:
    """The messages of each conversation in reply order, by range sorts, with their
    ``place``."""
    return placed(linked).orderBy("root", "depth", "sent", "msg_id")
