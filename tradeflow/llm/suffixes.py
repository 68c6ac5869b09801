"""Repeated byte strings by a distributed suffix sort with a difference cover.

A string of ``LENGTH`` bytes that starts twice makes two suffixes neighbours in the
order of their first ``LENGTH`` bytes. To sort the suffixes of a corpus:

1. *Cover.* A difference cover samples positions so that two equal strings meet the
   sample at an equal distance. Residues of the position in the text serve two
   strings only over several residues; here residues are counted from an anchor,
   the position of the smallest hash inside the string, which equal strings share,
   so one residue of ``STEP`` is enough and two suffixes always meet it alike.
2. *Exclusion.* The bytes that all strings of an anchor's half have in common (more
   than half of each) are hashed and counted over the corpus, as packed arrays. A
   hash that occurs once belongs to strings that occur once, so their suffixes
   need no sorting; that holds for all that is not repeated. Texts that occur as a
   whole more than once take part once.
3. *Sort.* What is left goes, with the bytes it needs, to the bucket of its hash,
   where all possible equals are. There the sampled positions are named by their
   ``STEP`` bytes, triples of names are sorted and named again (48, 144, 384 bytes),
   and each remaining suffix is placed by the bytes up to the next sampled position,
   that position's name, and the bytes after what it covers. Neighbours with equal
   prefixes are the repeats.

A hash with more than ``HOT`` places would fill one bucket; its strings are compared
by their own 128-bit hashes instead. Each slice of the texts sends a hash once,
however often it has it, and places the answers itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeflow.llm.shingles import batches_of, mix
from tradeflow.session import pin

LENGTH, GRAM, STEP = 400, 64, 16
GRAMS = LENGTH - GRAM + 1  # windows of an anchor
HALF = GRAMS // 2 + 1  # anchors less than this far into the string are its first half
SEGMENT = 4_000_000  # of a very long text, worked on at once
HOT = 4096
_PLACE_BITS = 24
_U = np.uint64


def _numbers(seed: int, n: int) -> np.ndarray:
    """The hash's own numbers: equal on every machine and in every run."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, _U) | _U(1)


_BYTES, _LEVELS = _numbers(401, 256), _numbers(402, 16)


def gram_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all strings of 64 and of 128 bytes, by doubling."""
    h, out = _BYTES[raw], []
    for level in range(7):
        size = 1 << level
        if len(h) <= size:
            return np.empty(0, _U), np.empty(0, _U)
        h = h[:-size] * _LEVELS[level] + h[size:]
        h ^= h >> _U(32)
        out.append(h)
    return mix(out[5]), out[6]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchored(units: list[bytes]) -> dict[str, np.ndarray]:
    """Runs of strings that share an anchor and its half: unit, first string's
    offset, number of strings, distance of the anchor, and the common bytes' hash."""
    sizes = np.array([len(u) for u in units], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.frombuffer(b"".join(units), np.uint8)
    grams, longer = gram_hashes(raw)
    places = np.arange(len(grams), dtype=_U)
    low = (grams >> _U(_PLACE_BITS) << _U(_PLACE_BITS)) | places
    anchor = (sliding_min(low, GRAMS) & _U((1 << _PLACE_BITS) - 1)).astype(np.int64)
    many = np.maximum(sizes - LENGTH + 1, 0)
    unit = np.repeat(np.arange(len(units)), many)
    first_of = np.cumsum(many) - many
    at = np.arange(len(unit)) - first_of[unit] + starts[unit]  # all strings of all units
    anchor = anchor[at]
    far = anchor - at >= HALF
    change = np.ones(len(at), bool)
    change[1:] = (np.diff(anchor) != 0) | (np.diff(unit) != 0) | (far[1:] != far[:-1])
    run = np.flatnonzero(change)
    count = np.diff(run, append=len(at))
    a, f = anchor[run], far[run]
    begin = np.where(f, a - HALF, a)  # of the bytes that the run's strings share
    stop = np.where(f, a + GRAM, a + LENGTH - HALF + 1)
    key = longer[begin] * _LEVELS[8] + longer[stop - 128]
    key = mix(key ^ np.where(f, _LEVELS[9], _LEVELS[10]))
    return {
        "unit": unit[run],
        "first": at[run] - starts[unit[run]],
        "count": count,
        "ahead": a - at[run],
        "key": key,
    }


def units_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts of at least ``LENGTH`` bytes; very long ones in overlapping segments."""
    units, owner, base = [], [], []
    for i, t in enumerate(texts):
        for low in range(0, max(0, len(t) - LENGTH + 1), SEGMENT):
            units.append(t[low : low + SEGMENT + LENGTH - 1])
            owner.append(i)
            base.append(low)
    return units, np.array(owner, np.int64), np.array(base, np.int64)


def _grouped(units: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of units of at most about two segments, so that places fit their bits."""
    low = size = 0
    for i, u in enumerate(units):
        if size and size + len(u) > 2 * SEGMENT:
            yield low, i
            low, size = i, 0
        size += len(u)
    if low < len(units):
        yield low, len(units)


def runs_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    """As ``anchored``, with ``text`` and the offset in the whole text."""
    units, owner, base = units_of(texts)
    found = []
    for low, high in _grouped(units):
        part = anchored(units[low:high])
        unit = part.pop("unit") + low
        found.append({**part, "text": owner[unit], "first": part["first"] + base[unit]})
    if not found:
        return {c: np.empty(0, _U if c == "key" else np.int64) for c in ("text", "first", "count", "ahead", "key")}
    return {c: np.concatenate([f[c] for f in found]) for c in found[0]}


def _print(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


SCANNED = (
    "doc_id {id}, fp binary, n_bytes bigint, sha string, part bigint, place int, "
    "bucket int, keys binary, owners binary, places binary"
)
_NAMES = ["doc_id", "fp", "n_bytes", "sha", "part", "place", "bucket", "keys", "owners", "places"]
_TYPES = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _record(ids, columns) -> pa.RecordBatch:
    arrays = [pa.array(list(c), t) for c, t in zip(columns, _TYPES)]
    return pa.RecordBatch.from_arrays([ids, *arrays], _NAMES)


def _scan(docs: DataFrame, buckets: int) -> DataFrame:
    """One row per document, and packed keys by bucket: the hash, 64 bits of the
    text's fingerprint, and the text's place in the slice ``part``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in batches_of(batch, 1):
                texts = [(t or "").encode() for t in rows.column(1).to_pylist()]
                prints, m = [_print(t) for t in texts], len(texts)
                shas = [hashlib.sha256(t).hexdigest() for t in texts]
                sizes = [len(t) for t in texts]
                yield _record(rows.column(0), [prints, sizes, shas, [part] * m, range(m), *[[None] * m] * 4])
                found = runs_of(texts)
                owners = np.array([int.from_bytes(p[:8], "little") for p in prints], "<u8")
                bucket = (found["key"] % _U(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                key, text = found["key"][order].astype("<u8"), found["text"][order].astype("<u4")
                each, at = np.unique(bucket[order], return_index=True)
                ranges = list(zip(at, [*at[1:].tolist(), len(key)]))
                k = len(each)
                packed = [
                    [None] * k, [m] * k, [None] * k, [part] * k, [None] * k, each,
                    [key[a:b].tobytes() for a, b in ranges],
                    [owners[text[a:b]].tobytes() for a, b in ranges],
                    [text[a:b].tobytes() for a, b in ranges],
                ]
                yield _record(pa.nulls(k, rows.column(0).type), packed)
                part += 1

    return docs.select("doc_id", "text").mapInArrow(run, SCANNED.format(id=kind))


def _repeated_keys(blobs: pa.Table) -> pa.Table:
    """Per slice, the keys that occur in two texts, or twice in one, with their
    texts' places and whether they are hot."""
    columns = {c: blobs.column(c).to_pylist() for c in ("keys", "owners", "places")}
    keys = [np.frombuffer(k, "<u8") for k in columns["keys"]]
    place = [np.frombuffer(p, "<u4") for p in columns["places"]]
    key, owner = np.concatenate(keys), np.concatenate([np.frombuffer(o, "<u8") for o in columns["owners"]])
    row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    text = np.concatenate(place).astype(np.int64) + (row << 32)
    order = np.lexsort((text, key))
    k, o, t = key[order], owner[order], text[order]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(head)
    again = np.zeros(len(k), np.int64)
    again[1:] = (t[1:] == t[:-1]) & ~head[1:]
    size = np.diff(first, append=len(k))
    repeated = (np.minimum.reduceat(o, first) != np.maximum.reduceat(o, first)) | (np.add.reduceat(again, first) > 0)
    state = np.empty(len(k), np.uint8)
    state[order] = np.repeat(repeated.astype(np.uint8) + (repeated & (size > HOT)), size)
    out = []
    for i, (ks, ps, ss) in enumerate(zip(keys, place, np.split(state, np.cumsum([len(x) for x in keys])[:-1]))):
        live = ss > 0
        out.append((ks[live].tobytes(), ps[live].tobytes(), ss[live].tobytes()))
    some = [i for i, x in enumerate(out) if x[0]]
    return pa.table(
        {
            "part": blobs.column("part").take(pa.array(some, pa.int64())),
            **{n: pa.array([out[i][j] for i in some], pa.binary()) for j, n in enumerate(("keys", "places", "states"))},
        }
    )


def _by_text(rows: pa.Table) -> pa.Table:
    """The replies of all buckets to a slice, by text."""
    key, place, state = (
        np.concatenate([np.frombuffer(x, t) for x in rows.column(c).to_pylist()])
        for c, t in (("keys", "<u8"), ("places", "<u4"), ("states", np.uint8))
    )
    order = np.argsort(place, kind="stable")
    each, at = np.unique(place[order], return_index=True)
    ranges = list(zip(at, [*at[1:].tolist(), len(place)]))
    return pa.table(
        {
            "part": pa.array([rows.column("part")[0].as_py()] * len(each), pa.int64()),
            "place": pa.array(each, pa.int32()),
            "keys": pa.array([key[order][a:b].tobytes() for a, b in ranges], pa.binary()),
            "states": pa.array([state[order][a:b].tobytes() for a, b in ranges], pa.binary()),
        }
    )


def repeated_texts(scanned: DataFrame, docs: DataFrame) -> DataFrame:
    """``fp``, ``text``, ``keys`` and ``states`` of each different text with a key that
    occurs again."""
    blobs = scanned.filter("keys IS NOT NULL").select("part", "bucket", "keys", "owners", "places")
    replies = (
        blobs.groupBy("bucket")
        .applyInArrow(_repeated_keys, "part bigint, keys binary, places binary, states binary")
        .groupBy("part")
        .applyInArrow(_by_text, "part bigint, place int, keys binary, states binary")
    )
    meta = scanned.filter("fp IS NOT NULL").select("doc_id", "fp", "part", "place")
    first = F.min(F.struct("doc_id", "keys", "states")).alias("_first")
    one = meta.join(replies, ["part", "place"]).groupBy("fp").agg(first).select("fp", "_first.*")
    one = pin(one, "suffix-replies")

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A repeated id may bring another text along.
        for batch in batches:
            prints = [_print((t.as_py() or "").encode()) for t in batch.column(1)]
            mask = pa.array([p == f.as_py() for p, f in zip(prints, batch.column(0))], pa.bool_())
            yield batch.filter(mask)

    texts = docs.join(one, docs["doc_id"].eqNullSafe(one["doc_id"])).select("fp", "text", "keys", "states")
    return texts.mapInArrow(same, "fp binary, text string, keys binary, states binary").dropDuplicates(["fp"])


def _items(texts: DataFrame, buckets: int) -> DataFrame:
    """Three kinds of rows: runs of strings whose key occurs again, with their bytes;
    of hot keys, the strings' places in the slice ``part`` and the numbers of their
    hashes; and these hashes, packed by bucket, each with whether the slice has it
    more than once."""
    names = ["fp", "first", "bucket", "count", "phase", "bytes", "part", "hashes", "numbers", "many", "places", "starts"]
    kinds = [
        *[pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()],
        *[pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()],
    ]

    def record(rows: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([r.get(n) for r in rows], t) for n, t in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in batches_of(batch, 1):
                raw = [(t or "").encode() for t in rows.column(1).to_pylist()]
                prints, found = rows.column(0).to_pylist(), runs_of(raw)
                cuts = np.searchsorted(found["text"], np.arange(len(raw) + 1))
                cold, hot = [], []
                packed = zip(raw, rows.column(2).to_pylist(), rows.column(3).to_pylist())
                for i, (text, keys, states) in enumerate(packed):
                    known, state = np.frombuffer(keys, "<u8"), np.frombuffer(states, np.uint8)
                    order = np.argsort(known, kind="stable")
                    known, state = known[order], state[order]
                    part_of = slice(cuts[i], cuts[i + 1])
                    key, first, count, ahead = (found[c][part_of] for c in ("key", "first", "count", "ahead"))
                    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    state = np.where(known[at] == key, state[at], 0)
                    for j in np.flatnonzero(state):
                        low, n = int(first[j]), int(count[j])
                        if state[j] == 1:
                            cold.append(
                                {
                                    "fp": prints[i], "first": low, "count": n, "bucket": int(key[j]) % buckets,
                                    "phase": int(ahead[j]) % STEP, "bytes": text[low : low + n + LENGTH - 1],
                                }
                            )
                        else:
                            hot += [(i, p, _print(text[p : p + LENGTH])) for p in range(low, low + n)]
                yield record(cold)
                if hot:
                    yield record(_hot_rows(hot, prints, part, buckets))
                part += 1

    ddl = "fp binary, first bigint, bucket int, count bigint, phase int, bytes binary, part bigint, "
    return texts.mapInArrow(run, ddl + "hashes binary, numbers binary, many binary, places binary, starts binary")


def _hot_rows(hot: list[tuple[int, int, bytes]], prints: list[bytes], part: int, buckets: int) -> list[dict]:
    number: dict[bytes, int] = {}
    own = np.array([number.setdefault(h, len(number)) for _, _, h in hot], "<u4")
    many = (np.bincount(own) > 1).astype(np.uint8)
    rows = [
        {
            "part": part, "fp": b"".join(prints), "numbers": own.tobytes(),
            "places": np.array([i for i, _, _ in hot], "<u4").tobytes(),
            "starts": np.array([p for _, p, _ in hot], "<i8").tobytes(),
        }
    ]
    by_bucket: dict[int, list[bytes]] = {}
    for h in number:
        by_bucket.setdefault(int.from_bytes(h[:8], "little") % buckets, []).append(h)
    for bucket, hashes in by_bucket.items():
        ids = np.array([number[h] for h in hashes], "<u4")
        rows.append(
            {
                "part": part, "bucket": bucket, "hashes": b"".join(hashes),
                "numbers": ids.tobytes(), "many": many[ids].tobytes(),
            }
        )
    return rows


def _repeated_hashes(blobs: pa.Table) -> pa.Table:
    """Per slice, the numbers of the hashes that occur again."""
    packed = [np.frombuffer(h, "<u8").reshape(-1, 2) for h in blobs.column("hashes").to_pylist()]
    numbers = [np.frombuffer(n, "<u4") for n in blobs.column("numbers").to_pylist()]
    many = np.concatenate([np.frombuffer(m, np.uint8) for m in blobs.column("many").to_pylist()])
    rank = _name(*np.concatenate(packed).T)
    again = (np.bincount(rank, 1 + many) > 1)[rank]
    parts = np.split(again, np.cumsum([len(n) for n in numbers])[:-1])
    found = [n[a].tobytes() for n, a in zip(numbers, parts)]
    return pa.table({"part": blobs.column("part"), "numbers": pa.array(found, pa.binary())})


def _place_hashes(local: pa.Table, replies: pa.Table) -> pa.Table:
    out: tuple[list, list, list] = ([], [], [])
    again = np.concatenate([np.empty(0, "<u4"), *(np.frombuffer(n, "<u4") for n in replies.column("numbers").to_pylist())])
    columns = (local.column(c).to_pylist() for c in ("fp", "numbers", "places", "starts"))
    for prints, numbers, places, starts in zip(*columns):
        hit = np.isin(np.frombuffer(numbers, "<u4"), again)
        place, start = np.frombuffer(places, "<u4")[hit].astype(np.int64), np.frombuffer(starts, "<i8")[hit]
        order = np.lexsort((start, place))
        place, start = place[order], start[order]
        head = np.ones(len(place), bool)
        head[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(place)) - 1 if len(first) else first
        out[0].extend(prints[16 * i : 16 * i + 16] for i in place[first].tolist())
        out[1].extend(start[first].tolist())
        out[2].extend(start[last].tolist())
    kinds = (pa.binary(), pa.int64(), pa.int64())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("fp", "first", "last"), out, kinds)})


def _name(*columns: np.ndarray) -> np.ndarray:
    """Ranks of the tuples in sorted order, equal ones alike."""
    if len(columns) == 3 and all(len(c) and int(c.max()) < 1 << 21 for c in columns):
        a, b, c = (x.astype(np.int64) for x in columns)
        columns = ((a << 42) | (b << 21) | c,)
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0])
    new = np.zeros(len(order), bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def repeated_strings(parts: list[bytes], counts: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """Whether each string occurs again, for the strings of all parts in a row.

    ``phases`` is the distance from a part's start to its first sampled position.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(parts) + bytes(LENGTH + STEP), np.uint8)
    # Sampled positions, STEP apart in each part.
    many = np.maximum(-(-(sizes - phases) // STEP), 1)
    base = np.cumsum(many) - many
    part = np.repeat(np.arange(len(parts)), many)
    sample = starts[part] + phases[part] + STEP * (np.arange(len(part)) - base[part])
    words = raw[np.minimum(sample[:, None] + np.arange(STEP), len(raw) - 1)].view(">u8").astype(_U)
    name = _name(words[:, 0], words[:, 1])
    # Triples of names: 3, 9 and then 24 steps; the last triple overlaps.
    for second, third in ((1, 2), (3, 6), (9, 15)):
        ahead = np.minimum(np.arange(len(name))[:, None] + [second, third], len(name) - 1)
        name = _name(name, name[ahead[:, 0]], name[ahead[:, 1]])
    # All suffixes, by their distance to the next sampled position.
    owner = np.repeat(np.arange(len(parts)), counts)
    offset = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
    gap = (phases[owner] - offset) % STEP
    next_sample = base[owner] + (offset + gap - phases[owner]) // STEP
    begin = starts[owner] + offset
    covered = (LENGTH // STEP - 1) * STEP
    out = np.zeros(len(owner), bool)
    for g in range(STEP):
        own = np.flatnonzero(gap == g)
        if len(own) < 2:
            continue
        column = np.arange(STEP)
        at = begin[own][:, None] + (column + covered * (column >= g))
        outer = raw[at].view(">u8").astype(_U)
        key = (name[next_sample[own]], outer[:, 0], outer[:, 1])
        order = np.lexsort(key)
        same = np.ones(len(own) - 1, bool)
        for c in key:
            s = c[order]
            same &= s[1:] == s[:-1]
        out[own[order[1:][same]]] = True
        out[own[order[:-1][same]]] = True
    return out


def _sorted_bucket(items: pa.Table) -> pa.Table:
    counts = items.column("count").to_numpy()
    parts = items.column("bytes").to_pylist()
    found = repeated_strings(parts, counts, items.column("phase").to_numpy().astype(np.int64))
    owner = np.repeat(np.arange(len(parts)), counts)
    place = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + items.column("first").to_numpy()[owner]
    # Runs of repeated strings in a row.
    head = found.copy()
    head[1:] &= ~(found[:-1] & (owner[1:] == owner[:-1]))
    tail = found.copy()
    tail[:-1] &= ~(found[1:] & (owner[1:] == owner[:-1]))
    first, last = np.flatnonzero(head), np.flatnonzero(tail)
    return pa.table(
        {
            "fp": items.column("fp").take(pa.array(owner[first])),
            "first": pa.array(place[first], pa.int64()),
            "last": pa.array(place[last], pa.int64()),
        }
    )


def repeats(texts: DataFrame, buckets: int) -> DataFrame:
    """``fp``, ``first`` and ``last``: runs of starts of strings that start again."""
    items = pin(_items(texts, buckets), "suffix-items")
    kind = "fp binary, first bigint, last bigint"
    cold = items.filter("bytes IS NOT NULL").groupBy("bucket").applyInArrow(_sorted_bucket, kind)
    replies = (
        items.filter("hashes IS NOT NULL")
        .select("part", "bucket", "hashes", "numbers", "many")
        .groupBy("bucket")
        .applyInArrow(_repeated_hashes, "part bigint, numbers binary")
    )
    local = items.filter("starts IS NOT NULL").select("part", "fp", "numbers", "places", "starts")
    hot = local.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(_place_hashes, kind)
    return cold.unionByName(hot)


def spans(firsts: list[int], lasts: list[int]) -> list[tuple[int, int]]:
    """The bytes covered by the strings that start in these runs, as maximal spans."""
    out: list[list[int]] = []
    for a, b in sorted(zip(firsts, lasts)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + LENGTH)
        else:
            out.append([a, b + LENGTH])
    return [tuple(x) for x in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, firsts, lasts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            raw, found = (text or "").encode(), spans(firsts, lasts)
            ends = [0, *[b for _, b in found]]
            kept = b"".join(raw[a:b] for a, b in zip(ends, [*[a for a, _ in found], len(raw)]))
            flat = [{"start": a, "stop": b} for a, b in found]
            out.append((sum(b - a for a, b in found), flat, hashlib.sha256(kept).hexdigest()))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        arrays = [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), kind, pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["fp", "n_removed", "spans", "kept_sha256"])


def dedup_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` and ``kept_sha256``.

    A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else
    too, in this text or another; strings never cross texts and are judged on the
    input. ``spans`` are the maximal removed runs of UTF-8 bytes. A null text counts
    as empty; texts shorter than the length lose nothing; each row is a document,
    also where ids or texts repeat, so copies remove each other. An empty table
    gives an empty one; other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scanned = pin(_scan(rows, buckets), "suffix-scan")
    texts = pin(repeated_texts(scanned, rows), "suffix-texts")
    found = pin(repeats(texts, buckets), "suffix-repeats")
    by_text = found.groupBy("fp").agg(
        F.collect_list(F.struct("first", "last")).alias("r")
    ).select("fp", F.col("r.first").alias("firsts"), F.col("r.last").alias("lasts"))
    cut = (
        texts.select("fp", "text")
        .join(by_text, "fp")
        .mapInArrow(_cut, "fp binary, n_removed bigint, spans array<struct<start:bigint,stop:bigint>>, kept_sha256 string")
    )
    meta = scanned.filter("fp IS NOT NULL").select("doc_id", "fp", "n_bytes", "sha")
    copies = meta.groupBy("fp").agg(F.count(F.lit(1)).alias("_copies"))
    known = copies.join(cut, "fp", "left")
    out = meta.join(known, "fp", "left")
    copied = (F.col("_copies") > 1) & (F.col("n_bytes") >= LENGTH)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copied, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
