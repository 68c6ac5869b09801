"""Near copies, repeated strings, search, packing, mixing, quotes and the pipeline."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tradeflow.llm import jaccard, members, mixing, packing, queries, quotes, search, shingles, suffixes
from tradeflow.llm.common import n_words
from tradeflow.session import pin

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def edited(rng, words, k):
    out = list(words)
    for _ in range(k):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


def near_copies(seed):
    """Families of edited copies, some of them chains, with shared passages."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    out = []
    for family in range(12):
        words = [f"f{family}x{rng.randrange(400)}" for _ in range(rng.randint(20, 150))] + passage
        for _ in range(rng.randint(1, 12)):
            out.append(" ".join(words))
            words = edited(rng, words, rng.choice([0, 1, 1, 2, 6]))
    out += [None, "", " \n ", "one two", "ONE two", "one  two three", *["same text of five words"] * 3]
    rng.shuffle(out)
    return out


def brute_components(texts, words, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
        sets.append(grams)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(i, len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("seed,words,percent", [(1, 4, 85), (2, 5, 80)])
def test_jaccard_equals_brute_force(docs, seed, words, percent):
    texts = near_copies(seed)
    got = jaccard.jaccard_join(docs([(i, t, "s") for i, t in enumerate(texts)]), words=words, percent=percent)
    assert sorted(tuple(r) for r in got.collect()) == brute_components(texts, words, percent)


def test_jaccard_recursion_loses_no_link(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "GROWTH", 1)  # one pivot per group and round
    rng = random.Random(9)
    words = [f"x{i}" for i in range(60)]
    texts = [" ".join(edited(rng, words, rng.choice([0, 1, 2]))) for _ in range(25)]
    got = jaccard.jaccard_join(docs([(i, t, "s") for i, t in enumerate(texts)]))
    assert sorted(tuple(r) for r in got.collect()) == brute_components(texts, 4, 85)


def test_jaccard_takes_null_and_repeated_ids(docs):
    text = " ".join(f"w{i}" for i in range(50))
    got = jaccard.jaccard_join(docs([(7, text, "s"), (7, text, "s"), (3, text + " end", "s"), (None, text, "s")]))
    assert sorted((r[0] or 0, r[2]) for r in got.collect()) == [(0, 3), (3, 3), (7, 3), (7, 3)]
    assert jaccard.jaccard_join(docs([])).count() == 0


def test_jaccard_links_over_a_set_without_ids(docs):
    words = [f"w{i}" for i in range(72)]
    got = jaccard.jaccard_join(docs([(i, " ".join(words[:n]), "s") for i, n in [(1, 60), (None, 66), (2, 72)]]))
    assert sorted((r[0] or 0, r[2]) for r in got.collect()) == [(0, 1), (1, 1), (2, 1)]


def test_a_passage_of_many_texts_makes_no_group_of_them(docs):
    """Pairs of near copies that all hold one passage meet under their own shingles."""
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join([f"t{i}w{k}" for k in range(60)] + passage + ["end"] * copy) for i in range(30) for copy in (0, 1)]
    rows_ = docs([(i, t, "s") for i, t in enumerate(texts)])
    found = jaccard.candidates(jaccard._scan(rows_.select("doc_id", "text"), 4, 16), 85)
    shared = jaccard.shared_sets(rows_.select("doc_id", "text"), found, 4, 85)
    groups = jaccard.index(shared, 85).groupBy("s").count()
    assert groups.count() > 0 and groups.agg(F.max("count")).first()[0] == 2
    got = jaccard.jaccard_join(rows_)
    assert sorted(tuple(r) for r in got.collect()) == brute_components(texts, 4, 85)


def test_a_large_cluster_is_not_compared_with_itself(spark, monkeypatch):
    """Pivots of different groups ask in their own ones: in the first round one each."""
    prints = [bytes([65 + i]) * 16 for i in range(12)]
    kinds = ", ".join(f"{b} bigint" for b in jaccard.SKETCH)
    sets = [(p, i, 10, 10, list(range(10)), *[0] * len(jaccard.SKETCH)) for i, p in enumerate(prints)]
    shared = spark.createDataFrame(sets, f"fp binary, rep bigint, n bigint, m bigint, shared array<bigint>, {kinds}")
    rows_ = [(s, prints[(s + k) % 12], 0) for s in range(12) for k in range(4)]
    whole, most = jaccard._distances, []

    def counted(state, pivots, *a):
        asks = state.join(pivots, [c for c in ("s", "fp") if c in pivots.columns])
        most.append(asks.groupBy("s").count().agg(F.max("count")).first()[0])
        return whole(state, pivots, *a)

    monkeypatch.setattr(jaccard, "_distances", counted)
    comps = jaccard.link_components(shared, spark.createDataFrame(rows_, "s bigint, fp binary, pos int"), 85)
    assert comps.select("comp").distinct().count() == 1 and comps.count() == 12
    assert most[0] == 1


def test_packed_shingles_do_not_grow_with_the_buckets(docs):
    texts = [" ".join(f"t{i}w{k}" for k in range(80)) for i in range(200)]
    rows_ = docs([(i, t, "s") for i, t in enumerate(texts)]).select("doc_id", "text").coalesce(1)

    def size(buckets):
        packed = jaccard._scan(rows_, 4, buckets).filter("keys IS NOT NULL")
        return packed.agg(sum(F.sum(F.octet_length(c)) for c in ("keys", "sizes", "owners", "places"))).first()[0]

    assert size(100_000) < 3 * size(16)


def test_shingles_of_odd_words():
    long_word = "x" * 5000
    a, b = shingles.shingle_sets([long_word + "y a b c", "X" * 5000 + "z a b c"], 4)
    assert len(a) == len(b) == 1 and a[0] != b[0]
    assert [len(s) for s in shingles.shingle_sets(["a\x1cb c d e", "a\x0bb c d", ""], 4)] == [1, 1, 0]


def brute_repeats(texts):
    from collections import Counter

    raw = [(t or "").encode() for t in texts]
    n = suffixes.LENGTH
    count = Counter(r[i : i + n] for r in raw for i in range(len(r) - n + 1))
    out = []
    for i, r in enumerate(raw):
        gone = bytearray(len(r))
        for p in range(len(r) - n + 1):
            if count[r[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        kept = bytes(c for c, g in zip(r, gone) if not g)
        runs = len([s for s in bytes(gone).split(b"\0") if s])
        out.append((i, len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def strings(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdefghé \n") for _ in range(n))
    passage, exact = make(600), make(700)
    out = [make(rng.randint(0, 900)) + passage[: rng.choice([380, 399, 400, 401, 600])] + make(rng.randint(0, 50)) for _ in range(12)]
    out += [exact, exact, exact + "x", "y" + exact, make(300) * 3, "z" * 1000, "ab" * 600, None, "", "short", "short", make(399), make(400)]
    base = make(3000)
    out += [base, base[:1500] + "!" + base[1500:], base[:900] + base[1000:], base[500:2500]]
    return out


def repeats_of(docs, texts):
    got = suffixes.dedup_strings(docs([(i, t, "s") for i, t in enumerate(texts)]))
    got = got.select("doc_id", "n_bytes", "n_removed", F.size("spans"), "kept_sha256")
    return sorted(tuple(r) for r in got.collect())


def test_repeated_strings_equal_brute_force(docs):
    texts = strings(1)
    assert repeats_of(docs, texts) == brute_repeats(texts)


def test_hot_strings_and_segments_equal_brute_force(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 2)
    monkeypatch.setattr(suffixes, "SEGMENT", 500)
    texts = strings(2)
    assert repeats_of(docs, texts) == brute_repeats(texts)
    assert repeats_of(docs, []) == []


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=6).round(1).tolist() for _ in range(300)]
    vectors += [vectors[0]] * 30 + [None, [1.0, None, 0.0], [float("nan")] * 6, [float("inf")] * 6, []]
    table = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)] + [(None, [1.0] * 6, "x")], "vec_id long, embedding array<float>, v string")
    got = search.top_k(table, F.col("vec_id") % 10 == 0, k=7, pivots=12, block=64)
    whole = [(i, np.floor(1024 * np.float32(v).astype(float)).astype(int)) for i, v in enumerate(vectors) if i < 330 or v == []]
    expected = []
    for i, q in whole:
        if i % 10 == 0:
            scores = sorted((-int(q @ c) if len(q) and len(c) else 0, j) for j, c in whole if j != i)[:7]
            expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    assert search.top_k(table.limit(0), F.lit(True)).count() == 0
    few = search.top_k(table.filter("vec_id < 3"), F.col("vec_id") == 0)
    assert few.count() == 2


def test_top_k_takes_rows_and_not_ids(spark):
    rows_ = [(100, [1.0, 1.0]), (100, [2.0, 2.0]), (1, [3.0, 0.0]), (100, [1.0, 1.0]), (2, None)]
    table = spark.createDataFrame(rows_, "vec_id long, embedding array<float>")
    got = search.top_k(table, F.col("vec_id") == 100, k=2, pivots=3, block=2)
    m = 1024 * 1024
    expected = [(100, 1, 100, 4 * m), (100, 2, 1, 3 * m)] * 2 + [(100, 1, 1, 6 * m), (100, 2, 100, 4 * m)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == np.cumsum([0, *[r["length"] for r in own]])[:-1].tolist()
        assert sum(r["length"] for r in own) == len(ids) and (len(own) == 1) == (len(ids) <= 2048)
        assert all(r["length"] == 2048 for r in own[1:])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    return len(sequences), sum(r["length"] for r in rows)


def test_new_words_of_many_texts_are_encoded_in_one_call():
    encoder, calls = packing.Encoder(VOCABULARY), []
    texts = [f"w{i} don't é{i}, 's\nx{i % 7}" for i in range(300)] + ["a\n\nb", "", "\n", "y\nx"]
    expected = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    encode = encoder.tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, some, **options):
            calls.extend(some)
            return encode(some, **options)

    encoder.tokenizer = Counted()
    assert [bytes(x) for x in encoder.encode(texts)] == expected
    assert len(calls) <= 5  # new words, the newline and texts with other white space
    del calls[:]
    assert [bytes(x) for x in encoder.encode(texts[:300])] == expected[:300] and not calls


def test_no_call_gets_very_many_new_words():
    encoder, calls = packing.Encoder(VOCABULARY), []
    texts = [" ".join(f"w{i}é{k}" for k in range(30)) for i in range(100)] + ["one", "w1é1"]
    expected = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    encode = encoder.tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, some, **options):
            calls.extend(some)
            return encode(some, **options)

    encoder.tokenizer = Counted()
    assert [bytes(x) for x in encoder.encode(texts)] == expected
    assert max(t.count("\n") for t in calls) < 400 and len(calls) <= 10


def test_words_of_letters_and_marks_go_to_the_model_alone(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 30)  # generations change in between
    encoder, calls, rng = packing.Encoder(VOCABULARY), [], random.Random(9)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))
    plain = [" ".join(word("abéßsɏA") + rng.choice(["", ",", "'", "...", "$#&"]) for _ in range(30)) for _ in range(40)]
    other = ["".join(word("a's tS.é漢ʼɐ²7—-я\u0301") for _ in range(30)) for _ in range(200)] + ["' don't 's, ...\n, x's"]
    expected = {t: np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in plain + other}
    encode = encoder.tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, some, **options):
            calls.extend(some)
            return encode(some, **options)

    encoder.tokenizer = Counted()
    for at in range(0, 40, 8):
        assert [bytes(x) for x in encoder.encode(plain[at : at + 8])] == [expected[t] for t in plain[at : at + 8]]
    assert not calls
    for at in range(0, len(other), 8):
        assert [bytes(x) for x in encoder.encode(other[at : at + 8])] == [expected[t] for t in other[at : at + 8]]


def test_packing_round_trip(docs):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["alpha", "été", "x", "word,"]) for _ in range(rng.randint(0, 1500))) for _ in range(60)]
    texts += [None, "", " ", "a\n\nb", " a  b ", "tab\tx y", "a\0b", "<|endoftext|> x", "don't stop", "y " * 9000]
    got = packing.pack(docs([(i, t, "s") for i, t in enumerate(texts)]), VOCABULARY).collect()
    sequences, tokens = check_packing(got, texts)
    assert sequences <= 1.02 * (-(-tokens // 2048)) + 1
    assert packing.pack(docs([]), VOCABULARY).count() == 0
    twice = packing.pack(docs([(1, "a b", "s"), (1, "a b", "s")]), VOCABULARY).collect()
    assert sorted((r["sequence_id"], r["offset"]) for r in twice) == [(0, 0), (0, 3)]


def test_plan_uses_exact_complements():
    assert packing.plan({2048: 2}) == [(2, [(2048, 1)])]
    assert packing.plan({2000: 5, 48: 5}) == [(5, [(2000, 1), (48, 1)])]
    assert packing.plan({2000: 2, 40: 2, 8: 2}) == [(2, [(2000, 1), (40, 1), (8, 1)])]
    assert packing.plan({2000: 1, 30: 1, 10: 1, 8: 1}) == [(1, [(2000, 1), (30, 1), (10, 1), (8, 1)])]
    assert packing.plan({1024: 4}) == [(2, [(1024, 2)])]
    assert packing.plan({}) == []


def test_plan_holds_every_piece_once():
    rng = random.Random(8)
    for _ in range(15):
        have = {rng.randint(1, 2048): rng.choice([1, 3, 10**9]) for _ in range(rng.randint(1, 60))}
        made, used = packing.plan(have), {}
        for times, pattern in made:
            assert sum(n * k for n, k in pattern) <= 2048
            for n, k in pattern:
                used[n] = used.get(n, 0) + times * k
        assert used == have
        filled = sorted((n, a, b) for n, a, b, *_ in packing.slots(made))
        for n in have:
            own = [(a, b) for m, a, b in filled if m == n]
            assert own[0][0] == 0 and own[-1][1] == have[n] and all(x[1] == y[0] for x, y in zip(own, own[1:]))


def water(sizes):
    """Targets by resharing until none is above three times its source's size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    open_, full, left = set(names), {}, float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return {**full, **share}
        for s in above:
            full[s] = 3.0 * sizes[s]
            left -= full[s]
            open_.remove(s)
    return full


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["b", "a", "a", "a", "a", "é", None]), rng.randint(0, 40)) for i in range(3000)]
    rows += [(5000, "zero", 0), (5001, "zero", None), (5002, "d", 500)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, size int, target string")
    got = {r["doc_id"]: r for r in mixing.mix(table).collect()}
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + (n or 0)
    goal, taken = water(sizes), dict.fromkeys(sizes, 0)
    for i, s, n in rows:
        r = got[i]
        assert r["size"] == (n or 0) and r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[s] += r["taken"]
    assert sum(taken.values()) <= sum(sizes.values())
    assert all(abs(taken[s] - goal[s]) <= 41 for s in sizes if s != "d") and taken["d"] % 500 == 0
    again = mixing.mix(table.repartition(7)).collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {i: r["taken"] for i, r in got.items()}
    assert mixing.mix(table.limit(0)).count() == 0


def test_sizes_are_words(spark):
    texts = ["a b", None, "", "  x\x1fy\tz\r\nw", " "]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(n_words(F.col("t"))).collect()
    assert [r[0] for r in got] == [2, 0, 0, 4, 0]


MAILS = [
    ("a", 1, "First words\nof the thread\n\nsecond paragraph"),
    ("b", 2, "I agree\nSomebody wrote:\n> first  words\n> of the thread"),
    ("c", 3, "So do I\n> I agree\n>> First words of the thread"),
    ("d", 4, "On what?\n> > Second Paragraph\n> nothing known"),
    ("e", 4, None),
    ("f", 5, "> quoted by nobody"),
    (None, 6, "> I agree"),
    ("g", 0, "> First words"),
    ("h", 9, "I agree"),
    ("i", 10, "late\n> I agree"),
]


def test_quotes(spark):
    table = spark.createDataFrame([(*r, "x") for r in MAILS], "msg_id string, sent long, text string, root string")
    got = {r["msg_id"]: r for r in quotes.link_quotes(table).collect()}
    assert {k: (r["parent"], r["root"], r["depth"]) for k, r in got.items()} == {
        "a": (None, "a", 0), "b": ("a", "a", 1), "c": ("b", "a", 2), "d": ("a", "a", 1), "e": (None, "e", 0),
        "f": (None, "f", 0), None: (None, None, 0), "g": (None, "g", 0), "h": (None, "h", 0), "i": ("b", "a", 2),
    }
    assert got["b"]["body"] == "I agree" and got["f"]["body"] == "" and got["e"]["body"] is None
    assert [got[k]["n_quotes"] for k in "abcd"] == [0, 1, 2, 2] and got["d"]["n_linked"] == 1
    order = [r["msg_id"] for r in quotes.conversations(quotes.link_quotes(table)).filter("root = 'a'").collect()]
    assert order == ["a", "b", "d", "c", "i"]
    assert quotes.link_quotes(table.limit(0)).count() == 0


def test_quotes_of_repeated_ids_and_long_threads(spark):
    thread = [(f"m{i}", i, f"own {i}" + (f"\n> own {i - 1}" if i else ""), "s") for i in range(40)]
    odd = [("m5", 90, "again\n> own 30", "s"), ("n", 3, "x\n> own 2", "t"), ("n", 3, "x\n> own 2", None)]
    table = spark.createDataFrame(thread + odd, "msg_id string, sent long, text string, box string")
    got = quotes.link_quotes(table, scope="box").collect()
    assert len(got) == 43
    assert {(r["root"], r["depth"]) for r in got if r["msg_id"] == "m39"} == {("m0", 39)}
    assert all(r["parent"] is None for r in got if r["msg_id"] == "n")


def test_quotes_come_from_the_message_that_holds_them_all(spark):
    thread = [("a", 1, "line one\nof a"), ("b", 2, "line three\nof b"), ("c", 3, "line one\nline two\nline three")]
    table = spark.createDataFrame([*thread, ("r", 4, "yes\n> line one\nno\n> line three")], "msg_id string, sent long, text string")
    got = {r["msg_id"]: r for r in quotes.link_quotes(table).collect()}
    assert (got["r"]["parent"], got["r"]["root"], got["r"]["n_linked"]) == ("c", "c", 1)


def brute_parents(mails):
    out, own = {}, {i: {p[2] for p in quotes.passages([(0, x) for x in quotes.split_quotes(t)[0].split("\n")])} for i, _, t in mails}
    for i, sent, t in mails:
        votes, linked = {}, set()
        for level, number, h, chars in quotes.passages(quotes.split_quotes(t)[1]):
            for j, earlier, _ in mails:
                if (earlier, j) < (sent, i) and h in own[j]:
                    total, held = votes.get((level, earlier, j), (0, frozenset()))
                    votes[level, earlier, j] = total + chars, held | {h}
                    linked.add(number)
        first = {}
        for (level, *by), same in sorted(votes.items()):
            first.setdefault((level, *same), by)
        best = max(first, key=lambda v: (-v[0], v[1], first[v]), default=None)
        out[i] = best and first[best][1], len(linked)
    return out


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_parents_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(quotes, "HOT", hot)
    rng = random.Random(12)
    lines = lambda k: [f"line {min(rng.randrange(1, 30), rng.randrange(1, 30))}" for _ in range(k)]
    mails = []
    for i in range(120):
        text = lines(rng.randint(0, 4)) + [f"{'>' * rng.randint(1, 2)} {x}" for x in lines(rng.randint(0, 4))]
        mails.append((f"m{i:03}", rng.randrange(60), "\n".join(text)))
    got = quotes.link_quotes(spark.createDataFrame(mails, "msg_id string, sent long, text string")).collect()
    assert {r["msg_id"]: (r["parent"], r["n_linked"]) for r in got} == brute_parents(mails)


TURNS = [
    (1, 0, "first of one"), (1, 1, "second of one"), (1, 2, "third of one"),
    (2, 0, "first of two"), (2, 1, "apples"), (2, 1, "pears"), (2, 1, "pears"), (2, 2, "third of two"),
    (None, 0, "lost"), (3, None, "no turn"), (4, 1, "> lost\nfound"), (5, 0, None),
]


def test_every_turn_is_a_mail(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, text string")
    rows = queries.linked_mails(turns).collect()
    assert len(rows) == len({r["msg_id"] for r in rows}) == len(TURNS)
    by_body = {r["body_md5"]: r for r in rows}
    got = {t: by_body[hashlib.md5((t or "").encode()).hexdigest()] for _, _, t in TURNS if t != TURNS[10][2]}
    assert (got["third of one"]["root"], got["third of one"]["depth"], got["third of one"]["place"]) == ("1:0", 2, 2)
    assert got["third of two"]["parent"] == got["apples"]["msg_id"] and got["pears"]["root"] == "2:0"
    assert sorted(r["place"] for r in rows if r["root"] == "2:0") == [0, 1, 2, 3, 4]
    found = next(r for r in rows if r["msg_id"] == "4:1")
    assert found["parent"] == got["lost"]["msg_id"] and not found["root_in_scope"] and got["third of two"]["root_in_scope"]
    assert got["no turn"]["parent"] is None and got["no turn"]["sent"] is None


def test_quote_levels():
    body, held = quotes.split_quotes("a\n>b\n> > c\n  >>> d\n    > code\n>")
    assert body == "a\n    > code" and held == [(1, "b"), (2, "c"), (3, "d"), (1, "")]


def test_pipeline(spark, docs):
    rng = random.Random(3)
    text = lambda n: " ".join(f"{rng.choice(['the', 'of', 'and'])} w{rng.randrange(900)}" for _ in range(n))
    long_one = text(60)
    table = [(i, text(rng.randint(20, 80)), rng.choice("ab")) for i in range(60)]
    table += [(90, long_one, "a"), (91, long_one + " end", "b"), (92, long_one, "a"), (92, long_one, "a"), (93, None, "a"), (94, "", None), (95, "1 2", "b"), (None, text(30), "a")]
    frame, kept = docs(table), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, None)
        if name != "pack":
            assert out.columns == corpus_pipeline.COLUMNS
            assert dict(out.dtypes) == dict(frame.select(*corpus_pipeline.COLUMNS).dtypes)
        frame = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = sorted({r["doc_id"] for r in frame.collect() if r["doc_id"] is not None})
    assert kept["language"] == kept["site_lines"] == [*range(60), 90, 91, 92]
    assert kept["near_duplicates"] == [*range(60), 90]
    assert set(kept["mix"]) <= set(kept["near_duplicates"]) and kept["pack"] == kept["mix"]


def test_pipeline_judges_rows_and_not_ids(spark, docs):
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    table = [(3, text("a"), "s"), (5, text("a"), "s"), (5, text("b"), "s"), (7, text("c"), "s"), (7, text("c") + " end", "s")]
    table += [(None, text("d"), "s"), (None, text("d") + " end", "s"), (8, text("e"), "s"), (8, text("e"), "t"), (9, None, "s"), (9, None, "s")]
    kept = corpus_pipeline.near_duplicates(spark, docs(table), None).collect()
    got = sorted((r["doc_id"] or 0, (r["text"] or "")[:1]) for r in kept)
    assert got == [(0, "d"), (3, "a"), (5, "b"), (7, "c"), (8, "e"), (9, ""), (9, "")]


def test_rows_that_surely_stay_do_not_move(spark, docs):
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    frame = pin(docs([(i, text(f"n{i}x"), "s") for i in range(200)] + [(300, text("n7x") + " end", "s")]), "rows")
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_duplicates(spark, frame, None)
        plan = kept._jdf.queryExecution().sparkPlan().toString()
        assert sorted(r["doc_id"] for r in kept.collect()) == [*range(200)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    stay = plan.split("Union")[1].split("+- ")[1]
    assert "SortMergeJoin" not in stay and "BroadcastHashJoin" in plan


def test_marked_rows(spark):
    rows_ = spark.createDataFrame([(i, "t") for i in range(5000)] + [(None, "n"), (7, "u")], "k long, text string")
    asked = [*range(0, 5000, 50), None, 0, 9999]
    got = members.marked(rows_, "k", spark.createDataFrame([(k,) for k in asked], "x long"), "bits")
    assert got.columns == ["k", "text", "_maybe"] and got.count() == 5002
    marked = {r["k"] for r in got.filter("_maybe").collect()}
    assert marked >= set(asked) - {9999} and len(marked) < 1000
    assert members.marked(rows_, "k", spark.createDataFrame([], "x long"), "bits").filter("_maybe").count() == 0


def test_pipeline_mixes_rows_and_not_ids(spark, docs):
    rng = random.Random(5)
    table = [(i % 50, f"{rng.randrange(10**6)} b c", "xyz"[i % 3]) for i in range(600)] + [(1, "q r s", "x")] * 5
    taken = corpus_pipeline.mix(spark, docs(table), None).groupBy("source").count().collect()
    sizes = {s: sum(x == s for _, _, x in table) for s in "xyz"}
    goal = water(sizes)
    assert all(abs(r["count"] - goal[r["source"]]) <= 1 for r in taken) and len(taken) == 3


def test_pipeline_drops_the_tables_of_the_stage_before(spark, docs):
    frame, folders = docs([(i, f"the {i} of {i} and w{i}", "a") for i in range(8)]), []
    for _, stage in corpus_pipeline.STAGES:
        frame = pin(stage(spark, frame, None), "stage")
        held = [f for made in vars(corpus_pipeline._tables)["held"].values() for f in made]
        assert all(os.path.isdir(f) for f in held) and not any(os.path.exists(f) for f in folders if f not in held)
        folders += held
    assert len(folders) > 10 and frame.count() > 0


def test_pipeline_over_an_empty_table(spark, docs):
    frame = docs([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, None)
        frame = spark.createDataFrame(out.collect(), out.schema)
    assert frame.count() == 0
