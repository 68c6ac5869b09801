"""Encoding by distinct words, lexical search and spelling variants, by brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tradeflow.llm import bpe, lexical, variants

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def sliced(spark):
    """Small shuffles keep all their partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def made(letters, n, longest, seed):
    r = random.Random(seed)
    return ["".join(r.choice(letters) for _ in range(r.randint(1, longest))) for _ in range(n)]


# Encoding.

ODD = [
    None, "", " ", "  ", "\n\nx  \n y", "a<|endoftext|>b  \n\n x", "<|endoftext|><|endoftext|", " <|endoftext|> ",
    " 's's 'S don't  x漢字 тест  ²½ \x1c\x85 é \U0001f600!!! '", "a\0b\r\n\t\t z", "Ɤᲀ\U0001e904‿_", "same", "same",
]


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check_bpe(docs, texts):
    own, got = tokenizer(), bpe.encode_decode(docs, PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert list(np.frombuffer(bytes(r.ids), "<u4")) == ids
        assert r.decoded == own.decode(ids, skip_special_tokens=False)


def test_bpe_equals_the_library(docs):
    texts = ODD + made("ab'sS 1.\n\t é漢² \x1c\x85　_", 400, 40, 1)
    check_bpe(docs([(i, t, "s") for i, t in enumerate(texts)]), texts)


def test_bpe_of_many_blocks_and_long_texts(docs, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    monkeypatch.setattr(bpe, "PART_CHARS", 7)
    monkeypatch.setattr(bpe, "MEMO", 3)
    long = [" ".join(made("abé ", 300, 9, 2)), "a" * 3000, "  \n" * 500, "漢 字" * 300]
    texts = ODD + long + made("ab \n", 200, 30, 3)
    check_bpe(docs([(i, t, "s") for i, t in enumerate(texts)]), texts)


def test_bpe_of_null_and_repeated_ids_and_of_nothing(docs):
    rows = [(None, "one two", "s"), (None, "one two", "s"), (7, "x", "s"), (7, "y", None)]
    got = sorted((str(r.doc_id), r.decoded) for r in bpe.encode_decode(docs(rows), PATH).collect())
    assert got == [("7", "x"), ("7", "y"), ("None", "one two"), ("None", "one two")]
    empty = bpe.encode_decode(docs([]), PATH)
    assert empty.columns == ["doc_id", "ids", "decoded"] and empty.count() == 0


def test_bpe_refuses_other_vocabularies():
    with pytest.raises(ValueError):
        bpe.Words(public_tokenizers.path("word_bpe_49k.json"))


def test_numbers_of_any_size():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 1 << 21, (1 << 28) + 5])
    data, sizes = bpe.varints(numbers)
    assert sizes.tolist() == [1, 1, 1, 2, 2, 3, 4, 5]
    assert bpe.numbers_of(data.tobytes()).tolist() == numbers.tolist()
    assert bpe.numbers_of(b"").tolist() == []


# Search.


def ranked(texts, items, top=50):
    """(item, rank, doc, score) as the formula says, over all documents."""
    found = [re.findall(lexical.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    n, total = sum(map(bool, found)), sum(map(len, found))
    df = Counter(t for f in found for t in set(f))
    out = []
    for item, text in items:
        terms = set(re.findall(lexical.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        scores = []
        for i, f in enumerate(found):
            tf, m = Counter(f), 50 + 50 * len(f) * n // max(1, total)
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in terms if t in tf
            )
            scores += [(-s, i)] if s > 0 else []
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return out


@pytest.mark.parametrize("leaf, docs_a_shard", [(lexical.LEAF, lexical.SHARD_DOCS), (1, 40), (16, 7)])
def test_search_equals_brute_force(spark, docs, monkeypatch, leaf, docs_a_shard):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "SHARD_DOCS", docs_a_shard)
    monkeypatch.setattr(lexical, "ITEMS", 2)
    r = random.Random(4)
    vocabulary = ["É1", "é1", "b", "B", "c9", "d-d", "ñe", "漢", "x", "yy", "z_z", "rare"]
    texts = [" ".join(r.choices(vocabulary, range(12, 0, -1), k=r.randint(0, 60))) for _ in range(150)]
    texts += [None, "", "rare", "rare", "...", "c9 " * 5000] + ["b c9 rare x"] * 20
    items = [(1, "rare B c9"), (2, "É1 é1 ñe 漢 x"), (3, None), (4, "nowhere"), (5, "x x x yy"), (6, "")]
    queries = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.search(docs([(i, t, "s") for i, t in enumerate(texts)]), queries, top=10)
    assert sorted(map(tuple, got.collect())) == ranked(texts, items, 10)


def test_search_of_repeated_ids_and_of_nothing(spark, docs):
    queries = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a")], "item_id long, text string")
    rows = [(5, "a q", "s"), (5, "a q", "s"), (None, "a q", "s"), (3, "b q", "s"), (9, "z z", "s"), (8, "z", "s")]
    got = [(r.item_id, r["rank"], r.doc_id) for r in lexical.search(docs(rows), queries).collect()]
    assert sorted(g for g in got if g[0] == 1) == [(1, 1, 3), (1, 2, None), (1, 3, 5), (1, 4, 5)]
    assert sorted(g[1:] for g in got if g[0] is None) == [(1, None), (2, 5), (3, 5)]
    assert lexical.search(docs([]), queries).count() == 0
    assert lexical.search(docs(rows), queries.limit(0)).count() == 0


# Variants.


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            found[w] += len(w) >= variants.MIN_LENGTH
    return {w: n for w, n in found.items() if n >= variants.MIN_COUNT}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    form, near = {}, {}
    for w in counts:
        own = [v for v in counts if is_near(w, v)]
        near[w] = len(own)
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], near[w], counts.get(form[w])))
    return sorted(out)


def words_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("letters", ["ab", "abÀé"])
def test_variants_equal_brute_force(docs, sliced, letters):
    r = random.Random(letters)
    vocabulary = made(letters, 150, 9, 5) + ["a" * 40, "a" * 41, "abab" * 300, "abab" * 300 + "a"]
    rows = [(i, " ".join(r.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=90))) for i in range(60)]
    rows += [(None, "aabab-aabab aabab AABAB"), (3, None), (3, ""), (3, "baaba " * 300)]
    rows += [(None, " ".join(["abab" * 300, "abab" * 300 + "a"] * 4))]
    expected = brute_variants(brute_words(rows))
    assert sum(r[4] > 0 for r in expected) > 5
    assert letters != "ab" or any(r[1] and r[2] != r[1] for r in expected)
    assert words_of(variants.group_variants(docs([(i, t, "s") for i, t in rows]))) == expected


def test_variants_of_nothing(docs):
    for rows in ([], [(1, None, "s"), (2, "abc de", "s")]):
        found = variants.group_variants(docs(rows))
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found.count() == 0


def test_nodes_number_the_prefixes(spark, sliced):
    words = sorted(set(made("abc", 300, 6, 6)) | {"abcabc" * 50, "abcabc" * 50 + "b"})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    got = variants.trie(table, F.col("word"), "nodes", place="id").collect()
    number = {}
    for r in got:
        assert len(r.nodes) == len(r.word) + 1
        for d, node in enumerate(r.nodes):
            assert number.setdefault(r.word[:d], node) == node
    assert len(set(number.values())) == len(number)
    assert [r.word for r in sorted(got, key=lambda r: r.id)] == words
