"""URL rules, site lines, quality rules and language."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F


from tradeflow.llm import langid, lines, quality, urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judged(spark, found, listed=()):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(found)], "page_id int, url string, host string")
    known = spark.createDataFrame([(u,) for u in listed], "url string")
    got = urls.filter_urls(pages, known, RULES).orderBy("page_id")
    return [tuple(r) for r in got.select("host", "path", "rule", "verdict", "listed").collect()]


def test_url_rules(spark):
    got = judged(
        spark,
        ["http://A.example.NET/en/1?x#y", "https://example.net/de", "http://b.example.com/de/x", "http://x.org/fr/", "http://x.org/en/",
         "http://a.net", "http://badexample.com/de/", None, "", "no scheme", "http://a.com?u=http://b.net/"],
    )
    assert got == [
        ("a.example.net", "/en/1", "example.net/en/", "allow", False),
        ("example.net", "/de", "net/", "block", False),
        ("b.example.com", "/de/x", "example.com/de/", "block", False),
        ("x.org", "/fr/", "org/fr/", "allow", False),
        ("x.org", "/en/", None, "allow", False),
        ("a.net", "", None, "allow", False),
        ("badexample.com", "/de/", None, "allow", False),
        ("", "", None, "allow", False),
        ("", "", None, "allow", False),
        ("", "", None, "allow", False),
        ("a.com", "", None, "allow", False),
    ]


def test_listed_urls_in_canonical_form(spark):
    got = judged(
        spark,
        ["http://www.a.com/x/?ref=9", "https://m.a.com/x#t", "http://a.com/y", "http://b.a.com/x", "http://a.com/x?id=1", "http://a.net/x"],
        ["http://A.com/x", "http://a.net/x", None, "junk"],
    )
    assert [r[3:] for r in got] == [("block", True), ("block", True), ("allow", False), ("allow", False), ("allow", False), ("block", False)]


def test_bloom_filter_passes_all_listed(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BLOCKS", 2)  # far too few: only the join decides
    listed = [f"http://s{i}.com/p{i}" for i in range(0, 400, 2)]
    got = judged(spark, [f"http://s{i}.com/p{i}" for i in range(400)], listed)
    assert [r[4] for r in got] == [i % 2 == 0 for i in range(400)]


def test_url_tables_may_be_empty(spark):
    assert judged(spark, []) == []
    assert judged(spark, ["http://a.com/"], [])[0][3] == "allow"


def test_site_lines(spark, docs):
    body = [(i, f"menu\n own {i} \nmenu \n\nfooter", "s1") for i in range(20)]
    more = [(100, "menu\nfooter", "s1"), (101, None, "s1"), (102, "", "s1"), (103, "menu\nx", "s2"), (104, "menu\ny", None), (100, "menu\nfooter", "s1")]
    got = lines.drop_boilerplate(docs(body + more), share=0.5)
    by_id = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()}
    assert by_id[3] == (" own 3 \n", 5, 3)
    assert by_id[100] == ("menu\nfooter", 2, 0)  # nothing else in it: a copy, left whole
    assert by_id[101] == (None, 0, 0) and by_id[102] == ("", 1, 0)
    assert by_id[103][2] == by_id[104][2] == 0
    assert got.count() == 26 and {"part", "score"} <= set(got.columns)
    assert lines.drop_boilerplate(docs([])).count() == 0


def test_site_lines_of_small_hosts(docs):
    small = [(i, f"menu\nown {i}", "four") for i in range(4)] + [(9, "menu\nx", "one")]
    got = {r["doc_id"]: r["text"] for r in lines.drop_boilerplate(docs(small)).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: "own 2", 3: "own 3", 9: "menu\nx"}


def test_site_lines_of_a_very_long_text(docs):
    long = "\n".join(f"line {i} " + "x" * 1000 for i in range(2_000))
    got = lines.drop_boilerplate(docs([(i, f"{long}\nown {i}", "s") for i in range(3)])).collect()
    assert {(r["text"], r["n_dropped"]) for r in got} == {(f"own {i}", 2_000) for i in range(3)}


def brute_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = (text or "").split("\n")
    seen, dup = set(), 0
    for line in found:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_rule_counts_equal_brute_force():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a b a b a b", "é é é é", "  x y", "a\x1fb\x0bc", "# # #\n# # #"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a", "b", "ü", " ", " ", "\n", "*", "\t", "<"]) for _ in range(rng.randint(1, 120))))
    assert [quality.rule_counts(t)[:5] for t in texts] == [brute_counts(t) for t in texts]


def test_quality_verdicts(spark, docs):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 9)))
    good = [" ".join(word() for _ in range(rng.randint(80, 300))) for _ in range(300)]
    bad = [" ".join(word().upper() + "###!!" for _ in range(rng.randint(80, 300))) for _ in range(20)]
    table = [(i, t, "s") for i, t in enumerate(good + bad)] + [(900, None, None), (901, "few words", "s"), (902, "x y z " * 50, "s")]
    labels = spark.createDataFrame(
        [(i, int(i < 300), 0) for i in range(0, 320, 2)] + [(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    got = {r["doc_id"]: r for r in quality.judge(docs(table), labels).collect()}
    assert sum(got[i]["kept"] for i in range(300)) >= 292
    assert sum(not got[i]["kept"] for i in range(300, 320)) >= 15
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (900, 901, 902))
    unlabelled = quality.judge(docs(table), labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in unlabelled)
    assert quality.judge(docs([]), labels).count() == 0


def test_forest_sample_does_not_depend_on_the_cut(spark, monkeypatch):
    counts = spark.range(2000).selectExpr(
        "id AS doc_id", *[f"abs(hash(id, {k})) % 50 + 1 AS {c}" for k, c in enumerate(quality.COUNTS + quality.MORE)]
    )
    cut = quality.fit(counts, 3, 20)
    usable = counts.orderBy(F.xxhash64(F.lit("forest"), "doc_id"), "doc_id").limit(60).drop("doc_id")
    whole = quality.Forest(quality.features(np.array([tuple(r) for r in usable.collect()], float)), 3, 20)
    assert all(np.array_equal(a, b) for s, t in zip(cut.trees, whole.trees) for a, b in zip(s, t))


SOUNDS = {"en": ["th", "er", "ing", "wh", "on"], "fr": ["eau", "oi", "é", "tion", "que"], "de": ["sch", "ung", "ü", "heit", "zu"]}


def invented(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language(spark, docs):
    rng = random.Random(1)
    known = [(i, invented(rng, lang, rng.randint(3, 90)), lang) for i, lang in enumerate(["en", "fr", "de"] * 60)]
    rest = [(500, None, "en"), (501, "", "fr"), (502, "12 -- ...", None), (503, invented(rng, "fr", 9000), None)]
    rows_ = [(i, t, lang, "s", 1, "e", "e", 9.0) for i, t, lang in known + rest]
    frame = spark.createDataFrame(rows_, docs([]).schema)
    got = {r["doc_id"]: r for r in langid.identify(frame, F.col("doc_id") % 4 != 2).collect()}
    held = [(i, lang) for i, _, lang in known if i % 4 == 2]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) > 0.95
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (500, 501, 502))
    assert got[503]["lang_pred"] == "fr" and sum(r["words"] for r in got[503]["runs"]) == 9000
    nothing = langid.identify(frame, F.lit(False)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert langid.identify(frame.limit(0), F.lit(True)).count() == 0


def test_language_of_null_and_repeated_ids(spark, docs):
    rng = random.Random(4)
    texts = [(invented(rng, lang, 40), lang) for lang in ["en", "fr", "de"] * 20]
    hot = [texts[0]] * 200  # one row makes three quarters of the table
    rows_ = [(None, t, lang, "s", 1, "e", "e", 9.0) for t, lang in texts + hot]
    rows_ += [(7, *r[1:]) for r in rows_[:3]] * 2
    frame = spark.createDataFrame(rows_, docs([]).schema)
    got = langid.identify(frame, F.lit(True)).collect()
    assert len(got) == len(rows_) and np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.95
    learned = langid.sample(frame, F.lit(True), "doc_id", "text", "lang", 150)
    assert len(learned) == 63 and {t for t, _ in learned} == {t for t, _ in texts}
    assert len(langid.sample(frame, F.lit(True), "doc_id", "text", "lang", 5)) == 15


def test_excerpts_cover_whole_texts():
    words = [f"w{i}" for i in range(30_000)]
    cut = langid.excerpt(" ".join(words)).split()
    assert len(cut) == langid.SPAN * langid.SPANS and cut[0] == "w0" and cut[-1] == "w29999"
    assert langid.excerpt("a  b\n c") == "a  b\n c"


def test_language_by_brute_force(spark, docs):
    """The result of the query is the labels' letters, counted word by word."""
    rng = random.Random(6)
    known = [(i, invented(rng, lang, 30), lang, "s", 1, "e", "e", 9.0) for i, lang in enumerate(["en", "fr", "de"] * 20)]
    frame = spark.createDataFrame(known, docs([]).schema)
    model = langid.fit(langid.sample(frame, F.lit(True), "doc_id", "text", "lang", langid.SAMPLE))
    for r in langid.identify(frame, F.lit(True)).collect():
        words = langid.words_of(r["text"])
        emissions, letters = model.emissions(words)
        emissions[letters == 0] = 0.0
        shares = np.zeros(len(model.langs))
        best = []
        for k, n in enumerate(letters):  # the marginals of each word by messages from both sides
            left = np.ones(len(model.langs))
            for e in emissions[:k]:
                left = (left * np.exp(e - e.max())) @ np.exp(model.moves)
                left /= left.sum()
            right = np.ones(len(model.langs))
            for e in emissions[:k:-1]:
                right = np.exp(model.moves) @ (right * np.exp(e - e.max()))
                right /= right.sum()
            p = left * right * np.exp(emissions[k] - emissions[k].max())
            best.append(model.langs[int(p.argmax())])
            shares += n * p / p.sum()
        assert r["lang_pred"] == model.langs[int(shares.argmax())]
        assert abs(r["score"] - shares.max() / shares.sum()) < 1e-4
        assert [x["lang"] for x in r["runs"] for _ in range(x["words"])] == best


def test_code_switches_are_found():
    rng = random.Random(2)
    model = langid.fit([(invented(rng, lang, 60), lang) for lang in SOUNDS for _ in range(30)], 200, 40)
    text = invented(rng, "en", 40) + " " + invented(rng, "de", 50)
    _, _, runs = langid.Labeller(model).label([text])[0]
    assert [lang for lang, _ in runs] == ["en", "de"] and abs(runs[0][1] - 40) <= 1


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    lengths, moves = np.array([1, 5, 4]), rng.normal(size=(2, 2))
    emissions = rng.normal(size=(10, 2)) * 3
    got, at = langid.forward_backward(emissions, lengths, moves), 0
    for n in lengths:
        total = np.zeros((n, 2))
        for path in product(range(2), repeat=int(n)):
            e = sum(emissions[at + t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            for t, k in enumerate(path):
                total[t, k] += np.exp(e)
        assert np.allclose(got[at : at + n], total / total.sum(1, keepdims=True))
        at += n


def test_long_sequences_equal_one_pass():
    rng = np.random.default_rng(1)
    emissions, moves = rng.normal(size=(400, 3)) * 4, rng.normal(size=(3, 3))
    whole = langid.forward_backward(emissions, np.array([400]), moves)
    a = np.exp(moves)
    f, b = np.empty((400, 3)), np.ones((400, 3))
    f[0] = np.exp(emissions[0])
    for t in range(1, 400):
        f[t] = f[t - 1] @ a * np.exp(emissions[t])
        f[t] /= f[t].sum()
    for t in range(398, -1, -1):
        b[t] = a @ (np.exp(emissions[t + 1]) * b[t + 1])
        b[t] /= b[t].sum()
    p = f * b
    assert np.allclose(whole, p / p.sum(1, keepdims=True))


@pytest.mark.parametrize("text,letters", [("ab1", 2), ("é×÷", 1), ("日本", 2), ("-", 0)])
def test_letters(text, letters):
    assert langid.Words([text.encode()]).letters.tolist() == [letters]
