"""Registered queries of the corpus operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeflow.llm.common import n_words, table
from tradeflow.llm import bpe, jaccard, langid, lexical, lines, mixing, packing, quality, quotes, search, suffixes, urls, variants
from tradeflow.session import configure, pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
VOCABULARY = "byte_bpe_50k.json"
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
JUNK_TITLE = r"(?s)<title>[^<]*[#*$%]{3}"


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(configure(spark), sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def held_out(doc_id: str = "doc_id"):
    """The quarter of the documents that no model learns from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


@query
def op1_language(spark, sf_dir):
    """The language of every text, learned from three quarters of them."""
    out = F.coalesce(held_out(), F.lit(False))
    rows = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = langid.identify(rows, ~out)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", F.size("runs").alias("n_runs"))


@query
def op2_pack(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


@query
def op3_jaccard(spark, sf_dir):
    """Near copies of all documents: four words, 85 hundredths."""
    return jaccard.jaccard_join(documents(spark, sf_dir), words=4, percent=85)


def mails(turns: DataFrame) -> DataFrame:
    """Conversations as mails that quote, one for each row: each turn carries the one
    before it with ``>`` and the one before that with ``>>``, under a line that
    introduces them.

    A mail is named by its conversation and turn, and by its row too where one of
    them is null or the turn is repeated. Of a repeated turn the smallest text is
    quoted; without conversation or turn nothing is.
    """
    turns = turns.select("conv_id", "turn", "text").withColumn("_row", F.monotonically_increasing_id())
    own = turns.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn")
    own = own.agg(F.min("text").alias("own"), F.count(F.lit(1)).alias("_rows"))

    def earlier(back: int, mark: str) -> DataFrame:
        quoted = F.regexp_replace(F.concat(F.lit("\n"), "own"), "\n", "\n" + mark + " ")
        return own.select("conv_id", (F.col("turn") + back).alias("turn"), quoted.alias(f"q{back}"))

    rows = turns.join(own.select("conv_id", "turn", "_rows"), ["conv_id", "turn"], "left")
    rows = rows.join(earlier(1, ">"), ["conv_id", "turn"], "left")
    rows = rows.join(earlier(2, ">>"), ["conv_id", "turn"], "left")
    head = F.when(F.col("q1").isNotNull(), F.lit("\nA reader wrote:"))
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("conv_id", "turn", "text")]
    of_row = F.concat_ws(":", *names[:2], F.md5(names[2]), "_row")
    return rows.select(
        F.when(F.col("_rows") == 1, F.concat_ws(":", *names[:2])).otherwise(of_row).alias("msg_id"),
        "conv_id", "turn", F.concat_ws("", "text", head, "q2", "q1").alias("text"),
    )


def linked_mails(turns: DataFrame) -> DataFrame:
    """``scope`` is the conversation; no link looks at it, ``root_in_scope`` says
    whether the root found is of the same one."""
    linked = quotes.link_quotes(mails(turns), sent="turn", scope="conv_id", apart=False)
    linked = pin(linked.withColumn("body", F.md5("body")).withColumnRenamed("body", "body_md5"), "mails-linked")
    roots = linked.filter("msg_id = root").select("root", F.col("scope").alias("_of"))
    linked = linked.join(roots, "root").withColumn("root_in_scope", F.col("scope").eqNullSafe(F.col("_of")))
    return quotes.placed(linked.drop("_of"))


@query
def op4_quotes(spark, sf_dir):
    """Mails made of all conversations, linked by what they quote, in reply order."""
    return linked_mails(table(spark, sf_dir, "conversations")).select(
        "msg_id", "scope", "sent", "body_md5", "n_quotes", "n_linked", "parent", "root", "depth", "root_in_scope", "place"
    )


@query
def op5_top_k(spark, sf_dir):
    """The 10 best vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return search.top_k(vectors, F.col("vec_id") % 100 == 0)


@query
def op6_site_lines(spark, sf_dir):
    """Lines that many documents of their source share go."""
    rows = lines.drop_boilerplate(documents(spark, sf_dir))
    return rows.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("kept_md5"))


@query
def op7_mix(spark, sf_dir):
    """Sources mixed to weights 1, 2, 3."""
    sized = documents(spark, sf_dir).select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_suffixes(spark, sf_dir):
    """Bytes of all documents in strings of 400 bytes that start twice."""
    found = suffixes.dedup_strings(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"
    )


@query
def op9_quality(spark, sf_dir):
    """Rule statistics of every text and the verdict of rules and forest."""
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    return quality.judge(docs, labels).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", F.round("anomaly", 6).alias("anomaly")
    )


@query
def op10_urls(spark, sf_dir):
    """Every page's URL against four rules, and against the listed ones: those of
    pages whose title is junk."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(F.col("html").rlike(JUNK_TITLE)).select("url")
    found = urls.filter_urls(pages.select("page_id", "url"), listed, RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "listed")


@query
def op11_variants(spark, sf_dir):
    """Frequent words of all documents with their near words, forms and roots."""
    return variants.group_variants(documents(spark, sf_dir))


@query
def op12_lexical(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op13_bpe(spark, sf_dir):
    """Ids of all documents and the texts decoded from them."""
    found = bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
    n_tokens = (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens")
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return found.select("doc_id", n_tokens, *digests)
