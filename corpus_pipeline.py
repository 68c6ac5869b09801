"""Documents to packed training sequences, by the operators of ``tradeflow.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns
of ``documents``, whatever further columns come in, and keep every row but those
that they name. An empty table passes through all stages.
"""

from __future__ import annotations

import functools
import threading

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tradeflow.llm import jaccard, langid, lines, members, mixing, packing
from tradeflow.llm.common import n_words, table
from tradeflow.llm.queries import VOCABULARY, held_out
from tradeflow.session import configure, drop_tables, noted, pin

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_SHARE = 0.5  # of a text's letters in its main language
WORDS, PERCENT = 5, 80

# Random shuffles, fitted models and tokenizers have no SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a main language go: null, without any letter, or mixed so that
    no language has ``MIN_SHARE`` of the letters. The given language is not used to
    judge a text, and a null one stays null."""
    docs = docs.select(*COLUMNS)
    found = langid.identify(docs, ~F.coalesce(held_out(), F.lit(False)))
    kept = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SHARE)
    return found.filter(kept).select(*COLUMNS)


def site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents of their source share leave the texts; every
    document stays, with its new number of characters."""
    docs = docs.select(*COLUMNS)
    kind = docs.schema["n_chars"].dataType
    found = lines.drop_boilerplate(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*COLUMNS)


def _key(*columns: str) -> list[Column]:
    """Two hashes of the columns that tell nulls from texts and from each other."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull(), F.coalesce(F.length(c), F.lit(0)))]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the rows that links of five-word shingles with a similarity of at least 0.8
    connect, one stays: of the smallest id, null being the largest, and of its texts
    the one with the smallest hash. All rows that link with none stay, texts without
    words among them."""
    docs = docs.select(*COLUMNS)
    # Judged by id and text, so rows that share an id are judged apart.
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), *[h.alias(f"h{i}") for i, h in enumerate(_key("text"))])
    keyed = docs.withColumn("_row", row)
    found = jaccard.jaccard_join(keyed.select(F.col("_row").alias("doc_id"), "text"), words=WORDS, percent=PERCENT)
    found = found.filter("n_shingles > 0").groupBy(F.col("doc_id").alias("_row")).agg(
        F.first(F.col("doc_id") != F.col("component_id")).alias("_goes"), F.count(F.lit(1)).alias("_rows")
    )
    found = pin(found.filter("_goes OR _rows > 1"), "near-verdicts")
    # Most rows are sure to stay: their texts do not move for the join with the verdicts.
    marked = members.marked(keyed, "_row", found.select("_row"), "near-bits")
    judged = marked.filter("_maybe").drop("_maybe")
    kept = marked.filter("NOT _maybe").select(*COLUMNS)
    kept = kept.unionByName(judged.join(found.select("_row"), "_row", "left_anti").select(*COLUMNS))
    twice = found.filter("NOT _goes").select("_row")
    if not twice.isEmpty():  # one of rows equal in id and text
        ones = judged.join(twice, "_row", "left_semi").groupBy("_row").agg(F.min(F.struct(*COLUMNS)).alias("_one"))
        kept = kept.unionByName(ones.select("_one.*"))
    return kept


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, up to three times."""
    docs = docs.select(*COLUMNS)
    name = F.concat_ws(":", F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n")), *[F.hex(h) for h in _key("text", "source")])
    docs = docs.withColumn("_name", name).withColumn("_size", n_words(F.col("text")))
    taken = mixing.mix(docs.select(F.col("_name").alias("doc_id"), "source", F.col("_size").alias("size")))
    taken = taken.groupBy(F.col("doc_id").alias("_name")).agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")
    )
    taken = pin(taken.filter("_copies > 0"), "mix-taken")
    out = docs.join(taken.filter("_rows = 1").drop("_rows"), "_name")
    same = taken.filter("_rows > 1")
    if not same.isEmpty():  # rows equal in id, source and text share their copies
        place = F.row_number().over(Window.partitionBy("_name").orderBy("lang", "n_chars"))
        share = F.floor(F.col("_copies") / F.col("_rows")) + (F.col("_place") <= F.col("_copies") % F.col("_rows")).cast("bigint")
        again = docs.join(same, "_name").withColumn("_place", place).withColumn("_copies", share)
        out = out.unionByName(again.filter("_copies > 0").select(*out.columns))
    return out.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_copy")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


_tables = threading.local()


def _stage(k: int, f):
    """The stage with the tables of the one before dropped: its rows are stored when
    this one gets them as ``docs``."""

    @functools.wraps(f)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held = vars(_tables).setdefault("held", {})
        if k == 0:  # another run's: its result may still be read
            held.clear()
        drop_tables(spark, held.pop(k - 1, []))
        with noted() as made:
            out = f(spark, docs, sf_dir)
        held[k] = made
        return out

    return stage


STAGES = [(f.__name__, _stage(k, f)) for k, f in enumerate([language, site_lines, near_duplicates, mix, pack])]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
