"""Filter interaction audit: what every order of the filters removes, and each filter's share by Hart and Mas-Colell's potential.

One pass marks every document with the filters it fails. Documents are then
only counts: per part, per set of failed filters, of all, good and toxic ones.
From these follows the removal game v(S), the documents that fail a filter of
the coalition S, for all 32 coalitions. Its potential is

    P(empty) = 0,   P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

computed recursively; a filter's Shapley value is P(all) - P(all without it).
Times 5! everything is a whole number, and the value is the sum over all
orders. The steps of an order are differences v(S with i) - v(S).
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

FILTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions of the filters that look at one text; ``words`` are its words."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 100,
        "B": 100 * distinct < 80 * n,
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def marked(df: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, part, key of the text, mask of failed text filters: A is bit 0); one pass over whole texts."""
    text = F.coalesce(S.column(text_col), F.lit(""))
    words = F.array_remove(F.split(text, _SPACE), "")
    rows = df.select(
        S.column(id_col).cast("long").alias("doc_id"), F.coalesce(S.column(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"), words.alias("words"),
    )
    bits = [F.when(c, 1 << FILTERS.index(f)).otherwise(0) for f, c in failures(F.col("text"), F.col("words")).items()]
    return rows.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), sum(bits[1:], bits[0]).alias("mask"))


def patterns(marks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask with the copy filter E, good, toxic, n): counts of documents.

    Rows of a repeated id and text are counted before they move, and rows of
    one text meet only as counts per part and label, so neither is a hot group.
    """
    rows = marks.groupBy("doc_id", "part", "key", "mask").agg(F.count(F.lit(1)).alias("n"))
    quality = labels.where(S.column(id_col).isNotNull()).groupBy(S.column(id_col).cast("long").alias("doc_id")).agg(
        F.bool_or(S.column("quality") == 1).alias("good"), F.bool_or(S.column("toxic") == 1).alias("toxic")
    )
    labelled = rows.join(quality, "doc_id", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")}
    )
    known = F.col("doc_id").isNotNull()
    texts = labelled.groupBy("key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("without_id"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("key"))
    originals = F.col("without_id") + F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0)
    split = texts.select("part", "mask", "good", "toxic", "n", originals.alias("originals"))
    copy = 1 << FILTERS.index("E")
    both = split.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask"), F.col("originals").alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
    )))
    return both.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def coalitions(counts: DataFrame, n_filters: int) -> DataFrame:
    """Per part: total and the arrays v, good, toxic by coalition number, of documents failing any filter of it."""
    n = F.col("n")

    def game(which: Column) -> Column:
        return F.array(*[
            F.coalesce(F.sum(F.when(which & (F.col("mask").bitwiseAND(s) != 0), n)), F.lit(0)) for s in range(1 << n_filters)
        ])

    return counts.groupBy("part").agg(
        F.sum("n").alias("total"), game(F.lit(True)).alias("v"), game(F.col("good")).alias("good"), game(F.col("toxic")).alias("toxic")
    )


def potentials(games: DataFrame, n_filters: int) -> DataFrame:
    """``games`` (v) plus ``potential``: n_filters! times the potential of every coalition, smaller ones first."""
    scale = factorial(n_filters)
    out = games.withColumn("p0", F.lit(0).cast("long"))
    for size in range(1, n_filters + 1):
        level = {}
        for s in (s for s in range(1 << n_filters) if s.bit_count() == size):
            without = [F.col(f"p{s - (1 << i)}") for i in range(n_filters) if s >> i & 1]
            # whole: the potential sums dividends of subgames over their sizes
            level[f"p{s}"] = F.call_function("div", F.col("v")[s] * scale + sum(without[1:], without[0]), F.lit(size)) if size > 1 else F.col("v")[s] * scale
        out = out.withColumns(level)
    names = [f"p{s}" for s in range(1 << n_filters)]
    return out.withColumn("potential", F.array(*names)).drop(*names)


def steps(games: DataFrame, filters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the coalition arrays."""
    everything = (1 << len(filters)) - 1
    orders = F.array(*[F.lit("".join(o)) for o in permutations(filters)])
    rows = games.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))

    def bit(step: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(filters), F.substring(F.col("filter_order"), step, F.lit(1))) - 1)

    rows = rows.withColumns({
        "own": bit(F.col("step")),
        "before": F.aggregate(F.sequence(F.lit(1), F.lit(len(filters))), F.lit(0), lambda a, k: a + F.when(k < F.col("step"), bit(k)).otherwise(0)),
    }).withColumn("after", F.col("own") + F.col("before"))

    def gain(of: str) -> Column:
        return F.col(of)[F.col("after")] - F.col(of)[F.col("before")]

    rest = F.lit(everything) - F.col("own")
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.col("v")[F.col("after")]).alias("kept"),
        gain("v").alias("removed"),
        (F.col("v")[F.col("own")] - gain("v")).alias("redundant"),
        (F.col("v")[everything] - F.col("v")[rest]).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        (F.col("potential")[everything] - F.col("potential")[rest]).alias("shapley"),
    )


def audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of the contract.

    Null texts count as empty, null parts as ''. A null id is no smaller or
    larger than any, so its row never fails E and has no label; rows that
    repeat an id and its text count as often as given and are no copies of each
    other (their id is not smaller). A document is good or toxic if any of its
    labels says so. An empty table has no parts and gives no rows. ``labels``
    has columns ``id_col``, quality and toxic; other columns are not read.
    """
    counts = S.staged(patterns(marked(df, id_col, text_col, part_col), labels, id_col), "patterns")
    return steps(potentials(coalitions(counts, len(FILTERS)), len(FILTERS)), FILTERS)


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(S.read_table(spark, sf_dir, "documents"), S.read_table(spark, sf_dir, "labels"))
