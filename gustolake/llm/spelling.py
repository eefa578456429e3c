"""Spelling variants: words one letter apart, found by PartEnum signatures of their letter multisets.

A word's letter multiset is a binary vector with a dimension for every letter
and occurrence ("the second e"). Words one inserted, deleted or replaced letter
apart have vectors at Hamming distance one or two. PartEnum finds the vectors
at a distance of at most two: the dimensions are dealt into ``PARTITIONS``
partitions, two vectors that close agree on all but two of them, so each
multiset emits one signature for every choice of two partitions left out, the
hash of the rest. Multisets meet by an equi-join on signatures and are verified
by the sums of their letters' random numbers, whose difference tells which
letter one has in place of which other.

Words are then verified exactly: those of linked multisets are masked at the
letters that differ (or lose the letter too many) and meet on the masked text.
A masked word with one position open has at most as many partners as there are
letters, so no group of words is ever paired with itself.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

# Fixed values of the word pattern: letters, and what 199 divides loses a letter.
LETTERS = "A-Za-zÀ-ÿ"
TYPO_EVERY = 199

PARTITIONS = 8
#: Distinct words a task holds before it hands their counts on.
HELD_WORDS = 400_000

COUNTS = "word string, n long"
CLASSES = "wid long, n long, word string, cid binary"
SIGNATURES = "sig long, cid binary, total long"
VARIANTS = "key binary, wid long, n long, kind string"


def counted(df: DataFrame, id_col: str, text_col: str, least_length: int) -> DataFrame:
    """(word, n): occurrences of the runs of letters of every whole text, with the rule's deletions; partial counts."""
    schema = S.arrow_schema(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]{{{least_length},}}")  # a run this long or longer matches whole
        held: Counter[str] = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                before = zlib.crc32(f"{'null' if doc is None else doc}:".encode())
                for word, n in Counter(runs.findall((text or b"").lower().decode())).items():
                    h = zlib.crc32(word.encode(), before)
                    if h % TYPO_EVERY == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield S.batch_of(list(held.items()), schema)
                    held.clear()
        if held:
            yield S.batch_of(list(held.items()), schema)

    # bytes.lower() lowers A-Z only
    rows = S.map_rows(df, {"id": S.column(id_col).cast("string"), "text": S.column(text_col).cast("binary")}, run, COUNTS)
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with ``wid``, a number in the order of the words, and ``cid``, naming the letter multiset."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the order of UTF-8 bytes is that of code points
    in_order = words.repartitionByRange(n, "word").sortWithinPartitions("word")
    schema = S.arrow_schema(CLASSES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wid, n, word = (c.to_pylist() for c in b.columns)
            cid = [xxhash.xxh3_128_digest("".join(sorted(w)).encode()) for w in word]
            yield S.batch_of(list(zip(wid, n, word, cid, strict=True)), schema)

    return S.map_rows(in_order, {"wid": F.monotonically_increasing_id(), "n": F.col("n"), "word": F.col("word")}, run, CLASSES)


def _letter_number(letter: str) -> int:
    """A random number below 2^31, so that a word's sum fits a long."""
    return xxhash.xxh32_intdigest(letter, 11) >> 1


def signatures(classes: DataFrame) -> DataFrame:
    """``classes`` (cid, word) -> (sig, cid, total of the letters' numbers), one row per two partitions left out."""
    schema = S.arrow_schema(SIGNATURES)
    left_out = list(combinations(range(PARTITIONS), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition: dict[tuple[str, int], int] = {}
        number: dict[str, int] = {}
        for b in batches:
            out = []
            for cid, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                parts: list[list[str]] = [[] for _ in range(PARTITIONS)]
                total = 0
                for letter, times in sorted(Counter(word).items()):
                    if letter not in number:
                        number[letter] = _letter_number(letter)
                    total += times * number[letter]
                    for k in range(times):
                        dim = (letter, k)
                        if (p := partition.get(dim)) is None:
                            # the first occurrence of a letter in turn, so that frequent letters are apart; others by hash
                            p = ord(letter) % PARTITIONS if k == 0 else xxhash.xxh64_intdigest(f"{letter}{k}", 3) % PARTITIONS
                            if len(partition) < 10_000:
                                partition[dim] = p
                        parts[p].append(f"{letter}{k}")
                digests = [xxhash.xxh64_digest("".join(p)) for p in parts]
                for i, j in left_out:
                    rest = digests[:i] + digests[i + 1 : j] + digests[j + 1 :]
                    out.append((xxhash.xxh64_intdigest(b"".join(rest), i * PARTITIONS + j) - (1 << 63), cid, total))
            yield S.batch_of(out, schema)

    return S.map_rows(classes, {"cid": F.col("cid"), "word": F.col("word")}, run, SIGNATURES)


def _differences(spark: SparkSession) -> DataFrame:
    """(difference, gone, come): a multiset's total less that of one with ``come`` in place of ``gone`` ('' for none).

    The letters are those of the pattern after A-Z are lowered, so this has at most 91 * 90 rows.
    """
    letters = [c for c in map(chr, range(0x100)) if re.fullmatch(f"[{LETTERS}]", c) and not "A" <= c <= "Z"]
    number = {c: _letter_number(c) for c in letters} | {"": 0}
    rows = [(number[g] - number[c], g, c) for g in number for c in number if g != c]
    return spark.createDataFrame(rows, "difference long, gone string, come string")


def multiset_links(classes: DataFrame) -> DataFrame:
    """(cid, gone, other, come): pairs of multisets one letter apart, in both directions.

    ``cid`` has ``gone`` where ``other`` has ``come``; one of them may be '' (a letter more).
    """
    sigs = S.staged(signatures(classes), "signatures")
    shared = sigs.groupBy("sig").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("sig")
    met = sigs.join(shared, "sig")
    a, b = met.alias("a"), met.alias("b")
    pairs = a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.cid") < F.col("b.cid")))
    difference = F.col("a.total") - F.col("b.total")
    # at most 8,190 rows whatever the input
    known = F.broadcast(_differences(classes.sparkSession))
    found = (
        pairs.select(F.col("a.cid").alias("cid"), F.col("b.cid").alias("other"), difference.alias("difference"))
        .join(known, "difference").select("cid", "gone", "other", "come").distinct()
    )
    found = S.staged(found, "links")
    return found.unionByName(found.select(F.col("other").alias("cid"), F.col("come").alias("gone"), F.col("cid").alias("other"), F.col("gone").alias("come")))


def variants(words: DataFrame, links: DataFrame) -> DataFrame:
    """(key, wid, n, kind): words as they meet those of linked multisets.

    kind 'masked': a letter is open at one position; 'short': the word itself;
    'long': the word less one letter.
    """
    # per multiset at most one entry per letter and kind
    kinds = F.when((F.col("gone") != "") & (F.col("come") != ""), "masked").when(F.col("gone") == "", "short").otherwise("long")
    asked = links.select("cid", kinds.alias("kind"), "gone").groupBy("cid").agg(F.collect_set(F.struct("kind", "gone")).alias("asked"))
    schema = S.arrow_schema(VARIANTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            rows = []
            for wid, n, word, asked in zip(*[c.to_pylist() for c in b.columns], strict=True):
                open_at = {a["gone"] for a in asked if a["kind"] == "masked"}
                lose = {a["gone"] for a in asked if a["kind"] == "long"}
                if any(a["kind"] == "short" for a in asked):
                    rows.append((digest("-" + word), wid, n, "short"))
                for i, letter in enumerate(word):
                    if letter in open_at:
                        rows.append((digest(f"{word[:i]}\0{word[i + 1 :]}"), wid, n, "masked"))
                    # in a run of one letter it is all one which is lost
                    if letter in lose and word[i - 1 : i] != letter:
                        rows.append((digest(f"-{word[:i]}{word[i + 1 :]}"), wid, n, "long"))
                if len(rows) >= 20_000:
                    yield S.batch_of(rows, schema)
                    rows = []
            yield S.batch_of(rows, schema)

    joined = words.join(asked, "cid")
    return S.map_rows(joined, {c: F.col(c) for c in ("wid", "n", "word", "asked")}, run, VARIANTS)


def neighbours(met: DataFrame) -> DataFrame:
    """(wid, n_near, best): for every word with a near one, how many, and the most frequent (n, wid; ties: smallest)."""
    ranked = F.struct((-F.col("n")).alias("minus_n"), "wid")
    # one position open: as many words at most as there are letters
    groups = met.where("kind = 'masked'").groupBy("key").agg(F.array_sort(F.collect_list(ranked)).alias("words")).where(F.size("words") > 1)
    replaced = groups.select("words", F.posexplode("words").alias("at", "word")).select(
        F.col("word.wid").alias("wid"), (F.size("words") - 1).cast("long").alias("n_near"),
        F.when(F.col("at") == 0, F.col("words")[1]).otherwise(F.col("words")[0]).alias("best"),
    )
    short = met.where("kind = 'short'").select("key", ranked.alias("short"))
    long = met.where("kind = 'long'").select("key", ranked.alias("long"))
    pairs = short.join(long, "key").select(F.inline(F.array(
        F.struct(F.col("short.wid").alias("wid"), F.col("long").alias("best")),
        F.struct(F.col("long.wid").alias("wid"), F.col("short").alias("best")),
    ))).select("wid", F.lit(1).cast("long").alias("n_near"), "best")
    return replaced.union(pairs).groupBy("wid").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (wid, form) -> (wid, root), the last form from each word on; rounds double the distance followed.

    A form is ``factor`` times as frequent as its word, so chains are short and have no loops.
    """
    now = S.staged(forms.select("wid", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        both = S.staged(now.join(further, "root", "left").select("wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = both.select("wid", "root")
        if both.where("moved").isEmpty():
            return now


def spelling_variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, factor: int = 5
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the runs of letters of whole texts, A-Z lowered, at least
    ``least_length`` long and ``least_count`` times in all texts, after the
    rule that drops a letter of one occurrence in 199 by the crc32 of id and
    run (a null id counts as 'null'). ``form`` is the most frequent near word
    (ties: smallest in code-point order) if it is ``factor`` times as frequent
    as the word, else null; ``root`` follows forms to the last. Null texts have
    no words; repeated rows count as often as given; a table without such words
    gives an empty result.
    """
    if factor < 2:
        raise ValueError("forms must be more frequent than their words")
    counts = counted(df, id_col, text_col, least_length).where(F.col("n") >= least_count)
    words = S.staged(vocabulary(counts), "vocabulary")
    classes = words.groupBy("cid").agg(F.min("word").alias("word"))
    near = S.staged(neighbours(S.staged(variants(words, multiset_links(classes)), "variants")), "near")
    known = words.select("wid", "word", "n").join(near, "wid", "left").select(
        "wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.wid").alias("form"), (-F.col("best.minus_n")).alias("form_n")
    )
    formed = F.col("form_n") >= factor * F.col("n")
    known = S.staged(known.withColumns({c: F.when(formed, F.col(c)) for c in ("form", "form_n")}), "forms")
    ends = roots(known.where("form is not null").select("wid", "form"))
    names = words.select(F.col("wid").alias("at"), F.col("word").alias("name"))
    followed = known.where("form is not null").join(ends, "wid")
    followed = followed.join(names.select(F.col("at").alias("form"), F.col("name").alias("form_word")), "form")
    followed = followed.join(names.select(F.col("at").alias("root"), F.col("name").alias("root_word")), "root")
    alone = known.where("form is null")
    return followed.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n").union(
        alone.select("word", F.lit(None).cast("string"), "word", "n", "n_near", "form_n")
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(S.read_table(spark, sf_dir, "documents"))
