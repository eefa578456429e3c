"""Quality rules as a learned decision list.

Statistics of every whole text are computed in one pass. From the statistics of
labelled documents, sequential covering grows conjunctions of thresholds that
select bad documents (greatest information gain on two thirds of the rows),
prunes them on the other third, and keeps those that are precise there. The
ordered list becomes one Spark conditional expression over the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.llm import _shared as S

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_lower",
          "n_digits", "n_marks"]


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


#: What rules may test, as expressions over the counts (which carry a prefix while beside other columns).
def measures(prefix: str = "") -> dict[str, Column]:
    c = {n: F.col(prefix + n) for n in COUNTS}
    return {
        "words": c["n_words"].cast("double"),
        "chars_per_word": _ratio(c["word_chars"], c["n_words"]),
        "symbols_per_word": _ratio(c["n_symbols"], c["n_words"]),
        "marks_per_word": _ratio(c["n_marks"], c["n_words"]),
        "dup_lines_per_line": _ratio(c["n_dup_lines"], c["n_lines"]),
        "repeat_words_per_word": _ratio(c["n_repeat_words"], c["n_words"]),
        "distinct_per_word": _ratio(c["n_distinct"], c["n_words"]),
        "upper_per_letter": _ratio(c["n_upper"], c["n_upper"] + c["n_lower"]),
        "digits_per_char": _ratio(c["n_digits"], c["word_chars"]),
        "words_per_line": _ratio(c["n_words"], c["n_lines"]),
    }


def repeated_words(words: Sequence[bytes], window: int = 3) -> tuple[int, int]:
    """(words inside windows found twice or more, distinct words)."""
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(at) < window:
        return 0, len(ids)
    code = at[: len(at) - window + 1]
    for k in range(1, window):
        nxt = at[k : len(at) - window + 1 + k]
        if len(ids) ** 2 >= 2**62 // max(1, len(ids)):  # renumber before a product could overflow
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(ids) + nxt
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    inside = np.zeros(len(at), bool)
    for k in range(window):
        inside[k : len(again) + k] |= again
    return int(inside.sum()), len(ids)


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for a whole text; null counts as empty."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    repeat, distinct = repeated_words(words)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            lines += 1
            dups += line in seen
            seen.add(line)
    count = lambda kinds: len(raw) - len(raw.translate(None, kinds))
    white = count(b" \t\n\r\x0b\x0c")
    return (len(words), len(text) - white, count(SYMBOLS), dups, repeat, lines, distinct, count(UPPER), count(LOWER),
            count(DIGITS), count(b"!?"))


def with_counts(df: DataFrame, text_col: str, keep: Sequence[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` of ``df`` and the counts of its texts."""
    kept = df.select(*map(S.column, keep)).schema.fields
    schema = T.StructType(kept + [T.StructField(prefix + c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = [text_counts(t) for t in b.column(len(keep)).to_pylist()]
            cols = list(zip(*counts, strict=True)) if counts else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], *[pa.array(c, pa.int64()) for c in cols]], names=[*keep, *[prefix + c for c in COUNTS]]
            )

    return S.map_rows(df, {c: S.column(c) for c in keep} | {S.free_name("_text", keep): S.column(text_col)}, run, schema)


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def holds(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        x = columns[self.measure]
        return x > self.threshold if self.above else x <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.measure] > self.threshold if self.above else of[self.measure] <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a document that meets one is rejected, others are kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def kept(self, prefix: str = "") -> Column:
        of, out = measures(prefix), None
        for rule in self.rules:
            met = F.lit(True)
            for c in rule:
                met = met & c.column(of)
            out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join([*(f"if {' and '.join(map(str, r))}: reject" for r in self.rules), "else: keep"])


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    return -math.inf if p == 0 else p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _best(columns: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of greatest gain among all cuts between neighbouring values of the rows inside."""
    y = bad[inside]
    p0, n0 = int(y.sum()), int((~y).sum())
    best: tuple[float, Condition | None] = (1e-9, None)
    for name, x in columns.items():
        v = x[inside]
        order = np.argsort(v, kind="stable")
        v, z = v[order], y[order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        low_p = np.cumsum(z)[cuts]
        low_n = cuts + 1 - low_p
        for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))), -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), Condition(name, above, float((v[cuts[k]] + v[cuts[k] + 1]) / 2)))
    return best


def _covers(rule: Sequence[Condition], columns: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(columns)
    return out


def learn_rules(
    columns: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.9, min_covered: int = 5,
    max_rules: int = 12, max_conditions: int = 4,
) -> DecisionList:
    """Sequential covering over rows whose order carries no meaning: every third row prunes, the others grow."""
    n = len(bad)
    prune_row = np.arange(n) % 3 == 2
    left = np.ones(n, bool)
    out = DecisionList()
    while len(out.rules) < max_rules:
        grow = left & ~prune_row
        if not (bad & grow).any() or not (~bad & grow).any():
            break
        rule: list[Condition] = []
        inside = grow.copy()
        while len(rule) < max_conditions and (~bad & inside).any():
            _, c = _best(columns, bad, inside)
            if c is None:
                break
            rule.append(c)
            inside &= c.holds(columns)
        if not rule:
            break

        def worth(r: Sequence[Condition], rows: np.ndarray) -> tuple[float, int]:
            got = _covers(r, columns, n) & rows
            p = int((bad & got).sum())
            return (p / max(1, int(got.sum())), p)

        held = left & prune_row
        # the shortest prefix of the rule that is as precise on the pruning rows
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (round(worth(r, held)[0], 3), worth(r, held)[1], -len(r)))
        precision, covered = worth(rule, left)
        if precision < min_precision or worth(rule, held)[0] < min_precision or covered < min_covered:
            break
        out.rules.append(rule)
        left &= ~_covers(rule, columns, n)
    return out


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_train_rows: int = 20_000,
) -> DecisionList:
    """A decision list from at most ``max_train_rows`` labelled documents, taken in the order of their hashed ids.

    That bound makes the sample safe to broadcast and to fit on the driver.
    Labels other than 0 and 1 and null ids are ignored; with several labels for
    an id, the best counts. Without labelled rows the list is empty.
    """
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_good"))
        .where("_id is not null and _good in (0, 1)").groupBy("_id").agg(F.max("_good").alias("_good"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_train_rows)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    stats = with_counts(rows, "_text", ["_id", "_good"])
    names = measures()
    table = (
        stats.where(~base_failed()).groupBy("_id").agg(F.max("_good").alias("_good"), *[F.max(c).alias(n) for n, c in names.items()])
        .orderBy(F.xxhash64("_id"), "_id").toPandas()
    )
    return learn_rules({n: table[n].to_numpy(float) for n in names}, (table["_good"] == 0).to_numpy())


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_train_rows: int = 20_000,
) -> DataFrame:
    """Per document: doc_id, the four base counts with n_words, base_failed and kept.

    ``kept`` is false if the base rules fail, else the learned list's verdict.
    Null and empty texts have no words and fail; repeated rows are returned as
    often as given; an empty table gives an empty result.
    """
    rules = learn(docs, labels, id_col, text_col, label_col, max_train_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    return with_counts(rows, "_text", ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & rules.kept()).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all their columns, without the rejected documents; one pass, no shuffle of texts."""
    rules = learn(docs, labels, id_col, text_col)
    prefix = "_q"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    counted = with_counts(docs, text_col, docs.columns, prefix)
    return counted.where(~base_failed(prefix) & rules.kept(prefix)).select(*map(S.column, docs.columns))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(S.read_table(spark, sf_dir, "documents"), S.read_table(spark, sf_dir, "labels"))
