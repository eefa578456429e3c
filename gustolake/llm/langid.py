"""Language identification by rank-order profiles of n-grams.

Training counts the n-grams (1 to 3 letters, words padded by a mark) of all
training texts of a language and keeps the ``profile`` most frequent ones in
order. A text's own most frequent n-grams are ranked alike; its distance to a
language is the sum of how far out of place each is there (``profile`` where
it is missing), and the nearest language wins.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.llm import _shared as S

UNKNOWN = "und"
PAD = "_"
PROFILE = 400
#: Profiles are collected and sent to tasks; this and PROFILE bound their size.
MAX_LANGUAGES = 2000
_APART = re.compile(r"[\W\d_]+")
_HELD = 2_000_000  # n-grams a training task holds before it counts them


def grams_of(text: str | None) -> np.ndarray:
    """Codes of all 1- to 3-grams of the lower-cased, padded words of a text (three code points, from the left).

    The bare mark is no n-gram. Codes sort like the n-grams.
    """
    if not text:
        return np.zeros(0, np.int64)
    padded = PAD + _APART.sub(PAD + PAD, text.lower()) + PAD
    c = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    mark = c == ord(PAD)
    within = ~(mark[:-1] & mark[1:])  # neighbours of one word
    one = c << 42
    two = one[:-1] | c[1:] << 21
    return np.concatenate((one[~mark], two[within], (two[:-1] | c[2:])[within[:-1] & within[1:]]))


def gram_text(code: int) -> str:
    return "".join(chr(code >> s & 0x1FFFFF) for s in (42, 21, 0)).rstrip("\0")


def gram_code(gram: str) -> int:
    a, b, c = (ord(x) for x in gram.ljust(3, "\0"))
    return a << 42 | b << 21 | c


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", profile: int = PROFILE) -> dict[str, list[str]]:
    """Profiles of all languages from all rows with text and language: n-grams by falling count, ties by n-gram."""
    schema = "lang string, gram string, n long"
    arrow = S.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, dict[int, int]] = defaultdict(dict)
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        size = 0

        def fold() -> None:
            for lang, parts in held.items():
                into = total[lang]
                for code, n in zip(*(x.tolist() for x in np.unique(np.concatenate(parts), return_counts=True)), strict=True):
                    into[code] = into.get(code, 0) + n
            held.clear()

        def out() -> pa.RecordBatch:
            rows = [(lang, gram_text(code), n) for lang, counts in total.items() for code, n in counts.items()]
            total.clear()
            return S.batch_of(rows, arrow)

        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                codes = grams_of(text)
                held[lang].append(codes)
                size += len(codes) + 1
                if size > _HELD:
                    fold()
                    size = 0
                    if sum(map(len, total.values())) > _HELD // 4:
                        yield out()
        fold()
        yield out()

    rows = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = S.map_rows(rows, {"text": F.col(text_col), "lang": F.col(lang_col)}, run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile)
    found: dict[str, list[str]] = defaultdict(list)
    for r in sorted(top.limit(MAX_LANGUAGES * profile + 1).collect(), key=lambda r: (r["lang"], r["rank"])):
        found[r["lang"]].append(r["gram"])
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return dict(found)


class Ranker:
    """Distances of texts to profiles."""

    def __init__(self, profiles: dict[str, Sequence[str]], profile: int = PROFILE) -> None:
        self.size = profile
        self.langs = sorted(profiles)
        self.codes = np.array(sorted({gram_code(g) for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)  # the last row: in no profile
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, [gram_code(g) for g in profiles[lang]]), k] = np.arange(len(profiles[lang]))

    def ranked(self, text: str | None) -> np.ndarray:
        """Codes of the text's most frequent n-grams in order (ties by n-gram); none if it has no letter."""
        codes, n = np.unique(grams_of(text), return_counts=True)
        if not any(chr(c >> 42).isalpha() for c in codes[codes & ((1 << 42) - 1) == 0].tolist()):
            return codes[:0]
        return codes[np.argsort(-n, kind="stable")[: self.size]]

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score) of ``judged``."""
        return self.judged(text)[:2]

    def judged(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, nearness), both from 0 to 1.

        The score is how much farther the second nearest language is; the
        nearness is 1 where the nearest profile has the text's n-grams in the
        same order and 0 where it has none of them. ``und`` with zeros if the
        text is null or has no letter, or nothing was learned. Ties go to the
        language first in the alphabet.
        """
        top = self.ranked(text)
        if not len(top) or not self.langs:
            return UNKNOWN, 0.0, 0.0
        at = np.searchsorted(self.codes, top)
        at[at == len(self.codes)] = 0
        ranks = self.ranks[np.where(self.codes[at] == top, at, len(self.codes))]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(top))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        rest = np.delete(away, best)
        farthest = self.size * len(top)
        second = rest.min() if len(rest) else farthest
        return self.langs[best], float((second - away[best]) / second) if second else 0.0, float(1 - away[best] / farthest)


def with_language(
    df: DataFrame, profiles: dict[str, Sequence[str]], text_col: str, keep: Sequence[str], profile: int = PROFILE,
    names: Sequence[str] = ("lang_pred", "lang_score", "lang_nearness"),
) -> DataFrame:
    """The columns ``keep`` of ``df`` and the judgement of the whole text alone as the columns ``names``."""
    kept = df.select(*map(S.column, keep)).schema.fields
    judged = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.DoubleType()), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles, profile)
        for b in batches:
            got = [ranker.judged(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(keep)], pa.array([g[0] for g in got], pa.string()), *[pa.array([g[k] for g in got], pa.float64()) for k in (1, 2)]],
                names=[*keep, *names],
            )

    columns = {c: S.column(c) for c in keep} | {S.free_name("_text", keep): S.column(text_col)}
    return S.map_rows(df, columns, run, T.StructType(kept + judged))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.

    Profiles come from the rows whose crc32 of the id modulo 5 is not 0; the
    others are held out. Repeated rows are returned as often as given; an
    empty table gives an empty result.
    """
    held_out = S.fold_of(F.col(id_col)) == 0
    profiles = learn(df.where(~held_out), text_col, lang_col)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("_text"))
    out = with_language(rows, profiles, "_text", ["doc_id", "held_out"])
    return out.withColumnRenamed("lang_score", "score").select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_nearness: float = 0.25) -> DataFrame:
    """``df`` with all its columns, without documents in none of the learned languages.

    Such are documents without a letter and those whose nearness to the nearest
    profile is below ``min_nearness`` (other languages, random letters). A
    document that mixes learned languages is near to several and stays. If no
    language is learned (no row has both a language and letters), nothing can
    be told apart and only null texts and texts without a letter go.
    """
    profiles = learn(df, text_col, lang_col)
    if not any(profiles.values()):
        return df.where(S.column(text_col).rlike(r"\p{L}"))
    names = [S.free_name(n, df.columns) for n in ("_lang", "_score", "_nearness")]
    out = with_language(df, profiles, text_col, df.columns, names=names)
    return out.where((F.col(names[0]) != UNKNOWN) & (F.col(names[2]) >= min_nearness)).select(*map(S.column, df.columns))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(S.read_table(spark, sf_dir, "documents"))
