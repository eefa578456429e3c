"""Token counts under a unigram vocabulary: a Viterbi pass that keeps only the best score and its piece count.

An Aho-Corasick automaton lists all vocabulary pieces ending at each position;
the best path to a position is the one of highest score. Ties keep the earliest
start of the last piece, as the tokenizers library does: it goes through starts
from the left and replaces a path only by a strictly better one. A character
that is no piece itself may also be passed as unknown, at 10 below the lowest
score; unknown characters count one piece per UTF-8 byte if the vocabulary has
byte pieces, else one per run.

No piece of usual vocabularies holds a space mark after another character, and
integral scores add up exactly, so the text can be cut before such marks and
the counts of its words kept; otherwise whole texts are passed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

MARK = "▁"  # the mark that stands for a space
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 600_000


class Counter(dict):
    """Piece counts of segments, found when first asked for."""

    def __init__(self, pieces: dict[str, float], byte_fallback: bool, lowest: float | None = None) -> None:
        super().__init__()
        if not pieces:
            raise ValueError("an empty vocabulary")
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces.items():
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = (min(pieces.values()) if lowest is None else lowest) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        apart = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if apart and all(float(s).is_integer() for s in pieces.values()) else None

    def __missing__(self, segment: str) -> int:
        n = self.best(segment)[1]
        if len(segment) <= 64:
            self[segment] = n
        return n

    def best(self, text: str) -> tuple[float, int]:
        """(score, pieces) of the best path."""
        size = len(text)
        score = [0.0] + [None] * size
        count = [0] * (size + 1)
        begin = [0] * (size + 1)
        loose = bytearray(size + 1)  # the best path ends in an unknown run
        done = 0  # positions up to here are final but for the unknown step

        def step(end: int) -> None:
            """The unknown character before ``end`` (it starts last, so it loses ties)."""
            c = text[end - 1]
            if c not in self.single and ((s := score[end - 1] + self.unknown) > score[end] if score[end] is not None else True):
                score[end], begin[end], loose[end] = score[end - 1] + self.unknown, end - 1, 1
                count[end] = count[end - 1] + (len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else not loose[end - 1])

        for last, (length, s) in self.automaton.iter(text):
            end = last + 1
            while done < last:
                done += 1
                step(done)
            start = end - length
            got = score[start] + s
            if score[end] is None or got > score[end] or (got == score[end] and start < begin[end]):
                score[end], count[end], begin[end], loose[end] = got, count[start] + 1, start, 0
        while done < size:
            done += 1
            step(done)
        return score[size], count[size]

    def tokens(self, text: str | None) -> int:
        """Pieces of a text: a mark goes before it and for each space; null and empty texts have none."""
        if not text:
            return 0
        if len(self) > CACHE_ENTRIES:
            self.clear()
        marked = MARK + text.replace(" ", MARK)
        return sum(map(self.__getitem__, self.words.findall(marked))) if self.words else self.best(marked)[1]


@lru_cache(maxsize=2)
def counter(vocabulary: str) -> Counter:
    """The pieces and scores of a sentencepiece file, loaded once per Python worker."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    ids = range(p.get_piece_size())
    plain = {p.id_to_piece(i): p.get_score(i) for i in ids if not (p.is_unknown(i) or p.is_control(i) or p.is_unused(i) or p.is_byte(i))}
    return Counter(plain, any(p.is_byte(i) for i in ids))


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens) of every whole text under the vocabulary's scores.

    Null and empty texts have 0; repeated rows are returned as often as given;
    an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for b in batches:
            n = [c.tokens(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return S.map_rows(df, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col)}, run, "doc_id long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return token_counts(S.read_table(spark, sf_dir, "documents"), vocabulary=path("piece_bpe_32k.model"))
