"""Byte-pair encoding and decoding over a pair occurrence index.

The distinct pre-tokens of a batch that the task has not met before are laid
out as one row of symbols. An index maps each adjacent pair with a merge to all
its positions; active ranks are applied in ascending order, each to all its
positions at once, and only the lists of pairs beside a merge are updated. Ids
of a text are then the joined ids of its pre-tokens.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

# Fixed values of the tokenizer family: Unicode white space, and the byte-level split pattern.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: A Python worker keeps the ids of pieces of up to this many characters, while they take up to this many bytes,
#: counting so many for the objects of an entry. Longer ones (texts without spaces) are kept for a batch only.
CACHE_CHARS, CACHE_BYTES, ENTRY_BYTES = 64, 128 << 20, 200


def _bytes(piece: str, ids: bytes) -> int:
    return ENTRY_BYTES + 4 * len(piece) + len(ids)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Encoder:
    """A byte-level BPE vocabulary of a ``tokenizers`` JSON file."""

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError("a vocabulary without prefix space and with the split pattern is needed")
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        to_byte = {c: b for b, c in letters.items()}
        self.byte_id = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.merges: list[tuple[int, int, int]] = []
        self.width = 1 + max(vocab.values())
        made: dict[int, int] = {}
        rank_of: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right, new = vocab[a], vocab[b], vocab[a + b]
            if max(made.get(left, -1), made.get(right, -1)) >= rank:
                raise ValueError("a merge comes before its parts; ranks can't be applied in ascending order")
            made.setdefault(new, rank)
            rank_of.setdefault(left * self.width + right, rank)
            self.merges.append((left, right, new))
        self.pairs = np.array(sorted(rank_of), np.int64)
        self.rank_of = np.array([rank_of[p] for p in sorted(rank_of)], np.int64)
        specials = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in specials):
            raise ValueError("added tokens that strip or need word boundaries are not supported")
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in specials}
        self.pieces: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in specials)]))
        for token, i in vocab.items():
            self.pieces[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for t in specials:
            self.pieces[t["id"]] = t["content"].encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        # a space before a character that is no white space always begins a pre-token
        self.chunks = re.compile(rf" (?=[^{SPACE}])")
        self.words = regex.compile(SPLIT)
        self.bare: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.merged: dict[str, bytes] = {}
        self.held = 0

    def encode_batch(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes (null: none)."""
        if self.held > CACHE_BYTES:
            self.held = 0
            for known in (self.bare, self.spaced, self.merged):
                known.clear()
        new_bare: set[str] = set()
        new_spaced: set[str] = set()
        for t in texts:  # split twice rather than hold the pieces of all texts
            for s in self._segments(t):
                if s not in self.special:
                    first, *rest = self.chunks.split(s)
                    new_bare.add(first)
                    new_spaced.update(set(rest).difference(self.spaced))
        self._learn(new_bare.difference(self.bare), self.bare, "")
        self._learn(new_spaced, self.spaced, " ")
        out = [self._joined(t) for t in texts]
        for chunks, known in ((new_bare, self.bare), (new_spaced, self.spaced)):
            for c in chunks:
                if len(c) > CACHE_CHARS:
                    known.pop(c, None)
        return out

    def _joined(self, text: str | None) -> bytes:
        parts: list[bytes] = []
        for s in self._segments(text):
            if s in self.special:
                parts.append(self.special[s])
            else:
                first, *rest = self.chunks.split(s)
                parts.append(self.bare[first])
                parts.extend(map(self.spaced.__getitem__, rest))
        return b"".join(parts)

    def _segments(self, text: str | None) -> list[str]:
        if not text:
            return []
        return [s for s in self.cut.split(text) if s] if self.cut else [text]

    def _learn(self, chunks: set[str], into: dict[str, bytes], lead: str) -> None:
        """Ids of chunks of text (which begin at pre-token boundaries) into ``into``."""
        pieces = {c: self.words.findall(lead + c) for c in chunks}
        found = self.merge_all(list({w for p in pieces.values() for w in p} - self.merged.keys()))
        kept = {w: ids for w, ids in found.items() if len(w) <= CACHE_CHARS}
        self.merged |= kept
        for c, p in pieces.items():
            into[c] = b"".join([found[w] if w in found else self.merged[w] for w in p])
        self.held += sum(_bytes(w, ids) for w, ids in kept.items())
        self.held += sum(_bytes(c, into[c]) for c in pieces if len(c) <= CACHE_CHARS)

    def merge_all(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each pre-token, all merged together through the pair occurrence index."""
        if not words:
            return {}
        raw = [w.encode() for w in words]
        sym = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.cumsum([len(w) for w in raw])
        right, left = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
        right[ends - 1] = -1  # no links from one pre-token to the next
        left[ends[:-1]] = -1
        index: dict[int, list[np.ndarray]] = {}  # rank of a pair -> its positions
        ranks: list[int] = []  # heap of the active ranks

        def add(at: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            pair = a * self.width + b
            m = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            hit = self.pairs[m] == pair
            found, at = self.rank_of[m[hit]], at[hit]
            if not len(found):
                return
            order = np.argsort(found, kind="stable")
            found, at = found[order], at[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            for rank, part in zip(found[np.r_[0, cuts]].tolist(), np.split(at, cuts) if len(cuts) else (at,), strict=True):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(ranks, rank)

        at = np.flatnonzero(right >= 0)
        add(at, sym[at], sym[right[at]])
        while ranks:
            rank = heapq.heappop(ranks)
            a, b, new = self.merges[rank]
            parts = index.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            j = right[at]
            live = (sym[at] == a) & (j >= 0) & (sym[j] == b)  # others were taken by earlier merges
            if a == b:
                live = self._leftmost(at, j, live)
            at, j = at[live], j[live]
            if not len(at):
                continue
            sym[at], sym[j] = new, -1
            k, h = right[j], left[at]
            right[at] = k
            in_word = k >= 0
            left[k[in_word]] = at[in_word]
            h = h[h >= 0]
            h = np.where(sym[h] < 0, left[h], h)  # the left neighbour was merged away just now
            at, k = at[in_word], k[in_word]
            starts = np.concatenate((h, at))
            add(starts, sym[starts], sym[right[starts]])
        kept = sym >= 0
        ids = sym[kept].astype("<u4").tobytes()
        stops = (4 * np.cumsum(kept)[ends - 1]).tolist()
        return {w: ids[i:j] for w, i, j in zip(words, [0, *stops], stops, strict=False)}

    @staticmethod
    def _leftmost(at: np.ndarray, j: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Of overlapping occurrences of a pair of equal symbols, every second one from the left."""
        live = live.copy()
        taken = -1
        for n in np.flatnonzero(live).tolist():
            if at[n] == taken:
                live[n] = False
            else:
                taken = j[n]
        return live

    def decode(self, ids: bytes) -> str:
        """Text of ids (special tokens kept; invalid UTF-8 replaced)."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class RankEncoder(Encoder):
    """The same ids for vocabularies whose ids follow the ranks, with tiktoken merging chunks new to the task."""

    def __init__(self, vocabulary: str) -> None:
        import tiktoken

        super().__init__(vocabulary)
        made = [new for _, _, new in self.merges]
        if made != sorted(set(made)) or sorted(self.byte_id.tolist()) != list(range(256)):
            raise ValueError("ids don't follow the ranks")
        ranks = {p: i for i, p in enumerate(self.pieces) if p and p.decode("utf-8", "replace") not in self.special}
        self.ranked = tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.bare, self.spaced = _Ranked(self.ranked, ""), _Ranked(self.ranked, " ")

    def encode_batch(self, texts: Sequence[str | None]) -> list[bytes]:
        if self.bare.held + self.spaced.held > CACHE_BYTES:
            for known in (self.bare, self.spaced):
                known.clear()
                known.held = 0
        return [self._joined(t) for t in texts]


class _Ranked(dict):
    """Ids of chunks, found when first asked for; ``held`` counts the bytes of those kept."""

    def __init__(self, ranked, lead: str) -> None:
        super().__init__()
        self.encode, self.lead, self.held = ranked.encode_ordinary, lead, 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(self.lead + chunk)
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= CACHE_CHARS:
            self[chunk] = out
            self.held += _bytes(chunk, out)
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: str, by_rank: bool = False) -> Encoder:
    """The vocabulary, loaded once per Python worker (its caches are bounded and shared by tasks)."""
    return (RankEncoder if by_rank else Encoder)(vocabulary)


ENCODED = "doc_id long, ids binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str) -> DataFrame:
    """(doc_id, ids: little-endian uint32 binary) of every row; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in S.gathered(batches):
            ids = enc.encode_batch(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return S.map_rows(df, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col)}, run, ENCODED)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", *, vocabulary: str) -> DataFrame:
    """(doc_id, text) of every row of ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            texts = [enc.decode(i or b"") for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return S.map_rows(df, {"doc_id": F.col(id_col).cast("long"), "ids": F.col(ids_col)}, run, "doc_id long, text string")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str) -> DataFrame:
    """Encodes and decodes every text in one pass; returns doc_id, n_tokens and the SHA-256 digests of both.

    Null and empty texts have no tokens and the digests of nothing; repeated
    rows are returned as often as given; an empty table gives an empty result.
    """
    schema = S.arrow_schema(DIGESTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in S.gathered(batches):
            ids = enc.encode_batch(b.column(1).to_pylist())
            rows = [
                (d, len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(enc.decode(i).encode()).hexdigest())
                for d, i in zip(b.column(0).to_pylist(), ids, strict=True)
            ]
            yield S.batch_of(rows, schema)

    return S.map_rows(df, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col)}, run, DIGESTS)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return round_trip(S.read_table(spark, sf_dir, "documents"), vocabulary=path("byte_bpe_50k.json"))
