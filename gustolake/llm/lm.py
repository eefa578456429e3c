"""Language-model scoring with a probabilistic suffix tree over words.

States are contexts of any number of previous words. A context is retained if
its next-word distribution diverges from that of its suffix: the leave-one-out
log likelihood of the training words after it, under the smoothed distribution,
must exceed their likelihood under the suffix state. Next-word probabilities are
smoothed with the suffix state's, and a word is scored in the longest retained
suffix of what precedes it. A longer context is tested if it was seen twice, its
suffix was retained and the words before its last were tested as a context; the
tree ends where no context is left to test.

The model grows with the corpus, so it is never sent anywhere whole. Documents
are tokenized once into blocks of about ``block_tokens`` tokens. Level by level,
each block sends its distinct (context, word) pairs with their counts to the
tasks that sum that part of the model; a task sends back the totals, verdicts
and numbers of just these pairs. Words and pairs are known by numbers that the
tasks give out, so nothing rests on hashes; a pair's number names the longer
context on the next level. Contexts seen so often that one task should not hold
them are split by the next word; the parts' shares of the gain are added up in
a table, and each block gets the verdicts on the contexts it asked about.

Blocks lie in a table bucketed by block, so a round moves pairs and answers and
never texts. After two levels, and after each deeper one, the positions still
open are written as a smaller table of the same kind together with what they ask
on the next level, so a deeper level's contexts are found once; what earlier
rounds wrote is deleted. Once no
more than ``tail_rows`` positions are open in the whole corpus, which a few texts
that repeat themselves keep open for many levels, one task takes them through
all levels left by the same steps; the scores they add go back to their blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

BLOCKS = ("block long, n_tokens long, n_train long, doc_ids array<long>, held array<boolean>, lengths array<int>, "
          "tokens binary, words binary")
REQUESTS = "bucket long, block long, payload binary"
ANSWERS = "block long, level int, bucket long, distinct long, split array<long>, gains array<long>, payload binary"
OPEN = ("block long, n_open long, doc_ids array<long>, held array<boolean>, lengths array<int>, known array<long>, "
        "base array<double>, score array<double>, payload binary, buckets array<long>, requests array<binary>")
REST = "bucket long, block long, payload binary, train binary, doc binary"
CLOSED = "block long, doc binary, score binary"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

#: Block number of the rows that carry shares of the gain, and bucket number of those with verdicts on split contexts.
SHARES, VERDICTS = -1, -1
#: The number of the context at a document's start; words and pairs have smaller ones.
START = 1 << 62
#: log10 probabilities travel for the divergence test in steps of 1/_STEPS, down to 10^-65; shares of the gain in steps of 1/_UNITS.
_STEPS, _UNITS = 1000, 1 << 20
_POWERS = 10.0 ** (np.arange(1 << 16) / -_STEPS)
#: Levels that work on whole blocks (on the second most positions are still open); deeper ones work on the positions still open.
WIDE_LEVELS = 2


def _pack(*parts: bytes) -> bytes:
    return b"".join(struct.pack("<I", len(p)) + p for p in parts)


def _unpack(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        (n,) = struct.unpack_from("<I", data, at)
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _squeeze(data: bytes) -> bytes:
    return _COMPRESSOR.compress(data)


def _expand(data: bytes) -> bytes:
    return _DECOMPRESSOR.decompress(data)


def _planes(a: np.ndarray, width: int = 0, rising: bool = False) -> bytes:
    """Whole numbers as bytes of equal weight together (of their steps, if they rise), which compress well.

    Without a width there are as many as the largest number needs (one at least); the first byte tells how many.
    """
    a = (np.diff(a, prepend=0) if rising else a).astype("<i8", copy=False)
    used = width or max(1, (int(np.bitwise_or.reduce(a)) % (1 << 64)).bit_length() + 7 >> 3)
    by_weight = np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8)
    return b"".join([b"" if width else bytes([used]), *(by_weight[:, j].tobytes() for j in range(used))])


def _numbers(data: bytes, width: int = 0, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(data if width else memoryview(data)[1:], np.uint8).reshape(width or data[0], -1)
    a = np.zeros((planes.shape[1], 8), np.uint8)
    for j, plane in enumerate(planes):
        a[:, j] = plane
    a = a.view("<i8").ravel()
    return np.cumsum(a) if rising else a


def _mass(n: np.ndarray) -> np.ndarray:
    """Weight of the suffix state's distribution beside ``n`` observations."""
    return np.maximum(n, 1.0) ** 0.75


def _heads(a: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1)) if len(a) else np.zeros(0, np.int64)


def _groups(bucket: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    b = bucket[order]
    first = _heads(b)
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(b)][: len(first)], strict=True):
        yield int(b[i]), order[i:j]


def _ordered(key: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts values from 0 to ``top``, and the sorted values."""
    bits = len(key).bit_length()
    if top >> (62 - bits):
        order = np.argsort(key)
        return order, key[order]
    both = key.astype(np.int64) << bits
    both |= np.arange(len(key))
    both.sort()  # values are sorted faster than an order is found
    order = both & ((1 << bits) - 1)
    both >>= bits
    return order, both


def _by_bucket(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The stable order by bucket; numbers of two bytes are counted, not compared."""
    return np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")


def _paired(a: np.ndarray, b: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, as their two numbers (the second under ``n_b``), and which of them each row has."""
    bits = n_b.bit_length()
    keys, which = _grouped(a << bits | b)
    return keys >> bits, keys & ((1 << bits) - 1), which


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values (none negative) in order, and which of them each row has."""
    top = int(key.max(initial=0))
    if top < 4 * len(key):  # dense numbers need no sort
        there = np.zeros(top + 1, bool)
        there[key] = True
        return np.flatnonzero(there), (np.cumsum(there) - 1)[key]
    order, in_order = _ordered(key, top)
    first = _heads(in_order)
    distinct = in_order[first]
    in_order[:] = 0
    in_order[first[1:]] = 1
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(in_order, out=in_order)
    return distinct, which


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words (large binary or string) one after another, and where each one begins, with the end."""
    at = np.frombuffer(words.buffers()[1], "<i8")[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8), at - at[0]


def _joined(words: pa.Array) -> bytes:
    """Words, of which none holds a line end, as lines."""
    data, at = _bytes_of(words)
    out = np.full(len(data) + max(0, len(words) - 1), ord("\n"), np.uint8)
    of_word = np.ones(len(out), bool)
    of_word[at[1:-1] + np.arange(max(0, len(words) - 1))] = False
    out[of_word] = data
    return out.tobytes()


def _lines(data: bytes) -> pa.Array:
    """The words that ``_joined`` joined (one at least)."""
    a = np.frombuffer(data, np.uint8)
    ends = a == ord("\n")
    at = np.flatnonzero(ends)
    at = np.concatenate(([0], at - np.arange(len(at)), [len(a) - len(at)])).astype("<i8")
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(a[~ends])])


def _spread(words: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each word, by a polynomial of its bytes modulo 2^64; it only deals words out."""
    data, at = _bytes_of(words)
    n = np.diff(at)
    powers = np.full(int(n.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.cumprod(powers)[np.arange(len(data)) - np.repeat(at[:-1], n)] * (data + np.uint64(1)), out=sums[1:])
    h = (sums[at[1:]] - sums[at[:-1]]) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.int64) % buckets


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (binary, null: none) with A-Z in lower case, one after another, and how many each text has."""
    whole = pa.concat_arrays([texts[:0], texts])  # a copy from offset 0: ascii_lower misreads slices
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(whole.cast(pa.large_binary()).view(pa.large_string())))
    found = pc.ascii_split_whitespace(pc.if_else(pc.equal(pc.binary_length(trimmed), 0), None, trimmed))
    return found.flatten(), pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def build_blocks(df: DataFrame, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Blocks of whole documents; token 0 is the end of a document, others number the block's words."""
    schema = S.arrow_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, held, lengths, words = [], [], [], []  # of the block's documents, batch by batch

        def out() -> pa.RecordBatch:
            coded = pa.concat_arrays(words).dictionary_encode()
            length = np.concatenate(lengths) + 1
            flat = np.zeros(int(length.sum()), np.int64)
            is_word = np.ones(len(flat), bool)
            is_word[np.cumsum(length) - 1] = False
            flat[is_word] = coded.indices.to_numpy(zero_copy_only=False) + 1
            h = pa.concat_arrays(held)
            row = (
                part << 32 | made, len(flat), int(length[~h.to_numpy(zero_copy_only=False)].sum()), pa.concat_arrays(ids).to_pylist(), h.to_pylist(),
                length.tolist(), _squeeze(flat.astype("<u4").tobytes()), _squeeze(_joined(coded.dictionary)),
            )
            return S.batch_of([row], schema)

        size = 0
        for b in batches:
            own, n = words_of(b.column(2))
            word_ends, token_ends = np.cumsum(n), np.cumsum(n + 1)
            done = 0
            while done < len(n):
                before = int(token_ends[done - 1]) if done else 0
                # to the first text with which the block is full
                upto = min(int(np.searchsorted(token_ends, before + block_tokens - size)) + 1, len(n))
                word = int(word_ends[done - 1]) if done else 0
                for kept, more in ((ids, b.column(0)[done:upto]), (held, b.column(1)[done:upto]), (lengths, n[done:upto]), (words, own[word : int(word_ends[upto - 1])])):
                    kept.append(more)
                size += int(token_ends[upto - 1]) - before
                done = upto
                if size >= block_tokens:
                    yield out()
                    made, size = made + 1, 0
                    ids, held, lengths, words = [], [], [], []
        if ids:
            yield out()

    rows = {"doc_id": F.col(id_col).cast("long"), "held": S.fold_of(F.col(id_col)) == 1, "text": F.col(text_col).cast("binary")}
    return S.map_rows(df, rows, run, BLOCKS)


class Frontier:
    """The open positions of a block on one level, and the distinct (context, word) pairs at them.

    Pairs are in order of their contexts' numbers. ``p`` is the probability of a
    pair's word in the suffix state.
    """

    def __init__(self, pos, pair, ctx, word, p, ctx_id, ctx_n) -> None:  # noqa: ANN001  arrays; by position: pos, pair; by pair: ctx, word, p
        self.pos, self.pair, self.ctx, self.word, self.p, self.ctx_id, self.ctx_n = pos, pair, ctx, word, p, ctx_id, ctx_n

    @classmethod
    def made(cls, pos, ctx, ctx_id, ctx_n, kind, word, p) -> Frontier:  # noqa: ANN001
        """From each position's context and kind; a kind of pair has a word and a probability."""
        used = np.flatnonzero(np.bincount(ctx, minlength=len(ctx_id)))  # contexts that occur, in order of their numbers
        used = used[_ordered(ctx_id[used], int(ctx_id[used].max(initial=0)))[0]]
        rank = np.empty(len(ctx_id), np.int64)
        rank[used] = np.arange(len(used))
        of, kinds, pair = _paired(rank[ctx], kind, len(word))
        return cls(pos, pair, of, word[kinds], p[kinds], ctx_id[used], ctx_n[used])

    def _order(self, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of each pair, the order that groups buckets (contexts stay together), whether a context is split."""
        parts = self.ctx_n // model["split_rows"] + 1
        split = parts > 1
        bucket = (self.ctx_id % model["buckets"])[self.ctx]
        if split.any():
            some = np.flatnonzero(split[self.ctx])
            bucket[some] = (bucket[some] + self.word[some] % parts[self.ctx[some]]) % model["buckets"]
        return bucket, _by_bucket(bucket, model["buckets"]), split

    def requests(self, train: np.ndarray, model: dict) -> Iterator[tuple[int, bytes]]:
        bucket, order, split = self._order(model)
        counts = np.bincount(self.pair, train[self.pos], len(self.ctx))
        q = np.minimum(np.rint(-np.log10(self.p) * _STEPS), 0xFFFF)
        for k, rows in _groups(bucket, order):
            ctx = self.ctx[rows]
            first = _heads(ctx)
            own = ctx[first]
            yield k, _squeeze(_pack(
                _planes(self.ctx_id[own], rising=True), _planes(np.diff(np.append(first, len(rows)))),
                _planes(np.where(split[own], self.ctx_n[own], 0)), _planes(self.word[rows]), _planes(q[rows], 2), _planes(counts[rows]),
            ))

    def answered(self, got: dict[int, bytes], split_kept: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By pair: total, its number (where seen twice), and whether the context was retained; takes up the probabilities."""
        bucket, order, split = self._order(model)
        total, number, kept = np.zeros(len(self.ctx), np.int64), np.zeros(len(self.ctx), np.int64), np.zeros(len(self.ctx), bool)
        for k, rows in _groups(bucket, order):
            keep, counts, at = _unpack(_expand(got[k]))
            first = _heads(self.ctx[rows])
            flags = np.unpackbits(np.frombuffer(keep, np.uint8), count=len(first)).astype(bool)
            kept[rows] = np.repeat(flags, np.diff(np.append(first, len(rows))))
            total[rows], number[rows] = _numbers(counts), _numbers(at) * model["buckets"] + k
        if split.any():
            verdict = np.isin(self.ctx_id, split_kept)
            kept = np.where(split[self.ctx], verdict[self.ctx], kept)
        n = self.ctx_n.astype(float)
        mass = _mass(n)
        self.p = np.where(kept, (total + mass[self.ctx] * self.p) / (n + mass)[self.ctx], self.p)
        return total, number, kept

    def deeper(self, total: np.ndarray, number: np.ndarray, kept: np.ndarray, starts: np.ndarray) -> tuple[Frontier, np.ndarray]:
        """The frontier of contexts longer by a word, and which of this one's positions it has.

        Such a context is tested if its suffix was retained, the words before its last were tested and it was seen twice.
        ``starts`` tells, after the first level, which positions of the block begin a document.
        """
        on = kept[self.pair]
        on[:1] = False
        on[1:] &= (self.pos[1:] == self.pos[:-1] + 1) & (total[self.pair[:-1]] >= 2)
        at = np.flatnonzero(on)
        if len(starts):
            at = at[~starts[self.pos[at]]]
        out = Frontier.made(self.pos[at], self.pair[at - 1], number, total, self.pair[at], self.word, self.p)
        goes_on = np.zeros(len(self.pos), bool)
        goes_on[at] = True
        return out, goes_on

    @classmethod
    def joined(cls, parts: list[Frontier]) -> Frontier:
        """The frontiers of several blocks as one. Positions are numbered anew: neighbours stay neighbours, gaps shrink to one."""
        steps = np.concatenate([np.where(np.diff(f.pos, prepend=-2) == 1, 1, 2) for f in parts])
        ctx_id, ctx = _grouped(np.concatenate([f.ctx_id[f.ctx] for f in parts]))
        words, word = _grouped(np.concatenate([f.word for f in parts]))
        of, kinds, merged = _paired(ctx, word, len(words))
        p, ctx_n = np.zeros(len(of)), np.zeros(len(ctx_id), np.int64)
        p[merged] = np.concatenate([f.p for f in parts])  # alike in all blocks, as the counts are
        ctx_n[ctx] = np.concatenate([f.ctx_n[f.ctx] for f in parts])
        pairs = np.cumsum([0, *(len(f.ctx) for f in parts[:-1])])
        return cls(
            np.cumsum(steps),
            merged[np.concatenate([f.pair + a for f, a in zip(parts, pairs, strict=True)])],
            of, words[kinds], p, ctx_id, ctx_n,
        )

    def packed(self) -> bytes:
        return _squeeze(_pack(
            _planes(self.pos, rising=True), _planes(self.pair), _planes(self.ctx, rising=True), _planes(self.word),
            _planes(self.p.view("<i8")), _planes(self.ctx_id, rising=True), _planes(self.ctx_n),
        ))

    @classmethod
    def unpacked(cls, data: bytes) -> Frontier:
        pos, pair, ctx, word, p, ctx_id, ctx_n = _unpack(_expand(data))
        return cls(
            _numbers(pos, rising=True), _numbers(pair), _numbers(ctx, rising=True), _numbers(word), _numbers(p).view("<f8"),
            _numbers(ctx_id, rising=True), _numbers(ctx_n),
        )


class Answers:
    """What was answered to a block, by level (0: its words)."""

    def __init__(self, rows: pa.Table) -> None:
        self.by_level: dict[int, dict[int, bytes]] = {}
        self.kept: dict[int, np.ndarray] = {}
        for level, bucket, split, payload in zip(*[rows[c].to_pylist() for c in ("level", "bucket", "split", "payload")], strict=True):
            if bucket == VERDICTS:
                self.kept[level] = np.array(split, np.int64)
            else:
                self.by_level.setdefault(level, {})[bucket] = payload

    def to(self, frontier: Frontier, level: int, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return frontier.answered(self.by_level.get(level, {}), self.kept.get(level, np.zeros(0, np.int64)), model)


class Block:
    """A block's tokens."""

    def __init__(self, row: dict, model: dict) -> None:
        self.row, self.model = row, model
        self.ids = np.frombuffer(_expand(row["tokens"]), "<u4").astype(np.int64)
        words = _expand(row["words"])
        # the end of a document is the empty word
        self.words = _lines(b"\n" + words if words else b"")
        self.starts = np.concatenate(([0], np.cumsum(row["lengths"])[:-1])).astype(np.int64)
        self.begins = np.zeros(len(self.ids), bool)
        self.begins[self.starts] = True
        self.train = ~np.repeat(np.array(row["held"], bool), row["lengths"])

    def word_requests(self) -> Iterator[tuple[int, bytes]]:
        counts = np.bincount(self.ids[self.train], minlength=len(self.words))
        bucket = _spread(self.words, self.model["buckets"])
        for k, rows in _groups(bucket, _by_bucket(bucket, self.model["buckets"])):
            yield k, _squeeze(_pack(_joined(self.words.take(pa.array(rows))), _planes(counts[rows])))

    def first(self, answers: Answers) -> Frontier:
        """The frontier of contexts of one word; sets ``known`` and ``base`` of every position."""
        bucket = _spread(self.words, self.model["buckets"])
        count, number = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        for k, rows in _groups(bucket, _by_bucket(bucket, self.model["buckets"])):
            counts, at = _unpack(_expand(answers.by_level[0][k]))
            count[rows], number[rows] = _numbers(counts), _numbers(at) * self.model["buckets"] + k
        p = (count + 0.5) / (self.model["train_tokens"] + 0.5 * (self.model["distinct"] + 1))
        self.known, self.base = (count > 0)[self.ids], np.log10(p)[self.ids]
        before = np.concatenate(([0], self.ids[:-1]))
        before[self.starts] = len(self.words)
        ctx_n = np.append(count, count[0])  # as many documents begin as end
        pos = np.flatnonzero(ctx_n[before] >= 2)
        return Frontier.made(pos, before[pos], np.append(number, START), ctx_n, self.ids[pos], number, p)

    def at_level(self, level: int, answers: Answers) -> Frontier:
        """The frontier of a level, all above answered; ``logp`` holds every position's probability so far."""
        out = self.first(answers)
        self.logp = self.base.copy()
        for above in range(1, level):
            verdict = answers.to(out, above, self.model)
            self.logp[out.pos] = np.log10(out.p)[out.pair]
            out, _ = out.deeper(*verdict, self.begins)
        return out

    def open_row(self, answers: Answers) -> tuple:
        """What is left after the wide levels: scores of the positions that are done, by document, the frontier and what it asks."""
        left = self.at_level(WIDE_LEVELS + 1, answers)
        done = self.logp
        done[left.pos] = 0.0

        def by_doc(a: np.ndarray) -> list:
            return np.add.reduceat(a, self.starts).tolist()

        r = self.row
        asked = list(left.requests(self.train, self.model))
        return (
            r["block"], len(left.pos), r["doc_ids"], r["held"], r["lengths"], by_doc(self.known.astype(np.int64)), by_doc(self.base), by_doc(done),
            left.packed(), [k for k, _ in asked], [payload for _, payload in asked],
        )


class OpenBlock:
    """The positions of a block that are open on a level, with the scores of all others."""

    def __init__(self, row: dict, model: dict) -> None:
        self.row, self.model = row, model
        self.frontier = Frontier.unpacked(row["payload"])
        self.ends = np.cumsum(row["lengths"])
        self.score = np.array(row["score"], float)

    def _docs(self, pos: np.ndarray) -> np.ndarray:
        doc = np.repeat(np.arange(len(self.ends)), self.row["lengths"])
        return doc[pos]

    def _closed(self, f: Frontier, which: np.ndarray) -> None:
        self.score += np.bincount(self._docs(f.pos[which]), np.log10(f.p)[f.pair[which]], len(self.score))

    def open_row(self, level: int, answers: Answers) -> tuple:
        """What is left after the level: positions that are done go into ``score``, the others into the frontier."""
        above, r = self.frontier, self.row
        left, goes_on = above.deeper(*answers.to(above, level, self.model), np.zeros(0, bool))
        self._closed(above, ~goes_on)
        train = ~np.repeat(np.array(r["held"], bool), r["lengths"])
        asked = list(left.requests(train, self.model))
        return (
            r["block"], len(left.pos), r["doc_ids"], r["held"], r["lengths"], r["known"], r["base"], self.score.tolist(),
            left.packed(), [k for k, _ in asked], [payload for _, payload in asked],
        )

    def rest(self) -> tuple:
        """The open positions alone: the frontier, which of them are learned from and each one's document in the block."""
        docs = self._docs(self.frontier.pos)
        train = ~np.array(self.row["held"], bool)[docs]
        return (0, self.row["block"], self.row["payload"], np.packbits(train).tobytes(), _squeeze(docs.astype("<i4").tobytes()))

    def scores_with(self, closed: pa.Table) -> list[tuple]:
        """Scores of all documents, given what the open positions add."""
        for doc, score in zip(closed["doc"].to_pylist(), closed["score"].to_pylist(), strict=True):
            self.score[np.frombuffer(doc, "<i4")] += np.frombuffer(score, "<f8")
        return self._rows()

    def scores(self) -> list[tuple]:
        """Scores of all documents if the tree ends here."""
        self._closed(self.frontier, np.ones(len(self.frontier.pos), bool))
        return self._rows()

    def _rows(self) -> list[tuple]:
        r = self.row
        return [
            (d, h, n, k, self.model["train_tokens"], b, s)
            for d, h, n, k, b, s in zip(r["doc_ids"], r["held"], r["lengths"], r["known"], r["base"], self.score.tolist(), strict=True)
        ]


def _sum_words(schema: pa.Schema):
    """Totals and numbers (frequent words have small ones) of one bucket's words, for each block that asked."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        blocks, names, counts = table["block"].to_pylist(), [], []
        for payload in table["payload"].to_pylist():
            words, n = _unpack(_expand(payload))
            names.append(_lines(words))
            counts.append(_numbers(n))
        coded = pa.concat_arrays(names).dictionary_encode()
        word = coded.indices.to_numpy().astype(np.int64)
        total = np.bincount(word, np.concatenate(counts), len(coded.dictionary)).astype(np.int64)
        by_count = pc.sort_indices(pa.table({"n": total, "w": coded.dictionary}), sort_keys=[("n", "descending"), ("w", "ascending")])
        number = np.empty(len(total), np.int64)
        number[by_count.to_numpy()] = np.arange(len(total))
        distinct = int(np.count_nonzero(total))
        rows, r = [], 0
        for i, (block, own) in enumerate(zip(blocks, names, strict=True)):
            mine = word[r : r + len(own)]
            payload = _squeeze(_pack(_planes(total[mine]), _planes(number[mine])))
            rows.append((block, 0, bucket, distinct if i == 0 else 0, None, None, payload))
            r += len(own)
        return pa.Table.from_batches([S.batch_of(rows, schema)])

    return run


def _sum_pairs(schema: pa.Schema, level: int, min_gain: float):
    """Totals and numbers of one bucket's pairs and the verdicts on its contexts, for each block that asked.

    Rows name the split contexts they asked about; a row of block ``SHARES`` has these contexts' shares of the gain.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        blocks = table["block"].to_pylist()
        ctxs, runs, splits, words, qs, counts = [], [], [], [], [], []
        for payload in table["payload"].to_pylist():
            a, b, c, d, e, f = _unpack(_expand(payload))
            ctxs.append(_numbers(a, rising=True))
            runs.append(_numbers(b))
            splits.append(_numbers(c))
            words.append(_numbers(d))
            qs.append(_numbers(e, 2).astype(np.uint16))
            counts.append(_numbers(f))
        ctx_names, ctx_of_run = _grouped(np.concatenate(ctxs))
        word_names, word = _grouped(np.concatenate(words))
        pair_ctx, _, pair = _paired(np.repeat(ctx_of_run, np.concatenate(runs)), word, len(word_names))
        del word
        total = np.bincount(pair, np.concatenate(counts), len(pair_ctx)).astype(np.int64)
        q = np.zeros(len(pair_ctx), np.uint16)
        q[pair] = np.concatenate(qs)  # alike for all that ask about a pair
        p = _POWERS[q]
        n = np.bincount(pair_ctx, total, len(ctx_names))
        whole = np.zeros(len(ctx_names), np.int64)  # observations of split contexts in all buckets
        whole[ctx_of_run] = np.concatenate(splits)
        split = whole > 0
        n[split] = whole[split]
        mass, seen = _mass(n)[pair_ctx], total > 0
        left_out = (np.maximum(total - 1, 0) / p + mass) / (np.maximum(n[pair_ctx] - 1, 0) + mass)
        gain = np.bincount(pair_ctx[seen], (total * np.log10(left_out))[seen], len(ctx_names))
        keep = (gain > min_gain) & ~split
        number = np.where(total >= 2, np.arange(len(pair_ctx)), 0)
        rows, r, e = [], 0, 0
        if split.any():
            units = np.rint(gain[split] * _UNITS).astype(np.int64)
            rows.append((SHARES, level, bucket, 0, ctx_names[split].tolist(), units.tolist(), b""))
        for block, own in zip(blocks, runs, strict=True):
            size = int(own.sum())
            ctx, mine = ctx_of_run[r : r + len(own)], pair[e : e + size]
            named = ctx_names[ctx[split[ctx]]].tolist() or None
            flags = np.packbits(keep[ctx]).tobytes()
            rows.append((block, level, bucket, 0, named, None, _squeeze(_pack(flags, _planes(total[mine]), _planes(number[mine])))))
            r, e = r + len(own), e + size
        return pa.Table.from_batches([S.batch_of(rows, schema)])

    return run


def _last_levels(schema: pa.Schema, level: int, max_depth: int | None, min_gain: float):
    """What the positions open on ``level`` add to their documents' scores, with all levels from there on.

    All open positions are here, so a level's pairs are summed and judged in place, by the code that does so for a bucket.
    """
    model = {"buckets": 1, "split_rows": START}
    answers_schema, requests_schema = S.arrow_schema(ANSWERS), S.arrow_schema(REQUESTS)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [Frontier.unpacked(r["payload"]) for r in rows]
        out = Frontier.joined(parts)
        place = np.zeros(int(out.pos[-1]) + 1, np.int64)  # of a position among those open at first
        place[out.pos] = np.arange(len(out.pos))
        train = np.zeros(len(place), bool)
        train[out.pos] = np.concatenate([np.unpackbits(np.frombuffer(r["train"], np.uint8), count=len(f.pos)) for r, f in zip(rows, parts, strict=True)])
        logp = np.log10(out.p)[out.pair]
        at = level
        while len(out.pos) and (max_depth is None or at <= max_depth):
            asked = [(k, 0, payload) for k, payload in out.requests(train, model)]
            found = _sum_pairs(answers_schema, at, min_gain)(pa.Table.from_batches([S.batch_of(asked, requests_schema)]))
            verdict = Answers(found).to(out, at, model)
            logp[place[out.pos]] = np.log10(out.p)[out.pair]
            out, _ = out.deeper(*verdict, np.zeros(0, bool))
            at += 1
        closed, first = [], 0
        for r, f in zip(rows, parts, strict=True):
            docs, which = _grouped(np.frombuffer(_expand(r["doc"]), "<i4"))
            added = np.bincount(which, logp[first : first + len(f.pos)], len(docs))
            closed.append((r["block"], docs.astype("<i4").tobytes(), added.astype("<f8").tobytes()))
            first += len(f.pos)
        return pa.Table.from_batches([S.batch_of(closed, schema)])

    return run


def _with_verdicts(found: DataFrame, level: int, min_gain: float) -> DataFrame:
    """``found`` without shares but with a row per block that names the split contexts it asked about and may keep."""
    answers = found.where(F.col("block") != SHARES)
    shares = found.where(F.col("block") == SHARES)
    if shares.isEmpty():
        return answers
    kept = (
        shares.select(F.explode(F.arrays_zip("split", "gains")).alias("s")).groupBy(F.col("s.split").alias("ctx"))
        .agg(F.sum("s.gains").alias("units")).where(F.col("units") > round(min_gain * _UNITS)).select("ctx")
    )
    asked = answers.where("split is not null").select("block", F.explode("split").alias("ctx")).distinct()
    verdicts = asked.join(kept, "ctx").groupBy("block").agg(F.collect_list("ctx").alias("split"))
    rows = verdicts.select(
        "block", F.lit(level).alias("level"), F.lit(VERDICTS).cast("long").alias("bucket"), F.lit(0).cast("long").alias("distinct"),
        "split", F.lit(None).cast("array<long>").alias("gains"), F.lit(b"").alias("payload"),
    )
    return answers.unionByName(S.staged(rows, "verdicts"))


def _levels(
    df: DataFrame, id_col: str, text_col: str, max_depth: int | None, min_gain: float, block_tokens: int, split_rows: int, bucket_tokens: int, tail_rows: int,
) -> tuple[DataFrame, DataFrame | None, dict]:
    """The positions open when the levels end, what the last task adds to their scores (if it is needed), and the model's sizes."""
    blocks = S.bucketed(build_blocks(df, id_col, text_col, block_tokens), "blocks", "block")
    tokens, train = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    model = {"train_tokens": train, "distinct": 0, "buckets": max(1, -(-tokens // bucket_tokens)), "split_rows": split_rows}
    requests_schema, answers_schema, open_schema = map(S.arrow_schema, (REQUESTS, ANSWERS, OPEN))
    rest_schema, closed_schema = S.arrow_schema(REST), S.arrow_schema(CLOSED)

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                yield S.batch_of([(k, row["block"], payload) for k, payload in Block(row, model).word_requests()], requests_schema)

    asked = blocks.mapInArrow(ask_words, REQUESTS)
    answers = S.staged(asked.groupBy("bucket").applyInArrow(_sum_words(answers_schema), ANSWERS), "words")
    model = model | {"distinct": answers.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]}

    def per_block(of: DataFrame, known: DataFrame, make, schema: str, arrow: pa.Schema) -> DataFrame:  # noqa: ANN001  make(row, answers) -> rows
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            rows: list[tuple] = []
            for row in left.to_pylist():
                rows += make(row, Answers(right))
            return pa.Table.from_batches([S.batch_of(rows, arrow)])

        return of.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)

    def summed(asked: DataFrame, level: int) -> DataFrame:
        found = S.staged(asked.groupBy("bucket").applyInArrow(_sum_pairs(answers_schema, level, min_gain), ANSWERS), f"pairs{level}")
        return _with_verdicts(found, level, min_gain)

    def ask_wide(level: int):
        def make(row: dict, known: Answers) -> list[tuple]:
            block = Block(row, model)
            return [(k, row["block"], p) for k, p in block.at_level(level, known).requests(block.train, model)]

        return make

    for level in range(1, WIDE_LEVELS + 1):
        answers = answers.unionByName(summed(per_block(blocks, answers, ask_wide(level), REQUESTS, requests_schema), level))
    left = S.bucketed(per_block(blocks, answers, lambda row, known: [Block(row, model).open_row(known)], OPEN, open_schema), "open", "block")
    S.discard(blocks, answers)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield S.batch_of([OpenBlock(row, model).rest() for row in b.to_pylist()], rest_schema)

    def still_open(level: int):
        return lambda row, known: [OpenBlock(row, model).open_row(level, known)]

    level = WIDE_LEVELS + 1
    while max_depth is None or level <= max_depth:
        state = left.drop("buckets", "requests")
        if left.agg(F.coalesce(F.sum("n_open"), F.lit(0))).first()[0] <= tail_rows:
            rows = state.where("n_open > 0").mapInArrow(rest, REST)
            last = _last_levels(closed_schema, level, max_depth, min_gain)
            return left, S.staged(rows.groupBy("bucket").applyInArrow(last, CLOSED), "closed"), model
        asked = left.select("block", F.explode(F.arrays_zip("buckets", "requests")).alias("r"))
        found = summed(asked.select(F.col("r.buckets").alias("bucket"), "block", F.col("r.requests").alias("payload")), level)
        further = S.bucketed(per_block(state, found, still_open(level), OPEN, open_schema), "open", "block")
        S.discard(left, found)
        left, level = further, level + 1
    return left, None, model


def score(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_depth: int | None = None, min_gain: float = 0.01,
    block_tokens: int = 1 << 20, split_rows: int = 1 << 20, bucket_tokens: int = 1 << 22, tail_rows: int = 1 << 20,
) -> DataFrame:
    """Score every text with a tree learned from the texts that are not held out (crc32 of the id modulo 5 is not 1).

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (the
    add-half word model) and score, both as log10 probabilities of the whole
    text with its end. A context is retained if its gain is over ``min_gain``
    (in log10 over all its observations). Contexts get as long as the test
    retains them, about eight words where texts are copied (there the suffix
    state soon leaves nothing to gain), far more where texts repeat themselves.
    ``max_depth`` ends the tree earlier (two
    words at least). The scores do not
    depend on the sizes: ``tail_rows`` says from how few open positions on one
    task finishes the levels left. Null and empty texts are one end token. Null ids form one fold ('null' as text); repeated
    rows count and are scored as often as given; an empty table gives an empty
    result.
    """
    with S.shuffles_dropped(df.sparkSession):
        left, closed, model = _levels(df, id_col, text_col, max_depth, min_gain, block_tokens, split_rows, bucket_tokens, tail_rows)
    left, schema = left.drop("buckets", "requests"), S.arrow_schema(SCORES)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                yield S.batch_of(OpenBlock(row, model).scores(), schema)

    def add(one: pa.Table, other: pa.Table) -> pa.Table:
        scored: list[tuple] = []
        for row in one.to_pylist():
            scored += OpenBlock(row, model).scores_with(other)
        return pa.Table.from_batches([S.batch_of(scored, schema)])

    if closed is None:
        return left.mapInArrow(scores, SCORES)
    return left.groupBy("block").cogroup(closed.groupBy("block")).applyInArrow(add, SCORES)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(S.read_table(spark, sf_dir, "documents"))
