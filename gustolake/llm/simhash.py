"""SimHash near-duplicates: fingerprints linked at few differing bits, found by pivot distance tables.

Method. A fingerprint's Hamming distances to many fixed reference fingerprints
are precomputed once per distinct fingerprint, as a table per 16-bit block (the
distance restricted to the block) whose block sums are the full distances. If
two fingerprints differ in at most ``max_bits`` (two) bits, two of the four
blocks are equal, so all table entries of these blocks agree: rows meet on the
table entries of each pair of blocks. A pair that meets is discarded when any
full distances differ by more than ``max_bits`` (the triangle inequality), and
the survivors are verified on the fingerprints themselves.

Rows meeting on one key beyond ``group_limit`` (a swarm of near copies) are not
paired with each other. Each is sent to itself and its 64 one-bit neighbours;
two fingerprints at one or two bits always share such a point, and all rows at
a point are within two bits of each other, so each point links its (at most 65)
rows to the smallest one. That loses no link and grows linearly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustolake.llm import _shared as S
from gustolake.llm._components import components

BLOCKS = 4
BLOCK_PAIRS = [(i, j) for i in range(BLOCKS) for j in range(i + 1, BLOCKS)]
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: bit i is set if over half of the shingle hashes (repeats included) have it.

    A-Z are lower-cased; words are runs without ASCII white space; fewer words
    than ``shingle`` make one shingle; no word (or null) gives 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)) if len(words) > shingle else [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, n)
    # eight bit positions at a time: byte lanes hold the counts of up to 255 hashes
    padded = np.zeros(-(-n // 255) * 255, np.uint64)
    padded[:n] = h
    padded = padded.reshape(-1, 255)
    out = 0
    for k in range(8):
        lanes = ((padded >> np.uint64(k)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in range(8):
            if 2 * int(counts[byte]) > n:
                out |= 1 << (8 * byte + k)
    return out


def fingerprints(
    df: DataFrame, id_col: str, text_col: str, shingle: int = 3, seed: int = 42, carried: dict[str, Column] | None = None
) -> DataFrame:
    """(doc_id, fp: the fingerprint as a signed long) for every row; whole texts, one pass, no shuffle.

    ``carried`` are columns of longs that go along.
    """
    carried = carried or {}
    names = ["doc_id", "fp", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps), *b.columns[2:]], names=names)

    columns = {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")} | carried
    return S.map_rows(df, columns, run, ", ".join(f"{n} long" for n in names))


def references(n: int) -> list[int]:
    """``n`` fixed reference fingerprints, by hashing their number."""
    return [xxhash.xxh64_intdigest(f"reference {i}", 7) for i in range(n)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _block_distance(fp: Column, ref: int, block: int) -> Column:
    mask = _signed(0xFFFF << (16 * block))
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(ref))).bitwiseAND(F.lit(mask)))


def pivot_table(classes: DataFrame, n_references: int) -> DataFrame:
    """``classes`` (fp) plus per-block distance columns and ``full``, the distances to every reference."""
    refs = references(n_references)
    blocks = classes.select(
        "fp", *[F.array(*[_block_distance(F.col("fp"), r, b).cast("byte") for r in refs]).alias(f"b{b}") for b in range(BLOCKS)]
    )
    full = F.array(*[sum((F.col(f"b{b}")[i] for b in range(1, BLOCKS)), F.col("b0")[i]).cast("byte") for i in range(n_references)])
    return blocks.withColumn("full", full)


def links(classes: DataFrame, max_bits: int = 2, n_references: int = 12, group_limit: int = 32) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``classes.fp``, connecting all at ``max_bits`` or fewer bits.

    Within a group of up to ``group_limit`` rows every link is returned; in
    larger groups the links returned span the same connected components.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("two of four blocks agree only up to 2 bits")
    table = pivot_table(classes, n_references)
    keys = table.select(
        "fp", "full",
        F.explode(F.array(*[F.xxhash64(F.lit(k), f"b{i}", f"b{j}") for k, (i, j) in enumerate(BLOCK_PAIRS)])).alias("key"),
    )
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = S.staged(keys.join(shared, "key"), "pivots")
    few = met.where(F.col("n") <= group_limit)
    a, b = few.alias("a"), few.alias("b")
    apart = [F.abs(F.col("a.full")[i] - F.col("b.full")[i]) for i in range(n_references)]
    pairs = (
        a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")))
        .where(F.greatest(*apart) <= max_bits)
        .where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    )
    return pairs.union(_swarm_links(met.where(F.col("n") > group_limit).select("fp").distinct(), max_bits)).distinct()


def _swarm_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links by common one-bit neighbours (two bits), or by one-bit flips found in the set (one bit)."""
    near = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)] if max_bits else []
    at = fps.select("fp", F.explode(F.array(F.col("fp"), *near)).alias("at"))
    if max_bits == 2:
        points = at.groupBy("at").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
        return points.select("a", F.explode("fps").alias("b")).where("a <> b")
    hit = at.join(fps.select(F.col("fp").alias("b")), F.col("at") == F.col("b"))
    return hit.where("fp < b").select(F.col("fp").alias("a"), "b")


def _rooted(classes: DataFrame, max_bits: int, n_references: int = 12, group_limit: int = 32) -> DataFrame:
    """``classes`` (fp and others) plus ``root``, the fingerprint that names each one's component."""
    roots = components(links(classes.select("fp"), max_bits, n_references, group_limit))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select(*[classes[c] for c in classes.columns], F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
    seed: int = 42, n_references: int = 12, group_limit: int = 32,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 lower-case hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` bits, itself included. Null and word-less texts have
    fingerprint zero and link like any other. Rows with a null id belong to
    components but never name one (a component of null ids only has a null
    component_id). Repeated rows are returned as often as given. An empty
    table gives an empty result.
    """
    docs = S.staged(fingerprints(df, id_col, text_col, shingle, seed), "fingerprints")
    classes = S.staged(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    rooted = _rooted(classes, max_bits, n_references, group_limit)
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = S.staged(rooted.join(names, "root").select("fp", "component_id"), "components")
    return docs.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(S.read_table(spark, sf_dir, "documents"))


def _numbered(rows: DataFrame, block: str, number: str, numbers: DataFrame) -> DataFrame:
    """The rows of a table bucketed by ``block`` whose ``number`` is in ``numbers`` (k_row); the table is not shuffled."""
    name = S.free_name("block_bits", rows.columns)
    bits = numbers.select(F.shiftright("k_row", 15).alias(block), F.col("k_row").bitwiseAND(32767).alias("bit")).groupBy(block).agg(
        F.bitmap_construct_agg("bit").alias(name)
    )
    at = F.col(number).bitwiseAND(32767).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(name), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_in = F.call_function("shiftright", byte, at.bitwiseAND(7)).bitwiseAND(1) == 1
    # a bit per row: each bucket meets its blocks' bitmaps
    return rows.join(S.staged(bits, "bits").hint("shuffle_hash"), block).where(is_in).select(*map(S.column, rows.columns))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``df`` with all its columns and one row of each near-duplicate group, that of the smallest id.

    Null ids come last. If the smallest id has several texts in a group, the
    text of the smallest hash stays, and of rows with the same id and text the
    smallest by its columns (those that have an order; then any one). A null id
    or an id repeated with texts of other groups is judged in each of its
    groups, so no group is lost. Columns of any type pass, maps too; an empty
    table gives an empty result.

    Texts are written once more and never shuffled: rows are numbered as they
    are written, in a table bucketed by blocks of their numbers, groups are
    found on numbers and hashes, and each block meets a bitmap of the rows kept.
    """
    block, number = S.free_name("row_block", df.columns), S.free_name("row_number", df.columns)
    numbered = df.withColumn(number, F.monotonically_increasing_id()).withColumn(block, F.shiftright(S.column(number), 15))
    rows = S.bucketed(numbered, "rows", block)
    doc, text = S.column(id_col).cast("long"), S.column(text_col).cast("binary")
    # rows alike in these are of one group, as the text decides it; two hashes make 128 bits
    identity = {"k_null": doc.isNull().cast("long"), "k_id": F.coalesce(doc, F.lit(0)), "k_text": F.xxhash64(text), "k_text2": F.xxhash64(F.lit(1), text)}
    docs = S.staged(fingerprints(rows, id_col, text_col, shingle, carried=identity | {"k_row": F.col(number)}), "fingerprints")
    classes = S.staged(docs.groupBy("fp").agg(F.min(F.struct(*identity)).alias("first")), "classes")
    first = _rooted(classes, max_bits).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    same = S.staged(
        docs.groupBy(*identity).agg(F.min("k_row").alias("k_row"), F.count(F.lit(1)).alias("n")).join(first, [*identity]), "kept"
    )
    kept = same.where("n = 1").select("k_row")
    repeated = same.where("n > 1").select(*identity)
    if not repeated.isEmpty():
        candidates = _numbered(rows, block, number, docs.join(repeated, [*identity]).select("k_row"))
        others = [f.name for f in df.schema.fields if f.name != text_col and _has_order(f.dataType)]
        order = F.struct(*[S.column(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(number).alias("k_row"))
        chosen = candidates.groupBy(*[c.alias(n) for n, c in identity.items()]).agg(F.min(order).alias("row")).select("row.k_row")
        kept = kept.union(chosen)
    return _numbered(rows, block, number, kept).select(*map(S.column, df.columns))


def _has_order(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_has_order(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _has_order(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))
