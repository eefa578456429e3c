"""Spelling variants, filter audit and sharding against brute force, with nulls, empty and long texts, ties and repeated rows."""

import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from gustolake.llm import _shared as S
from gustolake.llm import audit, sharding, spelling
from gustolake.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, word string, n long, shard int, `key` string, `a.b` string"


def texts():
    rng = random.Random(9)
    stems = ["letter", "lettre", "Letters", "better", "étage", "Étages", "étagères", "straße", "strasse", "aaaaaaa", "abcdefgh", "abcdefg"]
    seps = [" ", ", ", "\n", "\t", " 7 ", "_", "-", " # ", "\x0b"]
    out = ["".join(rng.choice(stems) + rng.choice(seps) for _ in range(rng.randint(0, 150))) for _ in range(60)]
    return [None, "", " \n", "word", "long letter " * 5_000, "y" * 20_000, "y" * 20_001, "ABC DEF", *out, *out[:10]]


@pytest.fixture(scope="module")
def docs(spark):
    S.prepare(spark)
    x = ("w", 1, 2, "k", "ab")
    rows = [(i, t, ("en", "de", None, "")[i % 4], *x) for i, t in enumerate(texts())]
    rows += [(100 + i, "y" * (20_000 + i % 2), "en", *x) for i in range(14)]
    rows += [(None, "letter letter", "en", *x), (None, "letter letter", None, *x), (None, None, None, *[None] * 5), rows[9], rows[9], (9, "another text", "de", *x)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- spelling variants ------------------------------------------------------------------------
def brute_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_variants(rows):
    n = brute_words(rows)
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def test_variants_equal_brute_force(spark, docs, empty):
    got = spelling.spelling_variants(docs)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    rows = [tuple(r) for r in got.collect()]
    want = brute_variants(docs.select("doc_id", "text").collect())
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert any(r[1] for r in want) and any(len(r[0]) > 19_000 and r[4] for r in want)  # forms, and very long words that are near
    assert spelling.spelling_variants(empty).collect() == []
    assert spelling.spelling_variants(docs.where("text is null")).collect() == []


def test_variants_of_documents_equal_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter(tuple(r) for r in spelling.op11_spelling_variants(spark, SF).collect())
    assert got == Counter(brute_variants(table.select("doc_id", "text").collect()))


def test_forms_are_followed_to_the_last(spark):
    # a chain: each word one letter from the next, which is five times as frequent
    chain = ["aaaaaabb", "aaaaaab", "aaaaaa"]
    text = " ".join(" ".join([w] * (5 * 6**i)) for i, w in enumerate(chain))
    rows = spark.createDataFrame([(3, text)], "doc_id long, text string")
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.spelling_variants(rows).collect()}
    assert got == {chain[0]: (chain[1], chain[2]), chain[1]: (chain[2], chain[2]), chain[2]: (None, chain[2])}


def test_ties_go_to_the_smallest_in_code_point_order(spark):
    words = ["banane"] * 5 + ["banana"] * 30 + ["banané"] * 30 + ["bananÀ"] * 30
    got = spelling.spelling_variants(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string"))
    assert {r["word"]: r["form"] for r in got.collect()}["banane"] == "banana"


def test_multisets_at_distance_two_share_a_signature(spark):
    rng = random.Random(2)
    letters = "abcdeéÀnorst"
    words = set()
    for _ in range(300):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 12)))
        i = rng.randrange(len(w))
        words |= {w, w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + w[i + 1 :], w + rng.choice(letters)}
    sets = sorted({"".join(sorted(w)) for w in words})
    df = spark.createDataFrame([(s.encode(), s) for s in sets], "cid binary, word string")
    by_set = defaultdict(set)
    for r in spelling.signatures(df).collect():
        by_set[r["cid"].decode()].add(r["sig"])
    links = {(r["cid"].decode(), r["other"].decode(), r["gone"], r["come"]) for r in spelling.multiset_links(df).collect()}
    for a in sets:
        for b in sets:
            more, less = Counter(a) - Counter(b), Counter(b) - Counter(a)
            if a != b and more.total() <= 1 and less.total() <= 1:
                assert by_set[a] & by_set[b]
                assert (a, b, "".join(more), "".join(less)) in links


# --- filter audit -------------------------------------------------------------------------------
def brute_audit(docs, labels):
    docs = [(d, t or "", p or "") for d, t, p in docs]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t] = min(d, least.get(t, d))
    marks = []
    for d, t, p in docs:
        words = t.encode().split()
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(set("#$%&*|") & set(t)), "E": d is not None and least[t] < d,
        }
        marks.append((p, {f for f, x in fails.items() if x}, d in good, d in toxic))
    out = {}
    for part in {m[0] for m in marks}:
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = [m for m in marks if m[0] == part]
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                removed_by[f] += len(gone)
                mine = [m for m in marks if m[0] == part and f in m[1]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), len(mine) - len(gone), sum(m[1] == {f} for m in mine), sum(m[2] for m in gone), sum(m[3] for m in gone)
                ]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(removed_by[order[k - 1]])
    return {(*k, *v) for k, v in out.items()}


LABELS = [(8, 1, 0), (8, 0, 1), (9, 1, 1), (10, 0, 0), (None, 1, 1), (11, None, 1), (12, 1, None), (70, 1, 1), (4, 1, 1)]


def test_audit_equals_every_order_played_through(spark, docs, empty):
    labels = spark.createDataFrame([(*x, "text") for x in LABELS], "doc_id long, quality int, toxic int, text string")
    got = [tuple(r) for r in audit.audit(docs, labels).collect()]
    want = brute_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], LABELS)
    assert len(got) == len(want) == 600 * 3 and set(got) == want
    none = labels.limit(0)
    assert set(map(tuple, audit.audit(docs, none).collect())) == brute_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [])
    assert audit.audit(empty, labels).collect() == []
    dtypes = dict(audit.audit(empty, labels).dtypes)
    assert dtypes["step"] == "int" and dtypes["shapley"] == "bigint" and dtypes["part"] == "string"


def test_shapley_values_add_up_to_what_all_filters_remove(spark):
    rows = audit.op12_filter_interactions(spark, SF).where("step = 5")
    for part in rows.select("part").distinct().collect():
        of_part = rows.where(F.col("part") == part[0])
        value = {r["filter_order"][-1]: r["shapley"] for r in of_part.collect()}
        kept = {r["kept"] for r in of_part.collect()}
        n = spark.read.parquet(f"{SF}/documents.parquet").where(F.coalesce("lang", F.lit("")) == part[0]).count()
        assert len(kept) == 1 and sum(value.values()) == 120 * (n - kept.pop())


def test_audit_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(ORACLE_SQL["op12_filter_interactions"])
    names = [c[0] for c in cur.description]
    got = audit.op12_filter_interactions(spark, SF).select(*names)
    assert Counter(cur.fetchall()) == Counter(map(tuple, got.collect()))


# --- sharding -----------------------------------------------------------------------------------
def naive_schedule(weights, shards):
    heap, out = [(0, s) for s in range(shards)], []
    for w in weights:
        load, s = heapq.heappop(heap)
        out.append(s)
        heapq.heappush(heap, (load + w, s))
    return out, sorted(heap)


@pytest.mark.parametrize("by_heap_upto", [0, 7, 10**9])
def test_dealing_runs_at_once_equals_the_heap(by_heap_upto):
    rng = random.Random(by_heap_upto)
    for _ in range(60):
        shards = rng.randint(1, 9)
        runs = sorted(((rng.randint(1, 40), rng.randint(1, 60)) for _ in range(rng.randint(1, 12))), reverse=True)
        schedule = sharding.Schedule(shards, by_heap_upto)
        flat, at = naive_schedule([w for w, n in runs for _ in range(n)], shards)[0], 0
        for weight, n in runs:
            assert schedule.deal(weight, n) == Counter(flat[at : at + n])
            at += n
        assert sorted(schedule.heap) == naive_schedule([w for w, n in runs for _ in range(n)], shards)[1]


def checked(rows, given, shards):
    """The laws of a result for (doc_id, text) rows, and its loads."""
    crc = {t: zlib.crc32((t or "").encode()) for _, t in given}
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, len((t or "").encode()) + 16, crc[t]) for d, t in given)
    slots, load, where, weight = defaultdict(list), Counter(), defaultdict(set), Counter()
    for r in rows:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
        where[r["text_crc32"]].add(r["shard"])
        weight[r["text_crc32"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    return sorted([*load.values(), *[0] * (shards - len(load))]), weight


@pytest.mark.parametrize("shards,heavy", [(40, 10_000), (3, 10_000), (3, 1)])
def test_shards_are_those_of_the_schedule(docs, monkeypatch, shards, heavy):
    monkeypatch.setattr(sharding, "HEAVY", heavy)
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows = sharding.assign(docs, shards=shards).collect()
    loads, weight = checked(rows, given, shards)
    assert loads == sorted(load for load, _ in naive_schedule(sorted(weight.values(), reverse=True), shards)[1])


def test_documents_are_near_equal_in_bytes(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sharding.op13_sharding(spark, SF)
    loads, weight = checked(got.collect(), given, 40)
    assert loads[-1] <= sum(loads) / 40 + max(weight.values())
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}


def test_no_rows_no_shards(empty):
    assert sharding.assign(empty).collect() == []
