"""Filter audit, resharding and periodic runs against plain versions of themselves, and on odd rows."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest
from edge_rows import CLASHING, EDGE, LONG, edge, none  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import filter_audit, periodic_runs, resharding
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- periodic runs -----------------------------------------------------------
def plain_runs(words, least=12):
    """Every stretch of every lag, word by word; the smallest lag names a stretch."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        begin = None
        for i in range(q, len(words) + 1):
            same = i < len(words) and words[i] == words[i - q]
            if same and begin is None:
                begin = i
            elif not same and begin is not None:
                if i - begin >= q and i - begin + q >= least:
                    found.setdefault((begin - q, i), q)
                begin = None
    return sorted((s, e - s, q) for (s, e), q in found.items())


@pytest.mark.parametrize("seed", range(4))
def test_runs(seed):
    rng = random.Random(seed)
    for _ in range(400):
        n, kinds = rng.randint(0, 150), rng.choice((1, 2, 3, 6, 40))
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 3 and rng.random() < 0.6:  # a passage repeats, whole or broken, once more or as a part of a longer one
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            words[rng.randrange(n)] = rng.choice((99, words[0]))
            words = rng.choice((words, words * 2, words[:50] * 3))
        assert periodic_runs.find_runs(np.array(words, np.int64)) == plain_runs(words)


@pytest.mark.parametrize("words,runs", [
    ([0] * 60_000, [(0, 60_000, 1)]),
    ([0, 1] * 30_000, [(0, 60_000, 2)]),
    (([0] * 15_000 + [1]) * 4, [(0, 15_000, 1), (0, 60_004, 15_001), (15_001, 15_000, 1), (30_002, 15_000, 1), (45_003, 15_000, 1)]),
    ([0] * 11, []),
    ([0] * 12, [(0, 12, 1)]),
    (list(range(30_000)) * 2, [(0, 60_000, 30_000)]),
    (list(range(30_000)) + [7] + list(range(30_000)), []),
])
def test_hot_words(words, runs):
    """One word or one passage makes up all of a long text."""
    assert periodic_runs.find_runs(np.array(words, np.int64)) == runs


def test_periodic_runs(spark, edge, none):
    rows = [(1, "a b a b a b a b a b a b c"), (2, "x " * 11), (3, None), (4, "é É " * 6 + "z"), (5, "x y " * 12)]
    got = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"))
    told = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()}
    assert told[1] == (13, [(0, 12, 2)], "a b c")
    assert told[2] == (11, [], " ".join("x" * 11)) and told[3] == (0, [], "")
    assert told[4] == (13, [(0, 12, 2)], "é É z") and told[5] == (12, [(0, 12, 1)], "x y")
    odd = periodic_runs.periodic_runs(edge)
    assert odd.columns == [*edge.columns, "n_words", "runs", "collapsed"] and odd.count() == len(EDGE)
    assert odd.where("doc_id = 4 and n_words = 0 and collapsed = ''").count() == 1
    words = LONG.split()
    long = odd.where("doc_id = 6").first()
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    assert long["n_words"] == len(words) and [tuple(r) for r in long["runs"]] == periodic_runs.find_runs(np.array([numbers[w] for w in words]))
    assert periodic_runs.periodic_runs(none).count() == 0
    again = odd.drop("n_words", "runs").withColumn("runs", F.lit(1))
    assert periodic_runs.periodic_runs(again).columns == [*[c for c in again.columns if c not in ("runs", "collapsed")], "n_words", "runs", "collapsed"]


def test_periodic_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words) if n < 3_000 else periodic_runs.find_runs(np.array([zlib.crc32(w.encode()) for w in words]))
        drop = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = got[doc_id]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()).hexdigest()
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


# --- filter audit ------------------------------------------------------------
def plain_audit(rows, labels):
    """Every document through every order, one by one."""
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    fails = []
    for doc_id, text in [(r[0], r[1] or "") for r in rows]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails.append("".join(f for f, failed in (
            ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)), ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
            ("D", re.search(r"[#$%&*|]", text)),
            ("E", doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)),
        ) if failed))
    out = {}
    for part in {r[2] or "" for r in rows}:
        inside = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = inside
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                redundant = sum(f in x[1] for x in inside) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(x[1] == f for x in inside), *(sum(x[0] in s for x in gone) for s in (good, toxic))]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit(spark, edge, none):
    rng, rows = random.Random(5), []
    for i in range(60):
        text = rng.choice(("", "SHOUT", "a $ b")) + " ".join(rng.choice("abcdefghijk") * rng.randint(1, 9) for _ in range(rng.choice((3, 120, 140))))
        rows.append((i, rng.choice((text, "the same text", None, "")), rng.choice(("en", "de", None, "")), None, None))
    rows += [(3, rows[3][1], "en", None, None), (3, "other", "de", None, None), (None, "the same text", "en", None, None), (None, "the same text", "de", None, None)]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("clash"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()

    def told(found):
        return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in names) for r in found.collect()}

    assert told(filter_audit.audit_filters(df, said)) == plain_audit(rows, labels)
    assert told(filter_audit.audit_filters(edge, said.limit(0))) == plain_audit(EDGE, [])
    assert filter_audit.audit_filters(none, said).count() == 0


def test_counters_do_not_run_over(spark):
    """Sums far beyond 64 bits of a row of fields, and counts near the largest shares that a long holds, keep every field apart."""
    many = (1 << 56) - 1
    counts = spark.createDataFrame([("p", m, many if m == 31 else m + 1, 1, 0) for m in range(32)], "part string, mask int, docs long, good long, toxic long")
    got = filter_audit.audit_masks(counts, "ABCDE").collect()
    total = sum(many if m == 31 else m + 1 for m in range(32))
    assert len(got) == 600
    for r in got:
        before = [("ABCDE".index(f)) for f in r["filter_order"][: r["step"]]]
        passed = sum(m + 1 for m in range(31) if not any(m >> i & 1 for i in before))
        last = sum(m + 1 for m in range(31) if not any(m >> i & 1 for i in before[:-1]) and m >> before[-1] & 1)
        assert r["kept"] == passed and r["removed"] == last + (many if r["step"] == 1 else 0)
        assert r["removed"] + r["redundant"] <= total
    width = 5
    sums = sum(filter_audit.packed(m, "ABC", width) * 3 for m in range(8))
    fields = list(filter_audit.unpacked(sums, "ABC", width))
    assert all(sum(f[:2]) + f[2] <= 24 for f in fields) and fields[0] == (12, 12, 0)


# --- resharding --------------------------------------------------------------
def test_min_cost_flow():
    rng = np.random.default_rng(3)
    for _ in range(60):
        m, n = rng.integers(1, 4, 2)
        supply = rng.integers(0, 3, m)
        room = rng.integers(0, 4, n)
        while room.sum() < supply.sum():
            room[rng.integers(n)] += 1
        cost = rng.integers(0, 9, (m, n))
        flow = resharding.min_cost_flow(supply, room, cost)
        assert (flow >= 0).all() and (flow.sum(1) == supply).all() and (flow.sum(0) <= room).all()
        units, places = np.repeat(np.arange(m), supply), np.repeat(np.arange(n), room)
        best = min((sum(cost[a, b] for a, b in zip(units, p)) for p in permutations(places, len(units))), default=0)
        assert (flow * cost).sum() == best
    sizes, room = rng.integers(0, 10**12, 200), resharding.capacities(200 * 10**12, 150)
    flow = resharding.min_cost_flow(sizes, room, resharding.moving_costs(200, 150))
    assert (flow.sum(1) == sizes).all() and (flow.sum(0) <= room).all()
    with pytest.raises(ValueError):
        resharding.min_cost_flow([3], [2], np.zeros((1, 1)))


@pytest.fixture(scope="module")
def crowded(spark):
    """20,000 rows, a third of them in one old shard, a tenth equal to each other."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 10 == 0, 100).otherwise(20 + F.col("id") * 7919 % 400).alias("bytes"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 6).cast("int").alias("home"), F.lit("x").alias("size"), F.lit("y").alias("shard"), F.lit("z").alias("tie"),
    )
    return rows


def layout_of(df, shards=8, **more):
    return resharding.flow_layout(df, F.col("bytes"), F.col("home"), 6, shards, ["doc_id", "bytes"], **more)


def test_layout(spark, crowded):
    got = layout_of(crowded)
    assert got.columns == ["doc_id", "bytes", "home", "tie", "size", "old_shard", "shard", "slot"]
    assert got.where("tie <> 'z' or size <> bytes or old_shard <> home").count() == 0
    per = got.groupBy("shard").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.countDistinct("slot").alias("d")).collect()
    even = sum(r["b"] for r in per) / 8
    assert len(per) == 8 and all(abs(r["b"] - even) <= 2 * 420 for r in per)
    assert all(r["lo"] == 0 and r["hi"] == r["n"] - 1 == r["d"] - 1 for r in per) and sum(r["n"] for r in per) == 20_000
    old = {r["home"]: r["b"] for r in crowded.groupBy("home").agg(F.sum("bytes").alias("b")).collect()}
    fewest = sum(max(0, b - even) for b in old.values())
    moved = resharding.moved_bytes(got).agg(F.sum("bytes")).first()[0]
    assert abs(moved - fewest) <= 16 * 420
    key = ["doc_id", "bytes", "home", "shard", "slot"]
    again = layout_of(crowded.repartition(13, "home"))
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, again.select(key).collect()))
    # fewer and more shards, and costs by which every move goes to the last one first
    assert {r[0] for r in layout_of(crowded, 3).select("shard").distinct().collect()} == set(range(3))
    room = [10**7] * 9
    assert {r["shard"] for r in layout_of(crowded, room, cost=np.repeat([[5] * 8 + [0]], 6, 0)).select("shard").distinct().collect()} == {8}


def test_layout_of_odd_rows(spark, edge, none):
    def laid(df):
        sized = df.withColumn("bytes", F.octet_length("text"))
        return resharding.flow_layout(sized, F.col("bytes"), F.when(F.col("source") == "a", 0).when(F.col("source") == "b", 1), 2, 3, ["doc_id", "text"])

    got = laid(edge)
    assert got.count() == len(EDGE) and got.columns == [*[c for c in edge.columns if c not in resharding.NEW], "bytes", *resharding.NEW]
    assert {r[0] for r in got.select("key").distinct().collect()} == {"kept-key"}
    slots = {}
    for r in got.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert laid(none).count() == 0 and laid(edge.where("text is null")).count() == 2


def test_rewrite(spark, crowded, tmp_path):
    layout = layout_of(crowded)
    state = resharding.rewrite_shards(layout, str(tmp_path / "new"))
    rest, gained = (spark.read.parquet(str(tmp_path / "new" / part)) for part in ("rest", "gained"))
    gave = {r["old_shard"] for r in resharding.moved_bytes(layout).collect()}
    assert gave == {s for s, what in state.items() if what.startswith("rewritten")} == {r["shard"] for r in rest.select("shard").distinct().collect()}
    kept = layout.where("old_shard = shard").where(~F.col("shard").isin(*gave))
    now = kept.select("doc_id", "size", "shard", "slot").unionAll(rest.select("doc_id", "size", "shard", "slot")).unionAll(gained.select("doc_id", "size", "shard", "slot"))
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, layout.select("doc_id", "size", "shard", "slot").collect()))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_reshard_query(spark, sf):
    got = QUERIES["op12_reshard"](spark, f"/root/testdata/{sf}").collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    assert len(got) == len(docs) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    slots, sizes = {}, {}
    for r in got:
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    even, most = sum(sizes.values()) / 24, max(r["size"] for r in got)
    assert all(abs(s - even) <= max(0.02 * even, most) for s in sizes.values())
