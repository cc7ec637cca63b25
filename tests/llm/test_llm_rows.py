"""Sharding, centroid clustering and conversation repair, against their SQL on odd tables and against plain Python."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import clustering, conversations, queries, sharding
from tidemark.session import work_path


def sql(name, table, rows, schema):
    """The rows that a query's SQL gives for a table of its own."""
    con = duckdb.connect()
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    con.register(table, pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema))
    cursor = con.execute(queries.ORACLES[name])
    return [d[0] for d in cursor.description], cursor.fetchall()


# -- sharding ------------------------------------------------------------------------------------------------------

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
CLASH = ("size", "row", "key", "id", "range", "shard", "slot", "doc", "n", "place")


def shard_rows():
    rnd = random.Random(2)
    rows = [(i, " ".join(["word"] * rnd.randint(0, 40)) + str(i)) for i in range(600)]
    rows += [(1000 + i, "a copy of which there are very many") for i in range(400)]  # a hot group of texts
    rows += [(7, "all the same")] * 150 + [(None, None)] * 3 + [(None, ""), (5000, None), (5001, "é" * 300), (5002, "long " * 4000)]
    return rows


def test_shards_against_sql(spark, bag, monkeypatch):
    monkeypatch.setattr(sharding, "RANGES", 20)
    monkeypatch.setattr(sharding, "FEW", 5)
    rows = shard_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASH}).repartition(5)
    names, want = sql("op11_sharding", "documents", rows, DOCS)
    found = sharding.shard_digest(docs)
    assert bag(found.select(*names).collect()) == bag(want)
    by_shard = {}
    for r in found.collect():
        by_shard.setdefault(r.shard, []).append((r.slot, r.size))
    assert set(by_shard) <= set(range(24))
    assert all(sorted(s for s, _ in own) == list(range(len(own))) for own in by_shard.values())
    share, largest = sum(len((t or "").encode()) + 8 for _, t in rows) / 24, max(len((t or "").encode()) + 8 for _, t in rows)
    assert all(abs(sum(x for _, x in by_shard.get(s, [])) - share) <= largest for s in range(24))


def test_splitters_divide_hot_and_overfull_ranges(spark):
    rows = [(i, "the same text", 1 << 40) for i in range(3000)] + [(i, f"text {i}", 0) for i in range(3000, 6000)]
    path = work_path(spark, "measured")
    sharding.measure(spark.createDataFrame(rows, "doc_id long, text string, size long"), path)
    stored = spark.read.parquet(path)
    cuts, totals = sharding.splitters(stored, 30)
    assert cuts == sorted(set(cuts)) and len(totals) == len(cuts) + 1
    assert sum(n for _, n in totals) == 6000 and max(n for _, n in totals) <= max(3 * 6000 // 30, sharding.FEW)
    # Too few sampled: what is overfull is cut again.
    sharding_few, sharding.FEW = sharding.FEW, 10
    try:
        cuts, totals = sharding.splitters(stored, 30, seed=9)
        assert max(n for _, n in totals) <= 3 * 6000 // 30
    finally:
        sharding.FEW = sharding_few
    # The search gives what counting splitters gives.
    found = sharding.with_range(stored, cuts).select("key", "id", "row", "range").collect()
    assert all(r.range == sum(c <= (r.key, r.id, r.row) for c in cuts) for r in found)


def test_shards_of_few_or_no_rows(spark, no_docs):
    assert sharding.shard_digest(no_docs).count() == 0
    one = sharding.shard_digest(spark.createDataFrame([(1, "x")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.size, r.text_crc32, r.slot, r.law, r.grown_shard) for r in one] == [(1, 9, zlib.crc32(b"x"), 0, "bytes", None)]


def test_written_shards(spark, bag, edge_docs, pairs):
    out = work_path(spark, "written")
    sharding.write_shards(edge_docs, out, shards=4, files=2)
    back = spark.read.parquet(out)
    assert bag((r.doc_id, r.text) for r in back.select("doc.*").collect()) == bag(pairs(edge_docs))
    assert back.select("doc.*").columns == edge_docs.columns
    for shard in range(4):
        slots = [r.slot for r in back.filter(F.col("shard") == shard).select("slot").collect()]
        assert sorted(slots) == list(range(len(slots)))


# -- clustering ----------------------------------------------------------------------------------------------------

VECTORS = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))])


def cluster_rows(spark, rows, **options):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, n int")
    return clustering.clusters(table.repartition(3), **options)


@pytest.mark.parametrize("bits", [1, 6])
def test_clusters_against_sql(spark, bag, monkeypatch, bits):
    monkeypatch.setattr(clustering, "BLOCK", 64)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(i % 5 / 5, 0.2, 64).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (0, rows[5][1]), (1, rows[1][1])]
    odd = [(400, None), (401, []), (402, [1.0] * 63 + [None]), (403, [float("nan")] * 64), (404, [float("inf")] * 64), (405, [0.5] * 65)]
    names, want = sql("op12_centroids", "embeddings", rows + odd, VECTORS)
    assert bag(cluster_rows(spark, rows + odd, bits=bits).select(*names).collect()) == bag(want)


def plain_clusters(rows, dims, k, rounds):
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows]
    name = lambda i: "~" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest()
    centres = [v for _, v in sorted((name(i), v) for i, v in kept)[:k]]
    gap = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min((gap(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        own = [(nearest(v)[1], v) for _, v in kept]
        for n in {n for n, _ in own}:
            mine = [v for m, v in own if m == n]
            centres[n] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *nearest(v)) for i, v in kept]
    most = (1 << 63) - 1
    inertia = {n: sum(min(d, most) for _, d, m in last if m == n) for _, _, n in last}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, n, min(d, most), min(inertia[n], most), min(sum(inertia.values()), most), digest[n]) for i, d, n in last]


@pytest.mark.parametrize("large", [1e8, 3e38])
def test_clusters_of_very_large_components(spark, bag, monkeypatch, large):
    monkeypatch.setattr(clustering, "BLOCK", 8)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(30)] + [(None, [0.5] * 4), (None, [0.25] * 4)]
    rows += [(100 + i, [large, -large * i / 5, 1.0, 0.0]) for i in range(6)]
    found = cluster_rows(spark, rows, dims=4, k=5)
    assert bag(found.collect()) == bag(plain_clusters(rows, 4, 5, 3))


def test_clusters_of_few_or_no_vectors(spark, bag):
    assert cluster_rows(spark, []).count() == 0
    rows = [(1, [0.5] * 64), (2, [0.25] * 64)]
    assert bag(cluster_rows(spark, rows).collect()) == bag(plain_clusters(rows, 64, 16, 3))


def test_cells_decide_most_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 0.5, (8, 64))
    rows = [(i, (centres[i % 8] + rng.normal(0, 0.1, 64)).tolist()) for i in range(800)]
    path = work_path(spark, "va")
    clustering.write_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), f"{path}/v", 64)
    first = [[int(x) for x in np.floor(64 * c)] for c in centres]
    edges = clustering.cell_edges(spark, f"{path}/v")
    clustering.write_cells(spark, f"{path}/v", f"{path}/c", edges)
    after, fetched = clustering._round(spark, f"{path}/c", edges, first)
    assert fetched < 0.5 * len(rows) and after != first


# -- conversations -------------------------------------------------------------------------------------------------

TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def digest(spark, rows, harm=True):
    table = spark.createDataFrame([(*r, "x", True, "y") for r in rows], "conv_id long, turn long, role string, text string, fault string, lost boolean, audit string")
    own = conversations.rows_of(table.repartition(3))
    return conversations.repair_digest(conversations.damaged(own) if harm else own)


def odd_turns(seed):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rnd.randint(0, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "únd"])
            text = rnd.choice(["Yes.", "No!", "What? ", "open end", "same.", "same.", "", " \n\t", None, "é.\x85", f"turn {turn}.\n"])
            rows.append((conv, rnd.choice([turn, turn, turn, 2 * turn, None]), role, text))
    return rows + rows[5:9]


@pytest.mark.parametrize("seed", range(4))
def test_repair_against_sql(spark, bag, seed):
    rows = odd_turns(seed)
    names, want = sql("op13_conversations", "conversations", rows, TURNS)
    assert bag(digest(spark, rows).select(*names).collect()) == bag(want)


def cheapest(rows):
    """Least (cost, edits) over all edit sequences, by a search over the finite automaton."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("p", "u"): "u", ("u", "a"): "p"}
    best = {"0": (0, "", "")}
    for role, text, must_go, cut in rows:
        for _ in range(2):
            for state, (cost, edits, out) in list(best.items()):
                for x in "ua":
                    if (state, x) in step:
                        way = (cost + 5, edits + "I", out + x)
                        after = step[state, x]
                        best[after] = min(best.get(after, way), way)
        found = {}
        for state, (cost, edits, out) in best.items():
            offers = [(state, (cost + 2, edits + "D", out))]
            if not must_go:
                extra = 5 if cut else 0
                if (state, role[:1]) in step:
                    offers.append((step[state, role[:1]], (cost + extra, edits + "K", out + role[:1])))
                offers += [(step[state, x], (cost + 1 + extra, edits + "R", out + x)) for x in "ua" if (state, x) in step]
            for after, way in offers:
                found[after] = min(found.get(after, way), way)
        best = found
    ends = []
    for state, (cost, edits, out) in best.items():
        while state not in "0p":
            x = "u" if state == "s" else "a"
            cost, edits, state = cost + 5, edits + "I", step[state, x]
        ends.append((cost, edits))
    return min(ends)


@pytest.mark.parametrize("seed", range(3))
def test_parser_against_automaton(seed):
    rnd = random.Random(seed)
    for _ in range(300):
        rows = [(rnd.choice(["system", "user", "assistant", "tool", ""]), f"t{i}.", rnd.random() < 0.15, rnd.random() < 0.2) for i in range(rnd.randint(0, 25))]
        parse = conversations.Repair()
        for r in rows:
            parse.read(*r)
        cost, audit, _ = parse.end()
        assert (cost, audit) == cheapest(rows)
    assert conversations.step.cache_info().currsize < 1000  # few different graphs


def test_long_conversation_in_bounded_memory(spark):
    rows = [(1, i, "user", f"turn {i}.") for i in range(20_000)] + [(2, 0, "user", "Hi. " * 300_000), (2, 1, "assistant", "Yes.")]
    found = {r.conv_id: r for r in digest(spark, rows, harm=False).collect()}
    assert found[1].audit == "KR" * 10_000 and found[1].cost == 10_000 and found[1].illegal == 19_999
    text = "\n".join(f"{'assistant' if i % 2 else 'user'}:turn {i}." for i in range(20_000))
    assert found[1].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert found[2].audit == "KK" and found[2].cost == 0


def test_repaired_turns_match_their_digest(spark):
    rows = conversations.damaged(conversations.rows_of(spark.createDataFrame(odd_turns(9), "conv_id long, turn long, role string, text string")))
    found = conversations.repair_digest(rows)
    lines = {}
    for r in conversations.repaired(rows, found).collect():
        lines.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
    for r in found.collect():
        own = sorted(lines.get(r.conv_id, []))
        assert [p for p, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(x for _, x in own).encode()).hexdigest() == r.repaired_sha256


def test_no_conversations(spark):
    assert digest(spark, []).count() == 0
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = digest(spark, [(lost, 0, "user", "Hello.")]).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
