"""Operators on tables: top-k search, fixity, mixing, classifiers, components, filters, and the pipeline."""

import random

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, filters, fixity, mixing, neardup, quality, queries, topk, toxicity
from tidemark.llm.components import components
from tidemark.llm.labelled import training_sample
from tidemark.session import work_path

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, bag, name):
    con = duckdb.connect()
    for table in ("embeddings", "pages", "documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = queries.REGISTRY[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    assert bag(df.select(*names).collect()) == bag(cursor.fetchall())


def top_k(spark, rows, k, every):
    path = work_path(spark, "top-k")
    schema = "vec_id long, embedding array<float>, row string, score string"
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], schema).repartition(2)
    topk.write_vectors(table, f"{path}/vectors")
    vectors = spark.read.parquet(f"{path}/vectors")
    topk.write_index(vectors, f"{path}/blocks")
    found = topk.search(spark, f"{path}/blocks", vectors.filter(F.col("vec_id") % every == 0), k, vectors)
    return [(r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()]


def plain_top_k(rows, k, every):
    sound = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for n, (i, q) in enumerate(sound):
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for m, (j, w) in enumerate(sound) if m != n)
            out += [(i, rank, j, max(-(1 << 63), min((1 << 63) - 1, -s))) for rank, (s, j) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("block", [4096, 64])
def test_top_k_with_ties_and_odd_vectors(spark, bag, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "BATCH", 7)
    monkeypatch.setattr(topk, "PASS", 16)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 12).round(1).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (0, rows[5][1])]  # ties, and an id that is there twice
    rows += [(400, None), (401, []), (402, [1.0, None]), (403, [float("nan")] * 12), (404, [float("inf")] * 12), (None, [1.0] * 12)]
    rows += [(405, [0.0] * 12), (420, [0.5, -0.5]), (440, [2.0] * 15)]
    assert bag(top_k(spark, rows, 20, 20)) == bag(plain_top_k(rows, 20, 20))


@pytest.mark.parametrize("large", [1e6, 6e7, 1e8, 1.5e38])
def test_top_k_of_far_vectors(spark, bag, monkeypatch, large):
    monkeypatch.setattr(topk, "FAR_PASS", 3)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 1, 4).round(2).tolist()) for i in range(60)]
    rows += [(100 + i, [large, -large * (i % 3), float(i), 0.5]) for i in range(8)] + [(200, [-large] * 4), (201, [large] * 4), (0, [large, 1.0])]
    assert bag(top_k(spark, rows, 5, 4)) == bag(plain_top_k(rows, 5, 4))
    assert bag(top_k(spark, [(0, [large, 1.0]), (1, [1e8, 1.0])], 20, 1)) == bag(plain_top_k([(0, [large, 1.0]), (1, [1e8, 1.0])], 20, 1))
    long = [(i, [0.5] * 1500) for i in range(3)]
    assert bag(top_k(spark, long, 2, 1)) == bag(plain_top_k(long, 2, 1))


def test_top_k_of_few_or_no_vectors(spark):
    assert top_k(spark, [(0, [1.0]), (1, [2.0])], 20, 20) == [(0, 1, 1, 64 * 128)]
    assert top_k(spark, [(0, [1.0])], 20, 20) == []
    assert top_k(spark, [], 20, 20) == []


PAGES = "page_id long, url string, html string, record string, file int, position long"


def archive(spark, rows):
    path = work_path(spark, "archive")
    fixity.write_archive(spark.createDataFrame([(*r, "x", 1, 5) for r in rows], PAGES), f"{path}/records")
    return path, fixity.read_archive(spark, f"{path}/records")


def tree(spark, path, name, rows):
    fixity.write_fixity(rows, f"{path}/{name}/fixity")
    return f"{path}/{name}/fixity", f"{path}/{name}/tree", fixity.write_tree(spark, f"{path}/{name}/fixity", f"{path}/{name}/tree")


def test_audit_locates_every_difference(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}é</p>") for i in range(200)] + [(7, "http://x/7", "<p>7é</p>")] * 2 + [(None, None, None), (3, "%s", "")]
    path, own = archive(spark, rows)
    stored = sorted(own.collect(), key=lambda r: r.position)
    assert [r.position for r in stored] == list(range(len(rows)))
    assert [r.page_id for r in stored] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    other = own.filter("position NOT IN (70, 71)").withColumn(
        "record", F.when(F.col("position") == 130, F.lit(b"?")).otherwise(F.col("record"))
    )
    more = own.filter("position = 5").withColumn("position", F.lit(9000).cast("long"))
    left, right = tree(spark, path, "left", own), tree(spark, path, "right", other.unionByName(more))
    found = {(r.position, r.status) for r in fixity.audit(spark, left, right).collect()}
    assert found == {(70, "missing"), (71, "missing"), (130, "changed"), (9000, "extra")}
    same = tree(spark, path, "same", own)
    assert fixity.root(spark, *left[1:]) == fixity.root(spark, *same[1:]) != fixity.root(spark, *right[1:])
    assert fixity.audit(spark, left, same).count() == 0
    offsets = [r.offset for r in fixity.with_offsets(spark.read.parquet(left[0])).orderBy("position").collect()]
    sizes = [len(r.record) for r in stored]
    assert offsets == [sum(sizes[:i]) for i in range(len(sizes))]


def test_audit_of_empty_archives_and_repeated_positions(spark):
    path, own = archive(spark, [])
    empty = tree(spark, path, "empty", own)
    assert fixity.root(spark, *empty[1:]) is None and fixity.audit(spark, empty, empty).count() == 0
    path, own = archive(spark, [(1, "u", "h"), (2, "u", "h")])
    one, two = tree(spark, path, "one", own), tree(spark, path, "two", own.unionByName(own.filter("position = 0")))
    assert [(r.position, r.status) for r in fixity.audit(spark, one, two).collect()] == [(0, "changed")]


def plain_targets(sizes):
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    left, active, out = 1.5 * sum(sizes.values()), set(sizes), {}
    while active:
        level = left / sum(weight[s] for s in active)
        full = {s for s in active if level * weight[s] > 2 * sizes[s]}
        for s in full or active:
            out[s] = 2 * sizes[s] if full else level * weight[s]
            left -= out[s]
        active -= full or active
    return out


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rnd = random.Random(seed)
    names = ["a", "B", "é", "zz", "", None, "c", "hot"]
    rows = [(i, " ".join(["w"] * rnd.randint(0, 30)), "hot" if i % 3 == 0 else rnd.choice(names)) for i in range(900)]
    rows += [(1000, None, "empty"), (1001, "x y", "twice"), (1001, "x y", "twice"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    path = work_path(spark, "sizes")
    mixing.measure(docs).write.parquet(path)
    found = mixing.mix(spark.read.parquet(path)).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = plain_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in found if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(targets[source]) for r in own)
        assert all(r.taken == r.copies * r.size and r.copies in (0, 1, 2) for r in own)
        assert abs(sum(r.taken for r in own) - targets[source]) <= 15.5
        assert min(r.copies for r in own) >= targets[source] // max(size, 1) - 1e-9 or size == 0
    mixing.measure(docs.repartition(7)).write.parquet(f"{path}-again")
    again = mixing.mix(spark.read.parquet(f"{path}-again")).collect()
    key = lambda r: (r.doc_id or -1, r.source or "", r.tie, r.copies)
    assert sorted(found, key=key) == sorted(again, key=key)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in found)


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "plain words here" if i % 2 else "### $$$ %%%", "a") for i in range(2000)] + [(5000 + i, "x y z", "b") for i in range(900)]
    path = work_path(spark, "sizes")
    mixing.measure(spark.createDataFrame(rows, "doc_id long, text string, source string")).write.parquet(path)
    found = [r for r in mixing.mix(spark.read.parquet(path), share=0.3).collect() if r.source == "a"]
    good, bad = (sum(r.copies for r in found if r.doc_id % 2 == odd) for odd in (1, 0))
    assert good > 4 * bad


def test_mixing_an_empty_table(spark, no_docs):
    path = work_path(spark, "sizes")
    mixing.measure(no_docs).write.parquet(path)
    assert mixing.mix(spark.read.parquet(path)).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


def test_pair_sum_in_linear_time():
    rng = np.random.default_rng(4)
    width = quality.BUCKETS + quality.STATISTICS
    machine = quality.Machine(
        0.3, rng.normal(size=width), rng.normal(size=(width, 3)), np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS)
    )
    x = quality.Sparse(np.array([0, 4]), np.array([5, 70, 900, 4000], np.int32), np.array([0.5, 1.5, -1.0, 2.0], np.float32))
    direct = 0.3 + sum(machine.weight[c] * v for c, v in zip(x.column, x.value))
    for i in range(4):
        for j in range(i):
            direct += machine.factor[x.column[i]] @ machine.factor[x.column[j]] * x.value[i] * x.value[j]
    assert machine.margin(x)[0] == pytest.approx(direct)


def held_out_accuracy(found, labels, label):
    known = {r.doc_id: r[label] for r in labels.collect()}
    own = [(r.predicted, known[r.doc_id]) for r in found if r.held_out and r.doc_id in known]
    return sum(a == b for a, b in own) / len(own)


@pytest.mark.parametrize(("name", "label", "modulus", "held"), [("op4_quality", "quality", 4, 2), ("op1_toxicity", "toxic", 3, 1)])
def test_classifiers_on_held_out_rows(spark, name, label, modulus, held):
    import zlib

    found = queries.REGISTRY[name](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == 1000
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    assert held_out_accuracy(found, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), label) > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_take_odd_rows_and_no_labels(spark, small, edge_docs, edge_rows, no_docs, module):
    labels = small("labels").withColumn("text", F.lit("clash"))
    label = "quality" if module is quality else "toxic"
    model = module.train(small("documents"), labels, label)
    found = module.score(edge_docs, model).collect()
    assert len(found) == len(edge_rows) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1  # null and empty texts alike
    assert module.score(no_docs, model).count() == 0
    untrained = module.train(no_docs, labels, label)
    assert {r.score for r in module.score(edge_docs, untrained).collect()} == {0.5}
    alike = module.train(small("documents"), labels.withColumn(label, F.lit(1)), label)
    assert all(r.score >= 0.9 for r in module.score(edge_docs, alike).collect())


def test_training_sample(spark):
    docs = spark.createDataFrame([(i, "t", "x") for i in range(200)] + [(None, "t", "x")], "doc_id long, text string, label string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(0, 200, 2)] + [(0, 1), (0, 1), (3, None), (None, 1)], "doc_id long, quality int"
    )
    found = training_sample(docs, labels, "quality", F.col("doc_id") % 10 == 4, 30).collect()
    assert len(found) == 30 and all(r.doc_id % 2 == 0 and r.doc_id % 10 != 4 and 0 <= r.part < 10 for r in found)
    every = training_sample(docs, labels, "quality", F.lit(False), 1000).collect()
    assert {r.doc_id: r.label for r in every}[0] == 1 and len(every) == 100


def test_toxicity_features():
    rows = [None, "", "You are an IDIOT!!", "you are an 1d10t", "nothing here", "soooo stupid"]
    x = toxicity.features(pa.record_batch({"text": pa.array(rows, pa.string())}), ["noth*"])
    value = lambda row, name: x[row, toxicity.FEATURES.index(name)]
    assert not x[:2].any()
    assert value(2, "insults_per_100") == 25 and value(2, "near_second_person") > 0 and value(2, "capitals") > 0.4
    assert value(3, "insults_log") == 0 and value(3, "disguised_log") > 0
    assert value(4, "learned_per_100") == 50 and value(5, "stretched") == 1


def test_components(spark, bag):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 150)] + [(149, 7), (300, 301), (301, 300), (9, 9)]
    links += [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(90)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = components(spark, spark.createDataFrame(links, "a long, b long")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert bag(found) == bag((x, find(x)) for x in linked)
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_fixed_size_filters(spark, monkeypatch):
    rows = spark.range(2000).select("id", F.xxhash64("id").alias("key"))
    for bits in (filters.BITS, 64):
        monkeypatch.setattr(filters, "BITS", bits)
        left = filters.unlisted(rows, "key", rows.filter("id % 3 = 0").select("key"))
        assert sorted(r.id for r in left.collect()) == [i for i in range(2000) if i % 3]


def test_pipeline_against_plain_python(spark, bag, pairs):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    path = work_path(spark, "stages")
    columns, before = docs.columns, pairs(docs)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{path}/{i}")
        after = spark.read.parquet(f"{path}/{i}")
        if i == 4:
            break
        assert after.columns == columns
        now = pairs(after)
        if i == 0:
            machine = quality.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
            good = {r.doc_id for r in quality.score(docs, machine).collect() if r.predicted}
            assert bag(now) == bag(r for r in before if r[0] in good) and len(now) < len(before)
        elif i == 1:
            stay = {d for d, _, _, kept in brute.near_duplicates(before) if kept}
            assert bag(now) == bag(r for r in before if r[0] in stay)
        elif i == 2:
            bad = {r[0] for r in brute.decontaminate(before, items) if r[-1]}
            assert bag(now) == bag(r for r in before if r[0] not in bad)
        else:
            mixing.measure(docs).write.parquet(f"{path}/sizes")
            copies = {r.doc_id: r.copies for r in mixing.mix(spark.read.parquet(f"{path}/sizes")).collect()}
            assert bag(now) == bag(r for r in before for _ in range(copies[r[0]]))
        docs, before = after, now
    assert after.count() == len(before)
    assert bag(corpus_pipeline.run(spark, SMALL).collect()) == bag(after.collect())


#: Names the stages use inside, beside those of EXTRA.
INSIDE = "row_key row_check text_key drop_key key again own doc weight range border chosen before target source_size f1 f2 taken nth copy doc_key"


def test_stages_leave_columns_alone(spark, bag, edge_docs, small):
    import corpus_pipeline

    more = {name: F.concat(F.lit(f"{name}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))) for name in INSIDE.split()}
    docs = edge_docs.withColumns(more).withColumn("m", F.create_map(F.lit("a"), F.col("doc_id")))
    plain = lambda df: bag(tuple(str(x) for x in r) for r in df.collect())
    whole = plain(docs)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = plain(out)
        assert set(rows) <= set(whole) and rows, name
    assert plain(decontaminate.remove_contaminated(docs, small("benchmark"))) == whole
    assert set(plain(neardup.one_of_each(docs))) <= set(whole)


def test_stages_of_empty_tables(spark, no_docs):
    import corpus_pipeline

    assert neardup.one_of_each(no_docs).count() == 0
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, no_docs, SMALL).count() == 0


def test_mixed_words_per_source_with_repeated_ids(spark):
    """Ids and texts that stand in several sources count for each source by itself."""
    rows = [(i % 40, f"word{i % 40} " * (5 + i % 40), "ab"[i % 3 == 0]) for i in range(900)]
    rows += [(7, "the very same words", s) for s in "aabbbb"] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    path = work_path(spark, "sizes")
    mixing.measure(docs).write.parquet(path)
    goal = {r.source: r.target for r in mixing.targets(spark.read.parquet(path)).collect()}
    taken = dict.fromkeys(goal, 0)
    for r in mixing.mixed_documents(docs).collect():
        taken[r.source] += len(r.text.split())
    for source, target in goal.items():
        assert abs(taken[source] - target) <= 45, source


def test_no_range_of_keys_holds_much_of_a_source(spark):
    """Whatever the weights are."""
    for weight in (0.05, 0.3, 1.0):
        key = mixing.sampling_key(F.lit(weight), F.col("id"))
        ranges = spark.range(200_000).groupBy(F.floor(F.log2(key) * mixing.RANGES)).count()
        assert ranges.agg(F.max("count")).first()[0] < 200_000 / 1500


@pytest.mark.parametrize("size_and_alike", [(3, (85, 100)), (5, (80, 100)), (2, (90, 100))])
def test_shingle_size_and_threshold_are_parameters(spark, bag, size_and_alike):
    size, alike = size_and_alike
    rnd = random.Random(8)
    rows = []
    for group in range(12):
        words = [f"w{rnd.randrange(300)}" for _ in range(60)]
        for copy in range(6):
            own = list(words)
            for _ in range(copy):
                own[rnd.randrange(60)] = f"x{group}-{copy}"
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bag(neardup.near_duplicates(docs, size, alike).collect()) == bag(brute.near_duplicates(rows, *alike, size))
