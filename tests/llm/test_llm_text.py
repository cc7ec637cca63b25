"""Operators on whole texts against plain Python: tokens, licences, decontamination, near-duplicates, repeated substrings."""

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontaminate, licences, neardup, substrings, tokens
from tidemark.llm.simple8b import BLOCK, pack, unpack
from tidemark.llm.suffixes import permuted_common_prefixes, suffix_array
from tidemark.session import work_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 30_000])
@pytest.mark.parametrize("top", [2, 100, 50_000, 1 << 33, 1 << 60, 1 << 63])
def test_simple8b_round_trip(n, top):
    values = np.random.default_rng(n).integers(0, top, n, endpoint=True, dtype=np.uint64)
    assert (unpack(pack(values)) == values).all()


def test_simple8b_decodes_single_blocks():
    values = np.random.default_rng(0).integers(0, 50_000, 5 * BLOCK + 7).astype(np.uint64)
    coded = pack(values)
    assert (unpack(coded, (2, 4)) == values[2 * BLOCK : 4 * BLOCK]).all()
    assert (unpack(coded, (5, 6)) == values[5 * BLOCK :]).all()


def test_simple8b_refuses_other_bytes():
    with pytest.raises(ValueError):
        unpack(b"x" * 80)


def test_encoder_agrees_with_the_library():
    with open(VOCABULARY) as f:
        encoder = tokens.Encoder(f.read())
    rnd = random.Random(1)
    bits = ["'", " ", "s", "re", "ll", "\n", "!", "1", "é", "a", "  ", "t", " ", "’", "日本", "\t", "<|endoftext|>", "ve"]
    texts = ["", *("".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(4_000))]
    ids, counts = encoder.encode(pa.array(texts))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == encoder.model.encode(text, add_special_tokens=False).ids, text


def test_pieces_go_to_the_model_alone():
    """No running text is given to the library, which would cut and align it again, where the pieces are known for sure."""
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = tokens.Encoder(f.read())
    texts = ["It's  a\tplain\n\n text, isn't it? 12 \u00fcber\u00ad \u20ac\x00\x7f", "\r\n \u00a0x", ""]
    library, encoder.model = encoder.model, None
    ids, counts = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for text in texts for i in library.encode(text, add_special_tokens=False).ids]
    assert counts.tolist() == [len(library.encode(text, add_special_tokens=False).ids) for text in texts]


def check_tokens(spark, docs, rows, bag):
    path = work_path(spark, "tokens")
    tokens.write_tokens(docs, path, VOCABULARY)
    model = Tokenizer.from_file(VOCABULARY)
    ids = [(d, [*model.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows]
    found = tokens.read_tokens(spark, path).orderBy("start").collect()
    assert bag((r.doc_id, tuple(r.ids)) for r in found) == bag((d, tuple(x)) for d, x in ids)
    start = 0
    for r in found:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        start += r.n_tokens
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    crc = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found]
    assert bag(tokens.token_digest(spark, path).collect()) == bag(crc)


def test_tokens_of_edge_cases(spark, edge_docs, edge_rows, bag):
    check_tokens(spark, edge_docs, edge_rows, bag)


def test_tokens_of_small_tables(spark, small, pairs, bag):
    docs = small("documents")
    check_tokens(spark, docs, pairs(docs), bag)


def test_tokens_of_an_empty_table(spark, no_docs):
    path = work_path(spark, "tokens")
    tokens.write_tokens(no_docs, path, VOCABULARY)
    assert tokens.token_digest(spark, path).count() == 0


@pytest.mark.parametrize(
    ("text", "labels", "duty"),
    [
        ("mit", {"mit"}, 0),
        ("mit or gpl-3.0-only", {"mit", "gpl"}, 0),
        ("mit and gpl-3.0-only", {"mit", "gpl"}, 3),
        ("mit or apache-2.0 and gpl-2.0+", {"mit", "apache", "gpl"}, 0),
        ("(mit or apache-2.0) and gpl-2.0+", {"mit", "apache", "gpl"}, 3),
        ("gpl-2.0-only with classpath-exception-2.0", {"gpl"}, 2),
        ("cc-by-nc-4.0", {"cc-by-nc"}, 4),
        ("something-new", {"something-new"}, 4),
    ],
)
def test_expressions(text, labels, duty):
    assert licences.evaluate(text) == (labels, duty)


@pytest.mark.parametrize("text", ["", "mit or", "or mit", "(mit", "mit)", "mit mit", "()", "mit (gpl)"])
def test_what_is_no_expression(text):
    with pytest.raises(licences.ExpressionError):
        licences.postfix(text)


def test_tags_end_where_the_expression_does():
    assert licences.tagged_expression(" mit or apache-2.0 */") == "mit or apache-2.0"
    assert licences.tagged_expression(" (mit or isc) and zlib. See") == "( mit or isc ) and zlib"
    assert licences.tagged_expression(" (mit") is None
    assert licences.tagged_expression("") is None


def test_licences(spark, edge_docs, edge_rows, small, pairs, bag):
    more = [
        (20, "# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND CC-BY-4.0\nunder the MIT-License, gnu  General\nPublic license"),
        (21, "mit license mit license CC BY cc-by apache"),
        (22, "gnu general public"),
        (23, "license apache license"),
    ]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    found = licences.licence_digest(docs).collect()
    assert bag(r[:6] for r in found) == bag(brute.licence_places(edge_rows + more, licences.BASE))
    by_id = {r.doc_id: r for r in found}
    assert by_id[20].labels == "cc-by,gpl,mit"
    assert by_id[20].expressions == "( mit or gpl-2.0-only ) and cc-by-4.0"
    assert (by_id[2].labels, by_id[2].score) == ("", 0.0)
    assert all(0 <= r.score <= 1 for r in found)
    docs = small("documents")
    assert bag(r[:6] for r in licences.licence_digest(docs).collect()) == bag(brute.licence_places(pairs(docs), licences.BASE))


def test_licences_of_an_empty_table(no_docs):
    assert licences.licence_digest(no_docs).count() == 0


ITEMS = [("a", "one two"), ("b", None), ("c", ""), ("d", " ".join(f"w{i}" for i in range(30))), ("d", "w3 w4"), (None, "no id here")]


@pytest.mark.parametrize("block_words", [500_000, 20])
def test_decontamination(spark, edge_docs, edge_rows, bag, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    more = [
        (30, "start " + " ".join(f"W{i}" for i in range(4, 25)) + " end"),
        (31, " ".join(f"w{i}" for i in range(12))),
        (32, "one two one, TWO one"),
    ]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    items = spark.createDataFrame(ITEMS, "item_id string, text string").withColumn("key", decontaminate.F.lit(1))
    path = work_path(spark, "index")
    decontaminate.build_index(docs, path)
    found = decontaminate.contamination(spark, path, items).collect()
    assert bag(found) == bag(brute.decontaminate(edge_rows + more, ITEMS))


def test_decontamination_of_small_tables(spark, small, pairs, bag):
    docs, items = small("documents"), small("benchmark")
    path = work_path(spark, "index")
    decontaminate.build_index(docs, path)
    found = decontaminate.contamination(spark, path, items).collect()
    assert bag(found) == bag(brute.decontaminate(pairs(docs), [(r.item_id, r.text) for r in items.collect()]))


def test_decontamination_without_rows(spark, no_docs, edge_docs, edge_rows):
    path = work_path(spark, "index")
    decontaminate.build_index(no_docs, path)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert decontaminate.contamination(spark, path, items).count() == 0
    path = work_path(spark, "index")
    decontaminate.build_index(edge_docs, path)
    rows = decontaminate.contamination(spark, path, items.limit(0)).collect()
    assert len(rows) == len(edge_rows) and not any(r.n_hit for r in rows)


def test_proximity(spark):
    docs = [(1, "a b c d e f"), (2, "a x b c d e f"), (3, "f e d c b a"), (4, "a b c"), (5, "d e f")]
    path = work_path(spark, "index")
    decontaminate.build_index(spark.createDataFrame(docs, "doc_id long, text string"), path)
    items = spark.createDataFrame([(7, "a b c d e f")], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.phrase_matches(spark, path, items).collect()] == [1]
    near = decontaminate.proximity_matches(spark, path, items, slack=1).collect()
    assert sorted(r.doc_id for r in near) == [1, 2]
    with pytest.raises(ValueError):
        decontaminate.proximity_matches(spark, path, items, slack=decontaminate.GAP)


def check_near_duplicates(docs, rows, bag):
    assert bag(neardup.near_duplicates(docs).collect()) == bag(brute.near_duplicates(rows))


def test_near_duplicates_of_edge_cases(edge_docs, edge_rows, bag):
    check_near_duplicates(edge_docs, edge_rows, bag)


def test_near_duplicates_of_an_empty_table(no_docs):
    assert neardup.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize(("few", "chunk"), [(64, 2048), (2, 16)])
def test_near_duplicates_of_one_large_family(spark, bag, monkeypatch, few, chunk):
    monkeypatch.setattr(neardup, "SMALL", few)
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rnd = random.Random(few)
    base = [f"w{rnd.randrange(500)}" for _ in range(90)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 4])):
            words[rnd.randrange(len(words))] = f"n{rnd.randrange(40)}"
        rows.append((i, " ".join(words)))
    check_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rows, bag)


def test_a_pair_that_meets_in_one_bucket_is_looked_at(spark, folder):
    base = [f"w{i}" for i in range(60)]
    pivot, one, two = sorted((1, 2, 3), key=lambda i: spark.range(1).select(F.xxhash64(F.lit(i).cast("long"))).first()[0])
    texts = [(pivot, "not like the others at all"), (one, " ".join(base)), (two, " ".join([*base, "more"]))]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    sketches = neardup._sketches(rows, 3)
    leaders = sketches.select(F.col("doc_id").alias("id"), "doc_id", "f1", "f2")
    keyed = sketches.select(F.col("doc_id").alias("id"), "n", F.array(F.lit(7).cast("long")).alias("keys"))
    found = {r.node: r.component for r in neardup._linked(rows, ["doc_id"], leaders, keyed, False, folder, 3, (85, 100)).collect()}
    assert found == {one: min(one, two), two: min(one, two)}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b, c = (rng.integers(0, 1 << 63, 600).astype(np.uint64) for _ in range(3))
    one, two = np.append(a, b), np.append(b, c)
    regs = neardup.registers(np.concatenate([one, two, np.append(one, c)]), np.array([0, 1200, 2400, 4200]))
    assert (neardup.merged(regs[0], regs[1]) == regs[2]).all()
    near = neardup.estimate(regs[:1], regs[1:2], np.array([1200]), np.array([1200]))[0]
    assert abs(near - 1 / 3) < 0.1


def test_one_of_each(edge_docs, edge_rows):
    kept = neardup.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    stay = {d for d, _, _, keep in brute.near_duplicates(edge_rows) if keep}
    assert sorted(d for d in ids if d is not None) == sorted(stay - {None})
    assert ids.count(None) == 2


def test_stage_keeps_one_row_of_each_text_whatever_the_ids(spark):
    from corpus_pipeline import deduplicated

    rnd = random.Random(9)
    x, y, z, alone, other = (" ".join(f"{name}{rnd.randrange(400)}" for _ in range(80)) for name in "xyzao")
    rows = [
        *[(1, x), (1, y), (2, x + " end"), (3, y + " end"), (4, alone)],  # x and y share an id and nothing else
        *[(None, z), (None, z), (None, z + " end"), (None, x), (None, other), (5, other)],
        *[(6, "same id, other words"), (6, "nothing in common with it"), (7, "twice the same row"), (7, "twice the same row")],
        *[(None, None), (None, ""), (8, ""), (8, "")],
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(((r.doc_id, r.text) for r in deduplicated(spark, docs, "").collect()), key=str)
    of_z = [r for r in found if r[1] in (z, z + " end")]
    assert len(of_z) == 1
    stay = [(1, x), (1, y), (4, alone), (5, other), *rows[11:14], *rows[15:], *of_z]
    assert found == sorted(stay, key=str)


@pytest.mark.parametrize("many", [1500, 1])
def test_repeated_substrings_of_edge_cases(edge_docs, edge_rows, bag, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    found = substrings.remove_repeats(edge_docs).drop("removed").collect()
    assert bag(found) == bag(brute.repeated_substrings(edge_rows))


@pytest.mark.parametrize("many", [1500, 2])
def test_repeated_substrings_of_cut_up_texts(spark, bag, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    rnd = random.Random(many)
    parts = ["".join(rnd.choice("abcdé \n") for _ in range(rnd.randint(150, 420))) for _ in range(6)] + ["ab" * 130, "q" * 230]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rnd.randint(1, 4)):
            part = rnd.choice(parts)
            low, high = rnd.randrange(len(part)), rnd.randrange(len(part))
            text += part if rnd.random() < 0.4 else part[min(low, high) : max(low, high)]
        rows.append((i, text))
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert bag(found.drop("removed").collect()) == bag(brute.repeated_substrings(rows))
    for r in found.collect():
        assert sum(s["to"] - s["from"] for s in r.removed) == r.n_removed


def test_a_large_group_of_contexts_is_divided_inside_its_task(spark, monkeypatch):
    rnd = random.Random(4)
    core = "".join(rnd.choice("abcdefgh ") for _ in range(190))
    rows = [(i, "".join(rnd.choice("abc") for _ in range(3)) + core + "".join(rnd.choice("xy") for _ in range(8))) for i in range(300)]
    jobs, found = {}, {}
    for many in (1500, 1):
        monkeypatch.setattr(substrings, "MANY", many)
        spark.sparkContext.setJobGroup(f"many {many}", "")
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found[many] = sorted(substrings.remove_repeats(docs).drop("removed").collect())
        jobs[many] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"many {many}"))
    assert found[1] == found[1500] == sorted(brute.repeated_substrings(rows))
    assert jobs[1] <= jobs[1500] + 2  # no rounds of joins, however often a range is halved


def test_repeated_substrings_of_an_empty_table(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(0)
    for n in range(200):
        t = rng.integers(1, 4, n % 50 + 1)
        t = np.append(np.tile(t, 1 + n % 4), 0)
        order = sorted(range(len(t)), key=lambda i: t[i:].tolist())
        sa = suffix_array(t, 4)
        assert sa.tolist() == order
        shared = permuted_common_prefixes(t, sa, 1_000, np.zeros(0, np.int64))
        for a, b in zip(order, order[1:]):
            x, y = t[a:].tolist(), t[b:].tolist()
            assert shared[b] == next(k for k in range(len(x) + 1) if x[: k + 1] != y[: k + 1])
