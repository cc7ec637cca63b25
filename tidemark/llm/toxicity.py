"""Toxicity of texts: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are densities of lexicon words (a fixed list, and words and word beginnings that labelled rows show to be
typical of toxic texts), how many stand close to the second person, rates of capitals and punctuation, and rates of obfuscated
writing. They are worked out for whole Arrow batches; trees and calibration are Spark ML's, and so is scoring. Lexicon and trees are learned on four fifths of
the labelled sample, the calibration on the half that holds the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import held_out, training_sample
from tidemark.llm.words import ALNUM, Words, cut, lower_ascii, pieces, text_bytes

#: Labelled rows the model is fitted on at most.
ROWS = 20_000
#: Terms the learned lexicon holds at most (the most typical ones), the share of toxic texts each must be found in, and by how
#: much (natural logarithm) it must be more frequent in them.
LEXICON_SIZE, LEAST_SHARE, LEAST_ODDS = 200, 0.03, 2.0
#: Lengths of word beginnings that can be in the learned lexicon, so that inflected words are found.
BEGINNINGS = (4, 5, 6, 7, 8)
TREES, DEPTH = 20, 4
HELD_OUT = (3, 1)
THRESHOLD = 0.7
#: Words between a lexicon word and a pronoun at most.
NEAR = 3

# Common insults and slurs on character, in four languages.
INSULTS = (
    "asshole bastard bitch brainless clown coward crap creep cretin cunt damn degenerate despicable dick dickhead disgrace "
    "disgusting dumb dumbass failure fool fraud freak fuck fucking garbage gross hate horrible idiot idiotic idiots ignorant "
    "imbecile incompetent inferior jerk kill liar loser losers lunatic maggot moron moronic morons nasty pathetic pig prick "
    "psycho rat rubbish scum scumbag shame shit shithead sick slut stupid sucker terrible trash ugly useless vermin vile whore "
    "worm worthless wretched "
    "abschaum arschloch blödmann depp dreck dreckig dumm dummkopf ekelhaft erbärmlich feigling idioten lügner müll scheiße "
    "schwachkopf schwein trottel versager widerlich wertlos "
    "abruti connard con crétin dégoûtant débile imbécile ordure pathétique pourri putain salaud stupide tocard "
    "asqueroso basura cabrón cobarde escoria estúpido idiota imbécil inútil maldito mierda patético perdedor puta tonto"
).split()
# The second person in the same languages.
SECOND_PERSON = (
    "you your yours yourself youre ur u ya thou dich dein deine dir du euch eure ihr te ti toi ton ta tes tu vous votre vos "
    "usted ustedes vosotros tus tuyo"
).split()
# Signs that stand for letters in obfuscated writing.
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = (
    "insults_per_100 insults_log learned_per_100 learned_log different_log near_second_person second_person_per_100 capitals "
    "shouts questions punctuation signs disguised_log disguised_per_100 stretched words_log"
).split()


def _table(chars: str) -> np.ndarray:
    return np.array([chr(b) in chars for b in range(256)])


_CAPITALS, _LETTERS = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
_SHOUTS, _QUESTIONS, _STOPS, _SIGNS = _table("!"), _table("?"), _table(".,;:!?-'\""), _table("#$%&*@^~_+=|")
_PLAIN = np.array([ord(DISGUISE.get(chr(b), chr(b))) for b in range(256)], np.uint8)
_DISGUISE = _table("".join(DISGUISE))


def _members(words: Words, lexicons: list[list[str]], starred: bool = True) -> list[np.ndarray]:
    """For each lexicon, whether each word, or a beginning of it with a star, is in it; every different word is looked up once."""
    coded = words.values().dictionary_encode()
    index, names = coded.indices.to_numpy(), coded.dictionary.cast(pa.large_string())
    sets = [pa.array(x, pa.large_string()) for x in lexicons]
    found = [np.zeros(len(names), bool) for _ in lexicons]
    for term, fits in _terms(names) if starred else [(names, np.ones(len(names), bool))]:
        for i, entries in enumerate(sets):
            found[i] |= pc.is_in(term, value_set=entries).to_numpy(zero_copy_only=False) & fits
    return [f[index] for f in found]


def features(batch: pa.RecordBatch, learned: list[str]) -> np.ndarray:
    """A row of ``FEATURES`` for each text; an empty text has zeros."""
    data, offsets = text_bytes(batch.column("text"))
    n = batch.num_rows

    def rate(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(kind[data]))[offsets]) / np.maximum(of, 1)

    size = np.diff(offsets).astype(np.float64)
    low = lower_ascii(data)
    words = cut(low, offsets, ALNUM)
    (typical,) = _members(words, [learned])
    insults, person = _members(words, [INSULTS, SECOND_PERSON], starred=False)
    doc, any_ = words.doc, insults | typical
    some = np.maximum(words.counts, 1).astype(np.float64)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc[flags], minlength=n).astype(np.float64)

    hit = np.flatnonzero(any_)
    pairs = np.unique(np.stack([doc[hit].astype(np.uint64), words.hashes()[hit]]), axis=1) if len(hit) else np.zeros((2, 0))
    different = np.bincount(pairs[0].astype(np.int64), minlength=n)
    at = np.flatnonzero(person)
    near = np.zeros(len(doc), bool)
    for step in range(-NEAR, NEAR + 1):
        to = at + step
        keep = (to >= 0) & (to < len(doc))
        keep[keep] = doc[to[keep]] == doc[at[keep]]
        near[to[keep]] = True

    # Written plainly again, words with signs or digits among their letters may turn out to be in the lexicon.
    plain = cut(_PLAIN[low], offsets, ALNUM)
    odd = np.append(0, np.cumsum(_DISGUISE[low]))
    odd = odd[plain.ends] > odd[plain.starts]
    rows = np.flatnonzero(odd)
    disguised = np.zeros(n)
    if len(rows):
        few = Words(plain.data, plain.starts[rows], plain.ends[rows], np.zeros(1, np.int64))
        disguised = np.bincount(plain.doc[rows][_members(few, [INSULTS + learned])[0]], minlength=n).astype(np.float64)

    run = np.zeros(len(low), bool)  # a letter three times in a row
    if len(low) > 2:
        run[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & _LETTERS[low[2:]]
    stretched = np.diff(np.append(0, np.cumsum(run))[offsets])
    letters = rate(_LETTERS, np.ones(n))
    columns = [
        100 * per_doc(insults) / some,
        np.log1p(per_doc(insults)),
        100 * per_doc(typical) / some,
        np.log1p(per_doc(typical)),
        np.log1p(different),
        np.log1p(per_doc(any_ & near)),
        100 * per_doc(person) / some,
        rate(_CAPITALS, letters),
        rate(_SHOUTS, size),
        rate(_QUESTIONS, size),
        rate(_STOPS, size),
        rate(_SIGNS, size),
        np.log1p(disguised),
        100 * disguised / some,
        stretched / some,
        np.log1p(words.counts),
    ]
    return np.stack(columns, axis=1)


def with_features(rows: DataFrame, learned: list[str]) -> DataFrame:
    """``rows`` (text and any columns beside it) with ``features`` in place of the text; one scan, whole texts."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = features(batch, learned)
            bounds = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            column = pa.ListArray.from_arrays(bounds, pa.array(x.reshape(-1)))
            yield pa.record_batch({c: batch.column(c) for c in kept} | {"features": column})

    types = dict(rows.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", features array<double>"
    return rows.mapInArrow(run, schema).withColumn("features", array_to_vector("features"))


def _term_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Words and word beginnings of a batch with their places and texts, all and toxic."""
    data, offsets = text_bytes(batch.column("text"))
    words = cut(lower_ascii(data), offsets, ALNUM)
    toxic = batch.column("label").to_numpy() == 1
    coded = words.values().dictionary_encode()
    index, doc = coded.indices.to_numpy(), words.doc
    parts = []
    for term, fits in _terms(coded.dictionary.cast(pa.large_string())):
        few = term.dictionary_encode()
        code, names = few.indices.to_numpy()[index], few.dictionary
        use = fits[index]
        key, n = np.unique(code[use] * len(toxic) + doc[use], return_counts=True)
        of, bad = key // len(toxic), toxic[key % len(toxic)]
        m = len(names)
        counts = [np.bincount(of, n, m), np.bincount(of, n * bad, m), np.bincount(of[bad], minlength=m)]
        seen = counts[0] > 0
        parts.append([names.filter(pa.array(seen)), *(c[seen].astype(np.int64) for c in counts)])
    return pa.record_batch(
        {
            "term": pa.concat_arrays([p[0] for p in parts]).cast(pa.string()),
            **{c: pa.array(np.concatenate([p[i] for p in parts])) for i, c in ((1, "n"), (2, "p"), (3, "texts"))},
        }
    )


def _terms(words: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """For each word itself, then its beginning of each of ``BEGINNINGS`` lengths with a star: the term, and if it is one."""
    length = pc.utf8_length(words).to_numpy()
    star, empty = (pa.scalar(x, pa.large_string()) for x in ("*", ""))
    yield words, length >= min(BEGINNINGS)
    for size in BEGINNINGS:
        yield pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, size), star, empty), length > size


def learn_lexicon(rows: DataFrame) -> list[str]:
    """Words, and beginnings of words (with a star), far more frequent in toxic rows (``text``, ``label``), most typical first.

    At most ``LEXICON_SIZE`` of them, each found in ``LEAST_SHARE`` of the toxic texts at least. Counted in one scan, with one
    row per term and Arrow batch to shuffle; none if all labels are alike.
    """
    terms = rows.select("text", "label").mapInArrow(
        lambda batches: map(_term_counts, pieces(batches)), "term string, n long, p long, texts long"
    )
    terms = terms.groupBy("term").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("texts").alias("texts")).persist()
    words = terms.filter(~F.col("term").endswith("*")).agg(F.sum("p"), F.sum("n")).first()
    labels = rows.agg(F.sum("label"), F.count("*")).first()
    toxic, all_words, bad_words = labels[0] or 0, words[1] or 0, words[0] or 0
    if not toxic or toxic == labels[1]:
        terms.unpersist()
        return []
    clean = F.col("n") - F.col("p")
    odds = F.log((F.col("p") + 0.5) / (bad_words + 1)) - F.log((clean + 0.5) / (all_words - bad_words + 1))
    typical = terms.filter((F.col("texts") >= max(3, LEAST_SHARE * toxic)) & (odds > LEAST_ODDS))
    found = typical.orderBy((odds * F.sqrt("texts")).desc(), "term").limit(LEXICON_SIZE).select("term").collect()
    terms.unpersist()
    return [r.term for r in found]


@dataclass
class Model:
    """A fitted model; ``trees`` is None where the labels seen were all alike, then every score is ``rate``."""

    learned: list[str]
    trees: object | None
    calibration: object | None
    rate: float


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = ROWS) -> Model:
    """Fit on at most ``rows`` labelled rows that are not held out (parts 0-7 lexicon and trees, 8-9 calibration)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = training_sample(own, labels, label, held_out(F.col("doc_id"), *HELD_OUT), rows).select("text", "label", "part")
    sample = sample.repartition(max(2, docs.sparkSession.sparkContext.defaultParallelism)).persist()
    learned = learn_lexicon(sample.filter("part < 8"))
    # Trees ask for the same rows dozens of times: features alone are kept, of a bounded number of rows.
    found = with_features(sample, learned).persist()
    trained = found.filter("part < 8")
    totals = trained.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    model = Model(learned, None, None, float(totals[0] if totals[0] is not None else 0.5))
    if totals[1] != totals[2]:
        boosting = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=3, minInstancesPerNode=5)
        model.trees = boosting.fit(trained)
        margin = _margins(model.trees, found.filter("part >= 8"))
        if margin.select("label").distinct().count() == 2:
            model.calibration = IsotonicRegression(
                labelCol="label", featuresCol="margin", predictionCol="calibrated"
            ).fit(margin)
    found.unpersist()
    sample.unpersist()
    return model


def _margins(trees, rows: DataFrame) -> DataFrame:
    found = trees.transform(rows).withColumn("margin", vector_to_array("probability")[1])
    return found.drop("rawPrediction", "probability", "prediction")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row; null is an empty text. One scan, no shuffle."""
    rows = with_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model.learned)
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(model.rate))
    else:
        scored = _margins(model.trees, rows)
        if model.calibration is None:
            scored = scored.withColumn("score", F.col("margin"))
        else:
            scored = model.calibration.transform(scored)
            # Isotonic steps tie many rows; a hundredth of the trees' own margin keeps their order, so a score is within 0.01 of its
            # calibrated value.
            scored = scored.withColumn("score", 0.99 * F.col("calibrated") + 0.01 * F.col("margin"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"),
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
