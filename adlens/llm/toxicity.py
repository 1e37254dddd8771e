"""Toxicity scores: gradient-boosted trees over dense text features, with
isotonic calibration.

Features of a text: hits of a learned lexicon (count, density, weight),
hits near a second-person word, second-person density, capitals, upper-case
words, exclamation and question marks and runs of them, lexicon hits that only
show after undoing letter substitutions and separators, words with symbols
among letters, and length.

The lexicon (words and word beginnings, by log-odds in toxic against other
labelled texts), the
trees and the calibration are fitted on a bounded sample of the labelled rows;
the calibration uses rows that the trees have not seen. Scores are computed
for every row, trees and calibration in Spark ML.

Defined cases: a null text counts as empty and is scored like one; labels
that are null or have no text teach nothing; with only one class among the
training rows every score is that class's (0 without any); repeated rows are
scored alike. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import pin, spread
from .langid import LETTER, WORD_PATTERN
from .spans import BYTE_CODE, STEP, PrefixHash, codes_of, lookup, mix, small_batches, steps, text_buffer, words

SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine euch euer tu toi ton tes vous votre "
                 "tú tus usted ustedes").split()
# Letter substitutions undone, and separators removed, before the second look-up.
PLAIN = np.arange(256, dtype=np.uint8)
for _from, _to in zip("013457@$!|", "oieastasii"):
    PLAIN[ord(_from)] = ord(_to)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[ord(c) for c in "*._-~'`^"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
ASCII_LETTER = UPPER.copy()
ASCII_LETTER[97:123] = True
DIGIT_OR_SYMBOL = np.zeros(256, bool)
DIGIT_OR_SYMBOL[[ord(c) for c in "0123456789@$*#|"]] = True
NEAR = 4
# Characters of the word beginnings that the lexicon may hold beside words.
BEGINNINGS = (4, 5, 6)
N_FEATURES = 14


class Lexicon:
    """Learned words and word beginnings (marked by a final ``*``)."""

    def __init__(self, terms: list[str], weights: list[float]):
        self.tables = []  # byte length of a word's beginning (0: whole words), sorted hashes, weights
        by_size: dict[int, list] = {}
        for term, weight in zip(terms, weights):
            text = term.rstrip("*")
            by_size.setdefault(len(text.encode()) if term.endswith("*") else 0, []).append((text, weight))
        for size, entries in sorted(by_size.items()):
            keys = codes_of([t for t, _ in entries])
            order = np.argsort(keys)
            self.tables.append((size, keys[order], np.array([w for _, w in entries], np.float64)[order]))
        self.person = np.sort(codes_of(SECOND_PERSON))

    def hits(self, data, off):
        """Row, word index and weight of each word found (whole words before
        beginnings), then the hashes of all words and each row's first word."""
        starts, ends, rows = words(data, off, LETTER)
        hashes = PrefixHash(BYTE_CODE[data])
        code = lambda s, e: mix(hashes.span(s, e) + (e - s).astype(np.uint64))
        codes = code(starts, ends)
        weight = np.zeros(len(starts))
        for size, keys, weights in self.tables:
            if size:
                open_ = np.flatnonzero((ends - starts > size) & (weight == 0))
                at = lookup(keys, code(starts[open_], starts[open_] + size))
            else:
                open_, at = np.arange(len(starts)), lookup(keys, codes)
            weight[open_[at >= 0]] = weights[at[at >= 0]]
        found = np.flatnonzero(weight)
        return np.searchsorted(rows, found, side="right") - 1, found, weight[found], codes, rows

    def features(self, column) -> np.ndarray:
        """One row of ``N_FEATURES`` numbers per text."""
        raw, off = text_buffer(column)
        low, low_off = text_buffer(pc.utf8_lower(column))
        out = np.zeros((len(off) - 1, N_FEATURES))
        for a, b in steps(off, STEP):
            out[a:b] = self._part(raw[off[a]:off[b]], off[a:b + 1] - off[a],
                                  low[low_off[a]:low_off[b]], low_off[a:b + 1] - low_off[a])
        return out

    def _part(self, raw, off, low, low_off):
        n = len(off) - 1
        per_row = lambda rows, weights=None: np.bincount(rows, weights=weights, minlength=n).astype(np.float64)
        row, word, weights, codes, rows = self.hits(low, low_off)
        n_words = np.maximum(np.diff(rows).astype(np.float64), 1)
        n_bytes = np.maximum(np.diff(off).astype(np.float64), 1)
        count, weight = per_row(row), per_row(row, weights)
        top = np.zeros(n)
        np.maximum.at(top, row, weights)
        person = np.flatnonzero(lookup(self.person, codes) >= 0)
        person_row = np.searchsorted(rows, person, side="right") - 1
        near = np.zeros(len(word), bool)
        if len(person):
            at = np.searchsorted(person, word)
            for side in (np.maximum(at - 1, 0), np.minimum(at, len(person) - 1)):
                near |= (np.abs(person[side] - word) <= NEAR) & (person_row[side] == row)
        # the same words with substitutions undone and separators removed
        plain = PLAIN[low]
        stays = ~SEPARATOR[plain]
        left = np.concatenate([[0], np.cumsum(stays)])
        hidden = per_row(self.hits(plain[stays], left[low_off])[0])
        # capitals and punctuation of the original text
        doc_of = lambda where: np.searchsorted(off, np.flatnonzero(where), side="right") - 1
        upper = per_row(doc_of(UPPER[raw]))
        letters = np.maximum(per_row(doc_of(ASCII_LETTER[raw])), 1)
        starts, ends, raw_rows = words(raw, off)
        inside = lambda table: (lambda c: c[ends] - c[starts])(np.concatenate([[0], np.cumsum(table[raw])]))
        token_row = np.repeat(np.arange(n), np.diff(raw_rows))
        uppers, symbols, alphas = inside(UPPER), inside(DIGIT_OR_SYMBOL), inside(ASCII_LETTER)
        shouted = per_row(token_row, (uppers >= 3) & (uppers == ends - starts))
        mixed = per_row(token_row, (symbols > 0) & (alphas >= 2))
        mark, query = raw == 33, raw == 63
        run = np.zeros(len(raw), bool)
        if len(raw):
            run[1:] = (mark | query)[1:] & (mark | query)[:-1]
        return np.stack([
            np.log1p(count), count / n_words * 100, weight / n_words, top,
            np.log1p(per_row(row, near)), per_row(person_row) / n_words,
            upper / letters, shouted / n_words, per_row(doc_of(mark)) / n_bytes * 100,
            per_row(doc_of(query)) / n_bytes * 100, per_row(doc_of(run)) / n_bytes * 100,
            np.log1p(np.maximum(hidden - count, 0)), mixed / n_words, np.log1p(n_words)], axis=1)


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, trees, calibration, constant: float):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant


def _with_features(rows: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    def run(parts):
        for part in small_batches(parts):
            table = lexicon.features(part.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), flat], [*keep, "features"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return spread(rows.select(*keep, "text")).mapInArrow(run, f"{kinds}, features array<double>")


def fit(labelled: DataFrame, max_rows: int = 12_000, max_terms: int = 300,
        min_contexts: int = 4, min_share: float = 0.03) -> ToxicityModel:
    """Learn from rows with ``doc_id``, ``text`` and ``toxic`` (0 or 1).

    ``max_rows`` is the expected size of the sample, chosen by a hash of
    doc_id; ``max_terms`` bounds the lexicon. Words are counted by distinct
    following word, so that many copies of one toxic text count once; a word
    needs ``min_contexts`` of these, and ``min_share`` of the toxic rows.
    """
    rows = labelled.select("doc_id", "text", F.col("toxic").cast("double").alias("label")).where(
        "text is not null and label is not null")
    by_class = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = by_class.get(1.0, 0), by_class.get(0.0, 0)
    if not bad or not good:
        return ToxicityModel(Lexicon([], []), None, None, 1.0 if bad else 0.0)
    dice = lambda salt: F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(salt)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = pin(rows.where(dice("sample") < F.lit(min(1.0, max_rows / (bad + good)))))
    token = F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0))
    pairs = sample.select("label", token.alias("t")).select("label", F.explode(F.array_distinct(F.zip_with(
        "t", F.concat(F.slice("t", 2, F.size("t")), F.array(F.lit(""))),
        lambda x, y: F.struct(x.alias("token"), y.alias("after"))))).alias("pair"))
    word = F.col("pair.token")
    forms = F.concat(F.array(word), F.transform(
        F.filter(F.array(*map(F.lit, BEGINNINGS)), lambda k: k < F.char_length(word)),
        lambda k: F.concat(F.substr(word, F.lit(1), k), F.lit("*"))))
    pairs = pairs.select("label", F.explode(forms).alias("token"), F.col("pair.after").alias("after"))
    contexts = pairs.groupBy("token", "after").agg(F.max("label").alias("bad"), F.max(1 - F.col("label")).alias("good"))
    seen = contexts.groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    sums = sample.agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")).first()
    all_bad, all_good = sums["bad"] or 0.0, sums["good"] or 0.0
    odds = F.log((F.col("bad") + 0.5) / F.lit(all_bad + 1)) - F.log((F.col("good") + 0.5) / F.lit(all_good + 1))
    terms = (seen.where(F.col("bad") >= max(min_contexts, min_share * all_bad)).select("token", odds.alias("weight"))
             .where("weight > 2.5").orderBy(F.desc("weight"), "token").limit(max_terms).collect())
    lexicon = Lexicon([r["token"] for r in terms], [r["weight"] for r in terms])
    points = pin(_with_features(sample, lexicon, ["doc_id", "label"]).withColumn("features", array_to_vector("features")))
    fit_on, tune_on = points.where(dice("tune") >= 0.3), points.where(dice("tune") < 0.3)
    trees = GBTClassifier(maxIter=16, maxDepth=3, stepSize=0.3, seed=7).fit(fit_on.select("features", "label"))
    tuned = trees.transform(tune_on.select("features", "label")).select("label", vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="score").fit(tuned)
    return ToxicityModel(lexicon, trees, calibration, 0.0)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row of ``docs``."""
    if model.trees is None:
        return docs.select("doc_id", F.lit(model.constant).alias("score"))
    points = _with_features(docs, model.lexicon, ["doc_id"]).withColumn("features", array_to_vector("features"))
    probable = model.trees.transform(points).select("doc_id", vector_to_array("probability")[1].alias("p"))
    return model.calibration.transform(probable).select(
        "doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))
