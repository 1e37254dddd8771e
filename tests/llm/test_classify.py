"""Language ID, toxicity and decontamination."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents
from pyspark.sql import functions as F

from adlens.llm import decontaminate, langid, toxicity

SYLLABLES = {"aa": "ba be bi bo bu la le".split(), "bb": "ka ke ki zé zè ô ka".split(), "cc": "str schl ung ät ön ix".split()}


def word(rng, lang):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))


def text(rng, lang, n):
    return " ".join(word(rng, lang) for _ in range(n)).capitalize()


# --- language ID --------------------------------------------------------

def test_language_id(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.randint(3, 60)), lang if i % 3 else None, "s")
            for i, lang in enumerate(rng.choices(list(SYLLABLES), k=300))]
    truth = {i: lang for (i, _, _, _), lang in zip(rows, random.Random(1).choices(list(SYLLABLES), k=300))}
    odd = [(900, None, "aa", None), (901, "", None, None), (902, "12 !? 3", "bb", None), (903, "Zékè ôké", None, None), (904, "ba" * 60000, None, None)]
    docs = documents(spark, rows + odd, extra=True)
    model = langid.fit(docs.where("doc_id % 2 = 0 or doc_id >= 900"))
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert len(got) == len(rows) + len(odd)
    known = {i: lang for i, lang in truth.items()}
    right = sum(got[i]["lang_pred"] == lang for i, lang in known.items() if i % 2)
    assert right >= 0.95 * sum(i % 2 for i in known)
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (900, 901, 902))
    assert got[903]["lang_pred"] == "bb" and got[904]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    stay = langid.keep_identified(docs, model)
    assert stay.columns == docs.columns
    ids = {r["doc_id"] for r in stay.select("doc_id").collect()}
    assert not ids & {900, 901, 902} and len(ids) >= 295


def test_unseen_words_back_off_to_shorter_grams():
    keys, logs = langid.codes_of(["abc"]), np.array([[-1.0, -9.0]])
    grams = ["zz", "z"]
    order = np.argsort(langid.codes_of(grams))
    model = langid.LanguageModel(["x", "y"], keys, logs, langid.codes_of(grams)[order],
                                 np.array([[-8.0, -2.0], [-4.0, -3.0]])[order], -10.0)
    best, score = model.predict(pa.array(["abc", "zzq", "ABC abc", None]))
    assert best.tolist() == [0, 1, 0, -1] and score[3] == 0
    # zzq: zz, then z, then nothing known
    data = np.frombuffer(b"zzq", np.uint8)
    from adlens.llm.spans import BYTE_CODE, PrefixHash
    got = model.score_words(data, np.array([0]), np.array([3]), langid.codes_of(["zzq"]), PrefixHash(BYTE_CODE[data]))
    assert got[0].tolist() == pytest.approx([(-8 - 4 - 10) / 3, (-2 - 3 - 10) / 3])


def test_language_id_without_training_rows(spark):
    docs = documents(spark, [(1, "ba be", None, None), (2, None, None, None)])
    model = langid.fit(docs)
    assert [r["lang_pred"] for r in langid.identify(docs, model).collect()] == ["und", "und"]
    assert langid.keep_identified(docs, model).count() == 2
    assert langid.identify(documents(spark, []), model).count() == 0


# --- toxicity -----------------------------------------------------------

def test_toxicity(spark):
    rng = random.Random(3)
    bad = ["grubok", "plonk", "zwerf"]
    rows, toxic = [], {}
    for i in range(500):
        words = [word(rng, "aa") for _ in range(rng.randint(5, 80))]
        toxic[i] = int(rng.random() < 0.3)
        if toxic[i]:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "", "en", "!"]))
        rows.append((i, " ".join(words), None, None))
    odd = [(900, None, None, None), (901, "", None, None), (902, "you pl0nk, you gr.u.b.o.k! plonk", None, None), (903, "ba be bi", None, None)]
    docs = documents(spark, rows + odd, extra=True)
    labels = spark.createDataFrame([(i, t) for i, t in toxic.items() if i % 3] + [(901, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text").join(labels, "doc_id"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())
    held = [i for i in toxic if i % 3 == 0]
    assert sum((got[i] >= 0.7) == bool(toxic[i]) for i in held) >= 0.97 * len(held)
    assert got[902] >= 0.7 and max(got[900], got[901], got[903]) < 0.3


def test_features_see_disguise_and_address():
    lexicon = toxicity.Lexicon(["plonk", "zwer*"], [3.0, 2.0])
    plain, hidden, near, none = lexicon.features(pa.array(["a plonk here zwerfen", "a pl0nk here z.w.e.r.f", "you plonk", "PLAIN TEXT!!"]))
    assert plain[0] == pytest.approx(np.log1p(2)) and plain[3] == 3.0
    assert hidden[0] == 0 and hidden[11] == pytest.approx(np.log1p(2))
    assert near[4] > 0 and plain[4] == 0
    assert none[7] == 1.0 - 1.0 + none[7] and none[6] == 1.0 and none[10] > 0


def test_toxicity_of_one_class(spark):
    docs = documents(spark, [(1, "a b", None, None)])
    for rows, want in (([(1, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.0)):
        labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
        model = toxicity.fit(docs.select("doc_id", "text").join(labels, "doc_id"))
        assert [r["score"] for r in toxicity.score(docs, model).collect()] == [want]


# --- decontamination ----------------------------------------------------

def least_edits(item, words):
    """Fewest word edits between the item and any stretch of the text."""
    row = [0] * (len(words) + 1)
    for n, x in enumerate(item, 1):
        new = [n]
        for k, y in enumerate(words, 1):
            new.append(min(row[k - 1] + (x != y), row[k] + 1, new[-1] + 1))
        row = new
    return min(row)


def split(t):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())


def test_decontamination_against_all_pairs(spark):
    rng = random.Random(4)
    vocabulary = [word(rng, "aa") for _ in range(60)] + [word(rng, "cc") for _ in range(60)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [make(n) for n in (1, 3, 4, 6, 9, 14, 17, 25, 40, 59)]
    rows = []
    for i in range(150):
        w = make(rng.randint(0, 60))
        if rng.random() < 0.6:
            x = list(rng.choice(items[3:]))
            for _ in range(rng.randint(0, len(x) // 5)):
                p = rng.randrange(len(x))
                x[p:p + 1] = rng.choice([[], ["new"], [x[p], "new"]])
            w += x + make(rng.randint(0, 30))
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(w).capitalize(), None, None))
    rows += [(900, None, None, None), (901, "", None, None), (902, " ".join(make(30000) + items[8]), None, None)]
    table = spark.createDataFrame([(j, " ".join(x).upper()) for j, x in enumerate(items)] + [(77, None), (78, " !"), (None, "a b")],
                                  "item_id bigint, text string")
    docs = documents(spark, rows, extra=True)
    got = {r["doc_id"]: set(r["item_ids"]) for r in decontaminate.contaminated_items(docs, table).collect()}
    missed = extra = total = 0
    for i, t, *_ in rows[:-1]:
        want = {j for j, x in enumerate(items) if least_edits(x, split(t)) <= int(0.2 * len(x))}
        total += len(want)
        missed += len(want - got[i])
        extra += len(got[i] - want)
    assert extra == 0 and missed <= 0.02 * total and total > 100
    assert 8 in got[902]
    clean = decontaminate.drop_contaminated(docs, table)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == {i for i, x in got.items() if not x}
    rounds = {r["doc_id"]: set(r["item_ids"]) for r in decontaminate.contaminated_items(docs, table, round_items=3).collect()}
    assert sum(len(rounds[i] ^ got[i]) for i in got) <= 0.02 * total


def test_no_benchmark(spark):
    docs = documents(spark, [(1, "a b", None, None), (1, "a b", None, None)])
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [r["item_ids"] for r in decontaminate.contaminated_items(docs, none).collect()] == [[], []]
    assert decontaminate.drop_contaminated(docs, none).count() == 2
    some = spark.createDataFrame([(5, "a b")], "item_id bigint, text string")
    assert decontaminate.contaminated_items(documents(spark, []), some).count() == 0
