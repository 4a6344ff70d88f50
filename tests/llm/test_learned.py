"""Language identification and toxicity: what is learned, and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskstream.llm import language, toxicity
from riskstream.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def table(spark, name, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def test_language_of_held_out_documents(spark):
    found = QUERIES["op1_language_id"](spark, SF_DIR)
    docs = table(spark, "documents").withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)
    joined = found.join(docs, "doc_id")
    assert found.count() == docs.count() == joined.where("fold = held_out").count()
    row = joined.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert row[0] > 0.99 and 0 <= row[1] <= row[2] <= 1


TRAINING = [("the cat sat on the mat", "en"), ("die katze sitzt auf der matte", "de"), ("the dog and the cat", "en"), ("der hund und die katze", "de")] * 3


def test_words_first_then_grams(spark, documents):
    model = language.fit(documents([(i, t, lang) for i, (t, lang) in enumerate(TRAINING)] + [(90, None, "en"), (91, "x", None)]))
    scorer = language.Scorer(model)
    assert scorer.languages == ("de", "en")
    known = scorer.scores[scorer.known["katze"]]
    assert known[0] > known[1], "a known word goes by its own frequency"
    assert "katzen" not in scorer.known
    found = [s for g in language.grams("katzen", 4) if (s := scorer.grams.get((4, g))) is not None]
    assert np.allclose(scorer.back_off("katzen"), np.mean(found, axis=0)), "an unseen one by its longest known n-grams"
    assert (4, "q") not in scorer.grams and np.allclose(scorer.back_off("qqqq"), scorer.prior), "one without any by the shares"
    assert scorer.score("KATZEN UND HUNDE")[0] == "de"


def test_language_of_awkward_texts(spark, documents):
    model = language.fit(documents([(i, t, lang) for i, (t, lang) in enumerate(TRAINING)]))
    texts = ["", None, "123 !!! ²", "the", "日本語", "the cat " * 300_000, "die Katze", "die Katze", "qqq", "a1b"]
    docs = documents(texts, ("score", "hash", "held_out"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model, ["doc_id"]).collect()}
    assert [found[i] for i in range(3)] == [("und", 0.0)] * 3
    assert found[3][0] == found[5][0] == "en" and found[6] == found[7] and found[6][0] == "de"
    assert found[4][0] == found[8][0] in ("de", "en") and all(0 <= s <= 1 for _, s in found.values())
    nothing = language.fit(documents([(1, "a", None)]))
    assert [r.lang_pred for r in language.predict(docs, nothing, ["doc_id"]).collect()] == ["und"] * 10
    assert language.predict(docs.limit(0), model, ["doc_id"]).count() == 0


def test_long_and_short_texts_score_alike(spark, documents, monkeypatch):
    model = language.fit(documents([(i, t, lang) for i, (t, lang) in enumerate(TRAINING)]))
    text = "the katze sat unknownword " * 50
    whole = language.Scorer(model).score(text)
    monkeypatch.setattr(language, "REMEMBERED", 1)
    scorer = language.Scorer(model)
    scorer.score("other words fill what is kept")
    assert scorer.score(text + "zzz yyy")[0] == whole[0]
    assert np.isclose(scorer.score(text)[1], whole[1])


def test_sample_bounds_the_fit(spark, documents):
    docs = documents([(i, f"w{i} the", "en") for i in range(50)] + [(i, f"v{i} der", "de") for i in range(50, 100)] + [(7, "same text", "en")] * 40)
    model = language.fit(docs, sample=20)
    words = {item for kind, item in model.items if kind == 0}
    assert model.languages == ("de", "en") and words == {"the", "der", "w", "v"}, "ten texts of each language, copies once"
    assert np.allclose(model.prior, np.log(0.5))


def test_toxicity_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = QUERIES["op2_toxicity"](spark, sf_dir)
    assert found.count() == table(spark, "documents", sf_dir).count()
    labels = table(spark, "labels", sf_dir).where("toxic IS NOT NULL").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85, n
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.97, n
    assert found.where("predicted <> int(score >= 0.3) OR score < 0 OR score > 1").isEmpty()


def labelled(spark, documents):
    texts, labels = [], []
    for n in range(400):
        bad = n % 4 == 0
        texts.append(f"some words number {n} about " + (("you idiot " if n % 8 else "frobble frobbler ") if bad else "") + f"x{n}")
        labels.append((n, int(bad)))
    return documents(texts), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_what_toxicity_learns(spark, documents):
    docs, labels = labelled(spark, documents)
    model = toxicity.fit(docs, labels)
    scorer = toxicity.Scorer(model)
    assert scorer.score("you IDIOT") > 0.5 and scorer.score("frobbles frobblest") > 0.3, "patterns hold for words not seen"
    assert scorer.score("some words about it") < 0.3
    texts = ["", None, "idiot", "idiot " * 200_000, "clean", "clean"]
    found = {r.doc_id: r.score for r in toxicity.score(documents(texts, ("score", "key", "toxic")), model, ["doc_id"]).collect()}
    assert found[0] == found[1] < 0.3 and found[4] == found[5] < 0.3 < found[2]
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


@pytest.mark.parametrize("where", ["toxic = 0", "toxic = 1", "toxic > 5"])
def test_without_both_kinds_of_labels(spark, documents, where):
    docs, labels = labelled(spark, documents)
    model = toxicity.fit(docs, labels.where(where))
    assert {r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()} == {0.0}


def test_labels_that_repeat_or_are_null(spark, documents):
    docs, labels = labelled(spark, documents)
    noise = spark.createDataFrame([(0, 0), (0, 1), (None, 1), (5, None), (99_999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.unionByName(noise))
    assert toxicity.Scorer(model).score("you idiot") > 0.5


def test_label_model_finds_accuracies_and_copies():
    chance = np.random.default_rng(2)
    truth = chance.random(4000) < 0.2
    good = [(truth & (chance.random(4000) < 0.6)) | (chance.random(4000) < 0.005) for _ in range(4)]
    votes = np.column_stack([*good, good[0], good[0]])
    true, false, correlations, p = toxicity.label_model(votes, 0.2)
    assert np.allclose(true[:4], 0.6, atol=0.08) and (false[:4] < 0.05).all()
    assert correlations[0, 4] > 0.9 and correlations[0, 1] == 0
    seen = votes.any(axis=1)
    assert ((p > 0.5) == truth)[seen].mean() > 0.9 and p[~seen].max() < 0.3
