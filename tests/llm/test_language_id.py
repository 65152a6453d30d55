import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import language_id
from strata.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op7_language_id"](spark, sf_small).join(docs, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == docs.count() and 0.1 < len(held) / len(got) < 0.4
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_prediction_uses_the_text_alone(small_docs):
    usable = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))
    model = language_id.train(small_docs, usable)
    plain = language_id.identify(small_docs, model).select("doc_id", "lang_pred", "score").collect()
    other = small_docs.select(F.col("doc_id"), "text", F.lit("xx").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit("y").alias("lang_pred"))
    assert sorted(plain) == sorted(language_id.identify(other, model).select("doc_id", "lang_pred", "score").collect())


def test_edge_cases(documents):
    rows = [(1, "the cat and the dog of the house " * 3, "en"), (3, "der Hund und die Katze in dem Haus " * 3, "de"), (4, "le chat et le chien de la maison " * 3, "fr"),
            (5, None, "en"), (6, "", "fr"), (7, "123 456 !!", None), (None, "the cat and the dog", "en"), (8, "漢字かな", None), (8, "漢字かな", None), (9, "the house and the dog " * 20_000, None)]
    df = documents(*rows)
    model = language_id.train(df, F.lit(True))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(df, model).collect()}
    assert got[1][0] == "en" and got[3][0] == "de" and got[4][0] == "fr" and got[9][0] == "en"
    assert got[5] == got[6] == got[7] == ("und", 0.0) and got[8][0] in ("en", "de", "fr")
    assert language_id.identify(df, model).count() == len(rows)
    assert language_id.identify(df.limit(0), model).count() == 0


def test_no_labelled_rows_predict_und(documents):
    df = documents((1, "some text"), (2, "more"))
    model = language_id.train(df, F.lit(True))
    assert [r["lang_pred"] for r in language_id.identify(df, model).collect()] == ["und", "und"]


def test_families():
    assert language_id.family("de") == language_id.family("en") == "germanic"
    assert language_id.family("pt-BR") == "romance" and language_id.family("xx") == "xx"


def scalar(model, text):
    """(language, score) of one text with plain loops over its bytes and the model's weights."""
    code = [b | 0x20 if chr(b).isascii() and chr(b).isalpha() else b if b >= 0x80 else 0x20 for b in text.encode()]
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    count, word = {}, 0xFFFFFFFF
    for a, b, c in zip(code, code[1:], code[2:]):
        if (a, b, c) != (32, 32, 32):
            g = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & word
            g = ((g ^ g >> 15) * 0x2C1B3C6D & word) >> 20
            count[g] = count.get(g, 0) + 1
    size = math.sqrt(sum(count.values()))
    squash = lambda w: 1 / (1 + math.exp(-3 * max(-10, min(10, sum(math.sqrt(n) / size * float(w[g]) for g, n in count.items()) + float(w[-1])))))
    p = [squash(w) for w in model.family_weight]
    best = p.index(max(p))
    codes = model.languages[model.families[best]]
    if len(codes) == 1:
        return codes[0], max(p) / sum(p)
    vote, pairs = dict.fromkeys(codes, 0.0), iter(model.pair_weight[model.families[best]])
    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            q = squash(next(pairs))
            vote[a] += q
            vote[b] += 1 - q
    winner = max(codes, key=vote.get)
    return winner, max(p) / sum(p) * vote[winner] / (len(codes) - 1)


def test_predictions_equal_a_scalar_version(small_docs):
    usable = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))
    model = language_id.train(small_docs, usable)
    texts = {r["doc_id"]: r["text"] for r in small_docs.where("doc_id % 4 = 0").collect()}
    for r in language_id.identify(small_docs.where("doc_id % 4 = 0"), model).collect():
        lang, score = scalar(model, texts[r["doc_id"]] or "")
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-4)


def test_equal_votes_go_to_the_first_code_in_order():
    """A text without any learned trigram: the machines' biases decide, equal ones for the first."""
    model = language_id.LanguageModel(["germanic"], None, {"germanic": ["de", "en", "nl"]}, {"germanic": np.zeros((3, language_id.DIMS + 1), np.float32)})
    lang, score = language_id.predict(model, np.zeros((2, language_id.DIMS), np.float32))
    assert list(lang) == ["de", "de"] and score == pytest.approx([0.5, 0.5])
