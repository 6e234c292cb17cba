"""Rejection: text of languages never learned and noise go, clean documents stay."""

import numpy as np
import pytest

from earshot.llm import langid

FOREIGN = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
}


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit_languages(docs)
    return docs, model, lambda rows: langid.predict_languages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()


def test_unlearned_languages_are_rejected(judged):
    _, _, judge = judged
    got = judge(list(enumerate(FOREIGN.values())))
    assert all(r.rejected for r in got), [(name, r.lang_pred, r.score) for name, r in zip(FOREIGN, got)]


def test_random_letters_are_rejected(judged):
    _, _, judge = judged
    draw = np.random.default_rng(12)
    word = lambda: "".join(chr(97 + i) for i in draw.integers(0, 26, draw.integers(2, 9)))
    got = judge([(i, " ".join(word() for _ in range(30))) for i in range(200)])
    assert sum(r.rejected for r in got) >= 190


def test_documents_of_learned_languages_stay(judged):
    docs, model, _ = judged
    got = langid.predict_languages(docs.withColumn("out", langid.held_out()), model, ("lang", "out")).collect()
    lettered = [r for r in got if r.lang_pred != "und" and r.lang is not None]
    assert sum(r.rejected for r in lettered) <= 0.005 * len(lettered)
    assert np.mean([r.lang == r.lang_pred for r in lettered if r.out]) > 0.97


def test_calibration_is_inside_its_grid(judged):
    _, model, _ = judged
    assert 0.01 < model.temperature < 10 and 0 < model.threshold < 1


@pytest.mark.parametrize("seed", range(4))
def test_strange_text_keeps_the_shape_of_words(seed):
    text = "Über den Wolken, 12 naïve  cafés! \U0001f600"
    got = langid.strange(text, seed)
    assert len(got) == len(text.lower()) and [c.isalpha() for c in got] == [c.isalpha() for c in text.lower()]
    assert langid.strange("", seed) == "" and langid.strange("12", seed) == "12"
