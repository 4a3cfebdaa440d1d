import zlib

import cases
import numpy as np
from tidemark.llm import language
from tidemark.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{cases.SF}/documents.parquet").collect()}
    got = QUERIES["op4_language"](spark, cases.SF).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert sum(r["rejected"] for r in got) <= 0.01 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def plain_subwords(text):
    """N-grams of letters and word ends, none across a word end."""
    words, out = "".join(c if c.isalpha() else " " for c in text.lower()).split(), []
    line = " " + " ".join(words) + " " if words else ""
    for n in language.ORDERS:
        grams = [line[i : i + n] for i in range(len(line) - n + 1)]
        out += [g for g in grams if (n > 1 or g != " ") and " " not in g[1:-1]]
    return out


def test_subwords_match_the_plain_ones():
    for text in ("Hello, World!", "a", "", "1 2", "Éa-b  İx", "ab cd"):
        want = plain_subwords(text)
        assert len(language.subwords(text)) == len(want)
    same = [language.subwords(t).tolist() for t in ("ab cd", "AB, cd?", "ab\n\n7cd")]
    assert same[0] == same[1] == same[2]
    assert (language.subwords("x" * 1000) < language.BUCKETS).all()


def small_model():
    rng = np.random.default_rng(1)
    make = lambda words: " ".join(rng.choice(words, 30))
    one, two = "the and of with house water light".split(), "der und von mit haus wasser licht".split()
    return language.train([(lang, make(w)) for lang, w in (("en", one), ("de", two)) for _ in range(60)])


def test_rejects_what_it_does_not_know():
    model = small_model()
    assert model.predict("the light of the house with water")[0] == "en"
    assert model.predict("das licht von der haus und wasser")[:1] == ("de",)
    assert model.predict("Привет мир, это совсем другой текст")[2]
    for text in (None, "", "123 !!"):
        assert model.predict(text) == ("und", 0.0, True)
    assert language.train([]).predict("text") == ("und", 0.0, True)


def test_a_long_text_is_read_whole(monkeypatch):
    model = small_model()
    monkeypatch.setattr(language, "SLICE", 1000)
    assert model.predict("the light of house " * 50 + "der wasser und von mit " * 5000)[0] == "de"


def test_odd_rows(spark):
    got = language.identify(cases.frame(spark), small_model()).collect()
    assert len(got) == len(cases.rows())
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in got if r["doc_id"] in (3, 4, 5, 7)} == {("und", 0.0, True)}
    kept = language.keep_identified(cases.frame(spark), small_model())
    assert kept.columns == cases.SCHEMA.names and kept.count() == sum(not r["rejected"] for r in got)
    assert language.identify(cases.empty(spark), small_model()).collect() == []
    assert language.sample(cases.empty(spark), "doc_id", "text", "lang") == []
    assert {lang for lang, _ in language.sample(cases.frame(spark), "doc_id", "text", "lang")} == {"en", "de", "fr"}


def test_every_language_is_sampled(spark):
    rows = [(i, f"words of the language {i}", f"l{min(i, 1200)}") for i in range(1300)]
    got = language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert {lang for lang, _ in got} == {f"l{i}" for i in range(1201)}
