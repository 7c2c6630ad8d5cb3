"""Learned operators: held-out accuracy, edge cases, and that held-out rows and labels stay out of a fit."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from adperf.llm import common, langid, queries, toxicity

MEDIUM = "/root/testdata/sf0.01"


def fold(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


def test_toxic_documents_are_found(spark):
    found = queries.op7_toxicity(spark, MEDIUM)
    assert found.count() == 1000
    rows = found.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").filter("held_out").collect()
    caught = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(caught) / len(caught) > 0.7 and sum(clean) / len(clean) < 0.05


def test_toxicity_of_odd_rows(spark, odd, small):
    found = toxicity.score_toxicity(odd, small("labels")).collect()
    assert len(found) == odd.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in found if r.doc_id is not None)
    kept = toxicity.drop_toxic(odd, small("labels"))
    assert kept.columns == odd.columns and kept.count() == sum(r.predicted == 0 for r in found)
    nothing = toxicity.score_toxicity(odd, small("labels").limit(0)).collect()
    assert {r.score for r in nothing} == {0.0}
    assert toxicity.score_toxicity(odd.limit(0), small("labels")).count() == 0


def test_rare_expressions_and_length():
    ordinary = {"^hou": 50, "hous": 50, "ouse": 50, "use$": 50, "^ho": 50, "hou": 50, "ous": 50, "use": 50, "se$": 50}
    toxic = {"^mor": 9, "moro": 9, "oron": 9, "ron$": 9, "^mo": 9, "mor": 9, "oro": 9, "ron": 9, "on$": 9}
    model = toxicity.KneserNey(toxic, ordinary)
    assert model.words["moron"] > model.words["moronic"] > 0 > model.words["house"]
    assert abs(model.words["日本"]) < 1e-9  # rare in both: the shared counts cancel
    short, long = model.evidence("moron"), model.evidence("日本 " * 5000 + "moron")
    assert abs(long - short) < 1e-9 < short and model.evidence("") == 0.0 == model.evidence("123 !")


def test_labels_of_held_out_rows_are_not_learned(spark, small):
    docs, labels = small("documents"), small("labels")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.score_toxicity(docs, x).collect())) for x in (labels, turned))
    assert [r[:2] + r[3:] for r in a] == [r[:2] + r[3:] for r in b] and max(abs(x[2] - y[2]) for x, y in zip(a, b)) < 1e-6


def test_languages_are_found(spark):
    found = queries.op8_language_id(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert found.count() == 1000 and found.filter("rejected").count() == 0


def test_language_of_odd_rows(spark, odd, small):
    docs = small("documents").select("doc_id", "text", "lang").unionByName(odd.select((F.col("doc_id") + 10**6).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang")))
    found = {r.doc_id: r for r in langid.identify_language(docs).collect()}
    for i in (3, 4, 5, 11):
        assert found[10**6 + i].lang_pred == "und" and found[10**6 + i].rejected and found[10**6 + i].score == 0
    assert all(0 <= r.score <= 1 and r.lang_pred in {"de", "en", "es", "fr", "und"} for r in found.values())
    assert found[10**6 - 2].rejected  # letters of no known language
    kept = langid.drop_unidentified(docs)
    assert kept.columns == docs.columns and kept.count() < docs.count()
    assert {r.lang_pred for r in langid.identify_language(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify_language(odd.limit(0)).count() == 0


def foreign(words):
    """Texts in languages and scripts that no test table has."""
    rnd = random.Random(3)
    word = lambda chars, least, most: "".join(rnd.choice(chars) for _ in range(rnd.randint(least, most)))
    cyrillic = [word("абвгдежзийклмнопрстуфхцчшщыэюя", 2, 9) for _ in range(800)]
    han = [word([chr(c) for c in range(0x4E00, 0x9000)], 1, 4) for _ in range(3000)]
    plain = [chr(c) for r in ((65, 91), (97, 123), (48, 58)) for c in range(*r)] + ["+", "/"]
    dutch = (
        "de het een van en in op te dat die is was voor met zijn niet aan ook als maar om door over bij uit naar wij zij hebben worden geen nog "
        "kunnen moeten gaan jaar mensen water huis straat nieuwe oude regering onderzoek volgens terwijl omdat echter waarschijnlijk gisteren "
        "vandaag morgen schrijven lezen geschiedenis wetenschap vrijheid gezondheid"
    ).split()
    texts = {name: " ".join(rnd.choice(of) for _ in range(words)) for name, of in (("cyrillic", cyrillic), ("han", han), ("dutch", dutch))}
    return texts | {"base64": " ".join(word(plain, 60, 60) for _ in range(max(1, words // 10)))}


def test_foreign_texts_are_rejected_at_any_length(spark):
    model = langid.fit(spark.read.parquet(f"{MEDIUM}/documents.parquet"))
    for words in (20, 200, 5000, 50_000):
        for name, text in foreign(words).items():
            language, score, rejected = model.nearest(text)
            # A short text in a related language is beyond what these n-grams can tell.
            assert rejected or (name, words) == ("dutch", 20), (name, words, language, score)
    assert (model.lowest[:, 1:] >= model.lowest[:, :-1]).all()


def test_lowest_cosines_do_not_follow_one_row():
    import numpy as np

    cosines, of_band = np.linspace(0.5, 0.9, 1000), np.arange(1000) % 5
    wanted = langid.lowest_cosines(cosines, of_band)
    cosines[4] = 0.01
    assert np.allclose(langid.lowest_cosines(cosines, of_band), wanted, atol=0.01) and wanted.min() > 0.17


@pytest.mark.parametrize("k", [1, 3])
def test_spherical_means(k):
    import numpy as np

    rnd = random.Random(1)
    rows = np.array([[1, rnd.random() / 10, 0] for _ in range(20)] + [[0, 1, rnd.random() / 10] for _ in range(20)], float)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres = langid.spherical_means(rows, k)
    assert len(centres) <= k and np.allclose(np.linalg.norm(centres, axis=1), 1)
    if k == 3:
        assert (rows @ centres.T).max(axis=1).min() > 0.99


def test_language_stage_gives_up_the_tables_of_the_stage_before():
    model = toxicity.Model("one", {"^ab": 1, "ab$": 1}, {"^cd": 1, "cd$": 1}, 1.0)
    model.score("ab")
    assert ("toxicity", "one") in common._held
    before = langid.frequencies("Wort für Wort")
    assert ("toxicity", "one") not in common._held
    assert all((a == b).all() for a, b in zip(before, langid.frequencies("Wort für Wort")))
