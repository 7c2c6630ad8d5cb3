import re

from pyspark.sql import functions as F

from adperf.functions import text as tx

SAMPLES = [
    "Hello. World!", "know thyself", "éAB cd", "AB é", "smile 😀 now", "ALL CAPS", "tab\tnew\nline  end ", " ",
    "Get yours: 50% off? $9!", "find out and get started", "Ⅷ Roman", "٣ digits", "aABCb _AB_ AB", "x y z",
    "real estate PORTFOLIO", "Trusted leader", "plain", "...", "1\x1c2",
]


def expected(t):
    low = t.lower()
    words = {f"mention_{w}": w in low for w in tx.MENTION_WORDS}
    cta = next((n for n, ws in tx.CTA_WORDS if any(w in low for w in ws)), "other")
    return {
        "word_count": len(t.split()),
        "char_count": len(t),
        "sentence_count": len(re.split(r"[.!?]+", t)),
        "has_numbers": bool(re.search(r"\d", t)),
        "has_percent": "%" in t,
        "has_dollar": "$" in t,
        "has_question": "?" in t,
        "has_exclamation": "!" in t,
        "has_emoji": any(ord(c) > 127 for c in t),
        "uppercase_ratio": sum(c.isupper() for c in t) / len(t),
        "has_all_caps_word": bool(re.search(r"\b[A-Z]{2,}\b", t)),
        **words,
        "mention_real_estate": any(w in low for w in tx.REAL_ESTATE_WORDS),
        "mention_data": any(w in low for w in tx.DATA_WORDS),
        "mention_professional": any(w in low for w in tx.PROFESSIONAL_WORDS),
        "cta_type": cta,
        "has_urgency": any(w in low for w in tx.URGENCY_WORDS),
        "has_social_proof": any(w in low for w in tx.SOCIAL_PROOF_WORDS),
    }


def test_features_against_plain_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    for row in tx.add_text_features(df, "t").collect():
        got = row.asDict()
        t = got.pop("t")
        assert got == expected(t), t


def test_documents_against_plain_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    for row in tx.add_text_features(df, "text").collect():
        got = row.asDict()
        t = got.pop("text")
        assert got == expected(t), t[:80]


def test_no_features_without_text(spark):
    df = spark.createDataFrame([(None,), ("",)], "t string")
    for row in tx.add_text_features(df, "t").collect():
        assert all(row[n] is None for n in tx.FEATURE_NAMES)


def test_basic_features_of_empty_text(spark):
    rows = tx.add_basic_features(spark.createDataFrame([("",), ("My data",), (None,)], "t string"), "t").collect()
    assert (rows[0].word_count, rows[0].char_count, rows[0].uppercase_ratio, rows[0].has_numbers) == (0, 0, 0.0, False)
    assert rows[1].mention_data and rows[1].word_count == 2 and rows[2].word_count is None


def test_combined_text(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), (None, None)], "h string, d string")
    assert [r[0] for r in df.select(tx.combined_text("h", "d")).collect()] == ["a b", " b", " "]


def test_parse_copy(spark):
    item = '[{"headline": "H", "description": "D", "cta": "C", "angle": "A"}]'
    rows = [
        (1, f"text\n```json\n{item}\n```\nmore"), (2, f"```\n{item}\n```"), (3, item), (4, "not json"),
        (5, '[{"headline": "' + "x" * 71 + '", "description": "' + "y" * 150 + '"}]'), (6, None), (7, "```json\nopen"),
    ]
    out = tx.parse_copy(spark.createDataFrame(rows, "id int, r string"), "r").orderBy("id").collect()
    assert [r.id for r in out] == [1, 2, 3, 5]
    assert [r.headline_fits for r in out] == [True, True, True, False]
    assert out[3].description_fits and out[3].cta is None


def test_money_and_thousands(spark):
    row = spark.range(1).select(tx.money(F.lit(2.675)), tx.thousands(F.lit(1234567))).first()
    assert list(row) == ["2.68", "1,234,567"]
