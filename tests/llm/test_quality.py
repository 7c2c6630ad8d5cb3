"""Quality rules against a plain version; the queries are checked with SQL in test_sql.py."""

import collections

from adperf.llm import quality, queries
from tests.compare import difference, duck


def plain(text):
    text = text or ""
    blank = " \t\n\x0b\x0c\r"
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(blank)]
    count = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {i + k for i in range(len(words) - 7) if count[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return (
        len(words), sum(c not in blank for c in text), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), len(lines),
        sum(line.lstrip(blank).startswith(("-", "*", "•")) for line in lines), sum(line.rstrip(blank).endswith(("...", "…")) for line in lines),
        sum(c in "0123456789" for c in text),
    )


TEXTS = [
    None, "", " \n\t", "a b c d e f g h", "a b c d e f g h " * 2, "x " + "a b c d e f g h i " * 3 + "y", "- a\n - a\n* b\n•c\n\n", "so...\nso…  \nno.. \n",
    "é 日本 #*$%&|<> 12", "one\x0btwo\x0cthree\rfour", "w " * 50, "   x", " ".join(str(i) for i in range(500)),
]


def test_measures(spark, small, odd):
    for text in TEXTS + [r.text for r in odd.collect()] + [r.text for r in small("documents").collect()]:
        assert quality.measures((text or "").encode()) == plain(text), text


def test_rules_and_policies(spark, odd):
    rows = quality.judge(quality.ledger(odd.withColumnRenamed("score", "failed")))
    found = rows.collect()
    assert len(found) == odd.count()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words) for r in found) == sorted((r.doc_id is None, r.doc_id or 0, plain(r.text)[0]) for r in odd.collect())
    for r in found:
        base = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == base == bool(r.failed & quality.mask(quality.BASE))
        assert r.kept == (r.failed == 0)
        assert r.sole == (r.failed if bin(r.failed).count("1") == 1 else 0)
    first = quality.judge(quality.ledger(odd), version=1).collect()
    assert all(r.kept == (not r.base_failed) for r in first)
    assert quality.ledger(odd.limit(0)).count() == 0


def test_ablations_equal_their_definition(spark, small):
    ledger = quality.ledger(small("documents"))
    bits = [r.failed for r in ledger.collect()]
    found = {(r.version, r.rule): r for r in quality.ablations(ledger).collect()}
    assert set(found) == {(v, rule) for v, rules in quality.POLICIES.items() for rule in rules}
    for (version, rule), r in found.items():
        policy, bit = quality.mask(quality.POLICIES[version]), quality.mask([rule])
        hit = [b & policy for b in bits if b & bit]
        assert (r.documents, r.kept, r.n_failed) == (len(bits), sum(not b & policy for b in bits), len(hit))
        assert r.kept_without == sum(not b & (policy & ~bit) for b in bits)
        every, some = policy if hit else 0, 0
        for b in hit:
            every, some = every & b, some | b
        assert (r.with_any, r.with_all) == (some, every)
    assert quality.ablations(ledger.limit(0)).count() == 0


def test_clean_documents_stay(spark, small):
    good = small("labels").filter("quality = 1").select("doc_id")
    judged = queries.QUERIES["op13_quality_rules"](spark, "/root/testdata/sf0.001").join(good, "doc_id")
    assert judged.filter("NOT kept AND NOT base_failed").count() == 0


def test_odd_texts_equal_sql(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(3, "a")], "doc_id long, text string")
    con = duck("/root/testdata/sf0.001")
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    assert difference(quality.judge(quality.ledger(docs)), con, quality.SQL) is None
