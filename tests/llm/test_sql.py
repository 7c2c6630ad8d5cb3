"""Operators that SQL can express, and the rules of urls, turns and mixing."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from adperf.llm import chat, mixing, queries, urls
from tests.compare import difference, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), duck(SMALL), queries.ORACLE[name]) is None


def test_url_rules_and_terms(spark):
    cases = {
        "http://WWW.Example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://example.com?x": ("example.com", "", None, "allow"),
        "http://b.net/es/": ("b.net", "/es/", "net/es/", "block"),
        "http://xnet/es/": ("xnet", "/es/", None, "allow"),
        "http://a.org/PORN/": ("a.org", "/PORN/", None, "block"),
        "http://a.org/unpornly/": ("a.org", "/unpornly/", None, "allow"),
        "http://a.org/sex/sex": ("a.org", "/sex/sex", None, "allow"),
        "http://a.org/sex-adult": ("a.org", "/sex-adult", None, "block"),
        "no scheme/xxx": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, url, "x") for i, url in enumerate(cases)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    found = urls.judge_urls(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == cases[rows[r.page_id][1]]
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_parts_are_flattened_in_order():
    content = (
        '[{"type": "text", "text": "see [1] "}, {"type": "image", "url": "u", "width": 57, "height": 28}, "!", '
        '{"type": "audio", "ref": "r", "seconds": 1.02}, {"type": "document", "pages": 2}, {"type": "image", "tokens": 5}, {"type": "odd"}]'
    )
    text, loss, attachments, tokens = chat.format_turn("user", content, typed=True)
    assert text == '[INST]see \\[1] <image:0>!<audio:1><document:2><image:3>{"type": "odd"}[/INST]' and loss == []
    assert [(a["position"], a["kind"], a["ref"], a["tokens"]) for a in attachments] == [
        (0, "image", "u", 3), (1, "audio", "r", 26), (2, "document", None, 2048), (3, "image", None, 5)]
    assert tokens == 3 + 26 + 2048 + 5
    assert chat.format_turn("user", "[broken", typed=True)[0] == "[INST]\\[broken[/INST]"


@pytest.mark.parametrize("part", [
    '{"type": "image", "width": "wide"}', '{"type": "audio", "seconds": NaN}', '{"type": "audio", "seconds": Infinity}',
    '{"type": "document", "pages": -1}', '{"type": "image", "tokens": "x"}', '{"type": "image", "tokens": 1e300}',
    '{"type": "image", "ref": 5}', '{"type": "image", "width": true}', '{"type": "text", "text": [1]}', '{"type": [], "a": 1}', "null", "7",
])
def test_malformed_parts_are_text(part):
    formatted, _, attachments, tokens = chat.format_turn("user", f'[{part}, {{"type": "image", "ref": "u"}}]', typed=True)
    assert [(a["position"], a["ref"]) for a in attachments] == [(0, "u")] and tokens == 1
    role, text = chat.parse_turn(formatted)
    whole = json.dumps(json.loads(part), sort_keys=True)
    assert role == "user" and text.startswith(whole) and text.endswith("<image:0>")


def test_hostile_json_stays_in_the_table(spark):
    texts = ["[" * 100_000, '[{"type": "text", "text": "a\\ud800b"}, {"type": "image", "url": "\\udc00"}]', '[{"type": "image", "width": 9e15, "height": 9e15}]', "[]"]
    turns = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    found = [r.formatted for r in chat.format_conversations(turns, typed=True).orderBy("turn").collect()]
    assert chat.parse_turn(found[0]) == ("user", texts[0])
    assert found[1] == "[INST]a\ufffdb<image:0>[/INST]" and found[3] == "[INST][/INST]"


@pytest.mark.parametrize("role", ["system", "user", "assistant", "tool", "", "a[SEP]b"])
@pytest.mark.parametrize("text", ["", "plain", chat.CONTROL, "\\", "\\\\[", "[/TURN][SEP]</s", "é🙂\n" * 50])
def test_turns_come_back(role, text):
    formatted, loss, _, _ = chat.format_turn(role, text)
    assert chat.parse_turn(formatted) == (role, text)
    assert [chat.unescape(formatted[s["start"] : s["start"] + s["length"]]) for s in loss] == ([text] if role == "assistant" else [])


def test_odd_conversations(spark):
    rows = [(1, 1, "assistant", None), (1, None, None, "x"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 0, "user", "y")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    found = {r.conv_id: r for r in chat.digest(chat.format_conversations(turns)).collect()}
    assert found[1].n_turns == 4 and found[1].loss_chars == 2 and found[None].n_turns == 1
    whole = "\nx\nassistant\n\nassistant\nb\nassistant\nb\n"
    assert found[1].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert found[1].loss_sha256 == hashlib.sha256(b"bb").hexdigest()
    assert chat.digest(chat.format_conversations(turns.limit(0))).count() == 0


def test_mixing_reaches_the_target(spark, odd):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 15000, "hot").when(F.col("id") < 19990, "b").otherwise("rare").alias("source"))
    found = {r.source: r for r in mixing.mix(docs, {"hot": 1.0}, default=1.0).groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("doc_id", "mix_part", "mix_copy").alias("d")).collect()}
    for name in ("hot", "b", "rare"):  # a third each; the rare source's documents come several hundred times
        assert abs(found[name].n - 20000 / 3) < 500 and found[name].n == found[name].d
    assert mixing.mix(odd, {"src1": 0.0}).filter("source = 'src1'").count() == 0
    assert set(odd.columns) <= set(mixing.mix(odd, {}).columns) and mixing.mix(odd, {}).filter("source IS NULL").count() >= 0
    assert mixing.mix(odd.limit(0), {}).count() == 0


def test_mixing_of_clashing_names(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 3).cast("string").alias("source"))
    once = mixing.mix(docs, {"1": 3.0})
    names = ("__mix_u", "__mix_source", "__MIX_cdf", "__kept_4", "parts", "rate", "weight", "a.b")
    odd = once.withColumns({n: F.col("doc_id") for n in names})
    found = mixing.mix(odd, {"1": 3.0})
    assert set(found.columns) == set(odd.columns) and found.count() > 0
    assert found.filter(" OR ".join(f"`{n}` <> doc_id" for n in names)).count() == 0
    again = lambda docs: sorted(r.mix_key for r in mixing.mix(docs, {"1": 3.0}).collect())
    assert again(docs.withColumn("MIX_RATE", F.lit("x"))) == again(docs)


def test_mixing_with_a_large_source_table(spark, monkeypatch):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 7).cast("string").alias("source"))
    keys = lambda: sorted(r.mix_key for r in mixing.mix(docs, {"1": 5.0}).collect())
    small = keys()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert keys() == small
