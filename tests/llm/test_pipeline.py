"""The pipeline's stages, each against its operator's own decisions on the stage's input."""

import collections

import public_tokenizers

import corpus_pipeline
from adperf.llm import langid, mixing, odd_sketch, packing, toxicity
from adperf.llm.common import read, stored
from tests.llm.test_near import expected_components, shingle_set

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language_id", "near_dedup", "source_mix", "packing"]
    docs = read(spark, SMALL, "documents")
    inputs, outputs = [], []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = stored(stage(spark, docs, SMALL), f"test-{name}")
        outputs.append(docs)
        if name != "packing":
            assert docs.columns == inputs[0].columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    labels = read(spark, SMALL, "labels")
    assert ids(outputs[0]) == ids(toxicity.score_toxicity(inputs[0], labels).filter("predicted = 0"))
    assert ids(outputs[1]) == ids(langid.identify_language(inputs[1]).filter("NOT rejected"))
    _, component = expected_components([(r.doc_id, r.text) for r in inputs[2].collect()], corpus_pipeline.SHARED)
    assert ids(outputs[2]) == sorted(set(component.values()))
    assert ids(outputs[3]) == ids(mixing.mix(inputs[3], mixing.WEIGHTS))
    own = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    tokens = collections.Counter()
    for r in inputs[4].collect():
        tokens[r.doc_id] += len(own.encode(r.text or "")) // 4 + 1
    packed = collections.Counter()
    for r in outputs[4].collect():
        packed[r.doc_id] += r.length
    assert packed == tokens


def test_near_copies_from_four_fifths_on_go(spark):
    words = lambda i: [f"d{i}w{k}" for k in range(200)]
    rows = []
    for i in range(30):
        copy = words(i)
        # Each edit takes five of 196 shingles: similarity 0.815 for four edits, 0.774 for five.
        for k in range(4 if i < 20 else 5):
            copy[20 + 40 * k if k < 4 else 195 - 5] = f"edit{i}-{k}"
        rows += [(2 * i, " ".join(words(i))), (2 * i + 1, " ".join(copy))]
    sets = {i: shingle_set(t) for i, t in rows}
    shared = [len(sets[2 * i] & sets[2 * i + 1]) / len(sets[2 * i] | sets[2 * i + 1]) for i in range(30)]
    assert all(0.80 <= s < 0.85 for s in shared[:20]) and all(s < 0.80 for s in shared[20:])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()}
    assert kept == {2 * i for i in range(30)} | {2 * i + 1 for i in range(20, 30)}


def test_bands_follow_the_similarity():
    for percent in (70, 80, 85, 95):
        assert (1 - (percent / 100) ** odd_sketch.ROWS) ** odd_sketch.band_count(percent) < 1e-6
    assert odd_sketch.band_count() == odd_sketch.BANDS


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SMALL).columns == packing.pack(read(spark, SMALL, "documents"), public_tokenizers.path("word_bpe_49k.json")).columns
