"""Token counts and packing against the tokenizer libraries."""

import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest

from adperf.llm.packing import CAPACITY, WordTokenizer, difference, pack, windows
from adperf.llm.tokens import MergeCounter, count_tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
STRANGE = ["", "  a  b ", "a　b\n\n x", "<s></s>[INST] don't", "ﬁ é é 日本語 🙂", "▁▁x", "a.b,c;;d", "x" * 500, "a b" * 300, "²³a²", "the<0x0A>",
           "It's we'll <|endoftext|> x İstanbul ÀÉ", "''s 'T'S", "a_b __ c"]


def strange():
    rnd = random.Random(3)
    return STRANGE + ["".join(rnd.choice("ab é.,'\n▁ 日Zя²1-_sSİªǄ") for _ in range(rnd.randint(0, 60))) for _ in range(500)]


@pytest.fixture(scope="module")
def sentencepiece_model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_merge_counts_equal_the_library(sentencepiece_model):
    own = MergeCounter(PIECES, cache=50)
    for text in strange():
        assert own.count(text) == len(sentencepiece_model.encode(text)), text


def test_counts_of_a_table(small, odd, sentencepiece_model):
    for docs in (small("documents"), odd):
        texts = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), len(sentencepiece_model.encode(r.text or ""))) for r in docs.collect())
        found = count_tokens(docs, PIECES).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in found) == texts
        assert all(r.over_limit == (r.n_tokens > 4096) for r in found)
    assert count_tokens(odd.limit(0), PIECES).count() == 0


def test_word_ids_of_every_plain_character():
    own = WordTokenizer(WORDS, cache=50)
    letters = [chr(c) for c in range(0x180, 0x260)]
    admitted = [chr(c) for c in range(0x250) if WordTokenizer.PLAIN(chr(c))]
    rnd = random.Random(9)
    texts = [f"a{c}b {c} 1{c}" for c in admitted + letters] + ["".join(rnd.choices(admitted, k=30)) for _ in range(400)]
    for text in texts + ["Əsas ƁƊ haƙuri Ƙ", "aƁb"]:
        assert own.encode(text) == array("I", own.whole.encode(text, add_special_tokens=False).ids).tobytes(), text


def test_word_ids_equal_the_library():
    own = WordTokenizer(WORDS, cache=50)
    for text in strange():
        assert own.encode(text) == array("I", own.whole.encode(text, add_special_tokens=False).ids).tobytes(), text


def test_differencing():
    assert sorted(map(len, difference([8, 7, 6, 5, 4], 2))) == [2, 3]
    rnd = random.Random(5)
    for ways in (1, 2, 3, 7):
        for n in (0, 1, 5, 40):
            sizes = [rnd.randint(1, 500) for _ in range(n)]
            found = difference(sizes, ways)
            assert len(found) == ways and sorted(i for w in found for i in w) == list(range(n))
    assert sum(len(w) for w in windows([1500] * 5, 2048)) == 5 and len(windows([1500] * 5, 2048)) == 5


def test_packing_is_an_exact_cover(small, odd):
    own = WordTokenizer(WORDS)
    for docs in (small("documents"), odd):
        rows = pack(docs, WORDS, with_ids=True).collect()
        wanted = sorted((r.doc_id is None, r.doc_id or 0, own.encode(r.text or "") + b"\1\0\0\0") for r in docs.collect())
        pieces, sequences = defaultdict(list), defaultdict(list)
        for r in rows:
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and r.length > 0
            pieces[r.doc_id is None, r.doc_id or 0].append((r.start, r.length, bytes(r.ids), r.doc_tokens))
            sequences[r.sequence_id].append((r.offset, r.length))
        for places in sequences.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= CAPACITY
        for key in {w[:2] for w in wanted}:
            texts = [w[2] for w in wanted if w[:2] == key]
            assert sum(p[1] for p in pieces[key]) * 4 == sum(map(len, texts))
            if len(texts) == 1:
                assert b"".join(p[2] for p in sorted(pieces[key])) == texts[0]
                assert {p[3] for p in pieces[key]} == {len(texts[0]) // 4}
    total = sum(r.length for r in pack(small("documents"), WORDS).collect())
    used = pack(small("documents"), WORDS).select("sequence_id").distinct().count() * CAPACITY
    assert total / used > 0.9
    assert pack(odd.limit(0), WORDS).count() == 0
