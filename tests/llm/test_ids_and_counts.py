import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fieldlake.llm import queries, range_coder, token_counts

IDS, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "  ", "a", "a  b", "a \n b", "\ta\n", "x <|endoftext|> y<|startoftext|>", "É é É ́x Ñandú", "it's we'LL 12 ٣ ½",
       "a\x1cb\x1d\0c", "😀 x​y", "Σίσυφος ΟΔΟΣ İI", "word " * 9000, "the the the"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50_256), min_size=1, max_size=300), min_size=1, max_size=5))
def test_blocks_come_back(blocks):
    arrays = [np.array(b) for b in blocks]
    assert all((a == b).all() for a, b in zip(arrays, range_coder.decode(range_coder.encode(arrays)), strict=True))


def test_blocks_of_all_shapes_come_back():
    rng = np.random.default_rng(1)
    arrays = [np.array([7]), np.full(8192, 3), np.arange(8192), rng.integers(0, 50_257, 8192), rng.zipf(1.5, 5000) % 50_257, np.tile([1, 2, 3], 900)]
    coded = range_coder.encode(arrays)
    assert all((a == b).all() for a, b in zip(arrays, range_coder.decode(coded), strict=True))
    assert len(coded[1]) < 300 and len(coded[5]) < 300  # context predictions pay
    assert range_coder.decode([coded[3]])[0].tolist() == arrays[3].tolist()  # a block stands alone


def test_a_damaged_block_is_an_error():
    block = bytearray(range_coder.encode([np.arange(500)])[0])
    block[-20] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode([bytes(block)])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_ids_and_counts_equal_the_library(text):
    of, by = range_coder.encoder(IDS), token_counts.counter(WORDS)
    assert of.texts([text], 2)[0].tolist() == [*of.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert by.text(text) == len(by.tokenizer.encode(text, add_special_tokens=False).ids)


def test_proven_words_are_one_token():
    by = token_counts.counter(WORDS)
    some = sorted(by.single)[::97]
    assert len(by.single) > 30_000 and all(len(by.tokenizer.model.tokenize(s)) == 1 for s in some)


def test_written_ids(spark, docs_of, tmp_path):
    docs = docs_of([(len(ODD) - i, t) for i, t in enumerate(ODD)] + [(3, "a"), (None, "null id")]).withColumn("part", F.lit(1)).withColumn("start", F.lit(2))
    range_coder.write(docs, f"{tmp_path}/ids", IDS)
    got = sorted(range_coder.read(spark, f"{tmp_path}/ids").collect(), key=lambda r: r.start)
    of, at = range_coder.encoder(IDS).tokenizer, 0
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda i: -1 if i is None else i)
    texts = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    found = []
    for r in got:
        ids = np.array(r.ids, "<u4")
        assert r.start == at and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids) and ids[-1] == 2
        at += len(ids)
        found.append((str(r.doc_id), ids[:-1].tolist()))
    assert sorted(found) == sorted((i, of.encode(t, add_special_tokens=False).ids) for i, t in texts)
    assert [r[:4] for r in sorted(range_coder.digests(spark, f"{tmp_path}/ids").collect(), key=lambda r: r.start)] == [r[:4] for r in got]


def test_empty_table(spark, docs_of, tmp_path):
    range_coder.write(docs_of([]), f"{tmp_path}/ids", IDS)
    assert range_coder.digests(spark, f"{tmp_path}/ids").count() == 0
    assert token_counts.count(docs_of([]), WORDS).count() == 0


def test_counts(docs_of):
    got = token_counts.count(docs_of(ODD).withColumn("n_tokens", F.lit(1)), WORDS).collect()
    by = token_counts.counter(WORDS).tokenizer
    for r in got:
        text = ODD[r.doc_id] or ""
        n = len(by.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


def test_queries_against_the_library(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    by, of, at = token_counts.counter(WORDS).tokenizer, range_coder.encoder(IDS).tokenizer, 0
    for r in queries.op2_token_counts(spark, small).collect():
        assert r.n_tokens == len(by.encode(docs[r.doc_id], add_special_tokens=False).ids)
    for r in sorted(queries.op1_range_coded_ids(spark, small).collect()):
        ids = np.array([*of.encode(docs[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)


def test_pieces_of_letters_special_strings_and_rests_are_as_the_tokenizer_gives_them():
    path = public_tokenizers.path("byte_bpe_50k.json")
    of = range_coder.Encoder(path)
    special = [t.content for t in of.tokenizer.get_added_tokens_decoder().values()]
    texts = ["word Word's don't x1y2 été naïve ÀÖ", " lead  two spaces ", "a\u0000b c", "tab\there new\nline", "", " ", "über-alles, so. (it) 12,5 it's'll", "日本 語 mixed日本",
             *special, *[f"a {s} b{s}c" for s in special], "ª º µ ²", "I'm I've 'Sx 'sx x'sy"]
    for text, ids in zip(texts, of.texts(texts, 2), strict=True):
        assert list(ids) == [*of.tokenizer.encode(text, add_special_tokens=False).ids, 2], text


def test_long_blocks_need_few_steps_and_stand_alone(monkeypatch):
    steps, step = [], range_coder._Models.step
    monkeypatch.setattr(range_coder._Models, "step", lambda self, t, n: (steps.append(n), step(self, t, n))[1])
    rng = np.random.default_rng(2)
    arrays = [rng.zipf(1.3, n) % 50_257 for n in [8192] * 20 + [1, 255, 256, 511, 512, 513, 8191, 4097]]
    coded = range_coder.encode(arrays)
    assert len(steps) <= 512  # one for each of 8,192 ids before
    assert all((a == b).all() for a, b in zip(arrays, range_coder.decode(coded), strict=True))
    assert [range_coder.encode([a])[0] for a in arrays] == coded
    assert all((range_coder.decode([c])[0] == a).all() for c, a in zip(coded, arrays, strict=True))


def test_words_are_merged_once_whatever_stands_around_them():
    of, seen = range_coder.Encoder(IDS), []
    merge, of.merge = of.merge, lambda s: (seen.append(s), merge(s))[1]
    texts = ["the cat.\nthe dog, the cat's", "the dog.\nthe cat\n\nthe  dog's. the cat", "the cat, the dog. the"]
    for text, ids in zip(texts, of.texts(texts, 2), strict=True):
        assert list(ids) == [*of.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert len(seen) == len(set(seen))


def test_a_small_cache_of_words_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(range_coder.Encoder, "KEPT", 20)
    of, rng = range_coder.Encoder(IDS), np.random.default_rng(3)
    signs = [*"aZé×÷ß'' ''strevmld  \n\t09.,ª\x1c\x85\xa0  日\0\x7f", "'s", "'re", "'ll", "'ve", "<|endoftext|>", "  ", "\n\n", "\r\n"]
    for most in (20, 30, len(signs)) * 100:
        texts = ["".join(rng.choice(signs[:most], rng.integers(0, 14))) for _ in range(8)]
        for text, ids in zip(texts, of.texts(texts, 2), strict=True):
            assert list(ids) == [*of.tokenizer.encode(text, add_special_tokens=False).ids, 2], text
