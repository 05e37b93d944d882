import random

import pytest
from conftest import write_tables

from lakefold.llm import token_counts
from lakefold.llm.bpe import vocab_path
from lakefold.llm.token_counts import TokenCounter, op12_token_counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocab_path(token_counts.VOCAB))


@pytest.fixture(scope="module")
def mine():
    return TokenCounter(vocab_path(token_counts.VOCAB))


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_proven_strings_are_one_token_in_the_library(mine, library):
    proven = sorted(mine.whole)
    assert len(proven) > 40_000 and set(expected(library, proven)) == {1}
    byte_of = {c: chr(b) for b, c in enumerate(token_counts.byte_symbols())}
    rest = [t for t in ("".join(byte_of[c] for c in t) for t in mine.vocab if t not in mine.special) if t.isascii() and t not in mine.whole]
    assert all(n > 1 for n in expected(library, rest))


def test_counts_equal_the_library(mine, library):
    rng = random.Random(5)
    odd = [chr(c) for c in [*range(0x250), *range(0x1F600, 0x1F640), *range(0x4E00, 0x4E60), 0x2028, 0x3000, 0x558, 0xCDC, 0x1C5, 0x200B, 0xFEFF]]
    more = [" ", "\n", "  ", "'s", "'", "a", "the", "12", "<|endoftext|>", "<|endof", "\r\n", "\t"]
    texts = ["".join(rng.choice(odd if rng.random() < .6 else more) for _ in range(rng.randint(0, 90))) for _ in range(3000)]
    texts += ["", " ", "a" * 120_000, "漢字" * 20_000, " " * 50_000, "<|endoftext|>" * 3, " <|endoftext|> \n\n x", "ab" * 40_000 + "՘"]
    assert mine.counts(texts) == expected(library, texts)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_CHARS", 5)
    c = TokenCounter(vocab_path(token_counts.VOCAB))
    texts = ["unusualwordings here", "and morewordings", "unusualwordings"]
    assert [c.counts([t])[0] for t in texts + texts] == expected(library, texts) * 2


def test_query_on_edge_documents(spark, edge_sf, edge_rows, library):
    got = sorted(map(tuple, op12_token_counts(spark, edge_sf).collect()), key=repr)
    texts = [r[1] or "" for r in edge_rows]
    want = [(r[0], len(t.encode()), n, n > 1024) for r, t, n in zip(edge_rows, texts, expected(library, texts))]
    assert got == sorted(want, key=repr)


def test_query_on_whole_table(spark, small_sf, library):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], expected(library, [r.text or "" for r in docs])))
    assert {r.doc_id: r.n_tokens for r in op12_token_counts(spark, small_sf).collect()} == want


def test_empty_table_and_extra_columns(spark, empty_sf, tmp_path):
    assert op12_token_counts(spark, empty_sf).count() == 0
    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, `odd name` string")
    out = token_counts.token_counts(docs, limit=1)
    assert out.columns == ["doc_id", "odd name", "n_bytes", "n_tokens", "over_limit"]
    assert tuple(out.first()) == (1, "x", 3, 2, True)
