import hashlib
import random

import numpy as np
import public_tokenizers
from conftest import multiset
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lakefold.llm import bpe
from lakefold.llm.queries import QUERIES

op2 = QUERIES["op2_bpe"]
LIB = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    out = LIB.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(out.encode()).hexdigest()


def test_whole_table(spark, small_sf):
    source = spark.read.parquet(f"{small_sf}/documents.parquet").collect()
    got = op2(spark, small_sf).collect()
    assert multiset(map(tuple, got)) == multiset((r.doc_id, *expected(r.text)) for r in source)


def test_edges(spark, edge_sf, edge_rows):
    got = op2(spark, edge_sf).collect()
    assert multiset(map(tuple, got)) == multiset((r[0], *expected(r[1])) for r in edge_rows)


def test_empty(spark, empty_sf):
    assert op2(spark, empty_sf).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abehtAEΣσs'!. \n\t1½é漢한́\x1c\x85<|>"), st.characters(exclude_categories=["Cs"])),
                        max_size=40), max_size=5))
def test_any_text_as_the_library(texts):
    ids, at = bpe.codec(bpe.VOCAB).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [LIB.encode(t, add_special_tokens=False).ids for t in texts]


def test_merge_rounds_against_one_word_at_a_time():
    table = bpe.MergeTable({c: i for i, c in enumerate(["a", "b", "aa", "ab", "aab", "aaaa", "ba"])},
                           [["a", "a"], ["aa", "b"], ["a", "b"], ["aa", "aa"], ["b", "a"]])
    order = {(0, 0): 2, (2, 1): 4, (0, 1): 3, (2, 2): 5, (1, 0): 6}
    rank = {p: i for i, p in enumerate(order)}

    def slow(word):
        while True:
            pairs = [p for p in zip(word, word[1:]) if p in rank]
            if not pairs:
                return word
            best, out, i = min(pairs, key=rank.get), [], 0
            while i < len(word):
                hit = tuple(word[i:i + 2]) == best
                out.append(order[best] if hit else word[i])
                i += 1 + hit
            word = out

    rng = random.Random(0)
    words = [[rng.randint(0, 1) for _ in range(rng.randint(1, 30))] for _ in range(300)]
    flat, count = table.merge(np.array([x for w in words for x in w], np.int64), np.array([len(w) for w in words]))
    ends = np.cumsum(count)
    assert [flat[e - c:e].tolist() for e, c in zip(ends, count)] == [slow(w) for w in words]


def test_encode_then_decode_frames(spark, edge_sf):
    docs = spark.read.parquet(f"{edge_sf}/documents.parquet").select("doc_id", "text", "lang")
    ids = bpe.encode(docs)
    assert dict(ids.dtypes) == {"doc_id": "bigint", "lang": "string", "ids": "array<int>"}
    back = {r.doc_id: r.text for r in bpe.decode(ids.filter("doc_id is not null")).collect()}
    for r in docs.filter("doc_id is not null and doc_id <> 24").collect():
        assert back[r.doc_id] == LIB.decode(LIB.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False)
