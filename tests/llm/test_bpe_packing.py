"""BPE and packing against the tokenizers library."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe, packing

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SF001 = "/root/testdata/sf0.001"


def fuzz():
    rnd = random.Random(1)
    out = ["".join(rnd.choices("ab \n\t'sétrdlm1<|>😀\u0301\x1c\x85\u3000Σ", k=rnd.randint(0, 60))) for _ in range(1500)]
    out += ["".join(rnd.choices(["in", "er", "th", "e", "he", " ", "s", "re", "ed", "ing", "aaaa"], k=rnd.randint(0, 60))) for _ in range(1500)]
    return out + ["ΣΑΣ Σ İI", "e\u0301 E\u0301x A\u030a", "a \n \n b", "  a  \n\n b \t c<|endoftext|>x  ", "don't we'll 'S x's"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("cache", [500_000, 300])
def test_ids_equal_the_library(odd_texts, name, cache, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", cache)      # a small cache forgets between batches
    path = public_tokenizers.path(name)
    own, ref = bpe.Bpe(path), Tokenizer.from_file(path)
    texts = [t or "" for t in odd_texts] + fuzz()
    for i in range(0, len(texts), 100):
        part = texts[i:i + 100]
        for t, got, want in zip(part, own.encode(part), ref.encode_batch(part, add_special_tokens=False), strict=True):
            assert got.tolist() == want.ids, t[:80]


def test_round_trip_and_decoding(spark, odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ref = Tokenizer.from_file(path)
    df = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    got = {r.doc_id: r for r in bpe.round_trip(df, path).collect()}
    enc = bpe.encode(df, path)
    dec = {r.doc_id: r.text for r in bpe.decode(enc, path).collect()}
    for k, t in enumerate(odd_texts):
        ids = ref.encode(t or "", add_special_tokens=False).ids
        assert got[k].n_tokens == len(ids) and dec[k] == (t or "")
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), path).count() == 0


def test_whole_table(spark):
    ref = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in bpe.op10_bpe(spark, SF001).collect()}
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        ids = ref.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def check_pieces(rows, docs, tokens):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in docs:
        ids, at = [*tokens.encode(text or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.ROOM
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(r.length for r in rows) / (packing.ROOM * max(1, len(by_sequence)))


def test_packing_whole_table(spark):
    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert check_pieces(packing.op1_packing(spark, SF001).collect(), docs, tokens) > 0.9


def test_packing_odd_texts(spark, odd_texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = list(enumerate(odd_texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("part", F.lit(0)).withColumn("rank", F.lit(0)).repartition(4)
    cut = packing.materialize(packing.pieces(df, path, 2).withColumns({c: F.lit("x") for c in ("base", "offset", "sequence_id", "row", "n")}))
    check_pieces(packing.pack(cut).collect(), docs, Tokenizer.from_file(path))
    empty = packing.materialize(packing.pieces(df.limit(0), path, 2))
    assert packing.pack(empty).count() == 0


def test_patterns_hold_every_length_once():
    rnd = random.Random(3)
    for counts in ({5: 1}, {64: 10**9, 1: 7}, {rnd.randint(1, 64): rnd.randint(1, 10**6) for _ in range(40)}):
        patterns = packing.shortest_pack_first(counts, 64)
        held = defaultdict(int)
        for often, pattern in patterns:
            assert sum(a * b for a, b in pattern.items()) <= 64 and often > 0
            for length, times in pattern.items():
                held[length] += often * times
        assert held == counts and len(patterns) <= 2 * len(counts)
        for length, n in counts.items():
            t = packing.intervals(patterns)
            own = t[t[:, 0] == length]
            assert own[0, 1] == 0 and (np.diff(own[:, 1]) > 0).all() and own[-1, 1] < n
