"""Repeated passages against the definition."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import passages as p
from tessera.session import materialize


def compare(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {bytes(r.tk): (r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in p.repeated_passages(df, length).collect()}
    for text, (size, removed, spans, digest) in zip(texts, p.brute_force(texts, length), strict=True):
        data = (text or "").encode()
        found = got.get(hashlib.md5(data).digest(), (0, 0, hashlib.sha256(data).hexdigest()))
        assert found == (removed, spans, digest), (length, text)


def mixed(seed, n):
    rnd = random.Random(seed)
    parts = ["abcdefgh", "é" * 7, "xyz" * 9, "common passage that many documents share ", "q"]
    return ["".join(rnd.choice([rnd.choice(parts), str(rnd.randint(0, 999)), "z" * rnd.randint(1, 70),
                                " ".join(rnd.choices(["aa", "bb", "ccc", "ddddd"], k=9))]) for _ in range(rnd.randint(0, 9)))
            for _ in range(n)]


@pytest.mark.parametrize("length", [1, 5, 20, 41, 100])
def test_matches_definition(spark, odd_texts, length):
    small = [t for t in odd_texts if t is None or len(t) < 4000]
    compare(spark, mixed(length, 60) + small + small[:3], length)


def test_hot_anchor_is_split(spark, monkeypatch):
    """One passage in most texts, each with its own surroundings, beyond the size of a group."""
    monkeypatch.setattr(p, "HOT", 10)
    monkeypatch.setattr(p, "BATCH", 2000)
    rnd = random.Random(5)
    shared = "".join(rnd.choices("abcdefgh ", k=300))
    texts = ["".join(rnd.choices("ijklm ", k=rnd.randint(0, 50))) + shared[rnd.randint(0, 40):rnd.randint(200, 300)]
             + "".join(rnd.choices("nopq ", k=rnd.randint(0, 50))) for _ in range(80)]
    seen, plain = [], p.sorted_groups

    def spy(*given):
        seen.append([materialize(d) for d in plain(*given)])
        return seen[-1]

    monkeypatch.setattr(p, "sorted_groups", spy)
    compare(spark, texts, 60)
    calm, crowded = seen[0]
    assert calm.groupBy("grp").count().agg({"count": "max"}).first()[0] <= p.HOT     # what one task sorts at most
    assert crowded.groupBy("grp").count().agg({"count": "min"}).first()[0] > p.HOT


def test_segments_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(p, "SEGMENT", 500)
    rnd = random.Random(6)
    long = "".join(rnd.choices("ab ", k=3000))
    compare(spark, [long, long[700:1900], "c" * 900, long[::-1]], 50)


def test_query_on_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in p.op8_suffix_array_dedup(spark, "/root/testdata/sf0.001").collect()}
    want = p.brute_force([r.text for r in rows], 400)
    assert got == {r.doc_id: w for r, w in zip(rows, want, strict=True)}


def test_empty_and_nulls(spark):
    df = spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")
    assert p.repeated_passages(df).count() == 0 and p.repeated_passages(df.limit(0)).count() == 0


def test_columns_of_prefixes():
    """Neighbours' common prefixes come out as if suffixes were compared one by one."""
    rnd = random.Random(8)
    data = [bytes(rnd.choices(b"ab", k=rnd.randint(12, 40))) for _ in range(40)]
    lead = np.array([rnd.randint(0, 8) for _ in data])
    group = np.sort(np.array([rnd.randint(0, 4) for _ in data]))
    got = p.repeated_windows(group, lead, data, 10)
    for i, d in enumerate(data):
        for s in range(len(d) - 9):
            want = any(group[j] == group[i] and j != i and 0 <= s - lead[i] + lead[j] <= len(e) - 10
                       and e[s - lead[i] + lead[j]:][:10] == d[s:s + 10] for j, e in enumerate(data))
            assert got[i][s] == want


def test_two_lengths_from_one_sort(spark, odd_texts):
    """The longer length as by itself, and the text left for the shorter one."""
    small = [t for t in odd_texts if t is None or len(t) < 4000]
    texts = mixed(3, 60) + small + small[:3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check_lengths(p.passages_of_lengths(df, [20, 41]), texts, 20, 41)


def check_lengths(lost, texts, short, long):
    got = {bytes(r.tk): r for r in lost.collect()}
    for text, want, removed in zip(texts, p.brute_force(texts, long), removed_bytes(texts, short), strict=True):
        data = (text or "").encode()
        r = got.get(hashlib.md5(data).digest())
        kept = data if r is None or r.kept is None else bytes(r.kept)
        assert (r.n_removed if r else 0, r.n_spans if r else 0, hashlib.sha256(kept).hexdigest()) == want[1:], text
        assert (r.shortest if r else text or "") == removed, text


def removed_bytes(texts, length):
    """Texts without bytes that a repeated string of ``length`` covers."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[s:s + length] for d in data for s in range(len(d) - length + 1))
    for d in data:
        gone = {i for s in range(len(d) - length + 1) if seen[d[s:s + length]] > 1 for i in range(s, s + length)}
        yield bytes(c for i, c in enumerate(d) if i not in gone).decode("utf-8", "ignore")


def test_two_lengths_in_crowded_groups(spark, monkeypatch):
    monkeypatch.setattr(p, "HOT", 10)
    monkeypatch.setattr(p, "BATCH", 2000)
    rnd = random.Random(9)
    shared = "".join(rnd.choices("abcdefgh ", k=300))
    texts = ["".join(rnd.choices("ijklm ", k=rnd.randint(0, 50))) + shared[rnd.randint(0, 40):rnd.randint(100, 300)]
             + "".join(rnd.choices("nopq ", k=rnd.randint(0, 50))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check_lengths(p.passages_of_lengths(df, [60, 130]), texts, 60, 130)


def test_passages_of_fifty_words_go_from_text(spark, tmp_path):
    """60 words, under 400 bytes, in two documents: the contract's columns keep them, the text column does not."""
    rnd = random.Random(10)
    words = lambda n: " ".join("".join(rnd.choices("abcdefghij", k=4)) for _ in range(n))
    planted = words(60)
    assert len(planted) < 400
    texts = [words(80) + " " + planted + " " + words(70), words(90) + " " + planted + " " + words(75), words(200), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in p.op8_suffix_array_dedup(spark, str(tmp_path)).collect()}
    assert [got[i].n_removed for i in range(4)] == [0, 0, 0, 0]
    assert [got[i].kept_text for i in range(4)] == [t or "" for t in texts]
    assert [got[i].text for i in range(4)] == [texts[0].replace(f" {planted} ", ""), texts[1].replace(f" {planted} ", ""), texts[2], ""]
