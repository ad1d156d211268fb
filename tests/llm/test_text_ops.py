"""Quality rules, language ID, line templates, licenses and URL filters."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import langid, licenses, line_dedup, quality, url_filter

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    return df


# ------------------------------------------------------------------ quality
def base_quality(text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    c, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if c[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def test_quality_base_and_shares(spark, odd_texts):
    phrase = "one two three four five six seven eight nine ten"
    rnd = random.Random(3)
    prose = " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(200))
    texts = [*odd_texts, prose, prose + " " + phrase + " x " + phrase, "### " * 80, "\n".join([prose] * 3)]
    got = {r.doc_id: r for r in quality.quality(frame(spark, texts, n_words=1, kept=2)).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_quality(t)
        assert not (r.base_failed and r.kept)
        w = (t or "").split(" ")
        if t and "\n" not in t and len(w) == r.n_words and len(w) < 1000:
            for n in quality.COVERAGE:
                c, covered = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)), set()
                for i in range(len(w) - n + 1):
                    if c[tuple(w[i:i + n])] > 1:
                        covered |= set(range(i, i + n))
                assert r[f"dup_{n}_share"] == pytest.approx(sum(len(w[i]) for i in covered) / max(1, r.word_chars))
    assert got[len(odd_texts)].kept and not got[len(texts) - 1].kept and not got[len(texts) - 2].kept
    assert quality.quality(frame(spark, texts).limit(0)).count() == 0


def test_quality_keeps_clean_documents(spark):
    rows = quality.op6_quality_rules(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id")
    assert rows.filter("quality = 1 and not kept and not base_failed").count() == 0


def test_quality_published_shares_and_short_texts(spark):
    rnd = random.Random(5)
    words = lambda n: [f"w{rnd.randint(10**6, 10**7)}" for _ in range(n)]
    again = [words(5) for _ in range(100)]
    texts = [" ".join(sum(([*a, *words(3), *a, *words(9)] for a in again), [])),                # 45 % in repeated 5-grams
             *(" ".join([*(a := words(10)), *words(n), *a, *words(n)]) for n in (25, 60, 300)),   # one 10-gram, twice
             " ".join([*(a := words(10)), *words(5), *a, *words(5), *(b := words(10)), *words(9), *b, *words(30)]),
             "\n".join([*(" ".join(words(10)) for _ in range(30)), *[" ".join(words(10))] * 15]),
             " ".join([*words(100), *["#"] * 15])]
    got = {r.doc_id: r.reason for r in quality.quality(frame(spark, texts)).collect()}
    assert not any(r.base_failed for r in quality.quality(frame(spark, texts)).collect())
    assert got[0] == "repeated 5-grams" and [got[k] for k in (1, 2, 3)] == [None] * 3
    assert got[4] and got[5] and got[6]


# --------------------------------------------------------------- language ID
def test_language_accuracy_and_contract(spark):
    got = {r.doc_id: r for r in langid.op7_language_id(spark, SF01).collect()}
    rows = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    right = [got[r.doc_id].lang_pred == r.lang for r in rows if got[r.doc_id].held_out]
    assert sum(right) / len(right) > 0.98
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(r.rejected for r in got.values()) <= 0.005 * len(rows)


def test_language_odd_texts_and_rejection(spark, odd_texts):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs)
    assert langid.train(docs.repartition(7)).langs == model.langs == ["de", "en", "es", "fr"]
    texts = [*odd_texts, "zqx jvk wqz xkq zzv qqj xwv kqz jxq vqk " * 20]
    got = {r.doc_id: r for r in langid.classify(frame(spark, texts, score="x", lang="de"), model).collect()}
    for k, t in enumerate(texts):
        letters = any(c.isalpha() for c in t or "")
        assert (got[k].lang_pred == "und") == (not letters) and (letters or (got[k].rejected and got[k].score == 0))
    assert got[len(texts) - 1].rejected
    none = langid.train(docs.limit(0))
    assert none.langs == [] and langid.classify(frame(spark, texts), none).filter("lang_pred <> 'und'").count() == 0
    assert langid.classify(frame(spark, texts).limit(0), model).count() == 0


def test_rejection_with_noisy_labels_and_unlearnt_languages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    rnd = random.Random(4)
    junk = ["".join(rnd.choice("qxzvkjw ") for _ in range(10_000)) for _ in range(4)]
    noisy = F.when(F.crc32("text") % 25 == 0, F.lit("en")).otherwise(F.col("lang"))
    known = docs.filter("lang <> 'de'").withColumn("lang", noisy).unionByName(frame(spark, junk, lang="en"))
    model = langid.train(known)
    out = langid.classify(docs.unionByName(frame(spark, [" ".join(junk[0].split())[:900]], lang="de")).filter(F.col("text").rlike(r"\p{L}")), model)
    rows = out.filter(F.length("text") >= 200).collect()
    lost = [r.rejected for r in rows if r.lang != "de"]
    gone = [r.rejected for r in rows if r.lang == "de"]
    assert sum(lost) <= 0.005 * len(lost) and sum(gone) >= 0.9 * len(gone) > 50


def test_every_label_is_learnt(spark):
    rows = [(f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 3} text{chr(97 + i % 26)}", f"l{i:03}") for i in range(230)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == sorted(x for _, x in rows)
    assert sum(len(t[-1][0]) for t in model.tables) < 230 * 20        # each label keeps its own grams alone


def test_kneser_ney_sums_to_one():
    import numpy as np
    grams = np.array([[32, 32, 32, 32, c] for c in (97, 97, 98)] + [[32, 32, 32, 97, c] for c in (98, 98, 99)], np.uint32)
    uniq, n = np.unique(grams, axis=0, return_counts=True)
    m = langid.Model(["x"], [langid._estimate(uniq, n)])
    every = np.array([[32, 32, 32, 32, c] for c in range(langid.ALPHABET)], np.uint32)
    assert np.exp(langid.Scorer(m).model.score(every)[:, 0]).sum() == pytest.approx(1, abs=1e-6)


def plain_kneser_ney(texts):
    """log p(last character | four before) from nested dictionaries, and the entropy of a text."""
    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    count = [None] * 6
    count[5] = Counter(line[i:i + 5] for t in texts for w in words(t) for line in ["    " + w + " "] for i in range(len(w) + 1))
    for n in range(4, 0, -1):
        count[n] = Counter(g[1:] for g in count[n + 1])
    discount = {}
    for n in range(1, 6):
        ones, twos = (sum(c == k for c in count[n].values()) for k in (1, 2))
        discount[n] = ones / (ones + 2 * twos) if ones else 0.5
    following = [defaultdict(list) for _ in range(6)]
    for n in range(1, 6):
        for g, c in count[n].items():
            following[n][g[:-1]].append(c)

    def p(g):
        n = len(g)
        if not n:
            return 1 / langid.ALPHABET
        after = following[n].get(g[:-1])
        if after is None:
            return p(g[1:])
        return max(count[n][g] - discount[n], 0) / sum(after) + discount[n] * len(after) / sum(after) * p(g[1:])

    def entropy(t):
        lines = ["    " + w + " " for w in words(t)]
        grams = [x[i:i + 5] for x in lines for i in range(len(x) - 4)]
        return -sum(math.log(p(g)) for g in grams) / len(grams)
    return entropy


def test_entropies_equal_a_plain_kneser_ney(spark, monkeypatch):
    """Three languages of different sizes: each keeps its own grams; words no language has met back off."""
    monkeypatch.setattr(langid, "CALIBRATE", 1 << 40)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").filter(F.col("text").rlike("^[ -~\n]+$"))
    draw = F.crc32("text") % 5
    docs = docs.select("text", F.when(draw == 0, "p").when(draw < 3, "q").otherwise("r").alias("lang"))
    rows = docs.collect()
    model = langid.train(docs)
    fresh = ["the quick brown fox", "zzyzx qqq", "der Hund und die Katze", "a", "le chat, l'eau et 42 oiseaux"]
    got, _ = langid.Scorer(model).entropies(fresh + [r.text for r in rows[:20]])
    for k, lang in enumerate(model.langs):
        entropy = plain_kneser_ney([r.text for r in rows if r.lang == lang])
        assert got[:, k].tolist() == pytest.approx([entropy(t) for t in fresh + [r.text for r in rows[:20]]], rel=1e-9)
    assert len({len(t[-1][0]) for t in model.tables}) == len(model.langs) > 1


def test_labels_of_few_rows_by_rule_and_shared_bound(spark, monkeypatch):
    rows = [(f"alpha beta {chr(97 + i)}", "many") for i in range(20)] + [("gamma", "one"), (None, "one"), ("delta", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert langid.train(docs).langs == ["many", "one"] and langid.train(docs, least_rows=2).langs == ["many"]
    monkeypatch.setattr(langid, "TOTAL_CHARS", 20)
    assert langid.train(docs).langs == ["many", "one"]


# ------------------------------------------------------------- line templates
def test_line_templates_match_plain_python(spark, odd_texts, monkeypatch):
    rnd = random.Random(2)
    names = [f"n{chr(97 + i)}" for i in range(20)]
    texts = list(odd_texts)
    for _ in range(60):
        lines = [f"user {rnd.choice(names)} logged in from host {rnd.randint(1, 99)} at noon today",
                 "shared boilerplate line of this site", " ".join(f"p{rnd.randint(0, 10**6)}x" for _ in range(8)), "", "ok"]
        rnd.shuffle(lines)
        texts.append("\n".join(lines[:rnd.randint(0, 5)]))
    want = line_dedup.brute_force(list(enumerate(texts)), 10)
    got = {r.row.doc_id: (r.n_lines, r.n_dropped, r.kept or "") for r in
           line_dedup.drop_recurring_lines(frame(spark, texts, dk=1, line="x", template=3)).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 20
    assert line_dedup.drop_recurring_lines(frame(spark, texts).limit(0)).count() == 0


def test_fields_of_a_crowded_leaf(spark):
    """One leaf for all lines: what varies is a field, however many lines there are."""
    texts = [f"a b c d e f {chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    got = {r.row.doc_id: r.n_dropped for r in line_dedup.drop_recurring_lines(frame(spark, texts)).collect()}
    assert got == {i: int(i > 0) for i in range(200)}


def test_ordinary_lines_in_one_leaf(spark):
    """Lines of one leaf made of common words, and of rarer ones, in any order and number: equal to plain Python."""
    rnd = random.Random(4)
    common, rare = ["red", "fox", "sees", "dog"], [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    texts = []
    for _ in range(600):
        lines = [f"the quick brown {' '.join(rnd.choices(common, k=5))}" for _ in range(6)]
        lines += [f"the quick brown {' '.join(rnd.choices(common, k=3))} {' '.join(rnd.choices(rare, k=2))}" for _ in range(2)]
        texts.append("\n".join(lines))
    want = line_dedup.brute_force(list(enumerate(texts)), 10)
    for parts in (2, 9):
        got = {r.row.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.drop_recurring_lines(frame(spark, texts).repartition(parts)).collect()}
        assert got == want
    assert 0 < sum(x[1] for x in want.values()) < 600 * 8


def test_lines_of_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    got = {r.row.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.drop_recurring_lines(
        spark.read.parquet(f"{SF01}/documents.parquet")).collect()}
    assert got == line_dedup.brute_force(rows, line_dedup.MIN_DOCS)


def test_distinct_numeric_rows_stay(spark):
    """Lines alike in their digits alone, or in the leading tokens alone, differ in what they say."""
    texts = [f"{i} {i + 1} {i + 2}\n{i}.5, {i}.7, x, {i}.9\nthe colour is w{chr(97 + i)}\n1 2 3 4\npage {i} of the site map" for i in range(12)]
    got = {r.row.doc_id: r.kept.split("\n") for r in line_dedup.drop_recurring_lines(frame(spark, texts)).collect()}
    assert got[0] == texts[0].split("\n")
    assert all(got[i] == texts[i].split("\n")[:3] for i in range(1, 12))      # the same row and the template go
    assert {k: (5, 5 - len(v), "\n".join(v)) for k, v in got.items()} == line_dedup.brute_force(list(enumerate(texts)), 10)


def test_short_lines_and_scripts_without_spaces(spark):
    texts = [f"Les.\nAnd so.\n  \n\n著作権所有。無断転載を禁じます。\nnur {i}\n第{i}章" for i in range(11)]
    got = {r.row.doc_id: r.kept for r in line_dedup.drop_recurring_lines(frame(spark, texts)).collect()}
    assert got == {i: f"  \n\nnur {i}\n第{i}章" if i else texts[0] for i in range(11)}
    assert got == {k: v[2] for k, v in line_dedup.brute_force(list(enumerate(texts)), 10).items()}


# ------------------------------------------------------------------- licenses
def base_license(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    at = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if tuple(w[i:i + len(phrase)]) == phrase]
    return (len(w), len(at), min((p for p, _ in at), default=None), max((p for p, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))


def test_license_base_on_whole_table(spark):
    got = {r.doc_id: r for r in licenses.op3_license_scan(spark, SF01).collect()}
    for r in spark.read.parquet(f"{SF01}/documents.parquet").collect():
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels) == base_license(r.text)
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and 0 <= g.score <= 1


def test_license_rules(spark, odd_texts):
    cases = {
        "Licensed under the Apache License, Version 2.0 (the x)": {"apache-2.0"},
        "SPDX-License-Identifier: GPL-3.0-or-later": {"gpl-3.0-or-later"},
        "Released under the MIT License. Also Mozilla Public License 2.0": {"mit", "mpl-2.0"},
        "released under the GNU General Public License, version 3.": {"gpl-3.0"},
        "Permission is hereby granted, free of charge, to any person obtaining a copy": {"mit"},
        "mit freundlichen Grüßen": set(),
        "the Apache License": {"apache"},
    }
    texts = [*cases, *odd_texts]
    found = licenses.scan(frame(spark, texts, label="x", gate=1)).collect()
    by_key = {}
    for r in found:
        by_key.setdefault(bytes(r.tk), set()).add(r.label)
    import hashlib
    for t, labels in cases.items():
        assert by_key.get(hashlib.md5(t.encode()).digest(), set()) == labels, t
    assert licenses.scan(frame(spark, texts).limit(0)).count() == 0
    rules = licenses.rules()
    assert len(rules) > 300 and all(re.match(p[1:].split(" ")[0].split("(?")[0] or ".", g) or True for _, g, p, *_ in rules)


def phrase(pattern, most):
    """A text the pattern matches, with all or none of what is optional."""
    def of(items):
        out = ""
        for op, x in items:
            kind = str(op)
            if kind == "LITERAL":
                out += chr(x)
            elif kind == "IN":
                out += "x" if str(x[0][0]) == "CATEGORY" else chr(x[0][1])
            elif kind == "BRANCH":
                out += of(x[1][-1 if most else 0])
            elif kind == "SUBPATTERN":
                out += of(x[3])
            elif kind == "MAX_REPEAT":
                out += of(x[2]) * min(6, int(x[1])) if most and len(x[2]) != 1 or x[0] == 0 and most else of(x[2]) * x[0]
        return out
    return of(re._parser.parse(pattern.removeprefix("^").removesuffix("(?= |$)")))


def test_every_rule_fires_on_its_phrase_alone(spark):
    import hashlib
    rules, want = licenses.rules(), []
    for _, _, pattern, label, priority, _ in rules:
        for most in (False, True):
            text = phrase(pattern, most)
            assert re.match(pattern, text), (pattern, text)
            want.append((text, pattern, label, priority, most))
    got = {}
    for r in licenses.scan(frame(spark, [w[0] for w in want])).collect():
        got.setdefault(bytes(r.tk), []).append(r)
    for text, pattern, label, priority, most in want:
        own = got.get(hashlib.md5(text.encode()).digest(), [])
        n = min(len(text.split(" ")), licenses.SPAN)
        assert any(r["first"] == 0 and r["last"] == n and r.priority <= priority for r in own), (text, pattern)
    notices = [(text, label) for text, pattern, label, priority, _ in want if priority == 1 and pattern[1:-len("(?= |$)")] in
               {words for _, words in licenses.NOTICES}]
    assert len(notices) == 2 * len(licenses.NOTICES)
    for text, label in [*notices, ("mit no attribution", "mit-0")]:
        assert label in {r.label for r in got[hashlib.md5(text.encode()).digest()]}, text


def test_span_holds_the_longest_rule(spark):
    """A rule's last word counts, however long the rule."""
    text = "released under the terms of the gnu general public license version 2 0 or any later version"
    r, = licenses.scan(frame(spark, [text])).collect()
    assert (r["first"], r["last"], r.label) == (0, len(text.split()), "gpl-2.0-or-later")
    assert licenses.span(r"^a (?:b ){1,3}c(?: d| e f)? g") == 8
    alone, paired, _ = licenses.gates()
    assert {"gnu", "bsd"} <= set(alone) and {"the", "this", "in", "you"} <= set(paired)
    assert len(licenses.NOTICES) > 150 and len(set(licenses.NOTICES)) == len(licenses.NOTICES)


def test_contained_detections_go(spark):
    """Against a check of every pair of detections."""
    text = "licensed under the gnu general public license version 2 or later and the mit license " * 3
    table = [(n, g, re.compile(p), lab, pr) for n, g, p, lab, pr, _ in licenses.rules()]
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    every = []
    for i, x in enumerate(w):
        for n, g, p, lab, pr in table:
            m = p.match(" ".join(w[i:i + licenses.SPAN])) if g == x else None
            if m:
                every.append((i, i + len(m.group().split(" ")), pr, n, lab))
    keep = sorted((a, b, n) for a, b, p, n, _ in every if not any(
        c <= a and d >= b and q <= p and (c, -d, q, m) < (a, -b, p, n) for c, d, q, m, _ in every))
    got = sorted((r["first"], r["last"], r.rule) for r in licenses.scan(frame(spark, [text])).collect())
    assert got == keep and len(keep) < len(every)


# ----------------------------------------------------------------------- urls
def test_url_rules_and_verdicts(spark):
    urls = ["http://a.example.com/en/x", "https://WWW.Example.com/en/1", "http://example.com", "http://x.net/fr/", "http://notnet/fr/",
            "ftp://q.net/es/?a=1", "no scheme", None, "", "http://", "http://h?x=/en/", "http://h#f", "http://é.org/ü%20?q=1&r=2#z",
            "http://a://b/c", "http://com/", "http://acom/"] + [f"http://s{i}.example.com/{'en' if i % 2 else 'de'}/{i}" for i in range(80)] + ["x" * 5000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    for k, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            head = re.match(r"[^/?#]*", rest).group()
            host, path = head.translate(LOW), re.match(r"[^?#]*", rest[len(head):]).group()
        fit = [(v, a, b) for v, a, b in url_filter.RULES if (host == a or host.endswith("." + a)) and path.startswith(b)]
        best = max(fit, key=lambda x: len(x[1] + x[2]), default=None)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, best and best[1] + best[2]), u
        assert got[k].verdict in ("allow", "block") and (best is None or got[k].verdict == best[0])
    assert url_filter.judge(df.limit(0)).count() == 0
    one = url_filter.judge(df.filter("page_id = 6")).collect()
    assert [r.verdict for r in one] == ["allow"]


def test_url_trees_learn_the_labels(spark):
    pages = spark.createDataFrame([(i, f"http://{'cheap-pills-%d' % i if i % 2 else 'news'}.{'net' if i % 2 else 'com'}/{'fr' if i % 2 else 'a'}/") for i in range(300)]
                                  + [(1000 + i, f"http://cheap-pills-{i}.org/q") for i in range(20)]
                                  + [(2000 + i, "http://news.org/q") for i in range(20)], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert all(got[1000 + i].verdict == "block" and got[2000 + i].verdict == "allow" for i in range(20))
