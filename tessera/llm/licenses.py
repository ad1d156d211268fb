"""License scans with ordered signature rules, in DataFrame functions only.

A rule is a regular expression over the words of a text, gated by the word it begins
with, and by the second where the first is a word of every text.  Each rule names a
literal it cannot match without; texts with none of these literals never reach the
rules.  Where gate words stand, their rules are tried on the words that follow, so every
place is found.  Of overlapping detections those that lie inside one of equal or better priority go.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import read, text_key
from tessera.llm.license_notices import NOTICES
from tessera.session import materialize

#: Everything that is no word: ASCII without 0-9 and a-z, once A-Z are lower-cased (fixed by the contract).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and labels (fixed by the contract).
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
#: label, how its name reads word by word, its identifier's words.
LICENSES = [
    ("apache-2.0", r"apache (?:software )?licen[cs]e (?:version |v)?2(?: 0)?", r"apache 2 0"),
    ("apache-1.1", r"apache (?:software )?licen[cs]e (?:version |v)?1 1", r"apache 1 1"),
    ("apache-1.0", r"apache (?:software )?licen[cs]e (?:version |v)?1 0", r"apache 1 0"),
    ("apache", r"apache (?:software )?licen[cs]e", r"apache"),
    ("mit", r"mit (?:x11 )?licen[cs]e", r"mit"),
    ("mit-0", r"mit no attribution(?: licen[cs]e)?", r"mit 0"),
    ("x11", r"x11 (?:mit )?licen[cs]e", r"x11"),
    ("expat", r"expat licen[cs]e", r"expat"),
    ("gpl-3.0", r"gnu general public licen[cs]e (?:version |v)?3(?: 0)?", r"gpl 3 0(?: only)?"),
    ("gpl-3.0-or-later", r"gnu general public licen[cs]e (?:version |v)?3(?: 0)? or (?:any )?later(?: version)?", r"gpl 3 0 or later"),
    ("gpl-2.0", r"gnu general public licen[cs]e (?:version |v)?2(?: 0)?", r"gpl 2 0(?: only)?"),
    ("gpl-2.0-or-later", r"gnu general public licen[cs]e (?:version |v)?2(?: 0)? or (?:any )?later(?: version)?", r"gpl 2 0 or later"),
    ("gpl-1.0", r"gnu general public licen[cs]e (?:version |v)?1(?: 0)?", r"gpl 1 0(?: only)?"),
    ("gpl", r"gnu (?:general public licen[cs]e|gpl)", r"gpl"),
    ("gpl-3.0", r"gplv?(?: version)? ?3(?: 0)?", r"gplv3"),
    ("gpl-2.0", r"gplv?(?: version)? ?2(?: 0)?", r"gplv2"),
    ("lgpl-3.0", r"gnu lesser general public licen[cs]e (?:version |v)?3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", r"gnu lesser general public licen[cs]e (?:version |v)?2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.0", r"gnu library general public licen[cs]e (?:version |v)?2(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl", r"gnu (?:lesser|library) general public licen[cs]e", r"lgpl"),
    ("agpl-3.0", r"gnu affero general public licen[cs]e (?:version |v)?3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("agpl", r"gnu affero general public licen[cs]e", r"agpl"),
    ("gfdl-1.3", r"gnu free documentation licen[cs]e (?:version |v)?1 3", r"gfdl 1 3(?: only| or later)?"),
    ("gfdl", r"gnu free documentation licen[cs]e", r"gfdl"),
    ("bsd-2-clause", r"(?:simplified|freebsd) bsd licen[cs]e", r"bsd 2 clause"),
    ("bsd-3-clause", r"(?:modified|revised|new) bsd licen[cs]e", r"bsd 3 clause"),
    ("bsd-4-clause", r"original bsd licen[cs]e", r"bsd 4 clause"),
    ("bsd-2-clause", r"bsd 2 clause(?: licen[cs]e)?", r"bsd 2"),
    ("bsd-3-clause", r"bsd 3 clause(?: licen[cs]e)?", r"bsd 3"),
    ("bsd-0-clause", r"zero clause bsd licen[cs]e", r"0bsd"),
    ("bsd", r"bsd (?:style )?licen[cs]e", r"bsd"),
    ("mpl-2.0", r"mozilla public licen[cs]e (?:version |v)?2(?: 0)?", r"mpl 2 0"),
    ("mpl-1.1", r"mozilla public licen[cs]e (?:version |v)?1 1", r"mpl 1 1"),
    ("mpl", r"mozilla public licen[cs]e", r"mpl"),
    ("epl-2.0", r"eclipse public licen[cs]e (?:version |v)?2(?: 0)?", r"epl 2 0"),
    ("epl-1.0", r"eclipse public licen[cs]e (?:version |v)?1(?: 0)?", r"epl 1 0"),
    ("epl", r"eclipse public licen[cs]e", r"epl"),
    ("edl-1.0", r"eclipse distribution licen[cs]e(?: (?:version |v)?1(?: 0)?)?", r"edl 1 0"),
    ("cddl-1.1", r"common development and distribution licen[cs]e (?:version |v)?1 1", r"cddl 1 1"),
    ("cddl-1.0", r"common development and distribution licen[cs]e(?: (?:version |v)?1 0)?", r"cddl 1 0"),
    ("cpl-1.0", r"common public licen[cs]e(?: (?:version |v)?1 0)?", r"cpl 1 0"),
    ("cc-by-4.0", r"creative commons attribution 4 0(?: international)?(?: public)?(?: licen[cs]e)?", r"cc by 4 0"),
    ("cc-by-3.0", r"creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?", r"cc by 3 0"),
    ("cc-by-sa-4.0", r"creative commons attribution share ?alike 4 0(?: international)?(?: licen[cs]e)?", r"cc by sa 4 0"),
    ("cc-by-sa-3.0", r"creative commons attribution share ?alike 3 0(?: unported)?(?: licen[cs]e)?", r"cc by sa 3 0"),
    ("cc-by-nc-4.0", r"creative commons attribution non ?commercial 4 0(?: international)?(?: licen[cs]e)?", r"cc by nc 4 0"),
    ("cc-by-nc-sa-4.0", r"creative commons attribution non ?commercial share ?alike 4 0(?: international)?", r"cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?", r"cc by nc nd 4 0"),
    ("cc-by-nd-4.0", r"creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?", r"cc by nd 4 0"),
    ("cc0-1.0", r"cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc", r"creative commons(?: \w+)? licen[cs]e", r"cc by"),
    ("unlicense", r"unlicense", r"unlicense"),
    ("wtfpl", r"do what the fuck you want to public licen[cs]e", r"wtfpl"),
    ("isc", r"isc licen[cs]e", r"isc"),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib"),
    ("bsl-1.0", r"boost software licen[cs]e(?: (?:version |v)?1 0)?", r"bsl 1 0"),
    ("artistic-2.0", r"artistic licen[cs]e (?:version |v)?2(?: 0)?", r"artistic 2 0"),
    ("artistic-1.0", r"artistic licen[cs]e (?:version |v)?1(?: 0)?", r"artistic 1 0"),
    ("artistic", r"artistic licen[cs]e", r"artistic"),
    ("psf-2.0", r"python software foundation licen[cs]e(?: (?:version |v)?2)?", r"psf 2 0"),
    ("ruby", r"ruby licen[cs]e", r"ruby"),
    ("php-3.01", r"php licen[cs]e(?: (?:version |v)?3 01)?", r"php 3 01"),
    ("ofl-1.1", r"sil open font licen[cs]e(?: (?:version |v)?1 1)?", r"ofl 1 1"),
    ("ms-pl", r"microsoft public licen[cs]e", r"ms pl"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", r"ms rl"),
    ("eupl-1.2", r"european union public licen[cs]e(?: (?:version |v)?1 2)?", r"eupl 1 2"),
    ("afl-3.0", r"academic free licen[cs]e(?: (?:version |v)?3(?: 0)?)?", r"afl 3 0"),
    ("osl-3.0", r"open software licen[cs]e(?: (?:version |v)?3(?: 0)?)?", r"osl 3 0"),
    ("odbl-1.0", r"open (?:data commons )?open database licen[cs]e(?: (?:version |v)?1 0)?", r"odbl 1 0"),
    ("openssl", r"openssl licen[cs]e", r"openssl"),
    ("vim", r"vim licen[cs]e", r"vim"),
    ("w3c", r"w3c software (?:notice and )?licen[cs]e", r"w3c"),
    ("upl-1.0", r"universal permissive licen[cs]e(?: (?:version |v)?1 0)?", r"upl 1 0"),
    ("sspl-1.0", r"server side public licen[cs]e(?: (?:version |v)?1)?", r"sspl 1 0"),
    ("busl-1.1", r"business source licen[cs]e(?: (?:version |v)?1 1)?", r"busl 1 1"),
    ("elastic-2.0", r"elastic licen[cs]e(?: (?:version |v)?2(?: 0)?)?", r"elastic 2 0"),
    ("proprietary", r"proprietary licen[cs]e", r"licenseref proprietary"),
]
GRANTS = ["licensed", "released", "distributed", "available", "published"]


def literal(pattern: str) -> str:
    """Words that stand in every match of a pattern: ``licen`` where a word must begin so, else the longest run of
    letters outside groups and classes."""
    flat = re.sub(r"\(\?:[^()]*\)(?:\?|\{[\d,]+\})?", "\n", pattern)      # groups do not nest twice
    flat = re.sub(r"\(\?:[^()]*\)(?:\?|\{[\d,]+\})?", "\n", flat)
    runs = [x.strip() for x in re.sub(r"\[\w+\]\??|\\w\+|.\?", "\n", flat).split("\n")]
    return "licen" if any(" licen" in f" {x}" for x in runs) else max(runs, key=len)


def _rules() -> list[tuple[tuple[int, str, str, str, int, float], str]]:
    out = []

    def add(first: str, pattern: str, label: str, priority: int, weight: float, need: str) -> None:
        out.append(((len(out), first, f"^{pattern}(?= |$)", label, priority, weight), literal(need)))

    def heads(name: str) -> list[str]:
        if name.startswith("gplv?"):
            number = name[name.index(" ?") + 2]
            return ["gpl", "gplv", f"gpl{number}", f"gplv{number}"]
        return name[3:name.index(")")].split("|") if name.startswith("(?:") else [name.split(" ")[0].split("(?:")[0]]

    for label, _, spdx in LICENSES:
        add("spdx", f"spdx license identifier {spdx}", label, 0, 1.0, "spdx license identifier")
    for label, words in NOTICES:
        add(words.split(" ")[0], words, label, 1, 0.9, words)
    for label, name, _ in LICENSES:
        for verb in GRANTS:
            add(verb, f"{verb} (?:under|by) (?:the )?(?:terms of the )?{name}", label, 1, 0.95, name)
        for gate in heads(name):
            add(gate, name, label, 2, 0.7, name)
    return out


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """(number, gate word, pattern, label, priority, weight); priority 0 is the best."""
    return [rule for rule, _ in _rules()]


def gates() -> tuple[list[str], list[str], list[str]]:
    """Words that open a rule by themselves; words that do so only with the next one, where that is plain in all
    their rules (most of these are words of every text); the pairs of the latter."""
    seconds: dict[str, set[str | None]] = {}
    for _, first, pattern, *_ in rules():
        head, *after = pattern.removeprefix("^").removesuffix("(?= |$)").split(" ")
        plain = after and re.fullmatch(rf"{first}|\(\?:[a-z0-9|]+\)", head) and re.fullmatch(r"[a-z0-9]+|licen\[cs\]e", after[0])
        seconds.setdefault(first, set()).update([after[0].replace("[cs]", x) for x in "cs"] if plain else [None])
    alone = sorted(w for w, found in seconds.items() if None in found)
    return alone, sorted(seconds.keys() - set(alone)), sorted(f"{w} {x}" for w in seconds.keys() - set(alone) for x in seconds[w])


def literals() -> list[str]:
    """At least one of these begins a word of every text a rule matches; none holds another."""
    every = {need for _, need in _rules()}
    return sorted(x for x in every if not any(f" {y}" in f" {x}" for y in every - {x}))


def hint() -> str:
    """Pattern that finds any of the literals behind a space.  They are told apart by their first letter, so that a
    word costs a few comparisons, not one a literal."""
    by: dict[str, list[str]] = {}
    for x in literals():
        by.setdefault(x[0], []).append(x[1:])
    return " (?:" + "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in by.items()) + ")"


def span(pattern: str) -> int:
    """Words a pattern covers at most: every optional part taken, groups as often as they may repeat."""
    while (group := re.search(r"\(\?:([^()]*)\)(?:\?|\{\d+,(\d+)\})?", pattern)):
        most = max(group[1].split("|"), key=lambda x: x.count(" "))
        pattern = pattern[:group.start()] + most * int(group[2] or 1) + pattern[group.end():]
    return pattern.count(" ") + 1


SPAN = max(span(r[2].removesuffix("(?= |$)")) for r in rules())       # words a rule may cover


def words(text="text"):
    """The text's words with one space between."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, NOT_WORD, " "))


def scan(docs: DataFrame) -> DataFrame:
    """(tk, label, rule, first, last, priority, weight) of what stays detected in each distinct text.

    ``docs`` has text; ``tk`` is ``text_key``; first and last count words from 0, last is the one
    behind.  Null, empty and wordless texts have no detections, equal texts have theirs once.
    """
    spark = docs.sparkSession
    table = spark.createDataFrame(rules(), "rule int, gate string, pattern string, label string, priority int, weight double")
    alone, paired, pairs = gates()
    told = docs.select(text_key().alias("tk"), words().alias("norm")).filter(F.concat(F.lit(" "), "norm").rlike(hint()))
    told = materialize(told.dropDuplicates(["tk"]).select("tk", F.split("norm", " ").alias("words")))
    opens = lambda w, i: w.isin(alone) | (w.isin(paired) & F.concat_ws(" ", w, F.get("words", i + 1)).isin(pairs))
    places = F.filter(F.transform("words", lambda w, i: F.when(opens(w, i), i).otherwise(-1)), lambda i: i >= 0)
    at = told.select("tk", "words", F.explode(places).alias("first")).select(
        "tk", "first", F.element_at("words", F.col("first") + 1).alias("gate"),
        F.array_join(F.slice("words", F.col("first") + 1, F.lit(SPAN)), " ").alias("ahead"))
    hits = at.join(F.broadcast(table), "gate").filter("ahead rlike pattern").select(       # a few hundred fixed rules
        "tk", "label", "rule", "first", "priority", "weight",
        (F.col("first") + F.size(F.split(F.expr("regexp_extract(ahead, pattern, 0)"), " "))).alias("last"))
    before = Window.partitionBy("tk").orderBy("first", F.desc("last"), "priority", "rule").rowsBetween(
        Window.unboundedPreceding, -1)
    reach = F.lit(None).cast("int")
    for p in (2, 1, 0):
        reach = F.when(F.col("priority") == p, F.max(F.when(F.col("priority") <= p, F.col("last"))).over(before)).otherwise(reach)
    return hits.withColumn("reach", reach).filter("reach is null or reach < last").drop("reach")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    found = scan(docs).groupBy("tk").agg(F.collect_set("label").alias("own"), F.max("weight").alias("weight"),
                                         F.count("*").alias("n_detections"))
    found = materialize(found)      # so the join below is free to split the rows of a text with many copies
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("tk"), words().alias("norm"))
    split = F.when(F.col("norm").contains("license"), F.split("norm", " ")).otherwise(F.array().cast("array<string>"))
    n = F.when(F.col("norm") == "", 0).otherwise(F.length("norm") - F.length(F.translate("norm", " ", "")) + 1)
    # each word with the two before it, so a place is judged by itself
    near = F.arrays_zip(split.alias("w"), F.concat(F.array(F.lit("")), split).alias("b"),
                        F.concat(F.array(F.lit(""), F.lit("")), split).alias("c"))
    mine = norm.select("doc_id", "tk", n.cast("long").alias("n_words"), near.alias("near"))
    label = lambda x: F.when(x["w"] == "license", F.when(x["b"] == "mit", "mit").when(x["b"] == "apache", "apache").when(
        (x["b"] == "public") & (x["c"] == "general"), "gpl"))
    places = F.filter(F.transform("near", lambda x, i: F.struct(
        (i - F.when(label(x) == "gpl", 2).otherwise(1)).cast("long").alias("at"), label(x).alias("label"))),
        lambda p: p["label"].isNotNull())
    mine = mine.select("doc_id", "tk", "n_words", places.alias("places"))
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    out = mine.join(found, "tk", "left").withColumn("base", base)
    both = F.array_sort(F.array_union("base", F.coalesce("own", F.array().cast("array<string>"))))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").alias("first_word"), F.array_max("places.at").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.greatest(F.coalesce("weight", F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
        F.coalesce("n_detections", F.lit(0).cast("long")).alias("n_detections"))
