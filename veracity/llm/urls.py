"""URL filters (4): rules first, then naive Bayes over segmented host and path tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.llm.common import checkpoint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host and path prefix)
RULES: tuple[tuple[str, str], ...] = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Longest word of the segmentation model.
MAX_WORD = 24
#: Buckets of the token hash: the size of the classifier, whatever the corpus.
FEATURES = 1 << 16


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(h: Column, p: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits a host (or its parent domain) and path, and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        rh, _, rp = r.partition("/")
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith("/" + rp)
        name, verdict = F.when(fits, F.lit(r)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def unigrams(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each run of letters (lower case, at most MAX_WORD) occurs in all texts."""
    w = F.explode(F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^\p{L}]+"))
    return (docs.select(w.alias("word")).where((F.length("word") > 0) & (F.length("word") <= MAX_WORD))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def viterbi(name: str, found: dict[tuple[int, int], int], log_total: float) -> list[str]:
    """Most probable split of ``name``; ``found`` has the counts of known substrings by
    (start, length).  An unknown string of ``m`` letters has probability 10 / (total * 10^m)."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        options = []
        for m in range(1, min(MAX_WORD, end) + 1):
            n = found.get((end - m, m))
            score = math.log(n) - log_total if n else math.log(10) - log_total - m * math.log(10)
            options.append((best[end - m][0] + score, -m))
        top = max(options)
        best.append((top[0], -top[1]))
    out: list[str] = []
    end = len(name)
    while end:
        m = best[end][1]
        out.append(name[end - m:end])
        end -= m
    return out[::-1]


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``names(name)``, distinct, to ``(name, parts)`` by unigram Viterbi.

    Only the substrings of the names meet the word counts (an equi-join), so neither the
    vocabulary nor the names are collected; a task holds the substrings of one name.
    """
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    at = F.sequence(F.lit(1), F.length("name"))
    subs = names.where(F.length("name") > 0).select("name", F.explode(at).alias("at"))
    subs = subs.select("name", "at", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(MAX_WORD), F.length("name") - F.col("at") + 1))).alias("len"))
    subs = subs.withColumn("word", F.substring("name", F.col("at"), F.col("len")))
    known = subs.join(counts, "word").groupBy("name").agg(
        F.collect_list(F.struct((F.col("at") - 1).alias("at"), "len", "n")).alias("found"))
    rows = names.where(F.length("name") > 0).join(known, "name", "left")
    log_total = math.log(total)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [viterbi(name, {(x["at"], x["len"]): x["n"] for x in (found if found is not None else [])},
                             log_total) for name, found in zip(b["name"], b["found"], strict=True)]
            yield pd.DataFrame({"name": b["name"], "parts": parts})

    return rows.mapInPandas(run, "name string, parts array<string>")


def host_tokens(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``hosts(host)``, distinct, to ``(host, words)``: runs of letters, segmented, in order."""
    runs = hosts.select("host", F.posexplode(F.filter(F.split("host", r"[^\p{L}]+"), lambda x: x != ""))
                        .alias("at", "name"))
    parts = segment(runs.select("name").distinct(), counts)
    per = runs.join(parts, "name").groupBy("host").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "parts"))), lambda x: x.parts)).alias("words"))
    return hosts.join(per, "host", "left").select("host", F.coalesce("words", F.array().cast("array<string>")).alias("words"))


def path_tokens(p: Column) -> Column:
    """Runs of letters and of digits; digits become their number, as the ids in paths never recur."""
    raw = F.filter(F.split(F.lower(p), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.transform(raw, lambda x: F.when(F.rlike(x, F.lit(r"^\p{N}+$")), F.concat(F.lit("#"), F.length(x).cast("string")))
                       .otherwise(x))


def judge(pages: DataFrame, docs: DataFrame, rules: tuple[tuple[str, str], ...] = RULES,
          features: int = FEATURES) -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict, segments, score``.

    The pages that a rule decides are the labelled rows: a multinomial naive Bayes over
    hashed tokens (the letters of the host split into words, and path tokens) learns
    from all of them and decides the rest; ``score`` is its probability of block.  Hosts
    are made distinct before they are split, the model has a fixed number of buckets
    and is applied row by row.  A null url or one without ``://`` has an empty host and path and
    no token: the prior decides.  If the rules decide no page the rest is allowed; if
    they all agree the rest gets that verdict.  Repeated rows are judged alike; other
    columns are dropped.
    """
    u = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    u = u.withColumns({"rule": name, "by_rule": verdict})
    tokens = checkpoint(host_tokens(u.select("host").distinct(), unigrams(docs)))
    u = u.join(tokens, "host", "left").withColumn("segments", F.coalesce("words", F.array().cast("array<string>"))).drop("words")
    bag = F.concat(F.transform("segments", lambda x: F.concat(F.lit("h:"), x)),
                   F.transform(path_tokens(F.col("path")), lambda x: F.concat(F.lit("p:"), x)))
    u = HashingTF(inputCol="tokens", outputCol="features", numFeatures=features).transform(u.withColumn("tokens", bag))
    known = u.where(F.col("by_rule").isNotNull()).withColumn("label", (F.col("by_rule") == "block").cast("double"))
    n = {r["by_rule"]: r["n"] for r in u.where(F.col("by_rule").isNotNull())
         .groupBy("by_rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) == 2:
        model = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(known.select("features", "label"))
        u = model.transform(u).withColumn("score", F.element_at(vector_to_array(F.col("probability")), 2))
    else:
        u = u.withColumn("score", F.lit(1.0 if "block" in n else 0.0))
    decided = F.coalesce("by_rule", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return u.select("page_id", "host", "path", "rule", decided.alias("verdict"), "segments", "score")

