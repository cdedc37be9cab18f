"""URL verdicts by given rules and by association rules that FP-growth mines from what those rules label.

URLs that a given rule fits are the labelled ones. Each becomes a basket of tokens (parts of the host,
of the path and of the query) and its verdict; FP-growth finds token combinations that go with a
verdict, and rules of too little support or confidence, or no better than a shorter one, are dropped.
Tokens that lie in the very same labelled URLs
say the same, so they are mined as one and any of them stands for it. That loses no rule, and it keeps the
number of combinations from doubling with each part of a path that only comes with another one.

The rest are matched by an inverted index: a rule lies under its rarest token, so a basket meets only
the rules whose rarest token it has, and then the other tokens are checked.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratascore.session import materialize, release

RULES = (  # verdict, host, path
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
OTHERWISE = "allow"
VERDICT = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, else null. A rule fits its host and all subdomains."""
    chain = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        chain = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chain)
    return chain


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host parts and endings, path parts and their first letters by place, suffix, query names and values.

    Nothing is cut: which tokens matter is left to the support of the rules.
    """
    parts = F.filter(F.split(host, r"\."), lambda x: x != "")
    folders = F.filter(F.split(path, "/"), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    asked = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.regexp_extract_all(asked, F.lit("(?:^|&)([^=&]+)"), F.lit(1))
    pairs = F.regexp_extract_all(asked, F.lit("(?:^|&)([^=&]+=[^&]+)"), F.lit(1))
    made = F.concat(
        F.transform(parts, lambda x: F.concat(F.lit("part:"), x)),
        F.when(F.size(parts) > 1, F.array(F.concat(F.lit("end:"), F.concat_ws(".", F.slice(parts, -2, 2))))).otherwise(F.array().cast("array<string>")),
        F.transform(folders, lambda x: F.concat(F.lit("folder:"), x)),
        F.transform(F.filter(folders, lambda x, i: i > 0), lambda x, i: F.concat(F.lit("at"), i + 2, F.lit(":"), F.substring(x, 1, 1))),
        F.transform(F.filter(F.array(ending), lambda x: x != ""), lambda x: F.concat(F.lit("suffix:"), F.lower(x))),
        F.transform(names, lambda x: F.concat(F.lit("query:"), x)),
        F.transform(pairs, lambda x: F.concat(F.lit("value:"), x)),
    )
    return F.array_sort(F.array_distinct(made))


def stand_ins(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> dict[str, str]:
    """The name of each token of enough support in ``labelled(tokens, verdict)``: the first of those in the very same rows.

    The others can be in no rule. Equal rows are merged before the shuffle; which rows a token lies in is
    compared by their number and two sums of hashes. The driver gets at most (mean tokens a row) / ``min_support`` rows.
    """
    sets = labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    of_set = F.xxhash64("tokens", "verdict")
    each = sets.select(F.explode("tokens").alias("token"), "n", of_set.alias("a"), F.xxhash64(of_set, F.lit("again")).alias("b"))
    marks = each.groupBy("token").agg(F.sum("n").alias("freq"), F.count("*").alias("sets"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    total = labelled.count()
    often = marks.where(F.col("freq") >= min_support * total * (1 - 1e-9))
    groups = often.groupBy("sets", "freq", "a", "b").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    return {t: r["tokens"][0] for r in groups.select("tokens").collect() for t in r["tokens"]}


def named_tokens(tokens: Column, names: dict[str, str]) -> Column:
    """The distinct names of the tokens that have one, sorted."""
    @F.pandas_udf("array<string>")
    def run(rows: pd.Series) -> pd.Series:
        return pd.Series([sorted({names[t] for t in row if t in names}) for row in rows], dtype=object)

    return run(tokens)


def _matches(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of ``baskets(tokens, ...)`` beside each row of ``rules(rarest, needs, ...)`` whose tokens they hold."""
    opened = baskets.withColumn("rarest", F.explode("tokens"))
    return opened.join(rules, "rarest").where(F.size(F.array_except("needs", "tokens")) == 0)


def mine_rules(baskets: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``rarest, needs, confidence, support, says`` from ``baskets(tokens, verdict)``, written to the shared folder."""
    items = baskets.select(F.concat("tokens", F.array(F.concat(F.lit(VERDICT), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent")[0].startswith(VERDICT)).select(
        F.array_sort("antecedent").alias("needs"), "confidence", "support",
        F.substring(F.col("consequent")[0], len(VERDICT) + 1, 100).alias("says"))
    rules = rules.where(~F.exists("needs", lambda x: x.startswith(VERDICT)))
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = rules.select("needs", "says", F.explode("needs").alias("token")).join(counts, "token").groupBy("needs", "says").agg(
        F.min(F.struct("freq", "token")).getField("token").alias("rarest"))
    rules = materialize(rules.join(rarest, ["needs", "says"]), "url-rules")
    # a rule goes if a shorter one inside it has the same verdict and is as sure
    inside = _matches(rules.select(F.col("needs").alias("tokens"), F.col("says").alias("long_says"), F.col("confidence").alias("long_sure")), rules)
    worse = inside.where("says = long_says AND confidence >= long_sure AND size(needs) < size(tokens)").select(
        F.col("tokens").alias("needs"), F.col("long_says").alias("says")).distinct()
    return materialize(rules.join(worse, ["needs", "says"], "left_anti"), "url-rules")


def judge(pages: DataFrame, url: str = "url", key: str = "page_id", rules: Sequence[tuple[str, str, str]] = RULES,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence`` of every row.

    A given rule decides where one fits. Elsewhere the surest mined rule does (then the one with more
    support, more tokens, ``block`` before ``allow``, then by token order); with none the verdict is
    ``allow`` and ``confidence`` null. A null URL, or one without ``://``, has an empty host and path and no
    tokens. Equal sets of tokens that some rule may hold are judged once; repeated rows are rows; an empty table gives an empty
    result. Without any labelled URL nothing is mined.
    """
    host, path = host_and_path(F.col(url))
    seen = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"), url_tokens(F.coalesce(F.col(url), F.lit("")), host, path).alias("tokens"))
    seen = materialize(seen.withColumn("given", given_rule(F.col("host"), F.col("path"), rules)), "url-baskets")
    names = stand_ins(seen.where("given IS NOT NULL").select("tokens", "given.verdict"), min_support)
    baskets = materialize(seen.withColumn("tokens", named_tokens(F.col("tokens"), names)), "url-baskets")
    release(seen)
    mined = mine_rules(baskets.where("given IS NOT NULL").select("tokens", "given.verdict"), min_support, min_confidence)
    sets = baskets.where("given IS NULL").select("tokens").distinct()
    order = Window.partitionBy("tokens").orderBy(
        F.desc("confidence"), F.desc("support"), F.desc(F.size("needs")), F.desc("says"), F.col("needs").cast("string"))
    found = _matches(sets, mined).withColumn("at", F.row_number().over(order)).where("at = 1").select("tokens", "says", "confidence")
    judged = baskets.join(found, "tokens", "left")
    return judged.select("page_id", "host", "path", F.col("given.rule").alias("rule"),
                         F.coalesce("given.verdict", "says", F.lit(OTHERWISE)).alias("verdict"),
                         F.when(F.col("given").isNull(), F.col("confidence")).alias("confidence"))
