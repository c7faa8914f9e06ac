"""URL filters: host and path rules first, then association rules mined by FP-growth.

``learn`` turns labelled urls into sets of url tokens. Tokens that stand in exactly the same
urls are one item there, named after the first of them, so what urls have in common as a
whole costs one item and not all its subsets. Spark's FP-growth finds the combinations that
are frequent among the bad urls; the others are looked up in an inverted index of these, which
gives the confidence of each rule "these tokens -> bad". Rules stay whose support and
confidence are high enough and that no shorter rule implies.
``match`` finds the rules of each distinct url through an inverted index: every rule is
posted under its rarest token, urls look up their own tokens, and a posting fires when
all tokens of the rule are there. ``judge`` adds verdicts.

Defined results: a NULL url, or one without ``://``, has an empty host and path, no
tokens, and is allowed. Rows are judged one by one, repeated rows and NULL ids included.
Labels with a NULL id are ignored; of several labels of an id the bad one counts, and a
NULL label value says nothing. Without labelled urls, or with too few, no rule is mined
and all other urls are allowed. Columns besides the named ones are not read.

The label of a page is that of the document with its number. Matching works on distinct
urls, so a url that many pages share costs one row; the rules are joined without a
hint, so Spark broadcasts them only when it has measured that they are small.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

RULE_SCHEMA = "antecedent array<string>, confidence double, support double, posted string"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return tuple(F.when(at > 0, x).otherwise("") for x in (host, path))


def listed_rule(
    host: Column, path: Column, block: Sequence[str], allow: Sequence[str]
) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    known = [(r, "block") for r in block] + [(r, "allow") for r in allow]
    for text, says in sorted(known, key=lambda x: len(x[0])):
        own_host, slash, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a url, marked by the part they come from; numbers are ``#``."""
    host, path = parts(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)

    def pieces(kind: str, text: Column, gaps: str) -> Column:
        found = F.array_remove(F.split(F.lower(text), gaps), "")
        return F.transform(
            found, lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[0-9]+", "#"))
        )

    made = F.concat(
        pieces("host:", host, r"[.\-]"),
        pieces("path:", path, r"[/.\-_]"),
        pieces("query:", query, "&"),
    )
    return F.array_sort(F.array_distinct(F.when(F.instr(url, "://") > 0, made).otherwise(F.array())))


def learn(
    urls: DataFrame,
    url_col: str = "url",
    bad_col: str = "bad",
    min_support: float = 0.0,
    min_count: int = 20,
    min_confidence: float = 0.7,
    max_tokens: int | None = None,
) -> DataFrame:
    """Rules ``antecedent -> bad`` from labelled urls, one row each.

    A rule needs ``min_count`` bad urls, however many are labelled, and where given a share
    of ``min_support`` of them. Antecedents are of any length, unless ``max_tokens`` is given.
    """
    spark = urls.sparkSession
    known = urls.filter(F.col(bad_col).isNotNull() & F.col(url_col).isNotNull())
    own = known.select(F.col(url_col).alias("url"), F.col(bad_col).alias("bad"), tokens(F.col(url_col)).alias("tokens"))
    n, n_bad = own.agg(F.count("*"), F.count_if("bad")).first()
    least = max(min_count, 1, ceil(min_support * n - 1e-9))
    if n_bad < least:
        return spark.createDataFrame([], RULE_SCHEMA)
    distinct = own.select("url", "tokens").dropDuplicates(["url"])
    same = alike(distinct)
    baskets = written(own.join(fold(distinct, same), "url").select("items", "bad"), "url-baskets")
    # Half a url less: the product with n_bad, rounded up, is least whatever the rounding.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_bad).fit(baskets.filter("bad"))
    sets = written(model.freqItemsets, "url-sets").select(
        F.array_sort("items").alias("antecedent"), F.col("freq").alias("n_bad")
    )
    if max_tokens is not None:
        sets = sets.filter(F.size("antecedent") <= max_tokens)
    rules = _confident(_posted(sets, baskets), baskets).filter(F.col("confidence") >= min_confidence)
    rules = rules.withColumn("support", F.col("n_bad") / n).drop("n_bad")
    return _unfolded(_not_implied(_not_repeating(rules)), same)


def _posted(sets: DataFrame, baskets: DataFrame) -> DataFrame:
    """The sets with ``posted``, the one of their items that fewest urls have."""
    rarity = baskets.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return (
        sets.withColumn("token", F.explode("antecedent"))
        .join(rarity, "token")
        .groupBy("antecedent", "n_bad")
        .agg(F.min_by("token", F.struct("n", "token")).alias("posted"))
    )


def _confident(posted: DataFrame, baskets: DataFrame) -> DataFrame:
    """Adds ``confidence``: the bad urls with a set as a share of all with it.

    Urls of equal items are looked up once.
    """
    others = baskets.filter(~F.col("bad")).groupBy("items").agg(F.count("*").alias("n"))
    held = (
        others.select("items", "n", F.explode("items").alias("posted"))
        .join(posted, "posted")
        .filter(F.size(F.array_except("antecedent", "items")) == 0)
        .groupBy("antecedent")
        .agg(F.sum("n").alias("n_other"))
    )
    every = F.col("n_bad") + F.coalesce("n_other", F.lit(0))
    return posted.join(held, "antecedent", "left").select(
        "antecedent", "n_bad", "posted", (F.col("n_bad") / every).alias("confidence")
    )


def alike(urls: DataFrame) -> DataFrame:
    """``token`` and ``first``: the first token that stands in exactly the same urls.

    Which urls these are is told by their number and two sums of hashes.
    """
    rows = urls.select("url", F.explode("tokens").alias("token"))
    marks = [F.sum(F.xxhash64(F.lit(seed), "url").cast("decimal(20,0)")).alias(f"h{seed}") for seed in (1, 2)]
    told = rows.groupBy("token").agg(F.count("*").alias("n"), *marks)
    first = told.groupBy("n", "h1", "h2").agg(F.min("token").alias("first"))
    return told.join(first, ["n", "h1", "h2"]).select("token", "first")


def fold(urls: DataFrame, same: DataFrame) -> DataFrame:
    """Per url its ``items``: the first tokens among its own."""
    first = same.filter(F.col("token") == F.col("first")).select("token")
    # A frequent token has a row a url, which Spark may split in the join.
    kept = (
        urls.select("url", F.explode("tokens").alias("token")).join(first, "token")
        .groupBy("url").agg(F.array_sort(F.collect_list("token")).alias("items"))
    )
    return urls.select("url").join(kept, "url", "left").select(
        "url", F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def _unfolded(rules: DataFrame, same: DataFrame) -> DataFrame:
    """Each rule with each of the tokens that one of its items stands for."""
    each = rules.withColumn("first", F.explode("antecedent")).join(same, "first")
    own = F.array_sort(F.array_append(F.array_remove("antecedent", F.col("first")), F.col("token")))
    posted = F.when(F.col("posted") == F.col("first"), F.col("token")).otherwise(F.col("posted"))
    return each.select(own.alias("antecedent"), "confidence", "support", posted.alias("posted")).dropDuplicates(
        ["antecedent"]
    )


def _not_repeating(rules: DataFrame) -> DataFrame:
    """Drops a rule if it is no more confident than with one token less.

    What such a rule implies is implied by the shorter one too, so ``_not_implied`` gives the
    same rules, from far fewer where urls have many tokens in common.
    """
    less = rules.select(
        F.col("antecedent").alias("long"), F.col("confidence").alias("long_confidence"),
        F.explode("antecedent").alias("token"),
    ).withColumn("antecedent", F.array_remove("long", F.col("token")))
    repeating = (
        less.join(rules.select("antecedent", "confidence"), "antecedent")
        .filter(F.col("confidence") >= F.col("long_confidence"))
        .select(F.col("long").alias("antecedent"))
        .distinct()
    )
    return rules.join(repeating, "antecedent", "left_anti").select(
        "antecedent", "confidence", "support", "posted"
    )


def _not_implied(rules: DataFrame) -> DataFrame:
    """Drops a rule if a shorter one, out of its tokens, is at least as confident."""
    longer = rules.select(F.explode("antecedent").alias("posted"), F.col("antecedent").alias("long"),
                          F.col("confidence").alias("long_confidence"))
    implied = (
        longer.join(rules.select("posted", "antecedent", "confidence"), "posted")
        .filter(
            (F.size("antecedent") < F.size("long"))
            & (F.size(F.array_except("antecedent", "long")) == 0)
            & (F.col("confidence") >= F.col("long_confidence"))
        )
        .select(F.col("long").alias("antecedent"))
        .distinct()
    )
    return rules.join(implied, "antecedent", "left_anti").select(
        "antecedent", "confidence", "support", "posted"
    )


def match(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """Per distinct url with a firing rule: ``url``, ``confidence`` and ``fired`` of the best."""
    own = urls.select(F.col(url_col).alias("url")).filter(F.col("url").isNotNull()).distinct()
    asked = own.select("url", tokens(F.col("url")).alias("tokens")).select(
        "url", "tokens", F.explode("tokens").alias("posted")
    )
    fired = asked.join(rules, "posted").filter(
        F.size(F.array_except("antecedent", "tokens")) == 0
    )
    best = F.max(F.struct("confidence", F.array_join("antecedent", " ").alias("fired")))
    return fired.groupBy("url").agg(best.alias("best")).select("url", "best.*")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    block: Sequence[str] = (),
    allow: Sequence[str] = (),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per row: id, host, path, listed rule, verdict, and the mined rule with its confidence."""
    host, path = parts(F.col("url"))
    own = pages.select(F.col(id_col), F.col(url_col).alias("url")).select(
        F.col(id_col), "url", host.alias("host"), path.alias("path")
    )
    rule, verdict = listed_rule(F.col("host"), F.col("path"), block, allow)
    return own.join(match(pages, rules, url_col), "url", "left").select(
        F.col(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("fired").isNotNull(), "block").otherwise("allow"))
        .alias("verdict"),
        "fired", "confidence",
    )


BLOCK = ("net/", "example.com/de/")
ALLOW = ("example.net/en/", "org/fr/")


def query(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = (
        table(spark, sf_dir, "labels")
        .filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    )
    rules = learn(pages.join(labels, "page_id"))
    return judge(pages, rules, BLOCK, ALLOW)
