"""URL filter: host rules first, then gradient-boosted trees on lexical features.

Method. A rule (host, path) decides for its host and all subdomains when the url's path starts with the rule's; the longest wins. The urls
that a rule decides are the labelled ones: on a bounded sample of them (``sample_rows`` by a hash of the url) boosted trees learn to
tell blocked from allowed by lengths, depth, digit share, entropy, parameter counts and the statistics of host suffixes. They judge the
urls that no rule fits. Suffix statistics cover all labelled urls; a labelled url's own label is left out of them, and they are
drawn towards the overall share by ``PRIOR`` urls' worth.

Everything is built from columns and the trees of Spark's own library. Suffixes are counted with partial sums in every task; the counts
are broadcast up to 200,000 of them and joined by suffix beyond that, so a host with a third of all rows weighs no more than others.

Defined results: a url that is null or has no ``://`` has an empty host and path, fits no rule and is judged by its features like any
other; if the labelled urls are of one verdict only, the method gives that one, and ``allow`` if there are none; rows that repeat an id are
judged each by itself; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import LOWER, UPPER, bounded, share, written

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._~/?#&=%:"
PRIOR = 20.0


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as ``struct(rule, verdict)``, or null."""
    found = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def occurrences(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def entropy(text: Column) -> Column:
    """Bits a character over a fixed alphabet, in one pass for each of its characters."""
    n = F.greatest(F.length(text), F.lit(1))

    def term(character: str) -> Column:
        p = occurrences(text, character) / n
        return F.when(p > 0, -p * F.log2(p)).otherwise(0.0)

    return reduce(lambda a, b: a + b, map(term, ALPHABET))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of a url's text alone."""
    text = F.coalesce(url, F.lit(""))
    small = F.translate(text, UPPER, LOWER)
    digits = F.length(text) - F.length(F.translate(text, "0123456789", ""))
    return {
        "url_length": F.length(text), "host_length": F.length(host), "path_length": F.length(path),
        "depth": occurrences(path, "/"), "labels": occurrences(host, "."), "hyphens": occurrences(host, "-"),
        "digits": digits / F.greatest(F.length(text), F.lit(1)),
        "host_digits": F.length(host) - F.length(F.translate(host, "0123456789", "")),
        "entropy": entropy(small), "host_entropy": entropy(host),
        "parameters": F.when(text.contains("?"), occurrences(text, "&") + 1).otherwise(0),
        "escapes": occurrences(text, "%"), "fragment": text.contains("#"), "secure": small.startswith("https"),
        "extension": path.rlike(r"\.[A-Za-z0-9]{1,5}$"), "ends_open": path.endswith("/"),
    }


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], sample_rows: int = 20_000, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_probability``."""
    url = F.col("url")
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host_of(url), "path": path_of(url)})
    ruled = parsed.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules)).withColumns({
        "rule": F.col("found.rule"), "ruled": F.col("found.verdict"), "blocked": (F.col("found.verdict") == "block").cast("double"),
        "domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1),
    }).drop("found")
    n, bad = ruled.agg(F.count("blocked"), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    columns = ["page_id", "host", "path", "rule"]
    if not n or bad in (0.0, float(n)):
        judged = F.lit("block" if bad else "allow")
        return ruled.select(*columns, F.coalesce("ruled", judged).alias("verdict"), F.lit(1.0 if bad else 0.0).alias("block_probability"))
    rows = ruled.select(*columns, "ruled", "blocked", "domain", "suffix", share(F.col("url"), sample_rows / n, 7).alias("picked"), *(
        c.cast("double").alias(name) for name, c in lexical(url, F.col("host"), F.col("path")).items()))
    names = list(lexical(url, url, url))
    for key in ("domain", "suffix"):
        rows = with_statistics(rows, ruled, key, bad / n)
        names += [f"{key}_share", f"{key}_labelled", f"{key}_rows"]
    rows, assembler = rows.fillna(0.0, names), VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(labelCol="blocked", featuresCol="features", maxIter=10, maxDepth=4, seed=11, subsamplingRate=1.0)
    # Training reads its rows several times, so the bounded sample is made once.
    sample = written(rows.where(F.col("blocked").isNotNull() & F.col("picked")).select(*names, "blocked"), "url-sample")
    model = trees.fit(assembler.transform(sample).select("features", "blocked"))
    scored = model.transform(assembler.transform(rows.drop("blocked")))
    method = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    chance = 1 / (1 + F.exp(-2 * margin(F.col("rawPrediction"))))
    return scored.select(*columns, F.coalesce("ruled", method).alias("verdict"), chance.alias("block_probability"))


def margin(raw: Column) -> Column:
    from pyspark.ml.functions import vector_to_array

    return F.get(vector_to_array(raw), F.lit(1))


def with_statistics(rows: DataFrame, ruled: DataFrame, key: str, overall: float) -> DataFrame:
    """Add what is known of a row's suffix: blocked share without the row itself, labelled urls and all urls."""
    counts = ruled.groupBy(key).agg(
        F.count("blocked").alias("labelled"), F.coalesce(F.sum("blocked"), F.lit(0.0)).alias("bad"), F.count(F.lit(1)).alias("all"))
    own, known = F.coalesce("blocked", F.lit(0.0)), F.col("blocked").isNotNull().cast("int")
    joined = rows.join(bounded(written(counts, "suffix-statistics"), 200_000), key)
    return joined.withColumns({
        f"{key}_share": (F.col("bad") - own + PRIOR * overall) / (F.col("labelled") - known + PRIOR),
        f"{key}_labelled": F.log1p(F.col("labelled") - known), f"{key}_rows": F.log1p(F.col("all").cast("double")),
    }).drop("labelled", "bad", "all")
