"""URL filter: host and path rules, and gradient-boosted trees on lexical features.

Everything is a column expression or Spark's own tree learner: lengths, depth,
digit ratio, entropy of characters, numbers of labels, hyphens and parameters,
and how often the ends of a host were blocked among all labelled urls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import sampled, settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labels of a host that end it in the two tables of suffixes.
ENDS = (2, 3)
#: A suffix counts as if it had been seen so often with the table's share of blocked urls.
PRIOR = 4.0
LEXICAL = [
    "url_length", "host_length", "path_length", "depth", "labels", "hyphens", "digit_ratio", "entropy", "parameters",
]

#: Rules as (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: Words in a host by which a url is labelled as one to block.
TERMS = [
    "ad", "ads", "adserver", "advert", "bet", "bets", "betting", "bonus", "casino", "cheap", "free", "gambling",
    "jackpot", "loan", "loans", "pharmacy", "pills", "poker", "porn", "promo", "sex", "slots", "track", "tracker",
    "tracking", "viagra", "win", "winner", "xxx",
]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both are empty for null and without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does.

    A rule fits its host and all subdomains of it, if the path starts with the
    rule's. The list is part of the expression and meant to be short.
    """
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        own = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        fits = F.when(own, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def _suffix(host: Column, n: int) -> Column:
    return F.substring_index(host, ".", -n)


def features(urls: DataFrame) -> DataFrame:
    """urls (url, ...) with host, path, the lexical features and the ends of the host added."""
    host, path = parts(F.col("url"))
    split = urls.withColumns({"_url": F.coalesce("url", F.lit("")), "host": host, "path": path})
    count = lambda text, what: F.length(text) - F.length(F.translate(text, what, ""))
    size = F.greatest(F.length("_url"), F.lit(1))
    share = lambda c: (F.length("_url") - F.length(F.replace("_url", c, F.lit("")))) / size
    chars = F.array_distinct(F.split("_url", ""))
    entropy = F.aggregate(
        F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c))
    )
    return split.withColumns(
        {
            "url_length": F.length("_url").cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": count(F.col("path"), "/").cast("double"),
            "labels": count(F.col("host"), ".").cast("double"),
            "hyphens": count(F.col("host"), "-").cast("double"),
            "digit_ratio": count(F.col("_url"), "0123456789") / size,
            "entropy": entropy,
            "parameters": F.size(F.regexp_extract_all("_url", F.lit(r"[?&][^&#]+"), F.lit(0))).cast("double"),
            **{f"end_{n}": _suffix(F.col("host"), n) for n in ENDS},
        }
    ).drop("_url")


@dataclass(frozen=True)
class Filter:
    trees: Model | None  # none if all labels are equal
    constant: str
    suffixes: dict[int, DataFrame]
    share: float


def train(labelled: DataFrame, rows: int = 20_000, rounds: int = 20, depth: int = 4) -> Filter:
    """Trees from about `rows` of labelled (url, block boolean), drawn by a hash of the url.

    The statistics of the suffixes count all labelled rows. A row without a url or label is passed over. In its own row a label does not
    count for the statistics of its suffixes. With one kind of label only, that is
    the verdict everywhere; without labels it is allow.
    """
    usable = labelled.where("url is not null and block is not null").select("url", F.col("block").cast("double").alias("label"))
    n, blocked = usable.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = blocked / n if n else 0.0
    host = parts(F.col("url"))[0]
    hosts = settled(usable.groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.sum("label").alias("sum")))
    ends = {
        k: settled(
            hosts.groupBy(_suffix(F.col("host"), k).alias(f"end_{k}")).agg(
                F.sum("n").alias(f"n_{k}"), F.sum("sum").alias(f"sum_{k}")
            )
        )
        for k in ENDS
    }
    if not 0 < blocked < n:
        return Filter(None, "block" if n and blocked else "allow", ends, share)
    rest = features(sampled(usable, "url", rows, "url"))
    for k in ENDS:
        without = (F.col(f"sum_{k}") - F.col("label") + PRIOR * share) / (F.col(f"n_{k}") - 1 + PRIOR)
        rest = rest.join(ends[k], f"end_{k}").withColumn(f"blocked_{k}", without)
    inputs = VectorAssembler(inputCols=[*LEXICAL, *(f"blocked_{k}" for k in ENDS)], outputCol="_features")
    learner = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=3
    )
    return Filter(learner.fit(settled(inputs.transform(rest).select("_features", "label"))), "", ends, share)


def judge(urls: DataFrame, model: Filter, rules: list[tuple[str, str, str]]) -> DataFrame:
    """urls with host, path, rule and verdict (allow or block) added.

    The verdict is the longest fitting rule's, else that of the trees. A null or
    odd url has empty host and path, no rule, and the trees' verdict. All rows and
    other columns are kept; existing columns of the added names are replaced.
    """
    names = ["host", "path", "rule", "verdict"]
    own = urls.drop(*names)
    row = own.select(F.struct(*own.columns).alias("_row"), F.col("url")) if own.columns else own
    out = features(row)
    if model.trees is None:
        out = out.withColumn("_method", F.lit(model.constant))
    else:
        for k in ENDS:
            out = out.join(model.suffixes[k], f"end_{k}", "left")
            seen = F.coalesce(F.col(f"n_{k}"), F.lit(0)), F.coalesce(F.col(f"sum_{k}"), F.lit(0.0))
            out = out.withColumn(f"blocked_{k}", (seen[1] + PRIOR * model.share) / (seen[0] + PRIOR))
        inputs = VectorAssembler(inputCols=[*LEXICAL, *(f"blocked_{k}" for k in ENDS)], outputCol="_features")
        out = model.trees.transform(inputs.transform(out))
        out = out.withColumn("_method", F.when(F.col("prediction") == 1, "block").otherwise("allow"))
    fits = ruled(F.col("host"), F.col("path"), rules)
    out = out.withColumn("_rule", fits)
    return out.select(
        *(F.col("_row")[c].alias(c) for c in own.columns),
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_method").alias("verdict"),
    )


def by_terms(urls: DataFrame, terms: list[str] = TERMS) -> DataFrame:
    """(url, block): urls labelled by whether a word of their host is one of the terms."""
    words = F.split(parts(F.col("url"))[0], "[.-]")
    return urls.select("url", F.arrays_overlap(words, F.array(*map(F.lit, terms))).alias("block"))
