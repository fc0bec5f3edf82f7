"""URL filter: rules on host and path, and gradient-boosted trees on lexical features where no rule fits.

DataFrame functions and Spark's own boosted trees only. The trees learn from the URLs that a rule decides: those are the labelled
ones. At most about ``MAX_LABELLED`` distinct ones are taken to fit the trees, evenly by the hash of the URL; the rest of the
work covers every row. The suffix statistics count all distinct labelled URLs: one row for each last label of a host, and
for each of those with the first directory of the path. What a URL learns of its suffix leaves out its own suffix and directory, in training as
in judging: labels come from rules, which decide such a group as a whole, so a statistic with the own group would hold the label itself and
say nothing of groups that no rule decides.

A null URL or one without ``://`` has an empty host and path; it is judged by the trees like an empty text. With no
labelled URL, or labels of one kind only, that kind (else "allow") is the verdict of all other rows. Repeated rows
are judged alike; extra columns are kept, but for those named like a result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import scratch_path, stored

MAX_LABELLED = 20_000
FEATURES = ("f_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_labels", "f_dashes", "f_suffix_rate", "f_suffix_count")
KEYS = {"suffix": ["__suffix"], "start": ["__suffix", "__start"]}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return pages.withColumn("host", F.translate(host, _UPPER, _LOWER)).withColumn("path", path)


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
    return host & F.col("path").startswith(rule.path)


def with_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``rule`` and ``rule_verdict``: of the longest rule that fits (of equally long ones the first in order of text)."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    name = F.coalesce(*(F.when(_fits(r), r.text) for r in ordered), F.lit(None).cast("string"))
    verdict = F.coalesce(*(F.when(_fits(r), r.verdict) for r in ordered), F.lit(None).cast("string"))
    return pages.withColumn("rule", name).withColumn("rule_verdict", verdict)


def _count_of(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign)))).cast("double")


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits."""
    n = F.length(text).cast("double")

    def add(total: Column, sign: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, sign))) / n
        return total - share * F.log2(share)

    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), add)).otherwise(0.0)


def _with_keys(urls: DataFrame) -> DataFrame:
    """Add what statistics are kept by: the host's suffix and the first directory of the path."""
    return urls.withColumn("__suffix", F.substring_index("host", ".", -1)).withColumn("__start", F.regexp_extract("path", "^/[^/]*/", 0))


def with_features(pages: DataFrame, statistics: dict[str, DataFrame], url_col: str = "url") -> DataFrame:
    """Add the FEATURES; ``statistics`` as of suffix_statistics. ``pages`` has host and path."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    params = F.when(url.contains("?"), _count_of(url, "&") + 1.0).otherwise(0.0)
    plain = {
        "f_length": F.length(url).cast("double"),
        "f_depth": _count_of(F.col("path"), "/"),
        "f_digits": (F.length(url) - F.length(F.translate(url, "0123456789", ""))) / n,
        "f_entropy": _entropy(url),
        "f_params": params,
        "f_labels": _count_of(F.col("host"), ".") + 1.0,
        "f_dashes": _count_of(F.col("host"), "-"),
    }
    out = _with_keys(pages.withColumns(plain))
    for name, keys in KEYS.items():
        out = out.join(statistics[name], keys, "left").fillna(0.0, [f"__{name}_n", f"__{name}_blocked"])
    others, blocked = (F.col(f"__suffix_{x}") - F.col(f"__start_{x}") for x in ("n", "blocked"))
    out = out.withColumns({"f_suffix_rate": (blocked + 1) / (others + 2), "f_suffix_count": F.log1p(others)})
    return out.drop("__suffix", "__start", *(f"__{name}_{x}" for name in KEYS for x in ("n", "blocked")))


def suffix_statistics(labelled: DataFrame) -> dict[str, DataFrame]:
    """Written tables of (keys, count, number of blocked), a row for each value of the KEYS."""
    tables = {}
    for name, keys in KEYS.items():
        rows = _with_keys(labelled).groupBy(keys).agg(F.count(F.lit(1)).cast("double").alias(f"__{name}_n"), F.sum("label").alias(f"__{name}_blocked"))
        tables[name] = stored(rows, scratch_path(labelled.sparkSession, f"url-{name}"))
    return tables


def labelled_urls(judged: DataFrame, url_col: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(url, host, path, label) of all distinct URLs that a rule decides, and of about ``most`` of them at most, as written tables."""
    rows = judged.where(F.col("rule_verdict").isNotNull()).select(F.col(f"`{url_col}`").alias("url"), "host", "path", (F.col("rule_verdict") == "block").cast("double").alias("label")).distinct()
    rows = stored(rows, scratch_path(judged.sparkSession, "labelled-urls"))
    share = min(1.0, most / max(1, rows.count()))
    return rows, stored(rows.where(F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))), scratch_path(judged.sparkSession, "training-urls"))


def judged_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url_col: str = "url", most_labelled: int = MAX_LABELLED, trees: int = 12, depth: int = 3) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (how likely the trees hold it to be blocked)."""
    pages = pages.drop("host", "path", "rule", "rule_verdict", "verdict", "score", "__suffix", "__start", *FEATURES, *(f"__{name}_{x}" for name in KEYS for x in ("n", "blocked")))
    judged = with_rule(with_host_and_path(pages, url_col), rules)
    labelled, sample = labelled_urls(judged, url_col, most_labelled)
    counts = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked")).first()
    if not counts.n or counts.blocked in (0, counts.n):
        constant = "block" if counts.n and counts.blocked else "allow"
        out = judged.withColumn("score", F.lit(float(constant == "block")))
        return out.withColumn("verdict", F.coalesce("rule_verdict", F.lit(constant))).drop("rule_verdict")
    statistics = suffix_statistics(labelled)
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
    training = vector.transform(with_features(sample, statistics)).select("__features", "label").coalesce(4)
    model = GBTClassifier(featuresCol="__features", labelCol="label", maxIter=trees, maxDepth=depth, seed=7).fit(training)
    model.setPredictionCol("__prediction").setRawPredictionCol("__raw").setProbabilityCol("__probability")
    scored = model.transform(vector.transform(with_features(judged, statistics, url_col)))
    scored = scored.withColumn("score", vector_to_array("__probability")[1])
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).drop("rule_verdict", "__features", "__prediction", "__raw", "__probability", *FEATURES)
