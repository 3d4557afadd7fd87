"""URL filter: rules for hosts and paths, and gradient-boosted trees for what no rule fits.

The URLs that a rule fits are the labelled ones. Trees learn from a bounded sample of them, on
lexical features: length, depth, share of digits, entropy, number of parameters and the like, and
how often URLs of the same host suffix or first path segment are blocked among all labelled ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.session import stored

# The trees are trained on at most so many different labelled URLs, those of least hash. Where these have one verdict
# only, as many of the other one are added as make a twentieth.
MAX_TRAINING_ROWS = 20_000
TREES = 12
DEPTH = 4
SEED = 11

# A suffix or segment counts as this many URLs of the average share more than it has.
PRIOR_ROWS = 20


@dataclass(frozen=True)
class UrlRule:
    """``allow`` or ``block`` for a host, its subdomains, and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


# The rules of this corpus.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = (
    "f_length",
    "f_host_length",
    "f_path_length",
    "f_labels",
    "f_depth",
    "f_digits",
    "f_host_digits",
    "f_hyphens",
    "f_params",
    "f_fragment",
    "f_secure",
    "f_entropy",
    "f_suffix_rows",
    "f_suffix_blocked",
    "f_head_rows",
    "f_head_blocked",
)


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds host (A-Z in lower case) and path to a table with ``url``; both empty without ``://``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract("rest_", r"^[^/?#]*", 0)
    path = F.regexp_extract(F.expr("substring(rest_, length(host_) + 1)"), r"^[^?#]*", 0)
    parts = pages.withColumn("rest_", F.coalesce(rest, F.lit(""))).withColumn("host_", host).withColumn("path", path)
    return parts.withColumn("host", F.translate("host_", _UPPER, _LOWER)).drop("rest_", "host_")


def with_rule(parts: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """Adds the name and verdict of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = rule.fits(F.col("host"), F.col("path"))
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return parts.withColumn("rule", name).withColumn("rule_verdict", verdict)


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.when(size > 0, -F.aggregate(shares, F.lit(0.0), lambda s, p: s + F.when(p > 0, p * F.log2(p)).otherwise(0.0)))


def _lexical(ruled: DataFrame) -> DataFrame:
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    digits = F.length(F.regexp_replace(url, r"[^0-9]", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return ruled.withColumns(
        {
            "f_length": F.length(url),
            "f_host_length": F.length(host),
            "f_path_length": F.length(path),
            "f_labels": _count(host, ".") + 1,
            "f_depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")),
            "f_digits": F.when(F.length(url) > 0, digits / F.length(url)).otherwise(0.0),
            "f_host_digits": F.length(F.regexp_replace(host, r"[^0-9]", "")),
            "f_hyphens": _count(url, "-"),
            "f_params": F.when(query != "", _count(query, "&") + 1).otherwise(0),
            "f_fragment": (F.instr(url, "#") > 0).cast("int"),
            "f_secure": F.startswith(url, F.lit("https://")).cast("int"),
            "f_entropy": F.coalesce(_entropy(url), F.lit(0.0)),
            "suffix": F.substring_index(host, ".", -1),
            "head": F.coalesce(F.get(F.filter(F.split(path, "/"), lambda s: s != ""), F.lit(0)), F.lit("")),
        }
    )


def _shares(labelled: DataFrame, key: str) -> DataFrame:
    """Per value of ``key`` its labelled rows and their smoothed share of blocked ones."""
    blocked = F.sum((F.col("rule_verdict") == "block").cast("long"))
    counts = labelled.groupBy(key).agg(F.count("*").alias("n"), blocked.alias("blocked"))
    return stored(
        counts.select(
            F.col(key).alias(f"{key}_"),
            F.col("n").alias(f"f_{key}_rows"),
            ((F.col("blocked") + 0.5 * PRIOR_ROWS) / (F.col("n") + PRIOR_ROWS)).alias(f"f_{key}_blocked"),
        ),
        f"url-{key}",
    )


def featured(ruled: DataFrame) -> DataFrame:
    """Adds the features. Statistics are over all labelled rows; unlabelled suffixes and segments count as average."""
    frame = _lexical(ruled)
    labelled = frame.filter("rule_verdict is not null")
    for key in ("suffix", "head"):
        shares = _shares(labelled, key)
        frame = frame.join(shares, frame[key] == shares[f"{key}_"], "left").drop(f"{key}_")
        frame = frame.fillna({f"f_{key}_rows": 0, f"f_{key}_blocked": 0.5})
    return frame


def train(frame: DataFrame):
    """Trees from a bounded sample of the labelled URLs; None where labelled rows have one verdict only."""
    known = frame.filter("rule_verdict is not null").withColumn(
        "label", (F.col("rule_verdict") == "block").cast("double")
    )
    if known.select("label").distinct().count() < 2:
        return None
    urls = known.select("url", "label", *FEATURES).distinct().orderBy(F.xxhash64("url"), "url")
    sample = stored(urls.limit(MAX_TRAINING_ROWS), "url-training")
    labels = [r.label for r in sample.select("label").distinct().collect()]
    if len(labels) < 2:
        other = urls.filter(F.col("label") != labels[0]).limit(max(1, MAX_TRAINING_ROWS // 20))
        sample = sample.union(stored(other, "url-training"))
    sample = sample.coalesce(4)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)


def url_filter(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, p_block.

    ``verdict`` is that of the longest rule that fits, else that of the trees, whose probability of a block is
    p_block. A null url, or one without ``://``, has an empty host and path and no rule. Where labelled rows have
    one verdict only, it is everybody's; without labelled rows all are allowed, and p_block is null in both
    cases. Repeated rows and null ids each give a row; other columns are left out. No rows give none.
    """
    frame = with_rule(with_parts(pages.select("page_id", "url")), rules)
    frame = featured(frame)
    model = train(frame)
    if model is None:
        only = frame.filter("rule_verdict is not null").select("rule_verdict").head()
        judged = frame.withColumn("p_block", F.lit(None).cast("double")).withColumn(
            "guess", F.lit(only[0] if only else "allow")
        )
    else:
        rows = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(frame))
        judged = rows.withColumn("p_block", vector_to_array("probability")[1]).withColumn(
            "guess", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
        )
    verdict = F.coalesce("rule_verdict", "guess").alias("verdict")
    return judged.select("page_id", "host", "path", "rule", verdict, "p_block")
