"""URL filter: rules first, gradient-boosted trees on lexical features for the
rest (DataFrame functions and Spark ML, no Python on the executors).

A rule is a host and a path prefix (``example.org/es/``); it fits its host and
all subdomains where the URL's path starts with the rule's, and the longest rule
that fits decides.  All other URLs are judged by trees trained on labelled URLs:
length, depth, digit ratio, character entropy, parameter counts, host form, and
statistics of the host's suffix (its last label) over the labelled URLs.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import let
from quire.llm import rows
from quire.operators.ranking import bounded_broadcast
from quire.session import materialize

ALLOW, BLOCK = "allow", "block"
#: Trees are fitted to at most so many labelled URLs, those with the smallest hashes.
MAX_LABELLED = 50_000
TREES, DEPTH, SEED = 20, 4, 7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty without ``://`` and for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of ``rules`` ((verdict, rule) pairs) that fits, or null; of
    rules as long the first in order of the text."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, _, rest = rule.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith("/" + rest)
        found = F.when(fits, rule).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character of the text's characters."""

    def of(found: Column) -> Column:
        total = F.aggregate(found, F.lit(0), lambda a, r: a + r["n"])
        return let(total, lambda n: F.aggregate(found, F.lit(0.0), lambda a, r: a - r["n"] / n * F.log2(r["n"] / n)))

    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return let(rows.runs(F.array_sort(characters)), of)


def _count(text: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


FEATURES = ["length", "depth", "digit_ratio", "entropy", "parameters", "labels", "hyphens", "host_length", "host_digits", "secure", "suffix_blocked", "suffix_seen"]


def lexical(url: Column, host_: Column, path_: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)^[^?#]*+\?([^#]*+)", 1)
    return {
        "length": F.length(url),
        "depth": _count(path_, "/"),
        "digit_ratio": _count(url, "0-9") / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(url),
        "parameters": F.when(query == "", 0).otherwise(_count(query, "&;") + 1),
        "labels": F.when(host_ == "", 0).otherwise(_count(host_, ".") + 1),
        "hyphens": _count(host_, "-"),
        "host_length": F.length(host_),
        "host_digits": _count(host_, "0-9"),
        "secure": F.lower(F.left(url, F.lit(6))) == "https:",
    }


def _suffix(host_: Column) -> Column:
    return F.substring_index(host_, ".", -1)


class UrlModel:
    """Trees and suffix statistics fitted to ``labelled(url, blocked)``.

    Suffix statistics are those of all distinct labelled URLs; trees are fitted to
    at most ``most`` of them.  Without any the model allows every URL; with one
    label only it gives that label."""

    def __init__(self, labelled: DataFrame, most: int = MAX_LABELLED):
        known = labelled.where("url IS NOT NULL AND blocked IS NOT NULL").groupBy("url").agg(F.max(F.col("blocked").cast("int")).alias("label"))
        known = materialize(known, "labelled")
        seen = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
        self.only = ALLOW if seen[1] == 0 else BLOCK if seen[1] == seen[0] else None
        if self.only:
            return
        self.share = seen[1] / seen[0]
        # a little more than ``most`` are under the threshold, so no task sorts many more
        below = min(1.0, (most + 10 * math.sqrt(most) + 100) / seen[0])
        held = known.where(F.xxhash64("url") <= min((1 << 63) - 1, int(below * (1 << 64)) - (1 << 63)))
        chosen = materialize(held.orderBy(F.xxhash64("url"), "url").limit(most), "chosen")
        stats = known.groupBy(_suffix(host(F.col("url"))).alias("suffix"))
        self.stats = materialize(stats.agg(((F.sum("label") + 10 * self.share) / (F.count(F.lit(1)) + 10)).alias("suffix_blocked"), F.log1p(F.count(F.lit(1)).cast("double")).alias("suffix_seen")), "suffixes")
        self.assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        inputs = self.assembler.transform(self._features(chosen, "url")).select("features", F.col("label").cast("double").alias("label"))
        self.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(inputs)

    def _features(self, df: DataFrame, url: str) -> DataFrame:
        cut = df.withColumns({"h": host(F.col(url)), "p": path(F.col(url))})
        found = cut.withColumns({n: c.cast("double") for n, c in lexical(F.col(url), F.col("h"), F.col("p")).items()} | {"suffix": _suffix(F.col("h"))})
        met = found.join(bounded_broadcast(self.stats), "suffix", "left")
        return met.fillna({"suffix_blocked": self.share, "suffix_seen": 0.0})

    def verdicts(self, df: DataFrame, url: str) -> DataFrame:
        """``df`` (columns ``row`` and ``url``) with the column ``judged``."""
        if self.only:
            return df.withColumn("judged", F.lit(self.only))
        found = self.trees.transform(self.assembler.transform(self._features(df, url)))
        return found.select(*df.columns, F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW).alias("judged"))


def filter_urls(pages: DataFrame, url_col: str, rules: list[tuple[str, str]], keep: dict[str, Column], labelled: DataFrame | None = None, most: int = MAX_LABELLED) -> DataFrame:
    """One row per row of ``pages``: the columns of ``keep``, ``host``, ``path``,
    ``rule`` (null without one), ``verdict`` (``allow`` or ``block``: the rule's,
    else the model's).

    ``labelled(url, blocked)`` trains the model; by default the URLs that rules
    decide are the labelled ones.  A null URL, or one without ``://``, has an
    empty host and path and no rule.  Equal URLs get equal verdicts.  An empty
    table gives no rows.  ``keep`` must not use the names above.
    """
    verdict_of = {rule: verdict for verdict, rule in rules}
    verdict = F.lit(None).cast("string")
    for rule, said in verdict_of.items():
        verdict = F.when(F.col("rule") == rule, said).otherwise(verdict)
    held = pages.select(F.struct(*(c.alias(n) for n, c in keep.items())).alias("row"), F.col(url_col).alias("url"))
    cut = held.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    ruled = cut.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("said", verdict)
    if labelled is None:
        labelled = ruled.where("said IS NOT NULL").select("url", (F.col("said") == BLOCK).alias("blocked"))
    judged = UrlModel(labelled, most).verdicts(ruled, "url")
    out = judged.select("row", "host", "path", "rule", F.coalesce("said", "judged").alias("verdict"))
    return out.select(*(F.col("row")[n].alias(n) for n in keep), "host", "path", "rule", "verdict")
