"""URL filter: rules first, then logistic regression on hashed character n-grams.

Host and path are cut out of the URL, the longest rule that fits decides, and a URL
no rule fits is judged by a logistic regression on the n-grams of its host and path.
The regression is trained from a small labelled URL table: ``labelled_sample`` takes
at most ``SAMPLE`` allowed and as many blocked URLs among those a rule decides, by the
order of a hash, so the table is the same on every run and no larger on larger
input. Everything is DataFrame work and Spark's own ML library; the judged rows need
no shuffle and the model is one vector of ``FEATURES`` weights.

Defined results
* A null URL, or one without ``://``, has an empty host and path; no rule fits.
* A rule ``host/path`` fits its host and all subdomains if the URL's path starts with
  the rule's path, slash included; the longest rule wins, and of two equally long
  ones the first in the order of their text.
* If no rule decides any URL, all are allowed; if all decided ones agree, the rest
  follows them.
* Repeated rows are judged alike; extra columns are passed on, those named as a
  result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import column, others, packed

#: Labelled URLs of each verdict that the regression is trained on, at most.
SAMPLE = 2000
#: Buckets of the hashed n-grams, and the lengths of these.
FEATURES = 1 << 14
LENGTHS = (3, 4)
#: Rules are part of each task's expression, so there may only be so many.
MOST_RULES = 1000
RESULT = ["host", "path", "rule", "verdict", "score"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``host/path`` and its verdict, ``allow`` or ``block``."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.text.partition("/")
        inside = (host == F.lit(own)) | host.endswith("." + own)
        return inside & path.startswith(slash + rest)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def by_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits, else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = rule.fits(host, path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def marker(mark: str) -> Callable[[Column], Column]:
    return lambda gram: F.concat(F.lit(mark), gram)


def with_grams(df: DataFrame) -> DataFrame:
    """Adds ``grams``, the character n-grams of host and path, marked by where they stand.

    The text is cut into characters once and Spark ML's sliding windows run over these: an
    expression that takes substrings in a loop would walk a long text once per place.
    """
    marked = []
    for mark, text in (("h", F.concat(F.lit("^"), "host", F.lit("$"))), ("p", F.concat("path", F.lit("$")))):
        df = df.withColumn(f"chars_{mark}", F.split(text, ""))
        for n in LENGTHS:
            df = NGram(n=n, inputCol=f"chars_{mark}", outputCol=f"grams_{mark}{n}").transform(df)
            marked.append(F.transform(f"grams_{mark}{n}", marker(mark)))
    return df.withColumn("grams", F.concat(*marked))


def hashed(df: DataFrame) -> DataFrame:
    tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    return tf.transform(with_grams(df)).select(*[column(c) for c in df.columns], "features")


def judged_by_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    host, path = host_and_path(column("url"))
    cut = pages.select(packed(pages).alias("row"), host.alias("host"), path.alias("path"))
    rule, verdict = by_rule(rules, F.col("host"), F.col("path"))
    return cut.select("*", rule.alias("rule"), verdict.alias("ruled"))


def labelled_sample(ruled: DataFrame) -> DataFrame:
    """Host, path and label of at most SAMPLE URLs of each verdict, spread by hash.

    The order takes the page's id into account: a URL with a third of all rows gets
    a third of the sample, not all of it. Nothing else of a page is read.
    """
    order = F.xxhash64("host", "path", F.col("row.page_id"))
    picked = [
        ruled.where(F.col("ruled") == verdict)
        .select("host", "path", F.lit(label).alias("label"), order.alias("order"))
        .orderBy("order", "host", "path")
        .limit(SAMPLE)
        for verdict, label in (("allow", 0.0), ("block", 1.0))
    ]
    return picked[0].unionByName(picked[1]).select("host", "path", "label")


def train(labelled: DataFrame) -> LogisticRegressionModel | str:
    """A model from rows of host, path and label (1: block), or the only verdict they hold."""
    small = labelled.coalesce(1).cache()
    try:
        seen = [row["label"] for row in small.select("label").distinct().orderBy("label").limit(2).collect()]
        if len(seen) < 2:
            return "block" if seen == [1.0] else "allow"
        learner = LogisticRegression(maxIter=40, regParam=0.01, featuresCol="features", labelCol="label")
        return learner.fit(hashed(small))
    finally:
        small.unpersist()


def filter_urls(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None) -> DataFrame:
    """Adds host, path, rule, verdict and score (of block; null if no model is needed).

    ``labelled`` holds host, path and label; without it the rules label the URLs.
    """
    ruled = judged_by_rule(pages, rules)
    model = train(labelled_sample(ruled) if labelled is None else labelled)
    if isinstance(model, str):
        scored = ruled.select("*", F.lit(None).cast("double").alias("score"), F.lit(model).alias("judged"))
    else:
        # The last digits follow the order in which gradients are added.
        score = F.round(vector_to_array("probability")[1], 6)
        scored = (
            model.transform(hashed(ruled))
            .select("row", "host", "path", "rule", "ruled", score.alias("score"))
            .withColumn("judged", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
        )
    kept = [F.col("row")[c].alias(c) for c in others(pages, RESULT)]
    return scored.select(
        *kept, "host", "path", "rule", F.coalesce("ruled", "judged").alias("verdict"), "score"
    )
