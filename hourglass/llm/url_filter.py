"""URL filters: host and path rules, and a classifier for what they leave.

Method. A rule (host, path prefix) fits a URL of its host or a subdomain whose
path starts with the prefix; the longest fitting rule decides. URLs without a
rule are judged by logistic regression on hashed character n-grams of host and
path. It is trained on a small labelled URL table: at most ``TRAIN_ROWS`` of
the URLs that a rule decides, labelled with its verdict (those with the least
hash of the URL, so the sample does not depend on the order of rows).

Distribution. Splitting, rules and scoring are row-wise and run on every URL in
the JVM; only the bounded training table is gathered.

Cases. A null URL, or one without ``://``, has an empty host and path and no
rule; it is judged like any other (its features are those of empty strings).
Without a labelled URL every verdict of the method is ``allow``; with one class
it is that class. Repeated rows are judged one by one.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DIMENSIONS = 1 << 14
GRAMS = (3, 4, 5)
TRAIN_ROWS = 20_000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    u = F.coalesce(url, F.lit(""))
    shape = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(u, shape, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(u, shape, 2)


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (as ``host/path``) and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def grams(column: Column, mark: str, sizes: tuple[int, ...] = GRAMS) -> Column:
    """Character n-grams of ``^column$``, marked with the part they come from."""
    s = F.concat(F.lit("^"), column, F.lit("$"))
    parts = [F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(s) - (n - 1))), lambda i, n=n: F.concat(F.lit(mark), F.substr(s, i, F.lit(n)))) for n in sizes]
    return F.concat(*parts)


def with_features(df: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    df = df.withColumn("_grams", F.concat(grams(F.col("host"), "h"), grams(F.col("path"), "p")))
    return HashingTF(numFeatures=dimensions, binary=True, inputCol="_grams", outputCol="_features").transform(df).drop("_grams")


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS, dimensions: int = DIMENSIONS):
    """Model for rows (host, path, label 0/1: block); None without rows."""
    some = labelled.orderBy(F.xxhash64("host", "path"), "host", "path").limit(train_rows)
    some = with_features(some.coalesce(1), dimensions).select("_features", F.col("label").cast("double").alias("label")).checkpoint()
    if some.isEmpty():
        return None
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=1e-4, maxIter=40).fit(some)


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row a page: id, host, path, rule, verdict, and ``block_score``, the
    classifier's probability of block (0 without a classifier)."""
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(page_id).alias(page_id), host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("_v"))
    labelled = rows.where("_v is not null").select("host", "path", F.when(F.col("_v") == "block", 1).otherwise(0).alias("label")).distinct()
    model = train(labelled, train_rows)
    if model is None:
        scored = rows.withColumn("block_score", F.lit(0.0))
    else:
        model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_p")
        scored = model.transform(with_features(rows)).withColumn("block_score", F.round(vector_to_array("_p")[1], 6))
    guess = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return scored.select(page_id, "host", "path", "rule", F.coalesce("_v", guess).alias("verdict"), "block_score")
