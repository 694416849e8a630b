"""URL filters: longest matching rule first, else a logistic regression on hashed character n-grams.

The regression learns from a small labelled URL table: (url, label), 1 = block. In production the
table is the part of the pages on which a rule decides, bounded to ``max_labelled`` rows (those whose
URL hashes lowest). Everything is DataFrame and Spark ML code that runs in the JVM.

Cases: a null URL, or one without ``://``, has an empty host and path, no rule, and the verdict that
the regression gives to no n-grams at all; without labelled rows, or with labels of one kind only, that
kind (else allow) is the verdict; rows repeat as given; further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.session import reliable_checkpoint

#: Rules of the production query: (verdict, host/path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does. A rule fits its host and all subdomains, on paths that start with its own."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tried first: it is wrapped last
        own_host, slash, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(value: Column, mark: str, sizes) -> list[Column]:
    framed = F.concat(F.lit("\x02"), value, F.lit("\x03"))
    # a look-ahead matches at every place, so the n-grams overlap; one pass each, however long the text
    return [F.transform(F.regexp_extract_all(framed, F.lit(f"(?s)(?=(.{{{n}}}))"), 1), lambda g: F.concat(F.lit(mark), g)) for n in sizes]


def url_features(df: DataFrame, *, features: int, sizes) -> DataFrame:
    """Adds ``features``: hashed n-grams of ``host`` and of ``path``, apart."""
    empty = F.when(F.col("host") == "", F.array().cast("array<string>"))
    grams = F.concat(*[F.coalesce(empty, g) for g in _grams(F.col("host"), "h", sizes)], *[F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(g) for g in _grams(F.col("path"), "p", sizes)])
    return HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="features").transform(df.withColumn("grams", grams)).drop("grams")


def with_host_path(df: DataFrame, url_col: str) -> DataFrame:
    return df.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})


def train(labelled: DataFrame, *, features: int, sizes, max_iter: int, reg: float) -> LogisticRegressionModel | float:
    """A model from (url, label); the constant share of blocked rows where there is nothing to tell apart."""
    rows = reliable_checkpoint(url_features(with_host_path(labelled, "url"), features=features, sizes=sizes).select("features", F.col("label").cast("double").alias("label")))
    seen = rows.agg(F.count("label").alias("n"), F.avg("label").alias("share")).first()
    if not seen.n or seen.share in (0.0, 1.0):
        return seen.share or 0.0
    return LogisticRegression(maxIter=max_iter, regParam=reg, standardization=False).fit(rows)


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, *, rules=RULES, id_col: str = "page_id", url_col: str = "url", max_labelled: int = 2000,
                features: int = 1 << 14, sizes=(2, 3, 4), max_iter: int = 30, reg: float = 1e-3) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, score (the regression's probability of block).

    ``labelled``: (url, label) rows, of which those ``max_labelled`` that hash lowest are used; by default
    the pages on which a rule decides.
    """
    given = with_host_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")), "url")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = given.withColumns({"rule": rule, "by_rule": verdict})
    if labelled is None:
        labelled = judged.where("rule is not null").select("url", (F.col("by_rule") == "block").cast("int").alias("label"))
    sample = labelled.select("url", "label").dropna().distinct().orderBy(F.xxhash64("url"), "url", "label").limit(max_labelled)
    model = train(sample, features=features, sizes=sizes, max_iter=max_iter, reg=reg)
    if isinstance(model, float):
        scored = judged.withColumn("score", F.lit(model))
    else:
        scored = model.transform(url_features(judged, features=features, sizes=sizes)).withColumn("score", vector_to_array("probability")[1])
    own = F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), "score")
