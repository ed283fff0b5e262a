"""URL filters: gradient-boosted trees on lexical features, trained from labelled URLs.

Rules (host, path) give a verdict for the URLs they fit. These URLs are the labels from which the trees learn the verdict of
all others. Features are built-in expressions on the URL itself and counts over its host's suffixes, which
are sums over all labelled URLs in a fixed number of hash buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import lowered
from patronlens.session import materialise


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query (fixed values).
RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)

#: Labelled URLs that the trees are fitted on at most; chosen by the hash of the URL.
MAX_LABELLED = 20_000
SUFFIX_BUCKETS = 4096
SEED = 17


def with_host(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (lower-cased) and ``path``; both are empty without ``://`` or for a null URL."""
    return pages.withColumns(
        {
            "host": F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit("")),
            "path": F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    )


def _fits(rule: UrlRule) -> Column:
    host = F.col("host")
    return ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)


def with_rule(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest fitting rule; null where none fits. Equal lengths: the first listed."""
    ranked = sorted(rules, key=lambda r: -len(r.text))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ranked):
        name = F.when(_fits(rule), F.lit(rule.text)).otherwise(name)
        verdict = F.when(_fits(rule), F.lit(rule.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": name, "rule_verdict": verdict})


def _entropy(text: str) -> str:
    """Entropy in bits of the characters of a text, as SQL: from the lengths that removing each character leaves."""
    n = f"length({text})"
    part = f"(({n} - length(replace({text}, c, ''))) / {n})"
    return f"if({n} = 0, 0D, aggregate(array_distinct(split({text}, '')), 0D, (a, c) -> a - if(c = '', 0D, {part} * log2({part}))))"


#: Lexical features: name and SQL over url, host and path.
LEXICAL = {
    "url_length": "length(_url)",
    "host_length": "length(host)",
    "path_length": "length(path)",
    "depth": "size(filter(split(path, '/'), s -> s <> ''))",
    "host_labels": "size(split(host, '[.]'))",
    "host_hyphens": "length(host) - length(replace(host, '-', ''))",
    "digit_ratio": "length(regexp_replace(_url, '[^0-9]', '')) / greatest(length(_url), 1)",
    "path_digits": "length(regexp_replace(path, '[^0-9]', ''))",
    "host_entropy": _entropy("host"),
    "path_entropy": _entropy("path"),
    "parameters": "length(_query) - length(replace(_query, '=', ''))",
    "has_query": "CAST(_query <> '' AS INT)",
    "has_fragment": "CAST(instr(_url, '#') > 0 AS INT)",
    "is_secure": "CAST(_url LIKE 'https://%' AS INT)",
    "first_segment_length": "length(split(path, '/')[least(1, size(split(path, '/')) - 1)])",
    "ends_in_slash": "CAST(path LIKE '%/' AS INT)",
    "has_extension": "CAST(path RLIKE '[.][A-Za-z0-9]+$' AS INT)",
}

SUFFIXES = {
    "last_label": "regexp_extract(host, '[^.]*$', 0)",
    "last_two_labels": "regexp_extract(host, '([^.]*[.])?[^.]*$', 0)",
    "first_segment": "split(path, '/')[least(1, size(split(path, '/')) - 1)]",
}


def with_lexical(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds the lexical features and the hash bucket of each suffix."""
    pages = pages.withColumn("_url", F.coalesce(F.col(url), F.lit("")))
    pages = pages.withColumn("_query", F.regexp_extract("_url", r"(?s)\?([^#]*)", 1))
    features = {name: F.expr(f"CAST({sql} AS DOUBLE)") for name, sql in LEXICAL.items()}
    buckets = {f"{name}_bucket": F.expr(f"CAST(pmod(xxhash64({sql}), {SUFFIX_BUCKETS}) AS INT)") for name, sql in SUFFIXES.items()}
    return pages.withColumns(features | buckets).drop("_url", "_query")


def suffix_rates(pages: DataFrame, strength: float = 20.0) -> dict[str, list[float]]:
    """For each suffix and bucket the share of block verdicts among labelled URLs, drawn to the overall share.

    At most SUFFIX_BUCKETS numbers for each suffix, so all tasks may hold them.
    """
    labelled = pages.filter(F.col("rule_verdict").isNotNull())
    stacked = labelled.select(
        F.explode(F.array(*[F.struct(F.lit(name).alias("suffix"), F.col(f"{name}_bucket").alias("bucket")) for name in SUFFIXES])).alias("s"),
        (F.col("rule_verdict") == "block").cast("int").alias("blocked"),
    )
    rows = stacked.groupBy("s.suffix", "s.bucket").agg(F.sum("blocked").alias("blocked"), F.count("*").alias("n")).collect()
    first = [r for r in rows if r.suffix == "last_label"]
    overall = sum(r.blocked for r in first) / max(1, sum(r.n for r in first))
    rates = {name: [overall] * SUFFIX_BUCKETS for name in SUFFIXES}
    for r in rows:
        rates[r.suffix][r.bucket] = (r.blocked + strength * overall) / (r.n + strength)
    return rates


def judge(pages: DataFrame, keep: tuple[str, ...] = ("page_id",), url: str = "url", rules: tuple[UrlRule, ...] = RULES, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Columns ``keep`` with host, path, rule, verdict and score (the trees' probability of block; null without trees).

    A null URL and one without ``://`` have empty host and path and are judged by the trees. With labels of one verdict
    only, that verdict holds for all others; with none, 'allow'. Repeated rows are judged alike and all returned. The
    trees are fitted on at most ``max_labelled`` labelled URLs (those with the smallest hash); suffix counts cover all.
    """
    pages = pages.select(*keep, F.col(url).alias("_judged"))
    known = with_lexical(with_rule(with_host(pages, "_judged"), rules), "_judged")
    rates = suffix_rates(known)
    spark = pages.sparkSession
    table = spark.createDataFrame([(name, b, float(r)) for name in rates for b, r in enumerate(rates[name])], "suffix string, bucket int, rate double")
    for name in SUFFIXES:
        rate = table.filter(F.col("suffix") == name).select(F.col("bucket").alias(f"{name}_bucket"), F.col("rate").alias(f"{name}_rate"))
        known = known.join(F.broadcast(rate), f"{name}_bucket", "left")
    columns = [*LEXICAL, *(f"{name}_rate" for name in SUFFIXES)]
    judged = known.select(*keep, "host", "path", "rule", "rule_verdict", *columns, F.xxhash64("_judged").alias("_order"))
    model = _fit(judged, columns, max_labelled)
    if isinstance(model, str):
        out = judged.withColumns({"score": F.lit(None).cast("double"), "_guess": F.lit(model)})
    else:
        predicted = model.transform(VectorAssembler(inputCols=columns, outputCol="_features").transform(judged))
        score = vector_to_array("_probability")[1]
        out = predicted.withColumn("score", score).withColumn("_guess", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return out.select(*keep, "host", "path", "rule", F.coalesce("rule_verdict", "_guess").alias("verdict"), "score")


def _fit(judged: DataFrame, columns: list[str], max_labelled: int) -> GBTClassificationModel | str:
    """The trees, or the verdict that holds for all where the labels know only one."""
    labelled = judged.filter(F.col("rule_verdict").isNotNull())
    sample = materialise(labelled.orderBy("_order").limit(max_labelled).select(*columns, (F.col("rule_verdict") == "block").cast("double").alias("_label")))
    seen = {r[0] for r in sample.select("_label").distinct().collect()}
    if len(seen) < 2:
        return "block" if seen == {1.0} else "allow"
    ready = VectorAssembler(inputCols=columns, outputCol="_features").transform(sample).select("_features", "_label").coalesce(8)
    trees = GBTClassifier(featuresCol="_features", labelCol="_label", predictionCol="_prediction", maxIter=20, maxDepth=4, maxBins=64, stepSize=0.2, seed=SEED)
    return trees.setProbabilityCol("_probability").setRawPredictionCol("_raw").fit(ready)


def digest(pages: DataFrame) -> DataFrame:
    return judge(pages, ("page_id",))
