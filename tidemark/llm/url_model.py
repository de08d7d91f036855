"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule allows and URLs that a rule blocks train one smoothed variable-order Markov
model each. A URL without a rule is judged by the difference of its log-likelihoods, divided by its
length; the threshold is calibrated on trained-out URLs of the rules.

Characters are mapped to 32 symbols, so a model of order k has 32^(k+1) entries whatever the input:
that bound is what makes it a broadcast value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.common import ascii_lower, free_names, staged, with_results

ORDER = 2  # characters of context at most
UNIT = 1_000_000  # log-likelihood differences are whole millionths of a nat, so that sums have one value
BIN = 10_000  # width of a bin of scores while the threshold is looked for, in millionths
CALIBRATION = 5  # one in so many rule-decided URLs calibrates instead of training
_RADIX = 32
# Symbols of the models: letters, one for digits, dot, slash, hyphen, one for all others; "@" fills the start.
_FROM = "abcdefghijklmnopqrstuvwxyz0123456789./-"
_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "[" * 10 + "\\]^"


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    name: str  # host, then path from its first slash on

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.name.partition("/")[2]


RULES = (
    UrlRule("allow", "com/"),
    UrlRule("block", "example.com/en/"),
    UrlRule("allow", "www.example.com/en/"),
    UrlRule("block", "net/es/"),
    UrlRule("block", "net/fr/"),
)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """Name of the longest rule that fits host (or a parent domain) and the start of the path; else null."""
    found = F
    for rule in sorted(rules, key=lambda rule: (-len(rule.name), rule.name)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        found = found.when(fits & path.startswith(rule.path), F.lit(rule.name))
    return found if rules else F.lit(None).cast("string")


def held(url: Column) -> Column:
    """Whether a URL calibrates instead of training; decided by its digest."""
    return F.conv(F.substring(F.md5(F.coalesce(url, F.lit(""))), 1, 4), 16, 10).cast("int") % CALIBRATION == 0


def symbols(url: Column) -> Column:
    """The URL after ``://`` (or all of it) as a string over the 32 symbols."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", "")
    return F.translate(F.regexp_replace(ascii_lower(rest), r"[^a-z0-9./-]", "_"), _FROM, _TO)


def grams(urls: DataFrame, order: int) -> DataFrame:
    """Counts per class of every run of ``order + 1`` symbols (starts are filled up), as its base-32 number."""
    filled = F.concat(F.lit("@" * order), F.col("symbols"))
    cut = urls.filter(F.length("symbols") > 0).select("accepted", filled.alias("filled"))
    runs = cut.select(
        "accepted",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("filled") - order), lambda at: F.substring(F.col("filled"), at, F.lit(order + 1))
            )
        ).alias("run"),
    )
    counted = runs.groupBy("run").agg(
        F.count_if("accepted").alias("n_accepted"), F.count_if(~F.col("accepted")).alias("n_rejected")
    )
    code = sum(
        (F.ascii(F.substring("run", i + 1, 1)) - 64) * _RADIX ** (order - i) for i in range(order + 1)
    )
    return counted.select(code.cast("long").alias("code"), "n_accepted", "n_rejected")


def smoothed(spark: SparkSession, counts: DataFrame, order: int) -> DataFrame:
    """Log-likelihood difference (accepted less rejected) of every symbol after every context.

    Interpolated from the empty context up to the longest: a context that was seen n times with
    t different symbols keeps n / (n + t) for its own counts and leaves t / (n + t) to the context
    that is one symbol shorter, down to equal chances. Unseen contexts so fall back to the longest seen one.
    """
    classes = ("accepted", "rejected")
    chances = {name: F.lit(1.0 / _RADIX) for name in classes}
    table = spark.range(_RADIX ** (order + 1)).withColumnRenamed("id", "code")
    for width in range(order + 1):
        size = _RADIX ** (width + 1)
        level = (
            counts.groupBy((F.col("code") % size).alias("short"))
            .agg(*[F.sum(f"n_{name}").alias(f"n_{name}") for name in classes])
            .withColumn("context", F.floor(F.col("short") / _RADIX))
        )
        context = Window.partitionBy("context")
        for name in classes:
            level = level.withColumn(f"all_{name}", F.sum(f"n_{name}").over(context))
            level = level.withColumn(f"kinds_{name}", F.count_if(F.col(f"n_{name}") > 0).over(context))
        own = level.select("short", *[F.col(f"n_{name}").alias(f"own_{name}") for name in classes])
        totals = level.select(
            "context", *[f"{part}_{name}" for name in classes for part in ("all", "kinds")]
        ).distinct()
        table = (
            table.withColumn("short", F.col("code") % size)
            .withColumn("context", F.floor(F.col("short") / _RADIX))
            .join(own, "short", "left")
            .join(totals, "context", "left")
        )
        for name in classes:
            seen, kinds = F.coalesce(F.col(f"all_{name}"), F.lit(0)), F.coalesce(F.col(f"kinds_{name}"), F.lit(0))
            mixed = (F.coalesce(F.col(f"own_{name}"), F.lit(0)) + kinds * chances[name]) / (seen + kinds)
            table = table.withColumn(f"chance_{name}", F.when(seen > 0, mixed).otherwise(chances[name]))
        table = table.select("code", *[f"chance_{name}" for name in classes])
        chances = {name: F.col(f"chance_{name}") for name in classes}
    ratio = F.round((F.log("chance_accepted") - F.log("chance_rejected")) * UNIT).cast("long")
    return table.select("code", ratio.alias("ratio"))


def model_value(spark: SparkSession, urls: DataFrame, order: int) -> Column:
    """The model as one constant array in the order of the codes.

    Its ``32^(order + 1)`` numbers pass through the driver; that number does not depend on the input.
    """
    ratios = smoothed(spark, staged(grams(urls, order), "url-grams"), order)
    listed = [str(row["ratio"]) for row in ratios.orderBy("code").collect()]
    return F.split(F.lit(",".join(listed)), ",").cast("array<bigint>")


def score(model: Column, text: Column, order: int) -> Column:
    """Mean log-likelihood difference per symbol, in whole millionths; 0 for nothing to judge."""
    start = F.struct(F.lit(0).cast("long").alias("code"), F.lit(0).cast("long").alias("total"))

    def step(model: Column, seen: Column, symbol: Column) -> Column:
        code = (seen["code"] * _RADIX + F.ascii(symbol) - 64) % _RADIX ** (order + 1)
        return F.struct(code.alias("code"), (seen["total"] + F.get(model, code.cast("int"))).alias("total"))

    total = F.aggregate(F.split(text, ""), start, lambda seen, symbol: step(model, seen, symbol), lambda seen: seen["total"])
    return F.when(F.length(text) == 0, F.lit(0).cast("long")).otherwise(F.floor(total / F.length(text)).cast("long"))


def threshold(scored: DataFrame) -> Column:
    """The score from which on URLs are allowed: least sum of both error rates on the calibration URLs.

    Scores are counted in bins, whose number is bounded by the range of the scores. Ties take the
    lowest threshold; 0 if one of the classes is missing.
    """
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rates = bins.select(
        "bin",
        F.coalesce(F.sum("accepted").over(below), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("rejected").over(below), F.lit(0)).alias("caught"),
        F.sum("accepted").over(everything).alias("n_accepted"),
        F.sum("rejected").over(everything).alias("n_rejected"),
    ).filter((F.col("n_accepted") > 0) & (F.col("n_rejected") > 0))
    gain = F.col("caught") / F.col("n_rejected") - F.col("lost") / F.col("n_accepted")
    best = rates.agg(F.max_by(F.col("bin") * BIN, F.struct(gain, -F.col("bin")))).first()[0]
    return F.lit(best or 0)


def judge_urls(
    pages: DataFrame, url: str = "url", rules: tuple[UrlRule, ...] = RULES, order: int = ORDER
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` (millionths of a nat per symbol) and ``verdict``.

    A null URL, or one without ``://``, has an empty host and path, so no rule; a URL without a
    symbol to judge scores 0. Verdicts without a rule: allow from the calibrated threshold on. Without
    rule-decided URLs of both classes the threshold is 0. Repeated URLs are judged alike and train as often as
    they stand there; an empty table stays empty. Other columns pass through; input
    columns named like a result give way.
    """
    spark = pages.sparkSession
    host, path = host_of(F.col(url)), path_of(F.col(url))
    ruled = with_results(pages, {"host": host, "path": path})
    ruled = with_results(ruled, {"rule": matching_rule(F.col("host"), F.col("path"), rules)})
    allowed = [rule.name for rule in rules if rule.verdict == "allow"]
    decided = ruled.filter(F.col("rule").isNotNull()).select(
        F.col("rule").isin(allowed).alias("accepted"),
        symbols(F.col(url)).alias("symbols"),
        held(F.col(url)).alias("held"),
    )
    model = model_value(spark, decided.filter(~F.col("held")), order)
    calibration = decided.filter(F.col("held")).select("accepted", score(model, F.col("symbols"), order).alias("score"))
    least = threshold(calibration)
    (letters,) = free_names(ruled, "_symbols")
    judged = with_results(ruled.withColumn(letters, symbols(F.col(url))), {"score": score(model, F.col(letters), order)})
    by_rule = F.when(F.col("rule").isin(allowed), "allow").otherwise("block")
    by_model = F.when(F.col("score") >= least, "allow").otherwise("block")
    return with_results(judged, {"verdict": F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_model)}).drop(letters)
