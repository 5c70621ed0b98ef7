"""URL filter by the ratio of two character language models.

Rules on hosts and path beginnings decide the URLs they fit. From the URLs that
rules allow and those they block, two character models are counted: smoothed
Markov models of variable order, which use two characters of context where they
were seen and fall back to one or none. The other URLs are blocked if their
log-likelihood difference per character (blocked minus allowed model) exceeds a
threshold, calibrated on a fifth of the rule-judged URLs that the models have
not seen.

URLs are spelled in 40 symbols (small letters, one for all digits, marks, one
for the rest), so a model has at most 40**3 entries: a bound by construction,
which makes it safe to broadcast.

Defined results: a null URL or one without ``://`` has an empty host and path;
without text to score (null or empty) or without one of the two classes the
method allows. Repeated rows get equal verdicts. Rows keep their id only, so no
other input column can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import let
from vitalgrid.session import settle

#: (verdict, host, path beginning)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ``^`` stands before the first character, ``0`` for digits, ``~`` for the rest.
SYMBOLS = "^" + LOWER + "0/.-_?=&%#:+~"
REST = len(SYMBOLS) - 1


@dataclass(frozen=True)
class Models:
    #: Weight of the shorter context's estimate, in characters.
    trust: float = 4.0
    #: Every n-th rule-judged URL (by hash) calibrates instead of training.
    calibrate: int = 5
    #: Threshold candidates: differences per character in steps of 1 / grain, within +-most.
    grain: int = 64
    most: int = 8


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict); null if none fits."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _codes(url: Column) -> Column:
    """A URL's symbols as numbers, after two for the beginning."""
    spelled = F.regexp_replace(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), "[0-9]", "0")
    # a character outside the alphabet has place 0; ^ itself counts as such a character
    place = lambda c: F.array_position(F.array(*[F.lit(x) for x in SYMBOLS]), c).cast("int")
    number = lambda c: let(place(c), lambda p: F.when(p <= 1, F.lit(REST)).otherwise(p - 1))
    return F.concat(F.array(F.lit(0), F.lit(0)), F.transform(F.filter(F.split(spelled, "", -1), lambda c: c != ""), number))


def _grams(url: Column) -> Column:
    """Each symbol with the two before it, as one number below 40**3."""
    n = len(SYMBOLS)
    return let(
        _codes(url),
        lambda s: F.when(
            F.size(s) > 2,
            F.transform(F.sequence(F.lit(0), F.size(s) - 3), lambda i: (F.get(s, i) * n + F.get(s, i + 1)) * n + F.get(s, i + 2)),
        ).otherwise(F.array().cast("array<int>")),
    )


def fit(judged: DataFrame, models: Models) -> DataFrame:
    """(gram, llr) for all 40**3 grams from (url, verdict): log p(blocked) - log p(allowed)."""
    n = len(SYMBOLS)
    spark = judged.sparkSession
    counted = judged.select("verdict", F.explode(_grams(F.col("url"))).alias("gram")).groupBy("gram").agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("allow"), F.count(F.when(F.col("verdict") == "block", 1)).alias("block")
    )
    grams = spark.range(n**3).select(F.col("id").cast("int").alias("gram")).join(counted, "gram", "left").na.fill(0, ["allow", "block"])
    grams = grams.withColumn("last", F.col("gram") % n).withColumn("pair", F.col("gram") % (n * n))
    grams = grams.withColumn("before", F.floor(F.col("gram") / n).cast("int")).withColumn("one", (F.floor(F.col("gram") / n) % n).cast("int"))
    both = ["allow", "block"]

    def summed(by: str, name: str) -> DataFrame:
        return grams.groupBy(by).agg(*[F.sum(c).alias(f"{c}_{name}") for c in both])

    wide = grams
    for by, name in (("last", "n1"), ("pair", "n2"), ("one", "c1"), ("before", "c2")):
        wide = wide.join(summed(by, name), by)
    total = grams.agg(*[F.sum(c).alias(c) for c in both]).first()
    k = models.trust

    def log_p(c: str) -> Column:
        none = (F.col(f"{c}_n1") + 1) / F.lit(float(total[c] + n))
        one = (F.col(f"{c}_n2") + k * none) / (F.col(f"{c}_c1") + k)
        return F.log((F.col(c) + k * one) / (F.col(f"{c}_c2") + k))

    return wide.select("gram", (log_p("block") - log_p("allow")).alias("llr"))


def score(rows: DataFrame, model: DataFrame, url: str = "url") -> DataFrame:
    """``rows`` and ``difference``: the mean llr over a URL's symbols (null without any)."""
    keep = rows.columns
    # the number only tells rows apart that are equal in all else, within the one stage that makes it
    spread = rows.withColumn("_row", F.monotonically_increasing_id()).select("*", F.explode_outer(_grams(F.col(url))).alias("gram"))
    return (
        spread.join(F.broadcast(model), "gram", "left")
        .groupBy("_row", *keep)
        .agg(F.avg("llr").alias("difference"))
        .drop("_row")
    )


def threshold(scored: DataFrame, models: Models) -> float:
    """The difference that parts allowed and blocked URLs with the least balanced error."""
    place = F.greatest(F.lit(-models.most * models.grain), F.least(F.lit(models.most * models.grain), F.round(F.col("difference") * models.grain)))
    bins = scored.where("difference IS NOT NULL").groupBy(place.cast("int").alias("at"), "verdict").count().collect()
    counts = {v: {r["at"]: r["count"] for r in bins if r["verdict"] == v} for v in ("allow", "block")}
    total = {v: sum(c.values()) for v, c in counts.items()}
    if not all(total.values()):
        return 0.0
    best, wrong, missed = None, total["allow"], 0
    for at in range(-models.most * models.grain, models.most * models.grain + 1):
        wrong -= counts["allow"].get(at, 0)
        missed += counts["block"].get(at, 0)
        found = (wrong / total["allow"] + missed / total["block"], abs(at), at)
        best = found if best is None or found < best else best
    return (best[2] + 0.5) / models.grain


def filter_urls(
    pages: DataFrame, rules=RULES, models: Models | None = None, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row for each page: the id, host, path, rule, verdict, difference."""
    models = models or Models()
    rows = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"))
    rows = rows.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    rows = rows.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules)).select(
        "_id", "_url", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("verdict")
    )
    judged = rows.where("verdict IS NOT NULL").select(F.col("_url").alias("url"), "verdict")
    trains = F.pmod(F.xxhash64("url"), F.lit(models.calibrate)) != 0
    model = settle(fit(judged.where(trains), models))
    both = judged.where(trains).groupBy("verdict").count().count() == 2
    scored = settle(score(rows, model, "_url"))
    held = scored.where("verdict IS NOT NULL").where(F.pmod(F.xxhash64("_url"), F.lit(models.calibrate)) == 0)
    cut = threshold(held, models) if both else float("inf")
    method = F.when(F.col("difference") > cut, "block").otherwise("allow")
    return scored.select(
        F.col("_id").alias(page_id), "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "difference"
    )
