"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

Everything that touches the URLs is a DataFrame or SQL expression. The model is fitted on a small labelled table by Spark's own
logistic regression; its weights, of a fixed number, become one constant array in the scoring expression, so scoring is a single
scan without shuffle, join or broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepanel.llm.common import with_fields

# What the contract blocks and allows. A rule is a host, then the beginning of a path.
RULES: tuple[tuple[str, str], ...] = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# The small labelled table: names of sites by kind, and the forms in which a name becomes a URL.
UNWANTED = (
    "casino casino-royal win-casino online-casino poker-win lucky-slots mega-jackpot free-spins bets best-bets bet-free sports-bets betting-tips "
    "pills pills-cheap cheap-viagra cheap-meds pharmacy-discount diet-pills spam spam-mail link-farm farm-links seo-spam content-farm "
    "adult adult-video xxx-tube x-videos porn-free sex-cams hot-dating ads ad-server ads-click ad-track track-clicks tracker pixel-track "
    "popup-ads win-prizes free-money cheap-loans quick-cash crypto-win free-download crack-serials warez-files"
).split()
ORDINARY = (
    "news morning-herald weather-report town-library city-museum university physics-department school-garden science-journal history-archive "
    "cooking-notes bread-recipes travel-stories mountain-hiking bird-watching chess-club music-lessons guitar-forum film-reviews book-shelf "
    "gardener-almanac open-source linux-help python-docs data-tables maps-project health-clinic hospital dentist law-review parliament "
    "ministry election-results train-timetable bicycle-repair house-building furniture painting-class photography astronomy telescope "
    "geology river-survey ocean-life animal-shelter veterinary kindergarten poetry theatre orchestra the-reader nation-post other-thoughts"
).split()
FORMS = ("https://www.{}.example.com/en/17", "http://{}.example.org/fr/204.html", "https://blog.{}.example.net/de/5/?page=2", "http://m.{}.example.com/es/91#top")


@dataclass(frozen=True)
class Model:
    """Weights of the hashed n-grams, and the intercept."""

    weights: tuple[float, ...]
    intercept: float
    sizes: tuple[int, ...]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table, ``url`` and ``label`` (1: block), made of the names and forms above."""
    rows = [(form.format(name), label) for names, label in ((UNWANTED, 1), (ORDINARY, 0)) for name in names for form in FORMS]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {y}.0D)" for u, y in rows) + " AS t(url, label)")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` and for null."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (equal lengths: the smallest) and its verdict; null where none does."""
    name = verdict = None
    for rule, say in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + start)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, say) if verdict is None else verdict.when(fits, say)
    return (F.lit(None).cast("string"),) * 2 if name is None else (name, verdict)


def ngram_slots(host: str, path: str, sizes: Sequence[int], slots: int) -> Column:
    """Distinct slots of the n-grams of two columns; a n-gram of the host and the same one of the path are two features."""
    parts = []
    for mark, column in (("h", host), ("p", path)):
        padded = f"concat('<', {column}, '>')"
        for n in sizes:
            parts.append(
                f"transform(sequence(1, greatest(1, length({column}) + {3 - n})), i -> pmod(xxhash64('{mark}', substr({padded}, i, {n})), {slots}))"
            )
    return F.expr(f"array_distinct(concat({', '.join(parts)}))")


def train(
    labelled: DataFrame, slots: int = 1 << 13, sizes: Sequence[int] = (3, 4), penalty: float = 0.003, prior: float = 0.25, rounds: int = 40,
) -> Model:
    """Fit on ``url`` and ``label`` (1: block, 0: allow); rows with a null in either are left out.

    The URLs that are judged later are not touched here. ``prior`` is the share of unwanted URLs to expect. Without rows of both labels the model knows nothing and allows everything.
    """
    known = labelled.where("url is not null and label is not null")
    counts = {r["label"]: r["n"] for r in known.groupBy(F.col("label").cast("double").alias("label")).agg(F.count(F.lit(1)).alias("n")).where("label in (0, 1)").collect()}
    if len(counts) < 2:
        return Model((0.0,) * slots, -1.0, tuple(sizes))
    rows = known.where("label in (0, 1)").select(F.col("label").cast("double").alias("label"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("slots", ngram_slots("host", "path", sizes, slots))
    rows = rows.withColumn("slots", F.col("slots").cast("array<string>"))
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(slots)], inputCol="slots", outputCol="features")
    # Unwanted rows weigh ``prior`` in all, however many there are.
    total = sum(counts.values())
    weight = F.when(F.col("label") == 1, F.lit(prior * total / counts[1.0])).otherwise(F.lit((1 - prior) * total / counts[0.0]))
    data = vectors.transform(rows.withColumn("weight", weight)).select("label", "features", "weight").coalesce(1)
    fitted = LogisticRegression(regParam=penalty, standardization=False, weightCol="weight", maxIter=rounds).fit(data)
    return Model(tuple(float(w) for w in fitted.coefficients), float(fitted.intercept), tuple(sizes))


def judge(urls: DataFrame, model: Model, rules: Sequence[tuple[str, str]] = RULES, column: str = "url", threshold: float = 0.5) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``; columns of these names give way, all others stay.

    ``score`` is the model's chance that the URL is unwanted. ``verdict`` is the rule's where one fits, else ``block`` from ``threshold`` on.
    A null URL, or one without ``://``, has an empty host and path: no rule fits, and the model judges the empty texts. Repeated rows and
    ties are judged alike, an empty table gives an empty one, and a URL of any length is read whole.

    ``rules`` is a short list written into the plan, not a table of millions of hosts.
    """
    out = with_fields(urls, {"host": host_of(F.col(f"`{column}`").cast("string")), "path": path_of(F.col(f"`{column}`").cast("string"))})
    rule, say = rule_of(out["host"], out["path"], rules)
    # The weights stand in the plan once, as text that the optimizer turns into one constant array.
    text = json.dumps([repr(w) for w in model.weights]).replace('"', "")
    slots = ngram_slots("host", "path", model.sizes, len(model.weights))
    out = with_fields(out, {"rule": rule, "_say": say, "_slots": slots, "_weights": F.from_json(F.lit(text), "array<double>")})
    total = F.expr("aggregate(_slots, 0D, (s, i) -> s + _weights[cast(i as int)])")
    out = with_fields(out, {"score": 1 / (1 + F.exp(-(total + F.lit(model.intercept))))})
    verdict = F.coalesce(F.col("_say"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return with_fields(out, {"verdict": verdict}).drop("_say", "_slots", "_weights")
