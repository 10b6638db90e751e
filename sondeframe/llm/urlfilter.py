"""URL filter: host and path rules, else logistic regression on hashed character n-grams.

Native: only DataFrame and SQL functions run on the pages, and the weights reach
them as one folded literal of ``BUCKETS`` doubles.  The model is fitted by Spark's
own LogisticRegression on the labelled table below (a few dozen rows, fixed).

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased.  Path: from there up to ``?``, ``#`` or the end.  A null URL or one
without ``://`` has both empty: no rule fits it and the model judges the empty
string.  A rule ``host/path`` fits its host and all subdomains when the URL's path
starts with the rule's path; the longest wins, ties go to the smaller string.
Null ids and repeated rows are judged like any other row; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (3, 4, 5)
#: Rules are compiled into one literal map; this bounds it.
MAX_RULES = 10_000
#: (rule, verdict)
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))

#: The labelled URL table, 1 = block.
LABELLED = [(u, 1) for u in """
http://casino-royal.example/play/slots
https://www.bestcasino.example/bonus/free-spins
http://online-casino.example/de/roulette
https://poker-stars.example/en/holdem/bonus
http://bet365win.example/sports-betting/odds
https://betting-tips.example/football/bet
http://xxx-videos.example/watch/12345
https://www.pornhub.example/view/xxx
http://freeporn.example/porn/teen
https://adult-cams.example/live/sex
http://sexchat.example/adult/rooms
http://cheap-viagra.example/buy/pills
https://pharmacy-pills.example/viagra/order
http://buycialis.example/pills/no-prescription
https://warez-download.example/crack/keygen
http://cracked-games.example/torrent/download
https://torrentz.example/torrent/movies
http://piratebay.example/torrent/99812
http://ads.tracker.example/click/banner
https://adserver.example/ads/pixel.gif
http://doubleclick-ads.example/banner/ads
https://win-free-iphone.example/lottery/claim
http://lottery-winner.example/claim/prize
https://payday-loans.example/loan/instant-cash
http://fast-cash-loan.example/payday/apply
https://replica-watches.example/shop/rolex-replica
http://fakebags.example/replica/gucci
https://malware-host.example/download/setup.exe
http://phish-login.example/verify/account/password
https://secure-bank-login.example/phish/verify
""".split()] + [(u, 0) for u in """
https://www.university.example/research/papers/2021
http://library.example/catalog/books/history
https://news.example.org/2020/05/science-report
http://www.museum.example/exhibits/ancient-art
https://docs.example.net/guide/install
http://blog.example.com/en/18288
https://m.example.net/fr/42008.html
http://www.example.org/de/70048
https://example.net/en/70089
http://example.com/es/8303?page=2
https://blog.example.org/en/23759
http://m.example.com/de/105883
https://www.weather.example/forecast/tomorrow
http://recipes.example/bread/sourdough
https://school.example/maths/lesson-4
http://health.example/advice/first-aid
https://gov.example/services/passport
http://wiki.example/wiki/Photosynthesis
https://forum.example/thread/10442
http://travel.example/guides/lisbon
https://journal.example/articles/10.1000/182
http://code.example/repo/readme
https://music.example/albums/classical
http://sports.example/results/league
https://magazine.example/culture/film-review
http://garden.example/plants/roses
https://bank.example/help/opening-hours
http://radio.example/programmes/morning
https://photos.example/gallery/mountains
http://charity.example/about/contact
""".split()]  # fmt: skip


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, letters, letters.lower()), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _grams(kind: str, text: Column) -> Column:
    """Hashed n-grams of one part, marked by part, with its ends marked too."""
    text = F.concat(F.lit("^"), text, F.lit("$"))

    def of(n: int) -> Column:
        bucket = lambda i: F.pmod(F.xxhash64(F.lit(kind), text.substr(i, F.lit(n))), F.lit(BUCKETS)).cast("int")
        at = F.sequence(F.lit(1), F.length(text) - (n - 1))
        return F.when(F.length(text) >= n, F.transform(at, bucket)).otherwise(F.array().cast("array<int>"))

    return F.concat(*[of(n) for n in GRAMS])


def features(host: Column, path: Column) -> Column:
    """Distinct buckets of the n-grams of host and path."""
    return F.array_distinct(F.concat(_grams("h", host), _grams("p", path)))


def fit(spark: SparkSession, labelled: Sequence[tuple[str, int]] = LABELLED) -> tuple[float, list[float]]:
    """Intercept and weights from a small labelled table."""
    table = json.dumps([{"url": u, "label": float(y)} for u, y in labelled])
    rows = spark.range(1).select(F.inline(F.from_json(F.lit(table), "array<struct<url:string,label:double>>")))
    host, path = host_and_path(F.col("url"))
    # Grouping keeps the optimiser from moving the n-grams into the lambda below.
    rows = rows.select("url", "label", F.explode(features(host, path)).alias("b")).groupBy("url", "label").agg(F.collect_set("b").alias("b"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.array_contains("b", i).cast("double"))
    rows = rows.select("label", array_to_vector(dense).alias("features")).coalesce(1)
    model = LogisticRegression(regParam=0.001, maxIter=100, standardization=False).fit(rows)
    return float(model.intercept), [float(x) for x in model.coefficients]


@lru_cache(maxsize=4)
def _fitted(spark: SparkSession) -> tuple[float, list[float]]:
    return fit(spark)


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    by_host: dict[str, list[dict]] = {}
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        by_host.setdefault(h.lower(), []).append({"k": -len(rule), "rule": rule, "path": "/" + p, "verdict": verdict})
    quote = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    entries = [
        f"{quote(h)}, array({', '.join('struct(%d as k, %s as rule, %s as path, %s as verdict)' % (r['k'], *map(quote, (r['rule'], r['path'], r['verdict']))) for r in of)})"
        for h, of in by_host.items()
    ]
    known = F.expr(f"map({', '.join(entries)})")
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    found = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(known, s), F.slice(F.element_at(F.map_values(known), 1), 1, 0))))
    return F.get(F.array_sort(F.filter(found, lambda r: F.startswith(path, r["path"]))), F.lit(0))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
    model: tuple[float, list[float]] | None = None, threshold: float = 0.5,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)``; score is the model's probability of block."""
    intercept, weights = model or _fitted(pages.sparkSession)
    w = F.expr("array(" + ", ".join(f"double({x!r}D)" for x in weights) + ")")
    host, path = host_and_path(F.col(url_col))
    df = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    df = df.withColumn("_r", best_rule(F.col("host"), F.col("path"), rules))
    total = F.aggregate(features(F.col("host"), F.col("path")), F.lit(intercept), lambda acc, i: acc + F.get(w, i))
    df = df.withColumn("score", 1 / (1 + F.exp(-total)))
    verdict = F.coalesce(F.col("_r")["verdict"], F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return df.select("page_id", "host", "path", F.col("_r")["rule"].alias("rule"), verdict.alias("verdict"), "score")
