"""URL filters: domain rules, and a logistic regression for all other URLs.

A rule names a host and the start of a path; it fits the host and all its
subdomains, and the longest rule that fits decides.  URLs without a rule are
judged by logistic regression on hashed character n-grams of host and path,
trained on the small labelled table below.

Defined results: a null URL, or one without ``://``, has an empty host and
path, no rule, and is judged by the model on no n-grams.  Repeated rows, null
ids and extra columns are kept as they are.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii

#: FIXED VALUES: the rules, (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]

#: FIXED VALUES: labelled URLs, to block and to allow.
BLOCKED = """
https://spam-farm.example.net/en/win-money
http://spam-farm.test/offers
http://casino-bonus.test/play
https://www.casino-royal.test/slots?free=1
http://online-casino.test/jackpot/spin
https://poker-win.test/bonus
http://bet365-tips.test/odds
https://sports-betting.test/win-big
http://free-xxx.test/video/1
https://adult-cams.test/live
http://hot-sex-dates.test/join
https://porn-tube.test/watch
http://xxx-movies.test/hd
https://cheap-viagra.test/buy
http://pills-online.test/order/cialis
https://pharma-discount.test/viagra-cheap
http://replica-watches.test/rolex
https://cheap-replica-bags.test/shop
http://payday-loan-now.test/apply
https://quick-cash-loans.test/approve
http://crypto-doubler.test/invest
https://bitcoin-profit.test/get-rich
http://free-iphone-winner.test/claim
https://you-won-prize.test/claim-now
http://lottery-winner.test/claim
https://warez-download.test/crack
http://keygen-crack.test/serial
https://torrent-free.test/crack/full-version
http://malware-host.test/setup.exe
https://secure-login-verify.test/account/update
http://paypa1-verify.test/login
https://click-here-offer.test/promo
http://link-farm.test/seo/backlinks
https://buy-backlinks.test/seo-cheap
http://seo-spam.test/buy-links
https://miracle-diet-pills.test/lose-weight-fast
""".split()
ALLOWED = """
https://en.encyclopedia.test/wiki/History
https://www.encyclopedia.test/wiki/Mathematics
https://news.daily.test/2023/05/world/story
http://blog.garden.test/en/tomatoes
https://m.weather.test/en/forecast
https://docs.library.test/guide/install
https://www.university.test/research/physics
http://museum.test/collections/paintings
https://cooking.test/recipes/bread
https://travel.test/fr/paris
https://www.health.test/articles/sleep
http://science.test/en/825
https://blog.music.test/de/concert
https://shop.books.test/en/novels
https://forum.python.test/questions/42
http://m.sports.test/en/football/results
https://city.test/es/transport
https://www.school.test/courses/algebra
https://blog.nature.test/en/960
http://tions.sample.test/en/4421
https://m.thered.sample.test/es/533
https://blog.tionand.sample.test/en/17?page=2
http://thher.sample.test/de/2769
https://ther.sample.test/fr/10035
https://heren.sample.test/en/728
https://m.andth.sample.test/en/853
http://code.test/projects/readme
https://www.gallery.test/photos/2020
https://film.test/reviews/drama
http://parliament.test/debates/2019
https://court.test/decisions/77
https://bank.test/en/about
https://hospital.test/departments
http://theatre.test/programme
https://garden.test/plants/roses
https://blog.history.test/en/rome
https://a.test/
http://sample.test
https://www.sample.test/en/9705.html
https://tether.sample.test/en/46410/
https://shations.sample.test/fr/14232
http://enther.sample.test/es/20479?page=2&ref=x
https://heat.sample.test/de/50884?utm_source=feed
https://onesh.sample.test/en/32?utm_source=feed
http://m.reston.sample.test/en/1
https://blog.stands.sample.test/en/51029#top
http://ention.sample.test/de/30840/
https://thanda.sample.test/fr/825.html
https://weather.test/
http://www.station.test/es/7
https://archive.test/2001/01/02/report.html
https://shop.garden.test/products/12
https://the.test/index.html
http://sh.test/a/b/c
https://library.test/catalogue?id=5
https://www.inheritance.test/en/7200/
https://nation.test/politics/election
http://lists.test/archive/2004-March
https://mail.test/help
https://tool.test/download/manual.pdf
""".split()
DIMENSIONS, SIZES, THRESHOLD = 1 << 14, (2, 3, 4), 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def with_parts(pages: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    return pages.select("page_id", host.alias("host"), path.alias("path"))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    null = F.lit(None).cast("string")
    return (null, null) if rule is None else (rule, verdict)


def _grams(text: Column, n: int, mark: str) -> Column:
    last = F.char_length(text) - n + 1
    grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                        lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
    return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))


def char_ngrams(host: Column, path: Column) -> Column:
    """Character n-grams of ``^host^`` and of the path, marked apart."""
    texts = (("h:", F.concat(F.lit("^"), host, F.lit("^"))), ("p:", F.lower(path)))
    return F.concat(*[_grams(text, n, mark) for mark, text in texts for n in SIZES])


def train(spark: SparkSession, blocked: list[str] = BLOCKED, allowed: list[str] = ALLOWED) -> PipelineModel:
    rows = [F.struct(F.lit(u).alias("url"), F.lit(label).alias("label"))
            for urls, label in ((blocked, 1.0), (allowed, 0.0)) for u in urls]
    host, path = host_and_path(F.col("url"))
    table = spark.range(1, numPartitions=1).select(F.inline(F.array(*rows))).select(
        "label", host.alias("host"), path.alias("path")).select("label", char_ngrams(F.col("host"), F.col("path")).alias("grams"))
    return Pipeline(stages=[
        HashingTF(numFeatures=DIMENSIONS, binary=True, inputCol="grams", outputCol="features"),
        LogisticRegression(maxIter=30, regParam=0.01, standardization=False, featuresCol="features",
                           labelCol="label")]).fit(table)


def judge(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) of every page."""
    parts = with_parts(pages).withColumn("grams", char_ngrams(F.col("host"), F.col("path")))
    scored = model.transform(parts)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    score = vector_to_array("probability")[1]
    return (scored.withColumn("block_score", score)
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("block_score") >= THRESHOLD, "block").otherwise("allow")).alias("verdict"),
                    "block_score"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), train(spark))
