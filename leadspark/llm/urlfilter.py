"""URL verdicts: host and path rules, and for the rest a logistic regression on hashed character n-grams.

Built from DataFrame functions and ``pyspark.ml`` only; no Python runs on the
executors. The model is trained from a small labelled URL table that is written
by kind (adverts, adult, drugs, link spam, gambling, phishing, fraud) and shares
no row or host with a table it judges.

Edge cases: a null url, or one without ``://``, has an empty host and path and
gets the model's verdict on them; repeated urls get equal verdicts; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM_SIZES = (3, 4, 5)
FEATURES = 1 << 16
REG_PARAM = 0.002


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path, as in ``example.com/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


#: Labelled URLs the model learns from, written for it and by kind; none is taken from a table it judges. Blocked kinds:
BLOCKED = {
    "adverts": (
        "https://ads.example.org/serve/banner/881", "http://adserver.example.net/track/click/4", "https://ad-tracking.example.org/pixel/19",
        "https://track-ads.example.net/en/52", "http://www.ads-click.example.com/de/7#top", "https://m.ads-media.example.org/fr/310",
        "https://popup-ads.example.net/es/66.html", "http://tracker.example.org/beacon?id=4", "https://adtrack.example.com/en/905",
        "https://banner-click.example.net/fr/14", "http://free-banners.example.com/de/230",
    ),
    "adult": (
        "https://xxx-video.example.net/watch/7", "http://hot-xxx.example.org/video/19", "https://adult-video.example.com/en/44",
        "http://www.adult-cams.example.net/de/12", "https://m.adult-chat.example.org/fr/8?ref=x", "https://blog.sexy-adult.example.net/es/73",
        "https://porn-tube.example.org/en/6.html", "http://x-adult.example.com/en/281",
    ),
    "drugs": (
        "https://pills-online.example.org/order/9", "http://buy-pills.example.net/fr/31", "https://www.cheap-tablets.example.com/en/12",
        "https://diet-pills.example.org/de/77.html", "http://m.discount-pills.example.net/en/450?page=2", "https://cheap-pharmacy.example.org/es/4",
        "https://cheap-viagra.example.net/buy/3#top", "http://blog.pills-shop.example.com/fr/60", "https://slim-tablets.example.net/de/19",
    ),
    "link spam": (
        "https://link-farm.example.org/en/18", "http://spam-links.example.net/fr/93", "https://seo-farm.example.com/en/520",
        "http://www.spam-blog.example.org/de/41#top", "https://content-farm.example.net/es/5", "https://blog.spam-mail.example.org/en/64",
        "http://spamfarm.example.com/en/301/", "https://m.spam-posts.example.net/en/88?ref=x",
    ),
    "gambling": (
        "http://casino-bonus.example.net/en/6", "https://www.best-casino.example.org/play/3", "https://poker-win.example.org/bonus/44",
        "https://casino-slots.example.com/de/9#top", "http://bet-win.example.net/en/712", "https://win-jackpot.example.org/fr/5",
        "http://www.poker-room.example.com/de/27", "https://online-poker.example.net/fr/480",
    ),
    "phishing": (
        "http://secure-login-verify.example.net/account/update", "https://account-verify.example.org/login/confirm", "http://bank-login.example.com/verify/id",
        "https://paypa1-secure.example.net/signin", "http://verify-wallet.example.org/unlock/8", "https://login-update.example.com/password/reset",
        "http://verify-account.example.com/fr/6", "https://www.bank-verify-id.example.org/de/39",
    ),
    "fraud": (
        "http://free-money.example.net/now/1", "https://win-money.example.org/free/prize", "https://payday-loans.example.org/apply/9",
        "https://replica-watches.example.net/shop/2", "http://cheap-watches.example.org/buy/71", "https://warez-crack.example.net/download/8",
        "http://crack-serial.example.org/keygen/3", "https://fast-cash-loans.example.com/en/14",
        "http://www.easy-money.example.com/fr/88", "https://free-cash.example.org/de/125",
    ),
}
#: Kinds that stay.
ALLOWED = {
    "news": (
        "http://news.example.org/en/2024/05/report.html", "https://www.dailypost.example.net/en/412", "https://m.herald.example.com/de/31#top",
        "https://gazette.example.org/fr/65.html", "https://weather.example.org/forecast/8", "https://blog.tribune.example.net/es/978?page=2&ref=x",
    ),
    "knowledge": (
        "https://www.library.example.org/catalog/17", "https://university.example.org/physics/lecture/4", "http://museum.example.net/de/ausstellung/12",
        "https://wiki.example.net/en/history", "https://docs.example.net/guide/install", "https://www.archive.example.com/en/853/",
        "https://history.example.org/de/41", "http://theatre.example.net/en/25#top",
    ),
    "daily life": (
        "https://health.example.org/en/nutrition/22", "https://recipes.example.net/es/sopa/5", "http://travel.example.org/fr/paris",
        "https://garden.example.com/en/676", "https://www.music.example.net/en/148.html", "https://m.school.example.org/de/300?page=2",
        "https://blog.cycling.example.net/en/59", "http://cooking.example.org/fr/825?page=2&ref=x",
    ),
    "technology": (
        "https://code.example.net/project/readme", "https://forum.example.org/en/thread/7", "https://www.software.example.com/en/685",
        "http://blog.developer.example.net/de/847", "https://m.network.example.org/es/12/",
    ),
    "made-up names": (
        "https://www.zentora.example.org/en/728?utm_source=feed", "http://velmika.example.net/fr/31", "https://blog.ortheon.example.com/en/9/",
        "https://m.brenthal.example.org/de/204#top", "http://thornshire.example.net/es/50", "https://lathenia.example.com/en/318.html",
        "https://www.tharion.example.org/fr/77", "https://blog.therano.example.net/en/461", "http://anthesia.example.org/en/2", "https://whenton.example.net/de/190",
        "https://www.example.org/", "https://monterra.example.com/de/17", "http://blog.cheswell.example.com/en/402.html", "https://rivenna.example.com/fr/9?page=2",
    ),
    "places and nature": (
        "https://www.harbour.example.com/en/17", "http://lakes.example.com/de/402.html", "https://mountain-hut.example.com/fr/9", "https://blog.forest.example.org/en/33",
        "https://riverside.example.net/es/71", "https://m.island.example.com/en/208?page=2&ref=x", "https://city-tours.example.com/de/5#top", "http://birds.example.net/fr/640",
    ),
    "work and offices": (
        "https://www.townhall.example.com/de/12", "https://engineering.example.com/en/9?ref=x", "http://clinic.example.com/fr/31.html", "https://blog.carpenter.example.net/en/73",
        "https://m.railways.example.com/es/8", "https://jobs.example.com/en/415#top", "https://architects.example.org/de/2", "http://statistics.example.com/en/90?page=2",
    ),
    "arts and games": (
        "https://www.orchard-choir.example.com/en/6", "https://cinema.example.com/fr/52", "http://blog.painting.example.com/de/118?page=2&ref=x", "https://chorus.example.net/en/27",
        "https://m.football.example.com/es/350.html", "https://boardgames.example.com/en/64#top", "https://poetry.example.org/fr/4", "https://checkers.example.com/de/81",
    ),
    "science and learning": (
        "https://www.biology.example.com/en/19", "https://chemistry.example.com/de/77?ref=x", "http://mathematics.example.com/fr/3.html", "https://blog.astronaut.example.com/en/240",
        "https://m.geology.example.net/es/16#top", "https://kindle-readers.example.com/en/58", "https://grammar.example.com/de/9?page=2", "https://college.example.org/en/701",
    ),
}
#: A labelled table of up to so many bytes of urls is trained on in one task, which a table this small is fastest in.
ONE_TASK_BYTES = 8 << 20


def labelled(spark: SparkSession) -> DataFrame:
    """(url, label) of the table above; label 1 is block."""
    rows = [F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for y, kinds in ((1.0, BLOCKED), (0.0, ALLOWED)) for us in kinds.values() for u in us]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...], value: str = "text") -> Column:
    """The text or verdict of the longest rule that fits, or null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, getattr(r, value)) if out is None else out.when(fits, getattr(r, value))
    return F.lit(None).cast("string") if out is None else out


def _grams_of(s: Column, kind: str) -> Column:
    """Character n-grams of one part, marked with the part and its bounds."""
    marked = F.concat(F.lit("^"), s, F.lit("$"))

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(f"{kind}{n}:"), F.substring(marked, i, F.lit(n))))

    return F.concat(*(of_size(n) for n in GRAM_SIZES))


def grams(host: Column, path: Column) -> Column:
    return F.concat(_grams_of(host, "h"), _grams_of(path, "p"))


def train(urls: DataFrame, features: int = FEATURES) -> PipelineModel:
    """Model from labelled ``urls`` (url, label 1 = block); a table larger than ``ONE_TASK_BYTES`` keeps its partitions. Both classes weigh the same."""
    size, n, bad = urls.agg(F.coalesce(F.sum(F.octet_length("url")), F.lit(0)), F.count("label"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    weight = F.when(F.col("label") == 1, n / max(2 * bad, 1)).otherwise(n / max(2 * (n - bad), 1))
    parts = urls.select("label", weight.alias("class_weight"), grams(host_of(F.col("url")), path_of(F.col("url"))).alias("grams"))
    return Pipeline(
        stages=[
            HashingTF(inputCol="grams", outputCol="gram_counts", numFeatures=features, binary=True),
            LogisticRegression(featuresCol="gram_counts", weightCol="class_weight", probabilityCol="block_probability", predictionCol="block_vote", rawPredictionCol="block_margin", regParam=REG_PARAM, maxIter=60, standardization=False),
        ]
    ).fit(parts.coalesce(1) if size <= ONE_TASK_BYTES else parts)


def judge(pages: DataFrame, rules: tuple[Rule, ...], labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, the rule that fits, the verdict, and the model's probability where no rule fits."""
    u = F.col("url").cast("string")
    parts = pages.select("page_id", host_of(u).alias("host"), path_of(u).alias("path"))
    host, path = F.col("host"), F.col("path")
    ruled = parts.withColumn("rule", matching_rule(host, path, rules)).withColumn("by_rule", matching_rule(host, path, rules, "verdict"))
    # urls with a rule need no n-grams
    todo = ruled.withColumn("grams", F.when(F.col("rule").isNull(), grams(host, path)).otherwise(F.array().cast("array<string>")))
    p = vector_to_array("block_probability")[1]
    return train(labels).transform(todo).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(p >= threshold, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), p).alias("p_block"),
    )
