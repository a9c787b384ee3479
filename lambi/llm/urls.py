"""URL verdicts: host and path rules, then a logistic model on hashed n-grams (operator 10)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path prefix) of the query; a rule fits its host and all its subdomains.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Small labelled table the model is trained on: (url, 1 = block).
LABELLED = [
    ("http://www.casino-bonus.win/slots/free-spins.html", 1), ("http://cheap-pills.top/buy/viagra-online", 1), ("https://track.adserver.click/banner?id=3", 1),
    ("http://xxx-videos.cam/watch/hot/123", 1), ("https://free-download.warez.pw/crack/keygen.exe", 1), ("http://bet.poker-online.win/bonus/casino", 1),
    ("http://ads.popunder.click/redirect/offer", 1), ("https://replica-watches.shop.top/cheap/buy-now", 1), ("http://torrent.crackz.pw/download/serial", 1),
    ("https://loan-payday.biz/apply/cash-fast", 1), ("http://spam.mailer.click/unsubscribe/offer", 1), ("http://adult-chat.cam/live/sex", 1),
    ("https://www.university.example.edu/research/papers/12", 0), ("https://docs.library.example.org/guide/index.html", 0), ("https://blog.garden.example.com/fr/2021/roses", 0),
    ("https://news.city.example.net/en/4821", 0), ("https://en.encyclopedia.example.org/wiki/Moon", 0), ("http://museum.example.com/de/sammlung/77.html", 0),
    ("https://m.weather.example.com/en/today", 0), ("https://blog.kitchen.example.org/es/sopa/9", 0), ("https://school.example.net/en/lessons/3/", 0),
    ("http://history.example.org/fr/archives/1804.html", 0), ("https://code.example.com/en/reference/strings", 0), ("https://health.example.net/de/ratgeber/21", 0),
]
#: At most so many labelled rows are used for the fit, those with the smallest md5 of their url.
FIT_ROWS = 20_000
FEATURES = 1 << 14
GRAMS = (3, 4)
BLOCK_AT = 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://``. Only A-Z are lower-cased."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def rule_name(host: str, path: str) -> str:
    """A rule as the query writes it: host and path without a doubled slash."""
    return host + path


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, h, p = rule
    return ((host == h) | host.endswith(f".{h}")) & path.startswith(p)


def _runs(letters: Column, n: int) -> Column:
    """All runs of n characters of an array of characters: the array joined with itself, shifted, so
    that a text costs as many steps as it has characters."""
    m = F.greatest(F.size(letters) - (n - 1), F.lit(0))
    out = F.slice(letters, F.lit(1), m)
    for i in range(1, n):
        out = F.zip_with(out, F.slice(letters, F.lit(i + 1), m), lambda a, b: F.concat(a, b))
    return out


def _grams(text: Column) -> Column:
    """Character n-grams of a text that begins and ends with a mark."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.concat(*(_runs(letters, n) for n in GRAMS))


def _features(df: DataFrame) -> DataFrame:
    framed = lambda mark, c: F.concat(F.lit(mark), F.lower(c), F.lit(mark))
    grams = df.withColumn("grams", F.concat(_grams(framed("^", F.col("host"))), _grams(framed("$", F.col("path")))))
    return HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features", binary=True).transform(grams)


def train_urls(labelled: DataFrame, fit_rows: int = FIT_ROWS):
    """Fit on (url, label); the fit sees at most `fit_rows` rows, chosen by md5 of the url."""
    host, path = split_url(F.col("url"))
    rows = labelled.orderBy(F.md5("url"), "url", "label").limit(fit_rows)
    data = _features(rows.select(F.col("label").cast("double").alias("label"), host.alias("host"), path.alias("path")))
    return LogisticRegression(regParam=0.01, maxIter=50, tol=1e-8).fit(data.select("label", "features").coalesce(1))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, rule, model score and verdict of every row; no shuffle of the pages.

    The longest fitting rule (as written, host and path; then the larger text) decides; without
    one, the model blocks at a probability of 0.5 or more. Rules and model are small constants of
    the plan. A null url, or one without ``://``, has an empty host and path and is judged by the
    model like any other; a very long one is judged whole. Null ids and repeated rows are judged
    row by row, other columns are not read, an empty table gives an empty result.
    """
    model = train_urls(labelled)
    host, path = split_url(F.col("url"))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    parts = base.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(rule_name(*r[1:])), rule_name(*r[1:]))):
        fits = _fits(F.col("host"), F.col("path"), r)
        rule = F.when(fits, rule_name(*r[1:])).otherwise(rule)
        verdict = F.when(fits, r[0]).otherwise(verdict)
    scored = model.transform(_features(parts)).withColumn("score", vector_to_array("probability")[1])
    by_model = F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), F.round("score", 6).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over all pages."""
    labelled = spark.createDataFrame(LABELLED, "url string, label int")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), labelled)
