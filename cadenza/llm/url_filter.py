"""Operator 9: URL filter by rules, and by a character language-model ratio where no rule fits. DataFrame functions only.

Rules are (verdict, host, path). A rule fits its host and all subdomains if the URL's path starts with the
rule's; the longest (host and path together) wins. URLs that a rule accepts or rejects train two
variable-order Markov models over the characters of a URL with digits made equal: contexts of 0 to 4
characters, interpolated by Witten-Bell smoothing. A URL's score is the mean over its characters of
the difference of log likelihoods. The cut is calibrated on a fifth of the judged URLs, kept from training:
the score that best separates accepted from rejected ones (by true minus false positive rate), half way to
the next score below it.

All counts cover all URLs. A score depends on the distinct windows of 5 characters only, so the models are
joined to those windows first and then to the positions of the distinct URLs.

A null URL or one without "://" has empty host and path and fits no rule; an empty text's score is 0. If no
URL is accepted or none rejected, there is nothing to compare: scores are then judged by a cut of 0.
Repeated rows stay. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4
#: A window has at most 5 characters and a number: so many take less than 100 MB when broadcast.
BROADCAST_WINDOWS = 1_000_000
BINS = 1000
ALPHABET = 256.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(urls: DataFrame, rules=RULES) -> DataFrame:
    """``urls`` with host, path, rule and ruling (null where no rule fits)."""
    host, path = host_and_path(F.col("url"))
    out = urls.withColumns({"host": host, "path": path})
    fits = F.lit(None).cast("struct<rule:string,ruling:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        here = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        fits = F.when(here, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("ruling"))).otherwise(fits)
    return out.withColumn("fit", fits).withColumns({"rule": F.col("fit.rule"), "ruling": F.col("fit.ruling")}).drop("fit")


def _windows(folded: Column) -> Column:
    padded = F.concat(F.lit("\u0002" * ORDER), folded)
    return F.when(F.length(folded) > 0, F.transform(F.sequence(F.lit(1), F.length(folded)), lambda i: F.substring(padded, i, F.lit(ORDER + 1))))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(window, ratio) from (window, accepted, rejected): the log ratio of its last character's likelihoods."""
    suffix = F.explode(F.transform(F.sequence(F.lit(0), F.lit(ORDER)), lambda k: F.struct(k.alias("k"), F.substring(F.col("window"), ORDER + 1 - k, k + 1).alias("gram"))))
    parts = counts.select("window", "accepted", "rejected", suffix.alias("s")).select("window", "accepted", "rejected", "s.k", "s.gram")
    grams = parts.groupBy("k", "gram").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    grams = grams.withColumn("context", F.substring("gram", F.lit(1), F.col("k")))
    contexts = grams.groupBy("k", "context").agg(F.sum("a").alias("ca"), F.sum("r").alias("cr"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"))
    known = grams.join(contexts, ["k", "context"]).select("k", "gram", "a", "r", "ca", "cr", "ta", "tr")
    row = parts.select("window", "k", "gram").join(known, ["k", "gram"]).groupBy("window").agg(
        *(F.max(F.when(F.col("k") == k, F.struct("a", "r", "ca", "cr", "ta", "tr"))).alias(f"o{k}") for k in range(ORDER + 1))
    )

    def likelihood(n: str, c: str, t: str) -> Column:
        # in each order: (count + kinds * shorter context's) / (context's count + kinds)
        return reduce(
            lambda p, k: F.when(F.col(f"o{k}.{c}") > 0, (F.col(f"o{k}.{n}") + F.col(f"o{k}.{t}") * p) / (F.col(f"o{k}.{c}") + F.col(f"o{k}.{t}"))).otherwise(p),
            range(ORDER + 1),
            F.lit(1.0 / ALPHABET),
        )

    return row.select("window", (F.log(likelihood("a", "ca", "ta")) - F.log(likelihood("r", "cr", "tr"))).alias("ratio"))


def _held_back(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(5)) == 0


def scores(judged: DataFrame) -> DataFrame:
    """(folded, score) for each distinct folded URL of ``judged`` (url, folded, ruling)."""
    learn = F.col("ruling").isNotNull() & ~_held_back(F.col("folded"))
    one = lambda v: F.count_if(learn & (F.col("ruling") == v))
    counts = judged.groupBy("folded").agg(one("allow").alias("accepted"), one("block").alias("rejected"))
    counts = written(counts, "urls")
    exploded = counts.select("folded", "accepted", "rejected", F.explode(_windows(F.col("folded"))).alias("window"))
    ratios = written(log_ratios(exploded.groupBy("window").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))), "ratios")
    if ratios.count() <= BROADCAST_WINDOWS:
        ratios = F.broadcast(ratios)
    return exploded.select("folded", "window").join(ratios, "window").groupBy("folded").agg(F.avg("ratio").alias("score"))


def cut(scored: DataFrame) -> DataFrame:
    """One row with ``cut``: the best separating score of the URLs held back, from counts in bins of a thousandth."""
    back = scored.where(F.col("ruling").isNotNull() & _held_back(F.col("folded")))
    bins = back.groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(F.count_if(F.col("ruling") == "allow").alias("a"), F.count_if(F.col("ruling") == "block").alias("r"))
    everything = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    gain = F.sum("a").over(above) / F.sum("a").over(everything) - F.sum("r").over(above) / F.sum("r").over(everything)
    below = F.lead("bin").over(Window.orderBy(F.col("bin").desc()))
    best = bins.select("bin", gain.alias("gain"), F.coalesce(below, F.col("bin")).alias("below")).where("gain is not null").agg(F.max(F.struct("gain", "bin", "below")).alias("best"))
    return best.select(F.coalesce((F.col("best.bin") + F.col("best.below")) / (2 * BINS), F.lit(0.0)).alias("cut"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of each page."""
    p = ruled(pages.select("page_id", "url"), rules).withColumn("folded", F.translate(F.coalesce("url", F.lit("")), "123456789", "000000000"))
    found = scores(p.select("folded", "ruling"))
    scored = p.join(found, "folded", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    scored = written(scored, "scored")
    verdict = F.coalesce("ruling", F.when(F.col("score") >= F.col("cut"), "allow").otherwise("block"))
    return scored.crossJoin(F.broadcast(cut(scored))).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
