"""URL filter: two smoothed variable-order Markov models over characters, compared by their length-normalised log-likelihoods.

Native: DataFrame expressions only. URLs that an allow rule decides teach the model of accepted URLs, those that a block rule
decides the model of rejected ones; a URL that no rule decides is judged by the difference of the two, against a threshold
calibrated on a fifth of the ruled URLs that taught nothing.

Defined cases: a null URL, or one without `://`, has empty host and path. A null or empty URL has no characters and the
score 0. Without ruled URLs of both kinds the two models agree, every score is 0 and the threshold is 0: all are allowed.
Repeated rows each give a row. Columns other than `id_col` and `url_col` are left out, so clashing names can't arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import ascii_lower, query, settle, table

#: The rules of the query, as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 3
#: Characters the models tell apart: a digit stands for all digits, `~` for whatever is not listed. 40 symbols, so that the
#: table of contexts and characters has at most 40^4 rows whatever the input: this bounds the broadcast.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0:/.?#&=_-%+~^"
GRID = 0.01


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits the host or a domain above it and starts the path; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def symbols(url: Column) -> Column:
    """The URL over SYMBOLS, with ORDER start marks before it."""
    low = F.translate(ascii_lower(F.coalesce(url, F.lit(""))), "123456789", "000000000")
    return F.concat(F.lit("^" * ORDER), F.regexp_replace(low, r"(?s)[^a-z0:/.?#&=_\-%+]", "~"))


def grams(df: DataFrame, *keep: str) -> DataFrame:
    """One row for each character: `g`, the ORDER characters before it and itself. Expects column `s` of `symbols`."""
    at = F.sequence(F.lit(1), F.length("s") - ORDER)
    listed = F.when(F.length("s") > ORDER, F.transform(at, lambda i: F.substring(F.col("s"), i, F.lit(ORDER + 1))))
    return df.select(*keep, F.explode(listed).alias("g"))


def fit(labelled: DataFrame, seen: DataFrame) -> DataFrame:
    """Log-likelihood ratio `llr` of accepted to rejected for every gram of `seen`. `labelled`: (accepted boolean, s).

    Witten-Bell: a context of length k leaves T / (n + T) of its mass to the context shorter by one, T being its number
    of distinct followers; below the empty context stands the uniform distribution over SYMBOLS.
    """
    # both tables are bounded by the symbols; every level below reads them instead of the pages
    count = settle(grams(labelled, "accepted").groupBy("accepted", "g").agg(F.count("*").alias("n")), "url-counts")
    model = settle(seen, "url-grams")
    for accepted, name in ((True, "a"), (False, "r")):
        own = count.where(F.col("accepted") == F.lit(accepted))
        p: Column = F.lit(1.0 / len(SYMBOLS))
        for k in range(ORDER + 1):
            tail = F.substring("g", ORDER + 1 - k, k + 1)
            level = own.groupBy(tail.alias("w")).agg(F.sum("n").alias("c"))
            context = level.groupBy(F.substring("w", 1, k).alias("h")).agg(F.sum("c").alias("n"), F.count("*").alias("t"))
            level, context = level.select(F.col("w").alias(f"w{name}{k}"), F.col("c").alias(f"c{name}{k}")), context.select(
                F.col("h").alias(f"h{name}{k}"), F.col("n").alias(f"n{name}{k}"), F.col("t").alias(f"t{name}{k}")
            )
            model = model.join(level, tail == F.col(f"w{name}{k}"), "left")
            model = model.join(context, F.substring("g", ORDER + 1 - k, k) == F.col(f"h{name}{k}"), "left")
            n, t, c = F.col(f"n{name}{k}"), F.col(f"t{name}{k}"), F.coalesce(F.col(f"c{name}{k}"), F.lit(0))
            p = F.when(n.isNull(), p).otherwise((c + t * p) / (n + t))
        model = model.select("g", *(c for c in ("p_a",) if c in model.columns), p.alias(f"p_{name}"))
    return model.select("g", (F.log("p_a") - F.log("p_r")).alias("llr"))


def calibrate(scored: DataFrame) -> DataFrame:
    """One row, `threshold`: the cut with the best mean of both kinds' hit rates, halfway between the cells it parts. Scored: (accepted, score)."""
    cell = scored.groupBy(F.floor(F.col("score") / GRID).alias("cell")).agg(
        F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")
    )
    # scores are bounded by log of the smallest probability, so there are a few thousand cells at most
    down = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lost, caught = F.coalesce(F.sum("a").over(down), F.lit(0)), F.coalesce(F.sum("r").over(down), F.lit(0))
    rated = cell.select(
        ((F.col("cell") + F.coalesce(F.lag("cell").over(Window.orderBy("cell")) + 1, F.col("cell"))) / 2 * GRID).alias("cut"),
        (1 - lost / F.greatest(F.sum("a").over(total), F.lit(1)) + caught / F.greatest(F.sum("r").over(total), F.lit(1))).alias("rate"),
        ((F.sum("a").over(total) > 0) & (F.sum("r").over(total) > 0)).alias("both"),
    ).where("both")
    return rated.agg(F.coalesce(F.max_by("cut", F.struct(F.col("rate"), -F.abs("cut"))), F.lit(0.0)).alias("threshold"))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Each row's host, path, rule, score (mean log-likelihood ratio of a character), threshold and verdict."""
    url = F.col(url_col)
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    rows = (
        pages.groupBy(F.col(id_col).alias("page_id"), url.alias("url"))
        .agg(F.count("*").alias("copies"))
        .withColumn("host", url_host(F.col("url")))
        .withColumn("path", url_path(F.col("url")))
        .withColumn("ruled", ruled)
        .withColumn("s", symbols(F.col("url")))
    )
    # a URL that many pages share counts once for the models
    known = rows.where("ruled IS NOT NULL").groupBy("url").agg(F.first("s").alias("s"), (F.first("ruled.verdict") == "allow").alias("accepted"))
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    # only grams, never whole strings, leave this step: the settled table has at most 40^4 rows
    seen = grams(rows).distinct()
    model = settle(fit(known.where(~held), seen), "url-model")
    score = grams(rows, "page_id", "url", "copies", "host", "path", "ruled").join(F.broadcast(model), "g")
    score = score.groupBy("page_id", "url", "copies", "host", "path", "ruled").agg(F.avg("llr").alias("score"))
    # an empty URL has no gram
    none = rows.where(F.length("s") <= ORDER).select("page_id", "url", "copies", "host", "path", "ruled", F.lit(0.0).alias("score"))
    scored = score.unionByName(none)
    probe = score.where(held & F.col("ruled").isNotNull()).groupBy("url").agg(
        F.first("score").alias("score"), (F.first("ruled.verdict") == "allow").alias("accepted")
    )
    threshold = calibrate(probe).first()["threshold"]
    verdict = F.coalesce(F.col("ruled.verdict"), F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block"))
    out = scored.select(
        "page_id", "url", "host", "path", F.col("ruled.rule").alias("rule"), "score", F.lit(threshold).alias("threshold"), verdict.alias("verdict"), "copies"
    )
    return out.withColumn("copies", F.explode(F.expr("sequence(1L, copies)"))).drop("copies")


@query("op3_url_filters")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")
