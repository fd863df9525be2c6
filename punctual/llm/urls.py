"""URL filters: a rule list, and association rules mined from labelled urls.

The list is by host and path; its longest rule that fits decides. Other urls
are judged by association rules: FP-growth mines combinations of url tokens that
come with a label, and rules of enough support, confidence and lift stay, if
chance can't explain them: the lower bound of the confidence must exceed the
label's share among all urls. An inverted index holds each rule under its rarest
token; a url meets the rules under its tokens, and those wholly contained
compete by confidence.

FP-growth gets whole urls, however many tokens they have, but for what can't
change a verdict: tokens below the support can't be in a rule, tokens that always
come together count as one, and to a token whose urls all have one label no other
token adds anything. Its counts with and without the label give support and
confidence exactly. Itemsets double with each token, so many tokens that are each
common and of both labels, and that come in all combinations, take long.

DataFrame operations alone.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import shuffle_partitions, small, written

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: What no rule says.
DEFAULT = "allow"
#: A rule's urls: least share, and least number; its confidence, and that over the label's share.
SUPPORT, LEAST, CONFIDENCE, LIFT = 0.001, 20, 0.6, 1.1
#: Deviations by which a rule's confidence must exceed the label's share.
SURE = 4.0
LABEL = "label="
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as text, and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, f"{h}{p}").otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, labels of the host, parts of the path with numbers masked, names in the query."""
    path = F.regexp_replace(path_of(url), "[0-9]+", "0")
    named = lambda mark, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    return F.array_distinct(
        F.concat(
            named("scheme:", F.array(F.regexp_extract(url, "^([A-Za-z]*)://", 1))),
            named("host:", F.split(host_of(url), r"\.")),
            named("path:", F.split(path, "/")),
            named("query:", F.regexp_extract_all(F.regexp_replace(url, "#.*$", ""), F.lit("[?&]([^=&]+)"), 1)),
        )
    )


def _bound(share: Column, n: Column, z: float) -> Column:
    """Wilson's lower bound of a share seen in n cases."""
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def mine(labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, least: int = LEAST, sure: float = SURE) -> DataFrame:
    """(token, antecedent, verdict, confidence, support) from (url, label): the rules under their rarest tokens.

    Rows without url or label don't count. ``confidence`` and ``support`` are
    exact. Of tokens that always come together the first stands for all in rules
    of several tokens; rules that add tokens to one which alone is always of one
    label are left out.
    """
    return _mined(labels, support, confidence, lift, least, sure)[0]


def _mined(labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, least: int = LEAST, sure: float = SURE) -> tuple[DataFrame, DataFrame]:
    """``mine``, and (token, first): which token stands for it in rules of several tokens, if another does."""
    spark = labels.sparkSession
    rows = labels.where("url is not null and label is not null").select("label", tokens(F.col("url")).alias("tokens"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    shares = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    floor = max(float(least), support * total)
    if total < floor:
        return spark.createDataFrame([], "token string, antecedent array<string>, verdict string, confidence double, support double"), spark.createDataFrame([], "token string, first string")
    base = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(shares.items()) for x in (k, n / total)]), F.col("verdict"))

    # Tokens that enough urls hold; those with the same urls are one, by count and digest of the rows.
    spread = rows.select("row", "label", F.explode("tokens").alias("token"))
    counted = spread.groupBy("token", "label").agg(F.count("*").alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("digest"))
    frequent = counted.groupBy("token").agg(F.sum("n").alias("n"), F.sum("digest").alias("digest")).where(F.col("n") >= floor)
    frequent = written(frequent)
    alike = written(frequent.groupBy("n", "digest").agg(F.min("token").alias("first"), F.collect_list("token").alias("tokens")))
    single = counted.join(small(frequent.select("token", F.col("n").alias("all")), frequent.count()), "token").select(F.array("token").alias("antecedent"), F.col("label").alias("verdict"), F.col("n").alias("both"), "all")
    single = written(single)
    mixed = single.where("both < `all`").select(F.col("antecedent")[0].alias("token")).distinct()
    chosen = written(alike.select(F.col("first").alias("token")).join(mixed, "token", "left_semi"))
    baskets = spread.join(small(chosen, chosen.count()), "token").groupBy("row", "label").agg(F.collect_set("token").alias("own"))
    baskets = written(baskets.select(F.concat("own", F.array(F.concat(F.lit(LABEL), F.col("label")))).alias("items")))
    n, several = baskets.count(), single.where("false")
    if n >= floor:
        # Half a url below the floor: the share is multiplied out again and must not round up past it.
        growth = FPGrowth(itemsCol="items", minSupport=(math.ceil(floor) - 0.5) / n, numPartitions=shuffle_partitions(spark))
        is_label = lambda x: x.startswith(LABEL)
        found = growth.fit(baskets).freqItemsets.select(F.array_sort(F.filter("items", lambda x: ~is_label(x))).alias("antecedent"), F.get(F.filter("items", is_label), F.lit(0)).alias("label"), "freq").where(F.size("antecedent") > 1)
        sums = found.groupBy("antecedent").agg(F.max(F.when(F.col("label").isNull(), F.col("freq"))).alias("all"), F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "freq"))).alias("own"))
        several = written(sums.select("antecedent", "all", F.explode("own").alias("own")).select("antecedent", F.expr(f"substring(own.label, {len(LABEL) + 1})").alias("verdict"), F.col("own.freq").alias("both"), "all"))

    share = F.col("both") / F.col("all")
    rules = single.unionByName(several).where((F.col("both") >= floor) & (share >= confidence) & (share >= lift * base) & (_bound(share, F.col("all"), sure) >= base))
    rules = rules.select("antecedent", "verdict", share.alias("confidence"), (F.col("both") / F.lit(total)).alias("support"))
    rarest = rules.select("*", F.explode("antecedent").alias("token")).join(frequent.select("token", "n"), "token").groupBy("antecedent", "verdict", "confidence", "support").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    rules = written(rarest.select("token", "antecedent", "verdict", "confidence", "support"))
    used = rules.where(F.size("antecedent") > 1).select(F.explode("antecedent").alias("first")).distinct()
    others = alike.select("first", F.explode("tokens").alias("token")).where("token <> first").join(used, "first", "left_semi")
    return rules, written(others.select("token", "first"))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, **options: float) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url); ``labels``: (url, label).

    A null url, or one without ``://``, has empty host and path. Where no listed
    and no mined rule fits, the verdict is ``allow``. Of mined rules the surest
    wins, then the best supported, then ``block``. Rows that repeat a page are
    judged alike; other columns are ignored.
    """
    url, host, path = F.col("url"), host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = listed(host, path, rules)
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("listed"))
    mined, others = _mined(labels, **options)
    open_ = rows.where("rule is null and url is not null").select("url", tokens(url).alias("tokens"))
    if n := others.count():
        # Rules of several tokens hold for each token that the one they name stands for.
        firsts = open_.select("url", F.explode("tokens").alias("token")).join(small(others, n), "token").groupBy("url").agg(F.collect_set("first").alias("firsts"))
        open_ = open_.join(firsts, "url", "left").select("url", F.array_union("tokens", F.coalesce("firsts", F.array().cast("array<string>"))).alias("tokens"))
    met = open_.select("url", "tokens", F.explode("tokens").alias("token")).join(small(mined, mined.count()), "token")
    fits = met.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = fits.groupBy("url").agg(F.max(F.struct("confidence", "support", "verdict"))["verdict"].alias("mined"))
    best = written(best)
    out = rows.join(small(best, best.count(), best.agg(F.coalesce(F.sum(F.octet_length("url") + 32), F.lit(0))).first()[0]), "url", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit(DEFAULT)).alias("verdict"))


def labels_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label): a page is labelled like the document of its id, ``block`` if that is toxic or of quality 0."""
    bad = F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)) == 1
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.when(bad, "block").otherwise("allow").alias("label"))
    return pages.select("page_id", "url").join(one, "page_id").select("url", "label")
