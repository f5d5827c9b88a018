"""Association-rule filtering of URLs, in DataFrame and SQL operations (Spark's own FP-growth).

Every URL becomes a set of tokens: scheme, the host's last two labels, each further
label and the words of a hyphenated one, path segments that are not numbers, file type
and query keys. The set of a URL whose document has a label gets the label as one more
token. FP-growth mines frequent token sets; those that lead to a label with enough
confidence and lift over the label's share become rules, and a rule that a shorter
rule with at least its confidence already covers is pruned.

Matching. An inverted index holds each rule under its rarest token only. The tokens
of a URL are looked up in it, and the rule's other tokens are tested in the row, so a
token that most URLs have (``https``) has no rules under it unless it is a rule by itself.
The matching rule with the highest confidence decides; equal ones: more support, then
more tokens, then text order.

Listed rules (host and path prefix) come first: a rule fits its host and all
subdomains, and the longest that fits wins.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no
tokens, and is allowed unless a listed rule fits; without labels there are no mined
rules; equal URLs are judged once; repeated rows are reported as often as they occur;
other columns pass.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, fresh, save_shared, table, within

#: (host, path prefix, verdict) of the listed rules.
LISTED = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A token set must occur in so many of the labelled URLs, however many there are, and in this share of them (none).
MIN_SUPPORT, MIN_COUNT = 0.0, 5
#: A rule must be right this often, and this many times as often as its label is given.
MIN_CONFIDENCE, MIN_LIFT = 0.8, 1.05
#: Up to so many rules the index is broadcast; beyond, it is joined by shuffle.
BROADCAST_RULES = 100_000
#: Label tokens; the blank keeps them apart from every URL token.
BAD, GOOD = "label block", "label allow"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def document_of(url: Column) -> Column:
    """Number of the document behind a URL: the last path segment that is a number (before a file type)."""
    return F.regexp_extract(path_of(url), r"(?s)^.*/([0-9]{1,18})(?:\.[a-z]+)?(?:/|$)", 1).try_cast("bigint")


def tokens_of(url: Column) -> Column:
    """The tokens of a URL, each once, sorted."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(F.regexp_replace(path, r"\.[A-Za-z0-9]+$", ""), "/"), lambda s: s != "")
    kind = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    query = F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("(?:^|&)([^=&]+)"), F.lit(1))
    prefixed = lambda p, a: F.transform(a, lambda t: F.concat(F.lit(p), t))
    depth = F.size(labels)
    subs = F.slice(labels, F.lit(1), F.greatest(depth - 2, F.lit(0)))
    parts = F.flatten(F.transform(F.filter(subs, lambda x: x.contains("-")), lambda x: F.split(x, "-")))
    # each fact is one token: redundant tokens would double the frequent sets, not inform them
    every = F.concat(
        F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
        F.array(F.concat(F.lit("site="), F.array_join(F.slice(labels, F.greatest(depth - 1, F.lit(1)), F.lit(2)), "."))),
        prefixed("sub=", subs), prefixed("word=", parts),
        prefixed("path=", F.filter(segments, lambda s: ~s.rlike("^[0-9]+$"))),
        F.when(kind != "", F.array(F.concat(F.lit("type="), kind))).otherwise(F.array().cast("array<string>")),
        prefixed("key=", query))
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(every))).otherwise(F.array().cast("array<string>"))


def mine(urls: DataFrame, labels: DataFrame, scratch: Scratch, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules (tokens, verdict, support, confidence) from ``urls`` (url) and ``labels`` (id, bad: boolean)."""
    one = labels.filter(F.col("id").isNotNull() & F.col("bad").isNotNull()).groupBy("id").agg(F.max("bad").alias("bad"))
    known = (urls.select(document_of(F.col("url")).alias("id"), tokens_of(F.col("url")).alias("tokens")).join(one, "id")
                 .select(F.concat("tokens", F.array(F.when(F.col("bad"), F.lit(BAD)).otherwise(F.lit(GOOD)))).alias("items")))
    known = scratch.save(known, "labelled")
    n = known.count()
    empty = urls.sparkSession.createDataFrame([], "tokens array<string>, verdict string, support bigint, confidence double")
    if not n:
        return empty
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    support = max(min_support, min(1.0, (MIN_COUNT - 0.5) / n))        # Spark rounds support times rows up
    sets = FPGrowth(itemsCol="items", minSupport=support, minConfidence=1.0, numPartitions=parts).fit(known).freqItemsets
    sets = scratch.save(sets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    marks = F.array(F.lit(BAD), F.lit(GOOD))
    whole = sets.filter(F.arrays_overlap("items", marks)).select(
        F.array_except("items", marks).alias("tokens"), F.array_intersect("items", marks)[0].alias("mark"), F.col("freq").alias("hit"))
    share = whole.filter(F.size("tokens") == 0).select("mark", (F.col("hit") / F.lit(n)).alias("share"))
    rules = (whole.filter(F.size("tokens") > 0).join(sets.withColumnRenamed("items", "tokens"), "tokens")
                  .join(F.broadcast(share), "mark")                        # two rows at most
                  .withColumn("confidence", F.col("hit") / F.col("freq"))
                  .filter((F.col("confidence") >= min_confidence) & (F.col("confidence") >= min_lift * F.col("share"))))
    verdict = F.when(F.col("mark") == BAD, "block").otherwise("allow")
    rules = scratch.save(rules.select("tokens", verdict.alias("verdict"), F.col("hit").alias("support"), "confidence"), "rules")
    # pruned: another rule for the same verdict uses fewer of the tokens and is right as often
    token = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("first"))
    short = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("better"),
                         F.element_at("tokens", 1).alias("first"))
    covered = (token.join(short, ["first", "verdict"])
                    .filter((F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)
                            & (F.col("better") >= F.col("confidence"))).select("tokens", "verdict").distinct())
    return rules.join(covered, ["tokens", "verdict"], "left_anti")


def match(urls: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """(url, verdict, tokens, confidence) for every distinct non-null url that a rule matches; the best rule of each."""
    rules = scratch.save(rules, "kept_rules")
    often = rules.select(F.explode("tokens").alias("token")).distinct()
    if within(often, BROADCAST_RULES):
        often = F.broadcast(often)
    listed = scratch.save(urls.filter(F.col("url").isNotNull()).select("url").distinct()
                             .withColumn("own", tokens_of(F.col("url"))), "tokens")
    counts = listed.select(F.explode("own").alias("token")).join(often, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # the rarest token of each rule is where the rule is filed
    filed = (rules.withColumn("token", F.explode("tokens")).join(counts, "token", "left")
                  .groupBy("tokens", "verdict", "support", "confidence")
                  .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    filed = scratch.save(filed, "index")
    if within(filed, BROADCAST_RULES):
        filed = F.broadcast(filed)
    hits = (listed.select("url", "own", F.explode("own").alias("token")).join(filed, "token")
                  .filter(F.size(F.array_except("tokens", "own")) == 0))
    best = F.max(F.struct("confidence", "support", F.size("tokens").alias("k"), F.array_join("tokens", " ").alias("spelled"), "verdict"))
    return hits.groupBy("url").agg(best.alias("best")).select(
        "url", F.col("best.verdict").alias("verdict"), F.col("best.spelled").alias("mined_rule"), F.col("best.confidence").alias("confidence"))


def listed_rule(host: Column, path: Column, rules: tuple = LISTED) -> Column:
    """(rule, verdict) of the longest listed rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):        # a longer one replaces a shorter one
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, labels: DataFrame, url_col: str = "url", rules: tuple = LISTED) -> DataFrame:
    """``pages`` plus (host, path, rule, verdict, mined_rule): see the module."""
    host, path, rule, verdict, mined, key, named = fresh(pages, "host", "path", "rule", "verdict", "mined_rule", "__url", "__listed")
    urls = pages.select(F.col(f"`{url_col}`").alias("url"))
    with Scratch(pages.sparkSession) as scratch:
        matched = save_shared(match(urls, mine(urls, labels, scratch), scratch), "matched")
    matched = matched.select(F.col("url").alias(key), F.col("verdict").alias(verdict), F.col("mined_rule").alias(mined))
    url = F.col(f"`{url_col}`")
    out = pages.withColumns({host: host_of(url), path: path_of(url)}).withColumn(named, listed_rule(F.col(host), F.col(path), rules))
    out = out.join(matched, url == F.col(key), "left")
    return (out.withColumn(rule, F.col(f"{named}.rule"))
               .withColumn(verdict, F.coalesce(F.col(f"{named}.verdict"), F.col(verdict), F.lit("allow")))
               .select(*[F.col(f"`{c}`") for c in pages.columns], host, path, rule, verdict, mined))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 0).alias("bad"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, labels).select("page_id", "host", "path", "rule", "verdict", "mined_rule")
