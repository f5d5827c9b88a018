"""URL rules need the same support on tables of every size."""
from pyspark.sql import functions as F

from sheaf.llm import urlrules as U


def test_rules_of_a_rare_host_on_a_larger_table(spark):
    n = 4000
    host = F.when(F.col("id") < 6, "rare-spam.example.com").otherwise("news.example.org")     # 6 of 4,000: under 0.2%
    labels = spark.range(n).select("id", (F.col("id") < 6).alias("bad"))
    urls = spark.range(n).select(F.concat(F.lit("http://"), host, F.lit("/en/"), F.col("id").cast("string")).alias("url"))
    with U.Scratch(spark) as scratch:
        rules = U.mine(urls, labels, scratch).collect()
    assert any(r.verdict == "block" and r.support == 6 for r in rules)
