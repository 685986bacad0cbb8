"""URL rules by sort-merge range join.

The canonical key of a rule is its host with the labels reversed, then its path. At one host the
urls that a rule fits form an interval of keys, and the intervals of a host nest or are disjoint. A
url takes part at each of its parent hosts that is as short as some rule's, so subdomains are equal
keys, not ranges.

At each host, rules and urls are sorted by path and swept once. A rule carries the stack of rules
that are open when it starts (itself on top): those whose path begins its own. A url takes the stack
of the last rule before it; the topmost entry that begins the url's path is the innermost rule that
fits, because whatever fits the url and starts earlier is open at that rule too. Of the hosts of a
url the longest rule wins.

A host may hold a third of the urls: it is split into as many lots as its share asks for before its
urls are shuffled, and its rules go into each. Equal urls are judged once.

Edge cases: a null url, or one without ``://``, has an empty host and path and fits no rule, as does
a url without a path if the rule has one. Rules that occur twice count once, if they agree; of two
that differ in their verdict only, ``block`` wins. Without rules everything gets the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import UPPER, column, unused

ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url; empty where there is none."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def _reversed(host: Column, labels: Column | None = None) -> Column:
    """The host with its labels reversed; with *labels*, only that many of them."""
    parts = F.reverse(F.split(host, r"\.", -1))
    return F.array_join(parts if labels is None else F.slice(parts, F.lit(1), labels), ".")


def _stacks(rules: DataFrame) -> DataFrame:
    """key, path, stack: the open rules at each rule's start, innermost last."""
    own = rules.select(
        _reversed(F.col("host")).alias("key"), "path", F.concat("host", "path").alias("rule"), F.col("verdict")
    )
    own = own.groupBy("key", "path").agg(F.max(F.struct("verdict", "rule")).alias("v")).select("key", "path", "v.rule", "v.verdict")
    sizes = own.groupBy("key").agg(F.collect_set(F.length("path")).alias("sizes"))
    # Every rule looks up its own beginnings, of the lengths that rules of its host have.
    starts = own.join(sizes, "key").select("key", "path", F.explode("sizes").alias("n")).where(F.col("n") <= F.length("path"))
    starts = starts.select("key", "path", F.expr("left(path, n)").alias("open"))
    opened = own.select("key", F.col("path").alias("open"), F.struct(F.length("path").alias("n"), F.col("path").alias("open"), "rule", "verdict").alias("entry"))
    return starts.join(opened, ["key", "open"]).groupBy("key", "path").agg(F.sort_array(F.collect_list("entry")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """*pages* with host, path, rule and verdict; *rules* has host, path, verdict."""
    spark = pages.sparkSession
    lots_of_all = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    url_host, url_path = host_and_path(column(url_col))
    taken = unused(pages, "_host", "_path")
    named = pages.withColumns({taken[0]: url_host, taken[1]: url_path})
    stacks = _stacks(rules)
    longest = rules.agg(F.max(F.size(F.split("host", r"\.", -1)))).scalar()

    urls = named.select(F.col(taken[0]).alias("host"), F.col(taken[1]).alias("path")).where(F.col(taken[0]) != "").distinct()
    most = F.least(F.size(F.split("host", r"\.", -1)), F.coalesce(longest, F.lit(1)))
    levels = urls.select("host", "path", F.explode(F.sequence(F.lit(1), most)).alias("n"))
    levels = levels.select("host", "path", _reversed(F.col("host"), F.col("n")).alias("key"))

    # Hosts of rules with more than one lot's share of all keys: at most as many as there are lots.
    share = F.ceil(F.col("n") * lots_of_all / levels.agg(F.count("*")).scalar()).cast("int")
    held = levels.groupBy("key").agg(F.count("*").alias("n"))
    hot = held.where(share > 1).select("key", share.alias("lots")).join(stacks.select("key").distinct(), "key", "left_semi")
    hot = F.broadcast(hot)

    lot = F.pmod(F.xxhash64("host", "path"), F.coalesce("lots", F.lit(1))).cast("int")
    dealt = levels.join(hot, "key", "left").withColumn("lot", lot)
    each = F.explode(F.sequence(F.lit(0), F.coalesce("lots", F.lit(1)) - 1)).alias("lot")
    opens = stacks.join(hot, "key", "left").select("key", each, F.lit(0).alias("kind"), "path", F.lit(None).cast("string").alias("host"), "stack")
    points = dealt.join(opens.select("key", "lot").distinct(), ["key", "lot"], "left_semi").select(
        "key", "lot", F.lit(1).alias("kind"), "path", "host", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack")
    )
    sweep = Window.partitionBy("key", "lot").orderBy("path", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = points.unionByName(opens).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fitting = swept.withColumn("top", F.expr("get(reverse(filter(stack, x -> startswith(path, x.open))), 0)"))
    fitting = fitting.where(F.col("top").isNotNull())
    best = F.max(F.struct(F.length("top.rule").alias("n"), F.length("key").alias("k"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict")))
    judged = fitting.groupBy("host", "path").agg(best.alias("best"))
    judged = judged.select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("best.rule").alias("_rule"), F.col("best.verdict").alias("_verdict"))

    joined = named.join(judged, (F.col(taken[0]) == F.col("_h")) & (F.col(taken[1]) == F.col("_p")), "left")
    own = [column(c) for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return joined.select(
        *own,
        F.col(taken[0]).alias("host"),
        F.col(taken[1]).alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.lit(default)).alias("verdict"),
    )
