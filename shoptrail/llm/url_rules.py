"""URL filters: a sort-merge range join of canonical keys with nested rules.

Hosts are turned around label by label and closed by a dot (``blog.example.org`` becomes
``org.example.blog.``), so "this host and its subdomains" is an interval of keys: those that begin
with the rule's key. Behind the host part, a path prefix is an interval in the same way. Such
intervals are nested or apart, never crossing. Keys and rules are laid out in one order over many
tasks; each rule brings the stack of rules that are open where it starts; a key takes the stack of
the last rule before it and keeps what really reaches it. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail.llm.common import cut_lineage

ALLOW, BLOCK = "allow", "block"


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Empty for null or without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(_behind_scheme(url), "#", 1))
    host = F.regexp_extract(rest, "\\A([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """From behind the host to the next ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(_behind_scheme(url), "\\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _behind_scheme(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url)))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def _with_stacks(rules: DataFrame) -> DataFrame:
    """(key) to (key, stack): all rule keys that the key begins with, its own included.

    Only prefixes as long as some rule are tried: the lengths in use are a set no larger than the
    longest key, pre-aggregated before it is gathered.
    """
    size = F.length("key")
    lengths = [row[0] for row in rules.select(size.alias("n")).distinct().orderBy("n").collect()]
    tried = rules.select(
        "key", F.explode(F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= size)).alias("n")
    ).withColumn("open", F.substring("key", F.lit(1), F.col("n")))
    real = tried.join(rules.select(F.col("key").alias("open")), "open", "left_semi")
    return real.groupBy("key").agg(F.collect_list("open").alias("stack"))


def sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Add to each distinct ``points.key`` the array ``found`` of rule keys that it begins with.

    ``points`` and ``rules`` have one row per key. The rows are laid out by ranges of the key, in
    partitions as even as the keys are distinct; the layout is checkpointed, as its boundaries come
    from a sample. A partition takes over the last stack of the partitions before it: one small row
    per partition.
    """
    spark = points.sparkSession
    stacked = _with_stacks(rules.select("key").distinct())
    events = points.select("key", F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("stack"))
    events = events.unionByName(stacked.select("key", F.lit(0).alias("kind"), "stack"))
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = events.repartitionByRange(slices, "key", "kind").withColumn("slice", F.spark_partition_id())
    laid = cut_lineage(laid)
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = laid.groupBy("slice").agg(
        F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack")
    ).select("slice", F.last("stack", ignorenulls=True).over(before).alias("carried"))
    sorted_slice = Window.partitionBy("slice").orderBy("key", "kind")
    swept = laid.withColumn(
        "open", F.last("stack", ignorenulls=True).over(sorted_slice.rowsBetween(Window.unboundedPreceding, 0))
    ).where("kind = 1")
    # As many rows as there are shuffle partitions.
    swept = swept.join(F.broadcast(carried), "slice", "left")
    reaching = F.filter(F.coalesce("open", "carried"), lambda rule: F.col("key").startswith(rule))
    return swept.select("key", F.coalesce(reaching, F.array().cast("array<string>")).alias("found"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to pages.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains, where the url's
    path begins with the rule's path. The longest rule (host and path together) wins, of equally
    long ones the one with the longer host; a rule given twice with different verdicts blocks. A page
    that no rule fits gets ``otherwise`` and a null rule. Rules with a null or empty host are
    ignored; a null rule path is empty. Columns of ``pages`` with the four names are replaced; null,
    broken, empty and repeated urls are judged like any others.

    Distinct hosts are swept first, then the distinct (rule host, path) keys of urls whose host has
    rules. Pages meet the verdicts of their (host, path) in a join that adaptive execution splits
    where one url is very frequent.
    """
    pages = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": url_host(F.col(url)), "path": url_path(F.col(url))}
    )
    path = F.coalesce("path", F.lit(""))
    rules = (
        rules.where("host is not null and host != ''")
        .groupBy(host_key(F.lower("host")).alias("host_key"), path.alias("path"))
        .agg(F.max("verdict").alias("verdict"), F.lower(F.min("host")).alias("rule_host"))
        .withColumn("key", F.concat("host_key", "path"))
    )
    urls = pages.select("host", "path").distinct()
    hosts = urls.select(host_key(F.col("host")).alias("key")).distinct()
    by_host = sweep(hosts, rules.select(F.col("host_key").alias("key")).distinct())
    by_host = by_host.where(F.size("found") > 0)
    # A host may have very many urls, so both sides are dealt out over parts of it.
    parts = 32
    part = F.pmod(F.xxhash64("path"), F.lit(parts))
    spread = by_host.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    points = (
        urls.withColumns({"host_key": host_key(F.col("host")), "part": part})
        .join(spread.withColumnRenamed("key", "host_key"), ["host_key", "part"])
        .select("host", "path", F.explode("found").alias("rule_host"))
        .withColumn("key", F.concat("rule_host", "path"))
    )
    swept = sweep(points.select("key").distinct(), rules.select("key"))
    fitting = swept.where(F.size("found") > 0).select("key", F.explode("found").alias("rule_key"))
    # Of a key's rules only those of the very rule host it was made for fit: a deeper host's rule is
    # reached by that host's own key.
    best = (
        points.join(fitting, "key")
        .join(rules.withColumnRenamed("key", "rule_key").select("rule_key", "host_key", "rule_host", F.col("path").alias("rule_path"), "verdict").withColumnRenamed("rule_host", "name"), "rule_key")
        .where("host_key = rule_host")
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct(F.concat("name", "rule_path").alias("rule"), "verdict"),
                F.struct(F.length(F.concat("name", "rule_path")), F.length("name")),
            ).alias("best")
        )
        .select("host", "path", "best.*")
    )
    return pages.join(best, ["host", "path"], "left").select(
        *pages.columns, "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )
