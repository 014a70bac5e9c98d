"""URL filters by host-suffix and path-prefix expressions.

Method: each URL is expanded into expressions, a suffix of whole host labels
followed by a prefix of the path. Expressions and rules meet in an equi-join on
the first ``PREFIX`` hex digits of their SHA-256 digests; of the rows that meet,
those with equal full digests are confirmed, and of a URL's confirmed rules the
longest wins. Only built-in DataFrame functions are used.

A rule has a host and a path; it fits URLs of its host and all subdomains whose
path starts with the rule's. The expressions of a URL are those of the shapes
(number of host labels, length of the path) that some rule has, so that a URL
of very many labels or path segments costs no more than the list's shapes; the
shapes are as many as pairs of label count and path length, whatever the number
of rules, and depend on the rules only.

Distribution: the rules are broadcast when their number is proven small, else
joined by shuffle from a written table, where adaptive execution splits a
crowded prefix. Each row carries a tag of its own, and the expanded rows of a
tag are merged where they were made before they are shuffled; what is merged is
one number, the precedence: the rule's length, its host's, and whether it blocks.

Edge cases: a null URL, or one without ``://``, has an empty host and path and
fits only rules with both empty. Hosts are compared with A-Z lower-cased, ports
and user names as part of the host; paths as they are. An empty path starts with
no rule's ``/``. Of rules equally long the one with the longer host wins; of
equal ones that differ in verdict, block. Rules with a null host or path count
these as empty; a null verdict blocks; a rule whose path begins with something
else than ``/``, or whose host holds ``/``, ``?`` or ``#``, fits no URL. Rows that repeat are judged each; a null
page_id is kept; other columns are ignored; an empty table gives an empty one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens.llm.shared import materialise, ship
from ridelens.operators._plan import broadcast_if_bounded

#: (verdict, host, path) of the default rules.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: Hex digits of a digest that the join compares: 32 bits.
PREFIX = 8
#: Rules that are broadcast, at most.
BROADCAST_RULES = 100_000
_BITS = 30

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``."""
    return lowered(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def labels_of(host: Column) -> Column:
    """The number of labels of a host; an empty one has none."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    return F.when(host == "", 0).otherwise(dots + 1).cast("int")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """verdict, host and path of a list of rules."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _digested(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path).cast("binary"), 256)


def _prepared(rules: DataFrame) -> DataFrame:
    """One row per distinct rule: its shape, digest, prefix and precedence."""
    host = lowered(F.coalesce(F.col("host"), F.lit("")))
    path = F.coalesce(F.col("path"), F.lit(""))
    rows = rules.select(host.alias("rule_host"), path.alias("rule_path"), (F.coalesce("verdict", F.lit("block")) != "allow").alias("blocks"))
    rows = rows.where(((F.col("rule_path") == "") | F.col("rule_path").startswith("/")) & ~F.col("rule_host").rlike("[/?#]"))
    rows = rows.groupBy("rule_host", "rule_path").agg(F.max("blocks").alias("blocks"))
    length, of_host = F.length(F.concat("rule_host", "rule_path")).cast("long"), F.length("rule_host").cast("long")
    return rows.select(
        labels_of(F.col("rule_host")).alias("labels"),
        F.length("rule_path").alias("path_length"),
        _digested(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"),
        (F.shiftleft(F.shiftleft(length, _BITS) + of_host, 1) + F.col("blocks").cast("long")).alias("precedence"),
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The digests of a URL's expressions of the given shapes."""
    suffix = lambda labels: F.call_function("substring_index", host, F.lit("."), -labels)
    n_labels, n_path = labels_of(host), F.length(path)
    every = F.array(*(F.struct(F.lit(a).alias("labels"), F.lit(b).alias("length")) for a, b in shapes))
    fitting = F.filter(every, lambda s: (s["labels"] <= n_labels) & (s["length"] <= n_path))
    return F.transform(fitting, lambda s: _digested(suffix(s["labels"]), F.substring(path, F.lit(1), s["length"])))


def judge(
    pages: DataFrame,
    rules: DataFrame | None = None,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, url, host, path, rule (host and path of the winning rule, null
    without one) and verdict (the rule's, else ``default``) of every row of
    ``pages``. ``rules`` has verdict (allow or block), host and path."""
    spark = pages.sparkSession
    ship(spark)
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    table = materialise(_prepared(rules if rules is not None else rule_table(spark)), "url-rules")
    # pairs of label count and path length: bounded by the longest host and path of a rule
    shapes = sorted((r.labels, r.path_length) for r in table.select("labels", "path_length").distinct().collect())
    digest = F.explode_outer(expressions(F.col("host"), F.col("path"), shapes)) if shapes else F.lit(None).cast("string")
    opened = rows.withColumn("tag", F.monotonically_increasing_id()).withColumn("digest", digest)
    opened = opened.withColumn("prefix", F.substring("digest", 1, PREFIX))
    known = broadcast_if_bounded(table.select("prefix", "rule_digest", "precedence"), BROADCAST_RULES)
    met = opened.join(known, "prefix", "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.col("precedence"))
    best = met.groupBy("tag", "page_id", "url", "host", "path").agg(F.max(confirmed).alias("best"))
    length = F.shiftright("best", _BITS + 1).cast("int")
    of_host = F.shiftright("best", 1).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    rule = F.concat(F.right(F.col("host"), of_host), F.left(F.col("path"), length - of_host))
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best") % 2 == 1, "block").otherwise("allow")
    return best.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
