"""URL filter: blocked Bloom filter in front of an exact hash join.

Two lists are applied. *Rules* ``(host, path, verdict)`` fit a host and its
subdomains when the url's path starts with the rule's; the longest rule wins.
*Listed urls* are blocked by their canonical form. Both become exact string
keys in one list. Each distinct url yields the keys that could be listed (its
host suffixes with the path prefixes of the lengths that rules have, and its
canonical url); a blocked Bloom filter over the list drops nearly all of them,
and an exact join on the key removes the false positives. A rule decides before
the listed urls.

The filter has a fixed number of 256-bit blocks (a parameter, so its broadcast
is bounded); a longer list only raises the false-positive rate, never changes
the result. The exact join salts the list side, so a key that a third of the
urls share does not land in one task.

Defined results: a null url, or one without ``://``, has empty host and path
and meets no rule and no listed url (verdict ``allow``). Repeated rows are
judged alike. With empty lists everything is allowed. Of rules with the same
host and path, ``block`` counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import literal_rows, table

N_FILTER_BLOCKS = 1 << 14
SALTS = 16
_LONGS, _PROBES = 4, 6  # a block is four longs; six bits are set for a key

# The host labels whose urls are listed.
LISTED_LABELS = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
# The rules.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")


def url_parts(df: DataFrame) -> DataFrame:
    """Adds host and path to a frame with the column ``url``."""
    rest = _rest(F.col("url"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without ``.html`` and a final slash."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(\.html)?/*$", ""))


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(N_FILTER_BLOCKS)).cast("int")


def _bits(key: Column) -> list[Column]:
    """The key's bit mask in its block, as four longs."""
    h = F.xxhash64(key, F.lit("bits"))
    spots = [F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(64 * _LONGS - 1)) for i in range(_PROBES)]
    words = []
    for w in range(_LONGS):
        word = F.lit(0).cast("long")
        for spot in spots:
            here = F.shiftright(spot, 6) == w
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))
            word = word.bitwiseOR(F.when(here, bit).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return words


def build_filter(keys: DataFrame) -> DataFrame:
    """Blocked Bloom filter of the column ``key``: one row per used block."""
    masks = keys.select(_block(F.col("key")).alias("block"),
                        *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col("key")))])
    return masks.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_LONGS)])


def might_contain(probes: DataFrame, bloom: DataFrame) -> DataFrame:
    """The rows of ``probes`` whose ``key`` may be in the filter."""
    with_bits = probes.withColumn("block", _block(F.col("key")))
    for i, b in enumerate(_bits(F.col("key"))):
        with_bits = with_bits.withColumn(f"b{i}", b)
    hit = F.lit(True)
    for i in range(_LONGS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) == F.col(f"b{i}"))
    # at most N_FILTER_BLOCKS rows of five numbers
    return with_bits.join(F.broadcast(bloom), "block").where(hit).select(*probes.columns)


def judge_urls(urls: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """``url, host, path, rule, listed`` for every distinct url that some list holds.

    urls: column ``url``. rules: ``host, path, verdict``. listed: ``url``.
    """
    known = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
    rule_keys = (known.groupBy(F.concat("host", "path").alias("rule"))
                 .agg(F.max("verdict").alias("verdict"))
                 .select(F.concat(F.lit("r "), "rule").alias("key"), "rule", "verdict"))
    listed_keys = (url_parts(listed.select("url").where(F.col("url").contains("://")).distinct())
                   .select(F.concat(F.lit("u "), canonical(F.col("host"), F.col("path"))).alias("key")).distinct()
                   .select("key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict")))
    keys = rule_keys.unionByName(listed_keys)

    # distinct path lengths of the rules: a handful of small numbers
    lengths = [r[0] for r in known.select(F.length("path")).distinct().collect()]
    parts = url_parts(urls.select("url").where(F.col("url").contains("://")).distinct())
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("path", 1, n).alias("s")) for n in lengths])
                      if lengths else F.expr("cast(array() as array<struct<n:int,s:string>>)"),
                      lambda x: F.length(x["s"]) == x["n"])
    rule_probes = F.flatten(F.transform(suffixes, lambda h: F.transform(
        starts, lambda x: F.concat(F.lit("r "), h, x["s"]))))
    probes = parts.select("url", F.explode(F.concat(
        F.array_distinct(rule_probes), F.array(F.concat(F.lit("u "), canonical(F.col("host"), F.col("path")))))).alias("key"))

    possible = might_contain(probes, build_filter(keys.select("key")))
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = (possible.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int"))
            .join(salted, ["key", "salt"]))  # exact: false positives of the filter end here
    return hits.groupBy("url").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "verdict"))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"))


def filter_pages(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """``page_id, url, host, path, rule, listed, verdict`` for every row of ``pages``."""
    pages = pages.select("page_id", "url")
    judged = (judge_urls(pages, rules, listed)
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    rows = (url_parts(pages)
            .withColumn("host", F.coalesce("host", F.lit(""))).withColumn("path", F.coalesce("path", F.lit("")))
            .withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")))
    listed_here = F.coalesce("listed", F.lit(False))
    return (rows.join(judged, ["url", "salt"], "left")
            .select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
                    listed_here.alias("listed"),
                    F.coalesce("best.verdict", F.when(listed_here, "block").otherwise("allow")).alias("verdict")))


def q_op1_url_filter(spark, sf_dir: str) -> DataFrame:
    """Rules, and as listed urls all pages on hosts with a listed label, in their canonical form."""
    pages = table(spark, sf_dir, "pages")
    rules = literal_rows(spark, ["host", "path", "verdict"], RULES)
    listed = url_parts(pages.select("url")).where(
        F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(x) for x in LISTED_LABELS]))).select("url")
    return filter_pages(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


_LABELS = ", ".join(f"'{x}'" for x in LISTED_LABELS)
OP1_SQL = f"""
WITH p AS (
  SELECT page_id, url,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, url,
         translate(regexp_extract(rest, '^[^/?#]*', 0),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
c AS (
  SELECT *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(\\.html)?/*$', '') AS canon,
         coalesce(len(list_filter(string_split(host, '.'), lambda x: x IN ({_LABELS}))) > 0, false) AS on_list
  FROM h),
r(rhost, rpath, rverdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
m AS (
  SELECT page_id, url, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(rverdict, length(rhost || rpath)) AS rverdict
  FROM (SELECT DISTINCT page_id, url, host, path FROM c) c
  JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, url)
SELECT c.page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, m.rule,
       coalesce(m.rverdict,
                CASE WHEN contains(c.url, '://') AND canon IN (SELECT canon FROM c WHERE on_list)
                     THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN m ON c.page_id = m.page_id AND c.url = m.url
"""
