"""URL rules fetched by their rarest literal token; DataFrame functions only.

A rule is a regular expression on ``host + path`` with the literal tokens
(letters and digits) that any match must hold as whole tokens.  The tokens of
all URLs are counted once for the rules' tokens; each rule is indexed by its
rarest one.  A URL's tokens then fetch candidate rules by an equi-join, and
only those run their expression.  Rules without a token are candidates for
every URL.

Listed rules (host and path prefix) win by length; where none fits, a URL is
blocked if any pattern rule fits and allowed otherwise.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with ASCII
letters lower-cased; path: from there up to ``?``, ``#`` or the end.

Edge cases: a null URL, or one without ``://``, has an empty host and path,
fits no listed rule and is allowed; ids may be null or repeat, every row is
returned; other columns are ignored; an empty table gives no rows.  Equal
addresses are judged once, after a partial aggregation, so a very common
address is no hot key there; the join back is left to Spark's skew handling.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.llm._common import save_table

# The agreed list (action, host, path).
LISTED = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Words that block as whole tokens of an address.
WORDS = ["adserver", "ads", "adult", "bet", "bets", "betting", "casino", "escort", "gambling", "lottery",
         "malware", "phishing", "pills", "poker", "porn", "sex", "spam", "torrent", "viagra", "warez", "xxx"]
BROADCAST_RULES = 20_000


def literal_tokens(text: str) -> list[str]:
    return sorted(set(re.findall("[a-z0-9]+", text.lower())))


def listed_rule(action: str, host: str, path: str) -> tuple:
    """(name, action, pattern, tokens, listed).  The last part of a path that
    does not end in a separator may be cut inside a token, so it is no token."""
    whole = re.sub("[A-Za-z0-9]+$", "", path)
    return (host + path, action, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}",
            literal_tokens(f"{host} {whole}"), True)


def word_rule(word: str) -> tuple:
    return (word, "block", f"(?i)(?:^|[^a-z0-9]){re.escape(word)}(?:[^a-z0-9]|$)", literal_tokens(word), False)


def default_rules() -> list[tuple]:
    return [listed_rule(*r) for r in LISTED] + [word_rule(w) for w in WORDS]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def _rules(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    rows = [F.struct(F.lit(name).alias("rule"), F.lit(action).alias("action"), F.lit(pattern).alias("pattern"),
                     F.array(*map(F.lit, tokens)).cast("array<string>").alias("tokens"), F.lit(listed).alias("listed"))
            for name, action, pattern, tokens, listed in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: list[tuple] | None = None) -> DataFrame:
    """``key, host, path, rule, verdict`` of every row."""
    spark = pages.sparkSession
    rules = default_rules() if rules is None else rules
    host, path = host_and_path(pages[url].cast("string"))
    rows = pages.select(pages[key].alias("key"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("address", F.concat("host", "path"))
    if not rules:
        return rows.select(F.col("key").alias(key), "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit("allow").alias("verdict"))
    small = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)

    table = _rules(spark, rules)
    addresses = save_table(rows.groupBy("address").agg(F.count("*").alias("n")), "addresses")
    tokens = addresses.select("address", "n", F.explode(F.array_distinct(
        F.split(ascii_lower(F.col("address")), "[^a-z0-9]+"))).alias("token"))
    literal = table.select("rule", F.explode("tokens").alias("token"))
    counts = tokens.join(small(literal.select("token").distinct()), "token").groupBy("token").agg(F.sum("n").alias("n"))
    rarest = (literal.join(counts, "token", "left").groupBy("rule")
              .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    index = table.join(rarest, "rule").select("token", "rule", "action", "pattern", "listed")
    fetched = tokens.join(small(index), "token").select("address", "rule", "action", "pattern", "listed")
    if any(not r[3] for r in rules):
        fetched = fetched.union(addresses.join(small(table.where(F.size("tokens") == 0)))
                                .select("address", "rule", "action", "pattern", "listed"))
    longest = F.when(F.col("listed"), F.struct(F.length("rule"), "rule"))
    fits = (fetched.where(F.expr("address rlike pattern")).groupBy("address")
            .agg(F.max_by("rule", longest).alias("rule"), F.max_by("action", longest).alias("action"),
                 F.bool_or(~F.col("listed")).alias("pattern_hit")))
    verdict = F.coalesce("action", F.when(F.col("pattern_hit"), "block"), F.lit("allow"))
    return (rows.join(fits, "address", "left")
            .select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict")))


def oracle_sql() -> str:
    """DuckDB SQL that tries every rule on every address."""
    listed = ", ".join(f"('{h}', '{p}', '{a}')" for a, h, p in LISTED)
    words = "|".join(WORDS)
    return rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
             '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
             regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM u),
r(h, f, action) AS (VALUES {listed}),
a AS (SELECT host, path, max_by(h || f, length(h || f)) AS rule, max_by(action, length(h || f)) AS action
      FROM (SELECT DISTINCT host, path FROM p) JOIN r
        ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, f) GROUP BY host, path)
SELECT page_id, p.host, p.path, a.rule,
       coalesce(a.action, CASE WHEN regexp_matches(p.host || p.path, '(?i)(^|[^a-z0-9])({words})([^a-z0-9]|$)')
                               THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN a ON p.host = a.host AND p.path = a.path"""
