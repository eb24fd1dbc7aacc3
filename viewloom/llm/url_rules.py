"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is a host and the beginning of a path, or a pattern in which `*` stands for anything, and says allow or block. Each
rule has literal tokens that any URL it fits must contain whole; it is filed under the one that the fewest URLs contain. A
URL's own tokens fetch its candidate rules, and only those run their regular expression. A rule without any whole token
is tried on every URL, as part of the plan; more than LOOSE_RULES of those are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import ascii_lower, query, scratch, stored, table

#: Rules given to every query: host and path beginning, a fit on the host's subdomains as well; the longest wins.
HOST_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
#: Patterns for what no rule above judges. Letters, digits and anything beyond ASCII are literal, `*` is anything.
PATTERN_RULES = [
    ("*spam-farm.*/*", "block"),
    ("*cheap-pills.*/*", "block"),
    ("*/*.exe", "block"),
    ("*/*.zip", "block"),
    ("*/wp-login.php*", "block"),
    ("*/cgi-bin/*", "block"),
]
#: Rules up to which the index is broadcast, at under a kilobyte each; beyond, the join shuffles.
BROADCAST_RULES = 20_000
LOOSE_RULES = 200

TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null or without `://`."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(__url, locate('://', __url) + 3)"))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def tokens(text: Column) -> Column:
    """Runs of letters and digits, A-Z lower-cased."""
    return F.array_distinct(F.regexp_extract_all(ascii_lower(text), F.lit(TOKEN), F.lit(0)))


def quoted(literal: Column) -> Column:
    """The text as a regular expression that fits just it."""
    return F.regexp_replace(literal, r"([\\.\[\]{}()*+?^$|])", r"\\$1")


def compiled(spark: SparkSession, host_rules: list[tuple[str, str]], pattern_rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, verdict, kind, regex, whole): kind 0 for patterns, 1 for hosts, which go first; `whole` are the tokens that
    are bounded on both sides in every URL that the rule fits."""
    rows = [(r, v, 1) for r, v in host_rules] + [(r, v, 0) for r, v in pattern_rules]
    rules = spark.createDataFrame(rows, "rule string, verdict string, kind int").distinct()
    host, path = F.regexp_extract("rule", "^([^/]*)", 1), F.regexp_extract("rule", "^[^/]*(.*)$", 1)
    of_host = F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted(ascii_lower(host)), quoted(path))
    of_pattern = F.concat(F.lit("^"), F.array_join(F.transform(F.split("rule", r"\*", -1), lambda p: quoted(p)), "(?s:.*)"), F.lit("$"))
    # In a host rule only the end of the path is open; in a pattern, the places next to each star. A space cuts tokens,
    # so what touches an open end is taken away.
    letter = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    closed = F.when(F.col("kind") == 1, F.regexp_replace("rule", f"{letter}+$", " ")).otherwise(F.regexp_replace("rule", rf"{letter}*\*{letter}*", " "))
    return rules.select("rule", "verdict", "kind", F.when(F.col("kind") == 1, of_host).otherwise(of_pattern).alias("regex"), tokens(closed).alias("whole"))


def indexed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules with `token`, the rarest of their whole tokens (ties: the lesser); null where there is none. `urls` has an
    array column `tokens`; each URL counts a token once."""
    wanted = rules.select(F.explode("whole").alias("token")).distinct()
    if rules.count() <= BROADCAST_RULES:
        wanted = F.broadcast(wanted)
    found = urls.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    choice = rules.select("rule", "kind", F.explode("whole").alias("token")).join(found, "token", "left")
    rarest = choice.groupBy("rule", "kind").agg(F.min_by("token", F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "token")).alias("token"))
    return rules.join(rarest, ["rule", "kind"], "left").select("rule", "verdict", "kind", "regex", "token")


def judge_urls(
    pages: DataFrame, host_rules: list[tuple[str, str]] = HOST_RULES, pattern_rules: list[tuple[str, str]] = PATTERN_RULES, default: str = "allow"
) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`.

    Of the host rules that fit, the longest wins (ties: the greater text) and is named in `rule`; else `rule` is null and
    the longest fitting pattern decides, else `default`. A null URL or one without `://` has an empty host and path; it
    fits patterns only. Repeated rows are judged alike; an empty table gives an empty result. Columns named as the added
    ones are replaced.
    """
    spark = pages.sparkSession
    folder = scratch(spark)
    # Every address is judged once, however many pages have it.
    parts = pages.select(F.col("url").alias("__url")).withColumns(dict(zip(("host", "path"), host_and_path(F.col("__url")), strict=True)))
    places = parts.select("host", "path").distinct().withColumn("tokens", tokens(F.concat_ws(" ", "host", "path")))
    places = stored(places, f"{folder}/places")
    rules = stored(indexed(compiled(spark, host_rules, pattern_rules), places), f"{folder}/rules")
    few = rules.count() <= BROADCAST_RULES
    filed, loose = rules.where("token IS NOT NULL"), rules.where("token IS NULL").drop("token")
    candidates = places.select("host", "path", F.explode("tokens").alias("token")).join(F.broadcast(filed) if few else filed, "token").drop("token")
    fits = candidates.where(F.regexp_like(F.concat("host", "path"), F.col("regex"))).drop("regex")
    if listed := loose.limit(LOOSE_RULES + 1).collect():
        if len(listed) > LOOSE_RULES:
            raise ValueError(f"more than {LOOSE_RULES} rules without a whole token")
        tried = [
            F.when(F.concat("host", "path").rlike(r["regex"]), F.struct(*[F.lit(r[c]).alias(c) for c in ("rule", "verdict", "kind")])) for r in listed
        ]
        fits = fits.unionByName(places.select("host", "path", F.explode(F.array_compact(F.array(*tried))).alias("r")).select("host", "path", "r.*"))
    best = fits.groupBy("host", "path").agg(F.max(F.struct("kind", F.length("rule").alias("size"), "rule", "verdict")).alias("best"))
    best = best.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "best")
    added = ("host", "path", "rule", "verdict")
    placed = pages.withColumn("__url", F.col("url")).withColumns(dict(zip(("__h", "__p"), host_and_path(F.col("__url")), strict=True)))
    judged = placed.join(best, (F.col("__h") == F.col("__host")) & (F.col("__p") == F.col("__path")), "left")
    return judged.select(
        *[c for c in pages.columns if c not in added], F.col("__h").alias("host"), F.col("__p").alias("path"),
        F.when(F.col("best.kind") == 1, F.col("best.rule")).alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def _oracle() -> str:
    fits = {
        1: "(host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}')",
        0: "regexp_full_match(host || path, '{r}', 's')",
    }
    regex = lambda rule: rule.replace(".", "[.]").replace("*", ".*")
    rows = [
        f"SELECT '{rule}' AS rule, '{verdict}' AS verdict, {kind} AS kind, host, path FROM p WHERE "
        + fits[kind].format(h=rule.partition("/")[0], p="/" + rule.partition("/")[2], r=regex(rule))
        for kind, rules in ((1, HOST_RULES), (0, PATTERN_RULES))
        for rule, verdict in rules
    ]
    return f"""
WITH q AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
d AS (SELECT page_id, lower(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM q),
p AS (SELECT DISTINCT host, path FROM d),
fit AS ({" UNION ALL ".join(rows)}),
best AS (SELECT host, path, arg_max((rule, verdict, kind), kind * 1000 + length(rule)) AS b FROM fit GROUP BY host, path)
SELECT page_id, host, path, CASE WHEN b[3] = 1 THEN b[1] END AS rule, coalesce(b[2], 'allow') AS verdict
FROM d LEFT JOIN best USING (host, path)
"""


@query("op3_url_rules", _oracle())
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")
