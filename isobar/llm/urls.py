"""URL verdicts: host and path rules, and pattern rules found through their rarest token.

A rule is an action for a host with its subdomains and a path prefix, or a
regular expression with the literal tokens that every match contains.  Each
rule is listed under the one of its tokens that the fewest URLs hold (counted
over the whole table).  A URL's own tokens fetch the rules listed under them;
only those are tested, and the rules without any token, which every URL is
tested against.

Rules are a table with a row per rule; URLs are looked at once each, however
many pages carry them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.text import packed
from isobar.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, action)
HOST_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: Words that mark a host as junk if they stand alone in one of its names, by family.
JUNK_HOSTS = {
    "advertising": "ads adserver adtrack affiliate banner banners clickbank clicktrack popunder popup promo sponsor tracker tracking",
    "gambling": "baccarat bet bets betting bingo blackjack casino casinos gamble gambling jackpot lottery lotto poker roulette slots sportsbook wager",
    "spam": "autoblog doorway linkfarm linkfarms scraper spam spammer splog",
    "pharmacy": "cialis diazepam meds painkillers pills steroids tramadol valium viagra xanax",
    "adult": "adult camgirls erotic erotica escort escorts hentai nude nudes porn porno webcams xxx",
    "piracy": "cracked cracks keygen keygens nulled serials torrent torrents warez",
    "money": "forex getrich moneymaker payday pyramid quickcash quickloans",
}
#: Path segments of pages that hold no text of their own.
EMPTY_PAGES = "login logout signin signout signup register cart checkout basket wishlist account password unsubscribe wp-admin wp-login cgi-bin captcha error404 notfound popup redirect sitemap thankyou printview"
#: Query parameters that only name a session or a reply.
SESSION_KEYS = "jsessionid phpsessid aspsessionid sessionid sid cfid cftoken zenid oscsid replytocom"


def _patterns() -> tuple[tuple[str, str, tuple[str, ...], str], ...]:
    import re

    made = [("ad-track host", r"^[a-z]+://([^/?#]*\.)?ads-track\.", "ads-track")]
    for family, words in JUNK_HOSTS.items():
        made += [(f"{family} host: {w}", rf"^[a-z]+://([^/?#]*[^a-z0-9/?#])?{w}([^a-z0-9/?#][^/?#]*)?([/?#]|$)", w) for w in words.split()]
    made += [(f"empty page: {w}", rf"^[a-z]+://[^/?#]*/([^?#]*/)?{w}(\.[a-z]+|/)?([?#]|$)", w) for w in EMPTY_PAGES.split()]
    made += [(f"session: {w}", rf"[?&;]{w}=", w) for w in SESSION_KEYS.split()]
    return tuple((name, pattern, tuple(re.split("[^a-z0-9]+", w)), "block") for name, pattern, w in made)


#: (name, pattern on the lower-cased URL, tokens in every match, action); the first one listed wins.
PATTERN_RULES = _patterns()


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path of a URL; both empty without ``://`` or for NULL."""
    whole = F.coalesce(url, F.lit(""))
    place = F.instr(whole, "://")
    rest = F.when(place > 0, F.substr(whole, place + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return lowered(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def tokens(text: Column) -> Column:
    """The distinct runs of letters and digits of a URL, lower case."""
    return F.array_distinct(F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda t: t != ""))


def rule_table(spark: SparkSession, hosts=HOST_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """``rule kind host path pattern tokens action strength``, a row per rule; the strongest match wins.

    Host rules beat patterns, longer host rules beat shorter ones, earlier patterns beat later ones.
    """
    import re

    rows = []
    for host, path, action in hosts:
        listed = [t for t in re.split("[^a-z0-9]+", host.lower()) if t]
        # A path that ends inside a word says nothing about the URL's token there.
        parts = re.split("[^a-z0-9]+", path.lower())
        listed += [t for t in parts[:-1] if t]
        rows.append((host + path, host.lower(), path, None, listed, action, 1_000_000 + len(host + path)))
    for n, (name, pattern, listed, action) in enumerate(patterns):
        rows.append((name, None, None, pattern, list(listed), action, len(patterns) - n))
    made = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(host).cast("string").alias("host"),
                F.lit(path).cast("string").alias("path"),
                F.lit(pattern).cast("string").alias("pattern"),
                F.array(*[F.lit(t) for t in listed]).cast("array<string>").alias("tokens"),
                F.lit(action).alias("action"),
                F.lit(strength).alias("strength"),
            )
            for rule, host, path, pattern, listed, action, strength in rows
        ]
    )
    return spark.range(1).select(F.inline(made))


#: Rules up to here are broadcast; more are joined by shuffle.
BROADCAST_RULES = 20_000


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else df


#: Rules without a token that every URL may be tested against.
MOST_LOOSE = 1000


def candidates(parts: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """``parts`` (``url host path``) beside the rules that could fit: those listed under a token of the URL, and those without a token."""
    told = ["rule", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "pattern", "action", "strength"]
    fetched = parts.withColumn("token", F.explode(tokens(F.col("url")))).join(small(listed.select("token", *told)), "token").drop("token")
    loose = rules.filter("tokens is null or size(filter(tokens, t -> t is not null)) = 0").select(*told)
    count = loose.limit(MOST_LOOSE + 1).count()
    if count > MOST_LOOSE:
        raise ValueError(f"more than {MOST_LOOSE} rules have no token; each of them would be tested on every URL")
    return fetched.unionByName(parts.crossJoin(F.broadcast(loose))) if count else fetched


def index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``rules`` that have tokens with ``token``: the rule's token that the fewest rows of ``urls`` (``url``, ``n``) hold, then the smallest."""
    named = small(rules.select("rule", F.explode("tokens").alias("token")))
    held = urls.select(F.explode(tokens(F.col("url"))).alias("token"), "n")
    held = held.join(named.withColumnRenamed("token", "t"), F.col("token") == F.col("t"), "left_semi").groupBy("token").agg(F.sum("n").alias("n"))
    counted = named.join(held, "token", "left").select("rule", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token").alias("at"))
    rarest = counted.groupBy("rule").agg(F.min("at")["token"].alias("token"))
    return rules.join(rarest, "rule")


def judged(pages: DataFrame, rules: DataFrame | None = None, *, url: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` as ``row`` with ``host path rule pattern_rule verdict``.

    ``rule`` is the longest host rule that fits, else NULL; without one the
    first pattern that matches (``pattern_rule``) gives the verdict, else it is
    ``default``.  A NULL URL or one without ``://`` has an empty host and path
    and fits no host rule.  Repeated rows stay; an empty table gives no rows.
    """
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    rows = packed(pages, url=F.coalesce(F.col(f"`{url}`"), F.lit("")))
    urls = stage(rows.groupBy("url").agg(F.count(F.lit(1)).alias("n")), "urls")
    listed = stage(index(urls, rules), "rules")
    host, path = host_and_path(F.col("url"))
    fetched = candidates(urls.select("url", host.alias("host"), path.alias("path")), rules, listed)
    fits_host = (F.col("host") == F.col("rule_host")) | F.endswith(F.col("host"), F.concat(F.lit("."), F.col("rule_host")))
    fits = F.when(F.col("pattern").isNotNull(), F.expr("regexp_like(translate(url, '%s', '%s'), pattern)" % (UPPER, LOWER))).otherwise(fits_host & F.startswith(F.col("path"), F.col("rule_path")))
    best = fetched.filter(fits).groupBy("url").agg(
        F.max(F.struct("strength", "rule", F.col("pattern").isNull().alias("by_host"), "action")).alias("best")
    )
    joined = rows.join(best.withColumnRenamed("url", "u"), F.col("url") == F.col("u"), "left")
    return joined.select(
        "row",
        *[c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))],
        F.when(F.col("best.by_host"), F.col("best.rule")).alias("rule"),
        F.when(~F.col("best.by_host"), F.col("best.rule")).alias("pattern_rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )


def allowed(pages: DataFrame, rules: DataFrame | None = None, *, url: str = "url") -> DataFrame:
    """The rows of ``pages`` whose verdict is allow, with their own columns."""
    kept = judged(pages, rules, url=url).filter("verdict = 'allow'")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in pages.columns])
