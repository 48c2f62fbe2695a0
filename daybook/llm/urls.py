"""URL filter: fixed host and path rules first, mined association rules for the rest. DataFrame operations only.

Labelled urls are transactions of tokens of the whole url plus their label. Mined are token combinations that conclude
``block`` with at least ``MIN_CONFIDENCE`` and ``MIN_SUPPORT``, without those that a shorter kept rule implies: first
single tokens by counts, then FP-growth over the urls and tokens that no single token decides. Tokens that stand in exactly the same
labelled urls are one item there, and any of them stands for it when rules are matched, so that long urls repeated
often do not make every subset of their words an item set. An inverted index from token to rules matches them: a
rule fires when a url has all of its tokens.

Labels come from ``labels``, through the document number that ends a url's path: low quality or toxic is ``block``,
anything else labelled is ``allow``. Urls with a host word of ``SEED_WORDS`` are labelled ``block`` too.

A null url, or one without ``://``, has an empty host and path, no rule, and is allowed. Repeated rows are judged
alike. Other columns are ignored; an empty table gives no rows. With fewer than ``MIN_COUNT`` labelled urls nothing is mined.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import saved, table

MIN_SUPPORT = 0.002
MIN_COUNT = 10  # and at least so many labelled urls
MIN_CONFIDENCE = 0.8

# Host, path prefix, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Host words by the kinds of site that public block lists keep: adult, gambling, pharmacy, advertising and tracking, fraud, pirated goods.
SEED_WORDS = tuple(
    "adult porn porno xxx sex sexy erotic escort escorts nude camgirls hentai fetish "
    "casino casinos gambling gamble bet bets betting poker slots roulette blackjack jackpot bingo lottery lotto bookmaker "
    "pill pills pharmacy pharma viagra cialis tramadol xanax steroids "
    "ad ads adserver adserv advert adverts advertising banners doubleclick popads popunder tracker trackers clicktrack affiliate affiliates "
    "spam spammer phishing scam malware spyware adware botnet "
    "warez crack cracks keygen torrent torrents replica replicas payday".split()
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label="
_BETWEEN = r"[^\p{L}\p{N}]+"  # what separates the words of a path segment


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null when none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for site, prefix, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(prefix)
        name = F.when(fits, f"{site}{prefix}").otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: the host's words, path segments and their words, the file's ending, query names, values and the fragment."""

    def lower(x: Column) -> Column:
        return F.translate(x, _UPPER, _LOWER)

    def tagged(tag: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    ending = lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))
    stem = F.regexp_replace(lower(path), r"\.[a-z0-9]{1,5}$", "")
    segments = F.split(stem, "/")
    slugs = F.flatten(F.transform(F.filter(segments, lambda x: x.rlike(_BETWEEN)), lambda x: F.split(x, _BETWEEN)))
    fields = F.regexp_extract_all(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), F.lit("[^&;]+"), F.lit(0))
    fragment = lower(F.regexp_extract(F.coalesce(url, F.lit("")), "#(.*)$", 1))
    values = F.transform(fields, lambda x: F.when(F.locate("=", x) > 0, lower(x)).otherwise(F.lit("")))
    return F.array_distinct(F.concat(
        tagged("word=", F.split(host, r"[.-]")),
        tagged("segment=", segments), tagged("slug=", slugs), tagged("ending=", F.array(ending)),
        tagged("field=", F.transform(fields, lambda x: lower(F.substring_index(x, "=", 1)))),
        tagged("value=", values), tagged("fragment=", F.array(fragment)),
    ))


def labelled(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled urls (tokens, label)."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("number")).agg(F.max(bad).alias("bad"))
    number = F.expr(r"try_cast(regexp_extract(path, '/([0-9]{1,18})(?:\\.[a-z]+)?/?$', 1) AS BIGINT)")
    seeded = F.arrays_overlap(F.split("host", r"[.-]"), F.array(*map(F.lit, SEED_WORDS)))
    joined = urls.withColumn("number", number).join(known, "number", "left")
    says = F.when(seeded | F.col("bad"), "block").when(F.col("bad").isNotNull(), "allow")
    return joined.select("tokens", says.alias("label")).where("label IS NOT NULL AND size(tokens) > 0")


def mine(examples: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules that conclude ``block`` (rule, tokens, members, confidence, support), without those a shorter rule implies.

    ``members`` has, for each of ``tokens``, all tokens that may stand for it.
    """
    spark = examples.sparkSession
    rows = saved(examples.withColumn("row", F.monotonically_increasing_id()), "examples")
    n = rows.count()
    if n < MIN_COUNT:
        return spark.createDataFrame([], "rule long, tokens array<string>, members array<array<string>>, confidence double, support double")
    least = max(min_support * n, MIN_COUNT)
    spread = rows.select("row", "label", F.explode(F.array_distinct("tokens")).alias("token"))
    counts = spread.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "block").alias("blocked"),
        F.bit_xor(F.xxhash64("row")).alias("rows"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("rows_again"),
    )
    # A rule's tokens stand in as many blocked urls as the rule does: at most the mean size of a url over MIN_SUPPORT tokens are left.
    counts = saved(counts.where(F.col("blocked") >= least), "tokens").withColumn("confidence", F.col("blocked") / F.col("n"))
    alone = counts.where(F.col("confidence") >= min_confidence).select(
        F.array("token").alias("tokens"), F.array(F.array("token")).alias("members"), "confidence", (F.col("blocked") / n).alias("support")
    )
    # Rules with a token that is a rule alone are implied by it. The other tokens are combined, on the urls that no single
    # token decides: those it does would lend their label to whatever else they share with innocent ones.
    items = counts.where(F.col("confidence") < min_confidence).groupBy("n", "rows", "rows_again").agg(
        F.min("token").alias("item"), F.sort_array(F.collect_list("token")).alias("members")
    )
    items = saved(items.select("item", "members"), "items")
    decided = spread.join(alone.select(F.element_at("tokens", 1).alias("token")), "token").select("row").distinct()
    left = spread.join(decided, "row", "left_anti")
    held = left.join(items.select("item", F.explode("members").alias("token")), "token")
    baskets = saved(held.groupBy("row", "label").agg(F.collect_set("item").alias("items")), "baskets")
    baskets = baskets.select(F.concat("items", F.array(F.concat(F.lit(_LABEL), "label"))).alias("items"))
    rules = alone
    if filled := baskets.count():
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / filled), minConfidence=min_confidence).fit(baskets)
        concluding = model.associationRules.where(F.col("consequent") == F.array(F.lit(f"{_LABEL}block")))
        found = saved(concluding.select(F.array_sort("antecedent").alias("tokens"), "confidence", F.col("support") * filled / n), "rules")
        found = found.toDF("tokens", "confidence", "support")
        named = found.select("tokens", F.explode("tokens").alias("item")).join(items, "item")
        named = named.groupBy("tokens").agg(F.sort_array(F.collect_list(F.struct("item", "members"))).alias("m"))
        rules = alone.unionByName(found.join(named.select("tokens", F.col("m.members").alias("members")), "tokens"))
    rules = saved(rules.withColumn("rule", F.xxhash64("tokens")), "rules")
    # A rule is implied when another has fewer tokens, all among its own: found by the inverted index, too.
    index = rules.select("rule", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    long = rules.select(F.col("rule").alias("long"), F.size("tokens").alias("width"), F.explode("tokens").alias("token"))
    met = long.join(index, "token").where("size < width").groupBy("long", "rule", "size").agg(F.count(F.lit(1)).alias("n"))
    implied = met.where("n = size").select(F.col("long").alias("rule")).distinct()
    return saved(rules.join(implied, "rule", "left_anti").select("rule", "tokens", "members", "confidence", "support"), "rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct urls that have all tokens of a rule."""
    places = rules.select("rule", F.size("tokens").alias("size"), F.posexplode("members").alias("place", "members"))
    index = places.select("rule", "size", "place", F.explode("members").alias("token"))
    spread = urls.select("url", F.explode("tokens").alias("token"))
    hits = spread.join(index, "token").groupBy("url", "rule", "size").agg(F.collect_set("place").alias("places"))
    return hits.where(F.size("places") == F.col("size")).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict for every row."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    rows = rows.withColumns({"host": host, "path": path})
    # Examples repeat as often as their urls do; matching needs each url once.
    listed = rows.withColumn("tokens", tokens(F.col("host"), F.col("path"), F.col("url")))
    mined = mine(labelled(listed, labels))
    blocked = matched(listed.where("url IS NOT NULL").select("url", "tokens").distinct(), mined)
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(blocked.withColumn("hit", F.lit(True)), "url", "left")
    method = F.when(F.col("hit"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
