"""URL verdicts: fixed rules first, then token combinations mined from labels by FP-growth."""

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from anchorage.sources import sinks

# fixed values: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# evidence for a mined rule, the same at every table size: bad pages, their share, and the
# chance that so many are bad at the base rate
MIN_BAD, MIN_CONFIDENCE, CHANCE = 5, 0.5, 1e-6
BAD = "=bad"  # no token holds this sign
JOINT = "\x00"  # nor this one
NARROW = 10  # tokens of a page that FP-growth may list all subsets of


def rest(url):
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url):
    found = F.regexp_extract(rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(
        F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")
    )


def path(url):
    return F.coalesce(F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url, host_col, path_col):
    """Distinct tokens: ``s:`` scheme, ``h:`` labels of the host and their parts, ``p:`` parts of
    the path, ``q:`` keys of the query. Runs of digits are not tokens."""
    parts = lambda kind, text, cut: F.transform(F.split(text, cut), lambda x: F.concat(F.lit(kind), x))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    found = F.concat(
        F.array(F.concat(F.lit("s:"), F.regexp_extract(url, r"^([A-Za-z]+)://", 1))),
        parts("h:", host_col, r"\."),
        F.filter(parts("h:", host_col, r"[.-]"), lambda x: host_col.contains("-")),
        parts("p:", path_col, r"[/._-]"),
        keys,
    )
    return F.array_distinct(F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda x: ~x.rlike("^.:[0-9=]*$")))


def matching_rule(host_col, path_col, rules=RULES):
    """(rule, verdict) of the longest rule for a host or its subdomains whose path starts the url's; or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def least_bad(base, min_bad=MIN_BAD, chance=CHANCE):
    """The fewest bad pages, none good beside them, that can make a rule."""
    return max(min_bad, math.ceil(math.log(chance) / math.log(base) - 1e-9))


def is_rule(base, min_bad=MIN_BAD, min_confidence=MIN_CONFIDENCE, chance=CHANCE):
    """Whether ``bad`` of ``pages`` make a rule: the lower Chernoff limit of their share is over the base rate."""
    n, c = F.col("pages").cast("double"), F.col("bad").cast("double")
    good = F.when(c < n, (n - c) * F.ln((n - c) / n / (1 - base))).otherwise(0.0)
    evidence = c * F.ln(c / n / base) + good
    return (c >= min_bad) & (c / n >= min_confidence) & (c / n > base) & (evidence >= -math.log(chance) - 1e-9)


def shortest(rules, frequent):
    """Rules that hold no shorter one, size by size."""
    kept, rest = rules.limit(0), sinks.materialize(rules)
    while (size := rest.agg(F.min(F.size("tokens"))).first()[0]) is not None:
        level = rest.where(F.size("tokens") == size)
        short = index(level, frequent).select("_token", F.col("tokens").alias("_short"))
        longer = rest.where(F.size("tokens") > size)
        holding = (
            longer.select("tokens", F.explode("tokens").alias("_token"))
            .join(short, "_token")
            .where(F.size(F.array_except("_short", "tokens")) == 0)
            .select("tokens")
        )
        kept, rest = kept.union(level), sinks.materialize(longer.join(holding, "tokens", "left_anti"))
    return kept


def grown_by_fp_growth(narrow, least, good):
    """Rules (tokens, pages, bad) of projected databases (prefix, bad, items), all in one run of FP-growth.

    An item is named with its prefix, so that databases do not mix.
    """
    named = lambda item: F.concat_ws(JOINT, "prefix", item)
    baskets = narrow.select(F.transform("items", lambda x: named(x.token)).alias("items"), "bad", "prefix")
    baskets = sinks.materialize(
        baskets.select(F.when(F.col("bad"), F.array_append("items", named(F.lit(BAD)))).otherwise(F.col("items")).alias("items"))
    )
    # the number of baskets makes a share of what is a count
    sets = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / max(least, baskets.count())).fit(baskets).freqItemsets
    tokens = F.array_sort(F.array_distinct(F.flatten(F.transform("items", lambda x: F.split(x, JOINT)))))
    with_bad = F.array_contains("tokens", BAD)
    return (
        sets.select(tokens.alias("tokens"), "freq")
        .groupBy(F.array_remove("tokens", BAD).alias("tokens"))
        .agg(F.max(F.when(~with_bad, F.col("freq"))).alias("pages"), F.max(F.when(with_bad, F.col("freq"))).alias("bad"))
        .where((F.size("tokens") > 1) & good)
    )


def combined(baskets, total, least, good, narrow=NARROW):
    """Rules (tokens, pages, bad) of two tokens or more, from rows (bad, items), items sorted.

    The pages that hold a prefix, with the tokens that follow it, are its database, as in
    FP-growth. FP-growth would list all subsets of tokens that many pages share, so it gets
    the databases of at most ``narrow`` tokens a page. The others are grown by one token:
    a token that makes the prefix a rule, is on too few bad pages for one, or is on all
    pages of the database (and so changes no count) goes no further. No rule without a
    shorter one in it is lost, and rules are never extended.
    """
    prefix = F.array().cast("array<string>")
    items = F.transform("items", lambda x: F.struct(x.alias("token"), F.lit(total).cast("long").alias("pages")))
    databases = baskets.select(prefix.alias("prefix"), F.lit(total).cast("long").alias("of"), "bad", items.alias("items"))
    databases = sinks.materialize(databases.where(F.size("items") > 0).withColumn("_row", F.monotonically_increasing_id()))
    found = baskets.select(prefix.alias("tokens"), F.lit(0).cast("long").alias("pages"), F.lit(0).cast("long").alias("bad")).limit(0)
    while not databases.isEmpty():
        width = databases.groupBy("prefix").agg(F.max(F.size("items")).alias("_width"))
        databases = sinks.materialize(databases.join(width, "prefix"))
        few = databases.where(F.col("_width") <= narrow)
        if not few.isEmpty():
            found = found.union(grown_by_fp_growth(few, least, good))
        each = databases.where(F.col("_width") > narrow).select(
            "_row", "prefix", "of", F.col("bad").alias("_bad"), F.explode("items.token").alias("token")
        )
        counts = sinks.materialize(
            each.groupBy("prefix", "of", "token").agg(F.count(F.lit(1)).alias("pages"), F.count_if("_bad").alias("bad"))
        )
        longer = F.size("prefix") > 0  # single tokens were judged before
        found = found.union(
            counts.where(longer & good).select(F.array_sort(F.array_append("prefix", F.col("token"))).alias("tokens"), "pages", "bad")
        )
        live = counts.where((F.col("bad") >= least) & ~(longer & good) & (F.col("pages") < F.col("of")))
        kept = (
            each.join(live.select("prefix", "token", "pages"), ["prefix", "token"])
            .groupBy("_row", "prefix", "_bad")
            .agg(F.array_sort(F.collect_list(F.struct("token", "pages"))).alias("items"))
        )
        # each token with those after it
        parts = F.transform("items", lambda x, i: F.struct(x.alias("head"), F.slice("items", i + 2, F.size("items")).alias("rest")))
        databases = sinks.materialize(
            kept.select("prefix", F.col("_bad").alias("bad"), F.explode(parts).alias("_part"))
            .select(
                F.array_append("prefix", F.col("_part.head.token")).alias("prefix"),
                F.col("_part.head.pages").alias("of"),
                "bad",
                F.col("_part.rest").alias("items"),
            )
            .where(F.size("items") > 0)
            .withColumn("_row", F.monotonically_increasing_id())
        )
    return found


def mine(labelled, min_bad=MIN_BAD, min_confidence=MIN_CONFIDENCE, chance=CHANCE, narrow=NARROW):
    """Rules (tokens, confidence, pages, bad) from rows (tokens, bad), and (token, freq) of all tokens.

    A rule is a combination of tokens with ``min_bad`` bad pages or more, of which
    ``min_confidence`` or more are bad, and which would be so bad with at most ``chance``
    if its pages were bad at the rate of all labelled ones. All bounds are counts or
    chances of the rule's own pages, so a rule needs the same evidence at every table size.
    Rules that hold a shorter one are left out. Rows with a null label do not count.

    Nothing else is left out: ``combined`` gets no token that is a rule (all it is in hold
    a shorter one) or is on fewer bad pages than any rule needs, and one of the tokens
    that are on the same pages; its rules hold for the others as well.
    """
    rows = sinks.materialize(labelled.where("bad is not null").withColumn("_row", F.monotonically_increasing_id()))
    total, bad = rows.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    signs = [F.sum(F.xxhash64(F.lit(i), "tokens").cast("decimal(38,0)")).alias(f"_sign{i}") for i in range(2)]
    every = sinks.materialize(
        rows.select("tokens", "bad", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("pages"), F.count_if("bad").alias("bad"), *signs)
    )
    frequent = every.select("token", F.col("pages").alias("freq"))
    found = every.select(F.array("token").alias("tokens"), "pages", "bad")
    if not 0 < bad < total or bad < (least := least_bad(bad / total, min_bad, chance)):
        return _shares(found.limit(0)), frequent
    good = is_rule(bad / total, min_bad, min_confidence, chance)
    classes = sinks.materialize(
        every.where((F.col("bad") >= least) & ~good)
        .groupBy("pages", "bad", "_sign0", "_sign1")
        .agg(F.array_sort(F.collect_list("token")).alias("_members"))
        .select(F.col("_members")[0].alias("_token"), "_members")
    )
    items = (
        rows.select("_row", "bad", F.explode("tokens").alias("_token"))
        .join(classes.select("_token"), "_token")
        .groupBy("_row", "bad")
        .agg(F.array_sort(F.collect_list("_token")).alias("items"))
    )
    few = shortest(combined(items.select("bad", "items"), total, least, good, narrow), frequent)
    members = (
        few.select("tokens", "pages", "bad", F.explode("tokens").alias("_token"))
        .join(classes, "_token")
        .groupBy("tokens", "pages", "bad")
        .agg(F.collect_list("_members").alias("_members"))
    )
    spread = F.aggregate(
        "_members",
        F.array(F.array().cast("array<string>")),
        lambda sofar, ms: F.flatten(F.transform(sofar, lambda t: F.transform(ms, lambda m: F.array_append(t, m)))),
    )
    longer = members.select(F.explode(spread).alias("tokens"), "pages", "bad")
    return _shares(found.where(good).union(longer.withColumn("tokens", F.array_sort("tokens")))), frequent


def _shares(rules):
    return rules.select("tokens", (F.col("bad") / F.col("pages")).alias("confidence"), "pages", "bad")


def index(rules, frequent):
    """Each rule under its rarest token, so that a common token is no hot key."""
    listed = rules.withColumn("_rule", F.concat_ws(" ", "tokens"))
    keyed = listed.select("_rule", F.explode("tokens").alias("token")).join(frequent, "token")
    rarest = keyed.groupBy("_rule").agg(F.min(F.struct("freq", "token")).alias("_key"))
    return listed.join(rarest, "_rule").withColumn("_token", F.col("_key.token")).drop("_key")


def judge(pages, labels, id_col="page_id", url_col="url", rules=RULES, min_bad=MIN_BAD, min_confidence=MIN_CONFIDENCE, chance=CHANCE):
    """id, host, path, rule, verdict, mined_rule and confidence of every page.

    ``labels`` has (key, bad): a page's key is the last number of its path. A fixed rule
    decides; else a mined rule whose tokens are all in the url blocks (``mined_rule`` is
    the most confident, ties to the first in the alphabet); else the verdict is allow.
    A null url, or one without ``://``, has an empty host and path and is allowed. Null
    ids and repeated rows are kept; a key with several labels is bad if any is.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col), url.alias("_url")).withColumns({"host": host(F.col("_url")), "path": path(F.col("_url"))})
    rows = rows.withColumns(
        {
            "_tokens": tokens(F.col("_url"), F.col("host"), F.col("path")),
            "_key": F.expr("try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) as bigint)"),
            "_fixed": matching_rule(F.col("host"), F.col("path"), rules),
        }
    )
    bad = labels.where("key is not null").groupBy("key").agg(F.max("bad").alias("bad"))
    labelled = rows.join(bad, F.col("_key") == F.col("key")).select(F.col("_tokens").alias("tokens"), "bad")
    mined, frequent = mine(labelled, min_bad, min_confidence, chance)
    # equal token sets are matched once; the number of sets is far below that of urls
    sets = rows.where("_fixed is null").select("_tokens").distinct()
    hits = (
        sets.select("_tokens", F.explode("_tokens").alias("_token"))
        .join(index(mined, frequent), "_token")
        .where(F.size(F.array_except("tokens", "_tokens")) == 0)
        .groupBy("_tokens")
        .agg(F.min(F.struct((-F.col("confidence")).alias("c"), "_rule")).alias("_hit"))
    )
    return rows.join(hits, "_tokens", "left").select(
        id_col,
        "host",
        "path",
        F.col("_fixed.rule").alias("rule"),
        F.coalesce(
            F.col("_fixed.verdict"), F.when(F.col("_hit").isNotNull(), F.lit("block")), F.lit("allow")
        ).alias("verdict"),
        F.col("_hit._rule").alias("mined_rule"),
        (-F.col("_hit.c")).alias("confidence"),
    )
