"""URL filters: rules first, then the likelihood ratio of two character language models.

Everything runs as DataFrame operations.  The models are smoothed variable-order
Markov models: the probability of a character after a context is interpolated
from the longest context down to a uniform one, each by what it has seen and by
how many different characters followed it (Witten-Bell).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bounded, materialise

#: Rule (host, path, verdict); fits the host and its subdomains if the path starts with the rule's.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Rules up to which they are one expression; more are joined by host.
EXPRESSION_RULES = 1_000
#: Characters of context, and the chance of a character that was never seen.
ORDER, UNSEEN = 4, 1.0 / 256
#: Characters up to which grams are cut out of a string as it is.
SHORT = 1_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\u0002", "\u0003"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to / ? # or the end, A-Z lower-cased; then up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) over columns host and path: the longest rule that fits, else null."""
    name = verdict = None
    for host, path, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.when(fits, host + path) if name is None else name.when(fits, host + path)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    return name if rules else F.lit(None).cast("string"), verdict if rules else F.lit(None).cast("string")


def with_rules(rows: DataFrame, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """``rows`` (host, path, more) with rule and verdict, for any number of rules."""
    if len(rules) <= EXPRESSION_RULES:
        rule, verdict = ruled(rules)
        return rows.withColumn("rule", rule).withColumn("verdict", verdict)
    table = rows.sparkSession.createDataFrame([(h, p, v) for h, p, v in rules], "r_host string, r_path string, r_verdict string")
    table = materialise(table.distinct())
    parts = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    kinds = materialise(rows.select("host", "path").distinct())
    fits = kinds.withColumn("r_host", F.explode(ends)).join(bounded(table), "r_host").where(F.col("path").startswith(F.col("r_path")))
    name = F.concat("r_host", "r_path")
    best = fits.groupBy("host", "path").agg(F.min(F.struct((-F.length(name)).alias("length"), "r_host", "r_path", "r_verdict")).alias("best"))
    best = materialise(best.select("host", "path", F.concat("best.r_host", "best.r_path").alias("rule"), F.col("best.r_verdict").alias("verdict")))
    return rows.join(bounded(best), ["host", "path"], "left")


def _gram(order: int) -> Column:
    """One row for each character of column ``key`` and for the end, with its context.

    Cutting a gram out takes time in proportion to its place, so long strings are split into characters first.
    """
    s = F.concat(F.lit(_START * order), "key", F.lit(_END))
    cut = F.transform(F.sequence(F.lit(1), F.length(s) - order), lambda i: F.substr(s, i, F.lit(order + 1)))
    chars = F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))
    windows = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - order - 1), lambda i: F.concat(*[F.get(c, i + d) for d in range(order + 1)]))
    return F.explode(F.when(F.length("key") <= SHORT, cut).otherwise(windows(chars))).alias("gram")


def log_ratios(known: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log of the chance of the last character among accepted over rejected URLs.

    ``known`` (verdict, gram, n) holds counts, ``wanted`` (gram) all grams to judge.
    """
    of = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v)
    none = wanted.select(F.lit(None).cast("string").alias("verdict"), "gram", F.lit(0).cast("long").alias("n"))
    counts = materialise(known.select("verdict", "gram", "n").unionByName(none).groupBy("gram").agg(of("allow"), of("block")))
    return _ratios(counts, order).join(wanted.distinct(), "gram")


def _ratios(counts: DataFrame, order: int) -> DataFrame:
    """(gram, ratio) for materialised counts (gram, allow, block), which may be 0.

    Counts of shorter grams are sums of those of longer ones.  From the shortest on,
    each order mixes its own counts with the chances one order below, which are
    joined by the gram without its first character; every table is written, so a
    plan holds one order.  A context has as many rows as there are characters at most.
    """
    levels = [counts.select(F.col("gram").alias("end"), "allow", "block")]
    for _ in range(order):
        shorter = levels[-1].groupBy(F.expr("substr(end, 2)").alias("end")).agg(*[F.sum(v).alias(v) for v in ("allow", "block")])
        levels.append(materialise(shorter))
    lower = None
    for k, level in enumerate(reversed(levels)):
        row = level.withColumn("context", F.substr("end", F.lit(1), F.lit(k)))
        if lower is not None:
            row = row.withColumn("rest", F.expr("substr(end, 2)")).join(bounded(lower), "rest")
        same = Window.partitionBy("context")
        below = lambda v: F.col(f"below_{v}") if lower is not None else F.lit(UNSEEN)  # noqa: B023, E731
        for v in ("allow", "block"):
            row = row.withColumns({f"all_{v}": F.sum(v).over(same), f"kinds_{v}": F.sum((F.col(v) > 0).cast("long")).over(same)})
        given = {v: F.col(f"all_{v}") + F.col(f"kinds_{v}") for v in ("allow", "block")}
        chance = {v: F.when(given[v] > 0, (F.col(v) + F.col(f"kinds_{v}") * below(v)) / given[v]).otherwise(below(v)) for v in given}
        if k == order:
            return row.select(F.col("end").alias("gram"), (F.log(chance["allow"]) - F.log(chance["block"])).alias("ratio"))
        lower = materialise(row.select(F.col("end").alias("rest"), *[c.alias(f"below_{v}") for v, c in chance.items()]))
    raise ValueError("order must not be negative")


def _scores(kinds: DataFrame, ratios: DataFrame, order: int) -> DataFrame:
    """(id, ratio): mean ratio over the characters of every row of ``kinds`` (id, key).

    The most frequent grams, BROADCAST_ROWS of them at most, are looked up in place;
    only the others' occurrences are shuffled.  ``ratios`` (gram, ratio, times) is materialised.
    """
    often = F.floor(F.log2("times")).cast("int")
    sizes = sorted(((r["often"], r["count"]) for r in ratios.groupBy(often.alias("often")).count().collect()), reverse=True)  # 64 rows at most
    least, total = 64, 0
    for k, n in sizes:
        total += n
        if total > BROADCAST_ROWS:
            break
        least = k
    grams = kinds.select("id", _gram(order))
    common, rare = ratios.where(often >= least), ratios.where(often < least)
    seen = grams.join(F.broadcast(common), "gram", "left")  # BROADCAST_ROWS short strings at most
    sums = [F.sum("ratio").alias("sum"), F.count("*").alias("n")]
    parts = seen.where("ratio is not null").groupBy("id").agg(*sums)
    if total > BROADCAST_ROWS:
        parts = parts.unionByName(seen.where("ratio is null").select("id", "gram").join(rare, "gram").groupBy("id").agg(*sums))
    return parts.groupBy("id").agg((F.sum("sum") / F.sum("n")).alias("ratio"))


def _threshold(scored: DataFrame, bins: int = 2_000) -> float:
    """The ratio that best tells held-out accepted from rejected URLs, both weighing the same.

    ``scored`` (verdict, ratio, n) is counted, n times each row if there is n, in a
    fixed number of bins from -10 to 10.
    """
    n = F.col("n") if "n" in scored.columns else F.lit(1)
    slot = F.least(F.greatest(F.floor((F.col("ratio") + 10) * bins / 20), F.lit(0)), F.lit(bins - 1)).cast("int")
    rows = scored.groupBy(slot.alias("slot")).agg(*[F.sum(F.when(F.col("verdict") == v, n).otherwise(0)).alias(v) for v in ("allow", "block")]).collect()
    allow, block = [0] * bins, [0] * bins
    for r in rows:
        allow[r["slot"]], block[r["slot"]] = r["allow"], r["block"]
    a, b = sum(allow), sum(block)
    if not a or not b:
        return 0.0
    best, found, low = -1.0, [], 0.0
    for k in range(bins + 1):  # URLs below bin k are blocked
        right = low + sum(allow[k:]) / a if k == 0 else right - allow[k - 1] / a + block[k - 1] / b  # noqa: F821
        if right > best + 1e-12:
            best, found = right, [k]
        elif right > best - 1e-12:
            found.append(k)
    middle = found[len(found) // 2]
    return middle * 20 / bins - 10


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, order: int = ORDER) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, ratio) for every row of ``pages`` (page_id, url, more).

    A rule's verdict stands.  Other URLs are allowed if their log-likelihood ratio
    by character, over the whole URL, is at least the calibrated threshold.  Models are
    fitted on the URLs that rules decide, each as often as it occurs, four fifths by
    hash of the URL; the rest calibrates.  Without accepted or rejected ones the
    threshold is 0.  Null URLs count as empty ones; these and URLs without ``://``
    have an empty host and path and are judged like any other.  Repeated rows are
    rows of their own; an empty table gives an empty table.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", F.coalesce("url", F.lit("")).alias("key"), host.alias("host"), path.alias("path"))
    rows = with_rules(rows, rules)
    kinds = rows.groupBy("key").agg(F.first("verdict").alias("verdict"), F.count("*").alias("n"))
    held = F.pmod(F.xxhash64("key"), F.lit(5)) == 0
    # a small table is much work, so it is dealt out anew
    kinds = kinds.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    kinds = materialise(kinds.select(F.monotonically_increasing_id().alias("id"), "key", "verdict", "n", held.alias("held")))
    fits = lambda v: F.sum(F.when((F.col("verdict") == v) & ~F.col("held"), F.col("n")).otherwise(0)).alias(v)
    counts = kinds.select("verdict", "held", "n", _gram(order)).groupBy("gram").agg(fits("allow"), fits("block"), F.count("*").alias("times"))
    counts = materialise(counts)
    ratios = materialise(_ratios(counts, order).join(counts.select("gram", "times"), "gram"))
    judged = kinds.where("held or verdict is null")
    scored = materialise(_scores(judged.select("id", "key"), ratios, order).join(judged, "id").select("key", "verdict", "n", "ratio"))
    edge = _threshold(scored.where("verdict is not null"))
    mine = materialise(scored.where("verdict is null").select("key", "ratio"))
    out = rows.join(bounded(mine), "key", "left")
    said = F.coalesce("verdict", F.when(F.col("ratio") >= edge, "allow").otherwise("block"))
    return out.select("page_id", "url", "host", "path", "rule", said.alias("verdict"), "ratio")
