"""URL filters (operator 5).

Each distinct host and path becomes expressions: every host suffix at a label
boundary joined to every path prefix of a length that some rule has. Expressions
meet the rules in an equi-join on a short prefix of their SHA-256 digest; full
digests confirm, and the longest rule wins. The join key is salted (rules are
copied once per salt), so a host that holds a third of all pages is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, without

DEFAULT_VERDICT = "allow"
SALTS = 16
#: Hexadecimal digits of the digest that the join compares.
PREFIX = 8
RULES = "action string, host string, path string"


def with_host_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` plus ``host`` and ``path`` (both empty for a null url or one without ``://``)."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), "path": F.coalesce(path, F.lit(""))})


def _rules(rules: DataFrame) -> DataFrame:
    """One row per expression; of a host and path with both actions, block holds."""
    one = rules.filter("host is not null and host != '' and path is not null").select(F.translate("host", UPPER, LOWER).alias("rhost"), F.col("path").alias("rpath"), "action")
    one = one.groupBy("rhost", "rpath").agg(F.max("action").alias("raction"))
    return one.withColumn("rule", F.concat("rhost", "rpath")).withColumn("rdigest", F.sha2("rule", 256))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """(all columns of ``pages``, host, path, rule, verdict), one row per row of
    ``pages`` (url, any others). ``rules``: action (allow or block), host, path.

    A rule fits its host and all subdomains where the url's path starts with the
    rule's path; of several the longest host and path together wins, then the
    longer host. No rule (or empty host): rule null, verdict ``default``. Repeated
    rows stay repeated; columns of the output names are replaced. Rules with a
    null part or an empty host fit nothing. Of a host only the suffixes with as many
    labels as some rule's host are made, of a path only the prefixes as long as
    some rule's, so the work per url does not grow with its length.
    """
    pages = with_host_path(without(pages, "host", "path", "rule", "verdict"))
    known = _rules(rules)
    # the lengths that rule paths have, and the numbers of labels of rule hosts: only such expressions can be in a rule
    dots = r"\."
    lengths = sorted(r[0] for r in known.select(F.char_length("rpath")).distinct().collect())
    depths = sorted(r[0] for r in known.select(F.size(F.split("rhost", dots))).distinct().collect())
    if not lengths:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    urls = pages.filter("host != ''").select("host", "path").distinct().withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
    labels = F.split("host", dots)
    within = F.filter(F.array(*map(F.lit, depths)), lambda n: n <= F.size(labels))
    suffixes = F.transform(within, lambda n: F.array_join(F.slice(labels, -n, n), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.char_length("path"))
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    grown = urls.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
    grown = grown.withColumn("digest", F.sha2(F.concat("suffix", "prefix"), 256)).withColumn("short", F.substring("digest", 1, PREFIX))
    copies = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("short", F.substring("rdigest", 1, PREFIX))
    fits = grown.join(copies, ["short", "salt"]).filter("digest = rdigest and suffix = rhost and prefix = rpath")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.char_length("rule").alias("n"), F.char_length("rhost").alias("h"), "rule", "raction")).alias("_best"))
    out = pages.join(best, ["host", "path"], "left")
    return out.select(*pages.columns, F.col("_best.rule").alias("rule"), F.coalesce("_best.raction", F.lit(default)).alias("verdict"))
