"""URL filter: fixed rules by host and path, and a tree of path templates for urls that no rule fits.

Per host, path segments that vary (numbers, long hexadecimal or mixed names; then, by counts, rare children of a node with
many children) become wildcards, and sibling branches whose labelled shares do not differ by more than chance are merged.
A template is rejected if its share of bad labels, smoothed by those of its ancestors, reaches a threshold; to an ancestor
each of its labelled branches counts once, however many urls are in it, so one branch decides nothing about its siblings.

All nodes of all depths are settled together: urls become lines, one for each prefix of their path, and prefixes are told apart by
two 64-bit hashes that run along the path, so a url costs its length. The number of jobs does not depend on how deep paths are.
Counts are DataFrame aggregations over (host, prefix), and hot keys are joined by broadcast, so nothing gathers a host or a
template in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.shared import aside, quoted, spread_join, written

#: The rules (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@dataclass(frozen=True)
class Settings:
    """many and rare: a node with over ``many`` children makes those below a ``rare`` share of its urls a wildcard; z: standard
    errors within which siblings merge; prior_bad of prior_n: the smoothing at a host, and prior_n its weight further down;
    reject: the least smoothed share of bad labels of a rejected template; passes: how often the tree is generalised, each
    time from what the pass before has made of it."""

    many: int = 12
    rare: float = 0.05
    z: float = 1.96
    prior_bad: float = 1.0
    prior_n: float = 4.0
    reject: float = 0.75
    passes: int = 2


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next of ``/?#``, ASCII letters in lower case; empty without ``://`` or a url."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict): of the rules whose host is the url's or a parent of it and whose path begins the url's, the longest."""
    rule = verdict = F.lit(None).cast("string")
    for name, prefix, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule, verdict = F.when(fits, F.lit(name + prefix)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """The segments of a path; what is variable by its letters is a wildcard already. Keeps endings like .html."""

    def general(x: Column) -> Column:
        ending = F.regexp_extract(x, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.substring(x, F.lit(1), F.char_length(x) - F.char_length(ending))
        varies = stem.rlike(r"^[0-9]+([._,-][0-9]+)*$|^(?=[^A-Za-z]*[A-Za-z])(?=.*[0-9])[0-9A-Za-z_-]{6,}$|^[0-9a-fA-F-]{16,}$")
        return F.when(varies, F.concat(F.lit("*"), ending)).otherwise(x)

    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), general)


#: The running hashes of a path's prefixes, from that of no segment on: an array of (h1, h2), one longer than the path.
_PREFIXES = """aggregate(shape, array(named_struct('h1', 17L, 'h2', 31L)), (hs, x) ->
    array_append(hs, named_struct('h1', xxhash64(element_at(hs, -1).h1, x), 'h2', xxhash64(x, element_at(hs, -1).h2))))"""


def _lines(paths: DataFrame, *columns: str) -> DataFrame:
    """A line for each segment of each path: its number k, how it was written, the node that ends with it, and the node before that."""
    at = F.explode(F.transform(F.sequence(F.lit(1), F.size("shape")), lambda k: F.struct((k - 1).alias("k"), F.element_at("raw", k).alias("segment"), F.element_at("hs", k).alias("parent"), F.element_at("hs", k + 1).alias("node"))))
    return paths.withColumn("hs", F.expr(_PREFIXES)).select("host", *columns, at.alias("x")).select("host", *columns, "x.*")


def _general(paths: DataFrame, s: Settings) -> DataFrame:
    """Paths (host, raw, n, bad, good, path, shape) with the shapes that one pass over the tree gives them."""
    lines = written(_lines(paths, "path", "n", "bad", "good"), "url-lines")
    nodes = lines.groupBy("host", "parent", "node").agg(F.sum("n").alias("urls"), F.sum("bad").alias("b"), F.sum("good").alias("g"), F.count("*").alias("lines"))
    nodes = written(nodes.withColumn("m", F.col("b") + F.col("g")), "url-nodes")
    family = nodes.groupBy("host", "parent").agg(F.sum("urls").alias("all"), F.count("*").alias("n"), F.sum("b").alias("bs"), F.sum("m").alias("ms"), F.count_if(F.col("m") > 0).alias("labelled"))
    judged = spread_join(nodes, written(family.withColumn("kids", F.col("n")), "url-families"), ["host", "parent"])
    # Rare children of many become a wildcard, and so do branches that are labelled alike, within chance.
    wild = (F.col("kids") > s.many) & (F.col("urls") < s.rare * F.col("all"))
    own, pool = F.col("b") / F.greatest(F.col("m"), F.lit(1)), (F.col("bs") + s.prior_bad) / (F.col("ms") + s.prior_n)
    alike = (F.col("m") > 0) & (F.col("labelled") > 1) & (F.abs(own - pool) <= s.z * F.sqrt(pool * (1 - pool) / F.greatest(F.col("m"), F.lit(1))))
    starred = written(judged.where(wild | alike).select("host", "node", F.col("lines").alias("n")), "url-wild")
    places = spread_join(lines.select("host", "path", "k", "node"), starred, ["host", "node"]).groupBy("path").agg(F.collect_set("k").alias("wild"))
    shape = F.transform("shape", lambda x, i: F.when(F.array_contains("wild", i), F.lit("*")).otherwise(x))
    return written(paths.join(places, "path", "left").withColumn("shape", F.when(F.col("wild").isNull(), F.col("shape")).otherwise(shape)).drop("wild"), "url-paths")


def _shares(tree: DataFrame, s: Settings) -> DataFrame:
    """(host, shape, bad_share, n): a template's share of bad labels, smoothed by that of its parent, and so on up to the host.

    A template counts its own labelled urls. A node above it counts its labelled branches, each once, by the share of bad
    labels in it; branches that were merged count as often as they were different. Without any it has the share of its
    parent, and a host without any the prior.
    """
    branches = _lines(tree.where("bad + good > 0"), "bad", "good").groupBy("host", "parent", "segment").agg(F.sum("bad").alias("b"), (F.sum("bad") + F.sum("good")).alias("m"))
    above = branches.groupBy("host", "parent").agg(F.sum(F.col("b") / F.col("m")).alias("s"), F.count("*").alias("d"))
    templates = tree.groupBy("host", "shape").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("n")).withColumn("path", F.monotonically_increasing_id())
    templates = written(templates, "url-templates")
    lines = written(_lines(templates.withColumn("raw", F.col("shape")), "path").select("host", "path", "k", "parent"), "url-lines")
    asked = lines.groupBy("host", "parent").agg(F.count("*").alias("n"))
    found = spread_join(lines, written(above.join(asked, ["host", "parent"]), "url-above"), ["host", "parent"])
    found = found.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("k", "s", "d"))).alias("line"))
    one = lambda share, x: (x["s"] + s.prior_n * share) / (x["d"] + s.prior_n)
    line = F.coalesce("line", F.expr("cast(array() as array<struct<k:int,s:double,d:bigint>>)"))
    # A host's own smoothing is the prior, which has the weight prior_n as well.
    fold = F.aggregate(line, F.lit(s.prior_bad / s.prior_n), one)
    share = (F.col("bad") + s.prior_n * fold) / (F.col("bad") + F.col("good") + s.prior_n)
    return templates.join(found, "path", "left").select("host", "shape", share.alias("bad_share"), "n")


def filter_urls(df: DataFrame, url: str = "url", rules=RULES, label: Column | None = None, s: Settings = Settings()) -> DataFrame:
    """Adds host, path, rule, verdict, template and bad_share to every row; equal-named columns are replaced, all others pass
    through whatever their names.

    Labels of the tree are ``label`` (1 bad, 0 good, else null), by default the verdicts of the rules themselves. A url that a
    rule fits gets the rule's verdict; others are blocked if their template's smoothed share of bad labels reaches ``s.reject``.
    A template without labels has the share of the branches around it: several that are bad reject it, one does not, so where a rule
    handles one branch of a host the others are allowed. Without any labels urls are allowed.
    Null urls and those without ``://`` have an empty host and path. Equal urls, and equal rows, get equal results; they count
    as often as they occur. Urls of any length and depth are taken whole. An empty table gives an empty result.
    """
    added = ["host", "path", "rule", "verdict", "template", "bad_share"]
    there, back = aside(df, added)
    known = label if label is not None else F.lit(None).cast("int")
    rows = df.select(*there, *(c.alias("url") for c in quoted([url])), known.alias("known"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "says": says, "raw": segments(F.col("path"))}).drop("url")
    y = F.col("known") if label is not None else F.when(F.col("says") == "block", 1).when(F.col("says") == "allow", 0)
    seen = rows.groupBy("host", "raw").agg(F.count("*").alias("n"), F.count_if(y == 1).alias("bad"), F.count_if(y == 0).alias("good"))
    tree = written(seen.withColumns({"shape": F.col("raw"), "path": F.monotonically_increasing_id()}), "url-paths")
    for _ in range(s.passes):
        tree = _general(tree, s)
    judged = spread_join(tree.select("host", "raw", "shape", F.col("n").alias("urls")), written(_shares(tree, s), "url-shares"), ["host", "shape"])
    judged = judged.select("host", "raw", F.concat(F.lit("/"), F.array_join("shape", "/")).alias("template"), "bad_share", F.col("urls").alias("n"))
    verdict = F.coalesce(F.col("says"), F.when(F.col("bad_share") >= s.reject, "block").otherwise("allow"))
    return spread_join(rows, written(judged, "url-judged"), ["host", "raw"]).select(*back, "host", "path", "rule", verdict.alias("verdict"), "template", "bad_share")
