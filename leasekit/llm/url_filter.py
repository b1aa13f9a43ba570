"""Operator 6: URL filter by rules and a path-template tree.

*Rules* ("host/path prefix") fit their host and its subdomains if the URL's path starts with theirs; the longest rule
that fits decides.

*Template tree.* For URLs without a rule, each host has a tree of path segments. Segments are typed first (numbers,
hexadecimal ids, also before a file ending). URLs are then counted by (host, typed path) with their labels, and all
work goes on over that table, in rounds for all hosts at once:

* what all paths of a node have in common is taken over at once, up to the first place where two of them differ: the
  smallest path (with an end after all segments) and the largest one differ there. So rounds follow the depth of
  branchings, not that of paths; a path that is alone in its node, or ends before that place, is done;
* a branch whose share of bad labels differs significantly from the rest of its node's keeps its name; all others are
  merged into the wildcard ``*`` (a variable segment). One rule holds for any number of branches: a two-proportion z-test,
  and an exact bound on the tail of the branch's count of bad labels (Chernoff), multiplied by the number of branches, as
  with more branches some differ by chance.

Counts are sums by (host, prefix, segment), so a host with a third of all URLs is never gathered in one task.

*Purity.* A template's share of bad labels is smoothed towards the share in all labels; templates from ``BLOCK_AT`` on are
rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit.llm.common import written

Z, SMOOTHING, BLOCK_AT = 1.96, 10.0, 0.5
#: Chance that a node keeps any branch that does not really differ.
FALSE_BRANCHES = 0.05
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; null or without ``://``: both empty."""
    part = lambda k: F.coalesce(F.regexp_extract(url, _URL, k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def rule_and_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of ``rules`` (verdict, "host/path prefix") that fits, and its verdict; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        of, _, start = text.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def typed_segments(path: Column) -> Column:
    """Segments of a path, with numbers as ``<n>`` and ids as ``<id>`` (a file ending stays)."""
    number = lambda s: F.regexp_replace(s, r"^[0-9]+(?=$|\.[A-Za-z0-9]{1,8}$)", "<n>")
    ident = lambda s: F.regexp_replace(s, r"^(?=.*[0-9])[0-9a-fA-F-]{8,}(?=$|\.[A-Za-z0-9]{1,8}$)", "<id>")
    return F.transform(F.split(path, "/"), lambda s: ident(number(s)))


def _differs(branches: Column, bl: Column, bb: Column, nl: Column, nb: Column) -> Column:
    """Does a branch with ``bb`` bad of ``bl`` labels differ from the rest of its node (``nb`` of ``nl`` with it)?"""
    rest_l, rest_b = nl - bl, nb - bb
    pooled = F.try_divide(nb, nl)
    spread = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), bl) + F.try_divide(F.lit(1.0), rest_l)))
    z = F.abs(F.try_divide(F.try_divide(bb, bl) - F.try_divide(rest_b, rest_l), spread))
    # The rest's share is kept off 0 and 1, as by one label more of each kind.
    rest = (rest_b + 1) / (rest_l + 2)
    part = lambda k, p: F.when(k > 0, k * F.log(k / (bl * p))).otherwise(0.0)
    sure = part(bb, rest) + part(bl - bb, 1 - rest) >= F.log(2 * branches / FALSE_BRANCHES)
    return F.coalesce((z >= Z) & sure, F.lit(False))


def _first_branching(now: DataFrame) -> DataFrame:
    """``host, template, at`` of each node: the place in ``rest`` where its paths first differ, -1 if nowhere."""
    step = lambda end, s: F.struct(F.lit(end).alias("end"), s.alias("s"))
    ending = F.concat(F.transform("rest", lambda s: step(False, s)), F.array(step(True, F.lit(""))))
    low, high = F.transform(F.filter(F.min(ending), lambda x: ~x["end"]), lambda x: x["s"]), F.max("rest")
    unlike = F.zip_with(low, high, lambda a, b: F.coalesce(a != b, F.lit(False)))
    return now.groupBy("host", "template").agg((F.array_position(unlike, True) - 1).cast("int").alias("at"))


def templates(counted: DataFrame) -> DataFrame:
    """``host, typed, template`` of the different typed paths in ``counted`` (host, typed, n, labelled, bad)."""
    keep = counted.columns
    now, done = counted.select("*", F.col("typed").alias("rest"), F.array().cast("array<string>").alias("template")), []
    while not now.isEmpty():
        placed = now.join(_first_branching(now), ["host", "template"])
        ends = (F.col("at") < 0) | (F.size("rest") <= F.col("at"))
        # Never evaluated for a path that ends, but a slice may not start before 1.
        at = F.greatest("at", F.lit(0))
        common = F.when(ends, F.col("rest")).otherwise(F.slice("rest", 1, at))
        placed = placed.select(*keep, ends.alias("ends"), F.concat("template", common).alias("template"),
                               F.when(~ends, F.get("rest", at)).alias("segment"),
                               F.slice("rest", at + 2, F.greatest(F.size("rest") - at - 1, F.lit(0))).alias("rest"))
        going = placed.where("not ends")
        branch = going.groupBy("host", "template", "segment").agg(F.sum("labelled").alias("bl"), F.sum("bad").alias("bb"))
        node = branch.groupBy("host", "template").agg(F.count("*").alias("branches"), F.sum("bl").alias("nl"), F.sum("bb").alias("nb"))
        differs = _differs(*map(F.col, ("branches", "bl", "bb", "nl", "nb")))
        name = F.when((F.col("branches") == 1) | differs, F.col("segment")).otherwise("*")
        named = branch.join(node, ["host", "template"]).select("host", "template", "segment", name.alias("name"))
        after = placed.join(named, ["host", "template", "segment"], "left")
        here = F.when(F.col("ends"), F.col("template")).otherwise(F.concat("template", F.array("name")))
        after = after.select(*keep, here.alias("template"), "rest", (F.col("ends") | (F.size("rest") == 0)).alias("ended"))
        after = written(after, "templates")
        done.append(after.where("ended").drop("ended", "rest"))
        now = after.where("not ended").drop("ended")
    out = done[0] if done else now.drop("rest")
    for more in done[1:]:
        out = out.union(more)
    return out.withColumn("template", F.array_join("template", "/"))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]], block_at: float = BLOCK_AT) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, bad_share`` of every row of ``pages`` (page_id, url).

    ``labelled`` has ``url`` and ``bad`` (boolean) of judged URLs; nulls are ignored. Null URLs, or without ``://``, have
    an empty host and path and the method's verdict for those. Hosts without labels take the share of all labels; with no
    labels nothing is blocked by the method. Repeated rows stay; an empty table gives an empty result; further columns
    are not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("typed", typed_segments(F.col("path")))
    seen = rows.groupBy("host", "typed").agg(F.count("*").alias("n"))
    marks = labelled.where("url is not null and bad is not null").select(host.alias("host"), typed_segments(path).alias("typed"), F.col("bad").cast("long").alias("bad"))
    marks = marks.groupBy("host", "typed").agg(F.count("*").alias("labelled"), F.sum("bad").alias("bad"))
    counted = written(seen.join(marks, ["host", "typed"], "left").fillna(0, ["labelled", "bad"]), "typed-paths")
    total = counted.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).first()
    prior = total.b / total.l if total.l else 0.0
    placed = templates(counted)
    share = (F.sum("bad") + SMOOTHING * prior) / (F.sum("labelled") + SMOOTHING)
    judged = placed.groupBy("host", "template").agg(share.alias("bad_share"))
    of = placed.select("host", "typed", "template").join(judged, ["host", "template"])
    rule, verdict = rule_and_verdict(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_share") >= block_at, "block").otherwise("allow")
    return rows.join(of, ["host", "typed"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", "bad_share")
