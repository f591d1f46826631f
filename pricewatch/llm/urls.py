"""URL filters: explicit rules, and a path-template tree judged by labelled purity.

Rules fit a host and its subdomains and the beginning of the path; the longest wins. URLs without a rule go by their template.
Per host, numbers inside segments become wildcards; then, level by level, the segments below one template prefix are compared:
rare ones, and those whose share of good labelled pages does not differ significantly from that of all pages below the prefix,
merge into a wildcard branch, the others stay branches of their own. A template's purity is its share of good labels, shrunk
towards the host's share, which is shrunk towards the global one; templates under ``least_purity`` are blocked.

The tree is built on counts per distinct generalised path, never on single pages, down to the deepest level at which two of
them share a template prefix. A path that has ended leaves the loop, and so does one that is alone below its prefix: its branches
are compared with themselves only, so all of them are wildcards.

Defined cases: a null URL or one without ``://`` has an empty host and path and is judged by the template of those; a template
without labels takes its host's share; repeated pages are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.common import ascii_lower, fresh, names, stored
from pricewatch.session import new_dir

#: The rules to judge by (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
LEAST_PAGES, LEAST_Z, STRENGTH, LEAST_PURITY = 5, 1.96, 10.0, 0.5


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        site, _, rest = rule.partition("/")
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(f"/{rest}")
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """The path's segments with numbers as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(s, "[0-9]+", "*"))


def _wild(segment: Column) -> Column:
    """The wildcard branch; an extension tells kinds of pages apart by itself, so it is kept."""
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z]+)$", 1))


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "labelled", "good")]


def templates(paths: DataFrame, strength: float = STRENGTH, least_pages: int = LEAST_PAGES, least_z: float = LEAST_Z) -> DataFrame:
    """host, segments, template, purity for counts (host, segments, n, labelled, good) per generalised path."""
    columns, path, level = ["host", "segments", "n", "labelled", "good", "template"], new_dir(paths.sparkSession, "url-leaves"), 0
    tree = stored(paths.withColumn("template", F.lit("")).select(*columns), "url-tree")
    while True:
        deeper = F.size("segments") > level
        several = tree.filter(deeper).groupBy("host", "template").agg((F.count(F.lit(1)) > 1).alias("several"))
        marked = stored(tree.join(several, ["host", "template"], "left").withColumn("on", deeper & F.col("several")), "url-marked")
        rest = F.transform(F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0))), _wild)
        left = marked.filter(~F.col("on")).withColumn("template", F.concat_ws("/", F.array("template"), rest))
        left.select(*columns).write.mode("append").parquet(path)
        here = marked.filter("on").select(*columns, F.element_at("segments", level + 1).alias("child"))
        if here.isEmpty():
            break
        branches = stored(here.groupBy("host", "template", "child").agg(*_sums()), "url-branches")
        parents = branches.groupBy("host", "template").agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "good")))
        rate = (F.col("all_good") + 1) / (F.col("all_labelled") + 2)
        z = F.abs(F.col("good") - F.col("labelled") * rate) / F.sqrt(F.col("labelled") * rate * (1 - rate) + 1e-9)
        apart = (F.col("n") >= least_pages) & (F.col("labelled") >= least_pages) & (z >= least_z)
        branch = F.when(apart, F.col("child")).otherwise(_wild(F.col("child")))
        named = stored(branches.join(parents, ["host", "template"]).select("host", "template", "child", branch.alias("branch")), "url-names")
        tree = here.join(named, ["host", "template", "child"]).withColumn("template", F.concat_ws("/", "template", "branch"))
        tree, level = stored(tree.select(*columns), "url-tree"), level + 1
    tree = paths.sparkSession.read.schema(tree.schema).parquet(path)
    total = tree.agg(F.sum("good").alias("g"), F.sum("labelled").alias("l")).first()
    overall = ((total.g or 0) + 1) / ((total.l or 0) + 2)
    hosts = tree.groupBy("host").agg(((F.sum("good") + strength * overall) / (F.sum("labelled") + strength)).alias("host_purity"))
    leaves = tree.groupBy("host", "template").agg(*_sums()).join(hosts, "host")
    purity = (F.col("good") + strength * F.col("host_purity")) / (F.col("labelled") + strength)
    leaves = stored(leaves.select("host", "template", purity.alias("purity")), "url-templates")
    return tree.select("host", "segments", "template").join(leaves, ["host", "template"])


def page_labels(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """host, path, segments and good (null without a label) per page; a URL's last number names the labelled document."""
    parsed = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    number = F.expr("try_cast(nullif(regexp_extract(path, '([0-9]+)[^0-9/]*/?$', 1), '') as bigint)")
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.col("quality") * (1 - F.coalesce("toxic", F.lit(0)))).alias("good"))
    return parsed.withColumn("number", number).join(known, F.col("number") == F.col("doc_id"), "left").select("host", segments(F.col("path")).alias("segments"), "good")


def judge(pages: DataFrame, labels: DataFrame, url_col: str = "url", rules=RULES, least_purity: float = LEAST_PURITY) -> DataFrame:
    """``pages`` with host, path, rule, template, purity and verdict."""
    marked = page_labels(pages, labels, url_col)
    one = F.lit(1).cast("long")
    counts = marked.groupBy("host", "segments").agg(F.sum(one).alias("n"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"))
    made = stored(templates(counts), "url-judged")
    new = {c: fresh(c, pages) for c in ("host", "path", "rule", "template", "purity", "verdict")}
    segs, h, s = (fresh(c, pages) for c in ("_segments", "_host", "_shape"))
    url = F.col(f"`{url_col}`")
    rows = pages.withColumns({new["host"]: host_of(url), new["path"]: path_of(url), segs: segments(path_of(url))})
    made = made.select(F.col("host").alias(h), F.col("segments").alias(s), F.col("template").alias(new["template"]), F.col("purity").alias(new["purity"]))
    rows = rows.join(made, (F.col(new["host"]) == F.col(h)) & (F.col(segs) == F.col(s)), "left").drop(segs, h, s)
    rule = rule_of(F.col(new["host"]), F.col(new["path"]), rules)
    own = F.when(F.col(new["purity"]) < least_purity, "block").otherwise("allow")
    by_rule = F.coalesce(*(F.when(F.col(new["rule"]) == r, F.lit(v)) for v, r in rules), own)
    return rows.withColumn(new["rule"], rule).withColumn(new["verdict"], by_rule).select(*names(pages), *new.values())
