"""URL filter by a path-template tree.

Rules (host, path) decide first: a rule fits its host and all subdomains if the path starts with the rule's; the longest
rule (host and path together, ties to the longer host) wins. Its verdicts also label the pages, from which the tree learns.

The tree, per host: a path's segments are typed (numbers, hexadecimal strings, mixed codes become wildcards of that kind).
Level by level, a node's children with little support among many become ``*``, and children whose labelled share of blocked
pages does not differ significantly from their node's are merged into ``*`` as well; the others stay branches of
their own. A template's purity is its labelled share of blocked pages, smoothed towards the whole table's
or one half, if that is less. A template above THRESHOLD is rejected; one without labelled pages is allowed.

The tree is as deep as paths branch: rounds of work go from branching to branching, however long the paths are.

The work is one row per distinct (host, typed path): grouped before anything else, so repeated urls weigh nothing. Levels are
group-bys and joins; joins on a hot host are salted.

Null url or no ``://``: host and path empty, a host like others that has one template. Repeated rows are judged row by row;
extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read_table, salted_left_join, staged

ALLOW, BLOCK = "allow", "block"
RULES = (("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW), ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK))
#: A node with more children generalises those below SUPPORT of its pages.
FANOUT = 16
SUPPORT = 0.05
#: Children within this many standard errors of their node are merged.
SIMILAR = 1.96
SMOOTHING = 4.0
THRESHOLD = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: str) -> tuple[Column, Column]:
    u = F.col(url).cast("string")
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """The winning rule's text and verdict (null without a rule), over columns host and path."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def typed(path: str) -> Column:
    """The path's segments, variable ones typed; a file extension stays."""
    def one(s: Column) -> Column:
        stem, ext = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", ""), F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        kind = (F.when(stem.rlike(r"^[0-9]+$"), "<n>").when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f]{8,}$"), "<x>")
                .when(stem.rlike(r"^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z_-]{6,}$"), "<c>").otherwise(stem))
        return F.concat(kind, ext)
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/", -1), one)


def templates(pages: DataFrame) -> DataFrame:
    """(host, key, template, purity) per distinct host and typed path, from (host, path, label): label 1 block, 0 allow, null none."""
    paths = (pages.withColumn("segs", typed("path")).withColumn("key", F.array_join("segs", "/"))
             .groupBy("host", "key").agg(F.first("segs").alias("segs"), F.count("*").alias("n"),
                                         F.count("label").alias("lab"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")))
    # What all paths below a node go on with is taken at once, as nothing branches there; so a round ends at a branching
    # (or where a path ends), and a path that is alone ends in its first one.
    tree, done = staged(paths.withColumns({"template": F.lit(""), "at": F.lit(0)}), "tree"), []
    while not tree.isEmpty():
        rest = F.slice("segs", F.col("at") + 1, F.size("segs"))
        ends = tree.groupBy("host", "template").agg(F.min(rest).alias("lo"), F.max(rest).alias("hi"))
        differ = F.array_position(F.zip_with("lo", "hi", lambda x, y: F.coalesce(x == y, F.lit(False))), False)
        ends = ends.select("host", "template", F.when(differ > 0, differ - 1).otherwise(F.size("lo")).cast("int").alias("common"))
        tree = salted_left_join(tree, ends, ["host", "template"], F.col("key"))
        shared = F.when(F.col("common") > 0, F.concat(F.lit("/"), F.array_join(F.slice("segs", F.col("at") + 1, F.col("common")), "/")))
        tree = tree.withColumn("template", F.concat("template", F.coalesce(shared, F.lit("")))).withColumn(
            "at", F.col("at") + F.col("common")).drop("common")
        here = tree.withColumn("seg", F.get("segs", F.col("at")))
        child = here.where("seg is not null").groupBy("host", "template", "seg").agg(*(F.sum(c).alias(c) for c in ("n", "lab", "bad")))
        node = child.groupBy("host", "template").agg(F.sum("n").alias("n_"), F.sum("lab").alias("lab_"), F.sum("bad").alias("bad_"), F.count("*").alias("kids"))
        both = salted_left_join(child, node, ["host", "template"], F.col("seg"))
        share = F.col("bad_") / F.greatest("lab_", F.lit(1))
        error = F.sqrt((share * (1 - share) + 0.01) / F.greatest("lab", F.lit(1)))
        alike = F.abs(F.col("bad") / F.greatest("lab", F.lit(1)) - share) <= SIMILAR * error
        rare = (F.col("kids") > FANOUT) & (F.col("n") < SUPPORT * F.col("n_"))
        turned = both.withColumn("star", (F.col("kids") > 1) & (rare | (alike & (F.col("lab") > 0)))).select("host", "template", "seg", "star")
        tree = salted_left_join(here, turned, ["host", "template", "seg"], F.col("key"))
        step = F.concat("template", F.lit("/"), F.when(F.col("star"), "*").otherwise(F.col("seg")))
        tree = staged(tree.withColumn("template", F.coalesce(step, "template")).withColumn("at", F.col("at") + 1).drop("seg", "star"), "tree")
        done.append(tree.where("at >= size(segs)"))
        tree = tree.where("at < size(segs)")
    tree = reduce(DataFrame.unionByName, done, tree)
    total = tree.agg(F.sum("bad").alias("bad"), F.sum("lab").alias("lab")).first()
    base = min(0.5, (total["bad"] or 0) / max(1, total["lab"] or 0))
    purity = tree.groupBy("host", "template").agg(
        ((F.sum("bad") + SMOOTHING * base) / (F.sum("lab") + SMOOTHING)).alias("purity"))
    return salted_left_join(tree.select("host", "key", "template"), purity, ["host", "template"], F.col("key"))


def judge(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for each row of ``pages``."""
    host, path = host_path(url_col)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, by_rule = rule_columns(rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", by_rule).withColumn("label", (F.col("by_rule") == BLOCK).cast("int"))
    found = templates(rows.select("host", "path", "label"))
    keyed = rows.withColumn("key", F.array_join(typed("path"), "/"))
    out = salted_left_join(keyed, found, ["host", "key"], F.col("page_id"))
    method = F.when(F.col("purity") > THRESHOLD, BLOCK).otherwise(ALLOW)
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "template", "purity")


def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's url."""
    return judge(read_table(spark, sf_dir, "pages", "page_id", "url"))
