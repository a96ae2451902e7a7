"""URL filter: fixed rules, and a tree of path templates for what they leave open.

**Rules.** A rule is a verdict, a host and a path. It fits its host and all
subdomains if the path of the url starts with its path; the longest rule wins.

**Templates.** For urls that no rule fits, each host has a tree of path templates.
Segments that are numbers, dates or long ids become wildcards by their form, and
at a place of a host's paths where more than ``FAN`` different words occur, all
become the wildcard ``*``. What the rules decide are the labels of the tree.

**Merging.** Templates of a host that differ only in their last word are branches
of one node. A branch whose share of blocked labels does not differ from that of
the whole node by more than ``SIGMAS`` standard errors is merged into the node; a
branch that does, or that has no labels, stays alone.

**Purity.** A url is blocked if the smoothed share of blocked labels of its branch
reaches ``PURITY``. A host's own labels are smoothed, with a weight of ``WEIGHT``
labels, by the share of the same template over all hosts, and that towards none
blocked. So a url about which no label says anything is allowed.

Everything is a DataFrame function, and pages are only counted by host and
template, with partial aggregation. A null url, or one without ``://``, has an
empty host and path and shares the template of the empty path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinrow.llm.common import bounded, settled

#: Verdict, host and path of the rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
FAN = 20
SIGMAS = 2.0
WEIGHT = 5.0
PURITY = 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first ``://`` to the next ``/``, ``?`` or ``#``, in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From after the host to the next ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest(rules: Sequence[tuple[str, str, str]], of) -> Column:
    """``of`` the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    # The last that is wrapped around is looked at first.
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        _, host, path = rule
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col(
            "path"
        ).startswith(path)
        found = F.when(fits, F.lit(of(rule))).otherwise(found)
    return found


def _form(segment: Column) -> Column:
    """A segment with its variable form replaced; an ending such as .html stays."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    form = (
        F.when(stem.rlike(r"^[0-9]+$"), F.lit("{n}"))
        .when(stem.rlike(r"^[0-9]{1,4}[-_.][0-9]{1,2}([-_.][0-9]{1,4})?$"), F.lit("{d}"))
        .when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), F.lit("{x}"))
        .when(stem.rlike(r"^(?=.*[0-9])[A-Za-z0-9_-]{12,}$"), F.lit("{i}"))
        .otherwise(stem)
    )
    return F.concat(form, ending)


def templates(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Id, host, path, rule, its verdict and the path's template of every row."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    ).withColumns({
        "rule": _longest(rules, lambda r: r[1] + r[2]),
        "said": _longest(rules, lambda r: r[0]),
        "segments": F.transform(F.split("path", "/"), _form),
    })
    words = (
        rows.groupBy("host", "segments").count()
        .select("host", F.posexplode("segments").alias("place", "word"))
        .where(~F.col("word").startswith("{") & (F.col("word") != ""))
    )
    wide = (
        words.distinct().groupBy("host", "place").count().where(F.col("count") > FAN)
        .groupBy("host").agg(F.sort_array(F.collect_list("place")).alias("wide"))
        .select(F.xxhash64("host").alias("host_key"), "wide")
    )
    wide = settled(wide, "wide-places")
    keyed = rows.withColumn("host_key", F.xxhash64("host")).join(bounded(wide), "host_key", "left")
    general = F.transform(
        "segments",
        lambda s, i: F.when(
            F.array_contains(F.coalesce("wide", F.array().cast("array<int>")), i)
            & ~s.startswith("{") & (s != ""),
            F.lit("*"),
        ).otherwise(s),
    )
    return keyed.select(
        "id", "host", "path", "rule", "said", F.array_join(general, "/").alias("template")
    )


def tree(rows: DataFrame) -> DataFrame:
    """Node and verdict of every host and template, from rows of ``templates``."""
    yes = F.count_if(F.col("said") == "block")
    counts = rows.groupBy("host", "template").agg(
        yes.alias("blocked"), F.count("said").alias("labelled")
    )
    # A node is a template with its last plain word left open.
    node = F.regexp_replace("template", r"(^|/)([^/{*][^/{]*)((?:/(?:\{[a-z]\}[^/]*|\*)?)*)$", "$1~$3")
    whole = Window.partitionBy("host", "node")
    branches = settled(counts.withColumn("node", node).withColumns({
        "node_blocked": F.sum("blocked").over(whole), "node_labelled": F.sum("labelled").over(whole),
    }), "url-branches")
    share = F.try_divide("node_blocked", "node_labelled")
    error = F.sqrt(F.try_divide(share * (1 - share), F.col("labelled")))
    # Null for a branch without labels.
    near = F.abs(F.try_divide("blocked", "labelled") - share) <= SIGMAS * error
    merged = branches.withColumn(
        "branch", F.when(near, F.col("node")).otherwise(F.col("template"))
    )
    own = merged.groupBy("host", "branch").agg(
        F.sum("blocked").alias("own_blocked"), F.sum("labelled").alias("own_labelled")
    )
    pooled = branches.groupBy("template").agg(
        F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled")
    )
    prior = F.col("all_blocked") / (F.col("all_labelled") + WEIGHT)
    purity = (F.col("own_blocked") + WEIGHT * prior) / (F.col("own_labelled") + WEIGHT)
    return (
        merged.join(settled(own, "url-own"), ["host", "branch"])
        .join(settled(pooled, "url-pooled"), "template")
        .select("host", "template", "branch", purity.alias("purity"))
    )


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Id, host, path, rule, verdict, and the branch and purity of the tree, of every row."""
    rows = templates(pages, rules, id_col, url_col)
    verdicts = settled(
        tree(rows).select(
            F.xxhash64("host", "template").alias("key"), F.xxhash64("template", F.lit(1)).alias("check"),
            "branch", F.round("purity", 6).alias("purity"),
        ),
        "url-verdicts",
    )
    keyed = rows.withColumns({
        "key": F.xxhash64("host", "template"), "check": F.xxhash64("template", F.lit(1)),
    })
    method = F.when(F.col("purity") >= PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return keyed.join(verdicts, ["key", "check"], "left").select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("said", method).alias("verdict"), "branch", "purity",
    )
