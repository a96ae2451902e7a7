"""Mixing sources to target weights by thresholds on a hash, with DataFrame functions only.

**Sizes.** The size of a document is its number of words between white space; a null
text has none. Sources are ordered by code point, null last, and weigh ``WEIGHTS``
in turn. Together they are to give ``SHARE`` of all sizes. No source gives more than
``MOST`` times its own size; what it cannot give the others share by weight. So a
source gives the lesser of ``MOST`` times its size and its weight times a level, and
the level is the greatest of those that running sums over the sources, in the order
in which they fill up, allow.

**Thresholds.** Every document has a hash of 60 bits over its id and text. A source
gives each of its documents as many whole times as fit its target, and those whose
hash is up to its threshold once more. The sizes are summed by source and the hash's
leading bits; running sums over these buckets find the one in which the rest of the
budget ends. Only that boundary bucket is refined by the bits that follow, until
it holds one hash. The document there is taken if that comes closer to the target.
A larger budget has a greater threshold, so mixes are nested. Nothing is sorted by
hash, and the widest window spans the buckets of one source.

Rows that repeat both id and text have one hash and are taken or left together. A
null id takes part. A source without words gives its documents zero times; an empty
table has an empty mix. The choice depends on nothing but the rows, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinrow.llm.common import bounded, settled, unused, whole
from twinrow.llm.shards import running

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Hash digits of four bits, and how many of them a histogram's buckets have.
DIGITS = 15
STEP = 3

_WORD = r"[^\x20\x09-\x0D]++"
_BLANKS = "\t\n\u000b\u000c\r "


def words(text: Column) -> Column:
    """Number of words: each becomes one letter, then white space goes."""
    ones = F.translate(F.regexp_replace(text, _WORD, "w"), _BLANKS, "")
    return F.length(ones).cast("bigint")


def place(id_: Column, text: Column) -> Column:
    """The hash of a document, from 0 to 16 ** DIGITS - 1."""
    named = F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, DIGITS), 16, 10).cast("bigint")


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Id, source, size and hash of every row."""
    id_, text = F.col(f"`{id_col}`"), whole(text_col)
    return docs.select(
        id_.alias("id"), F.col(f"`{source_col}`").alias("source"), words(text).alias("size"),
        place(id_, text).alias("place"),
    )


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source``, ``source_size``, ``target``, how many whole ``times`` it is taken, and the
    ``rest`` of its target. ``sizes`` has ``source`` and ``source_size``, a row a source."""
    one = F.lit(1).cast("bigint")
    # Null comes last where the first key tells it from the rest.
    ranked = running(
        sizes.withColumn("unnamed", F.col("source").isNull()), ["unnamed", "source"],
        {"nth": one}, "mix-sources",
    )
    turn = F.pmod(F.col("nth") - 1, F.lit(len(weights))).cast("int")
    weighed = settled(
        ranked.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), turn).cast("bigint"))
        .withColumn("most", MOST * F.col("source_size"))
        .withColumn("fills", F.col("most") / F.col("weight")),
        "mix-weights",
    )
    total = weighed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"),
        F.coalesce(F.sum("weight"), F.lit(0)).alias("weight"),
    ).first()
    filling = running(
        weighed, ["fills", "nth"],
        {"full": F.col("most"), "weighed": F.col("weight")}, "mix-levels",
    )
    # The level if the sources that fill up before this one give all they can.
    level = (F.lit(share * total["size"]) - (F.col("full") - F.col("most"))) / (
        F.lit(total["weight"]) - (F.col("weighed") - F.col("weight"))
    )
    highest = filling.agg(F.coalesce(F.max(level), F.lit(0.0))).first()[0]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(highest))
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (
        weighed.withColumn("target", target)
        .withColumn("times", times.cast("bigint"))
        .select("source", "source_size", "target", "times",
                (F.col("target") - F.col("times") * F.col("source_size")).alias("rest"))
    )


def _prefix(digits: int) -> Column:
    """The leading digits of a hash."""
    return F.shiftright("place", 4 * (DIGITS - digits))


def thresholds(narrow: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with ``top``: documents whose hash is up to it are taken once more."""
    same = F.expr("n.source <=> w.source")
    # Per source: the boundary bucket (all hashes at first), and what lies before it.
    edge = wanted.select("source", "rest", F.lit(0).cast("bigint").alias("before"))
    inside = narrow
    digits = 0
    found = None
    while digits < DIGITS:
        digits = min(digits + STEP, DIGITS)
        buckets = (
            inside.groupBy("source", _prefix(digits).alias("bucket"))
            .agg(F.sum("size").alias("held"), F.min("place").alias("low"), F.max("place").alias("high"))
        )
        in_order = Window.partitionBy("source").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, 0
        )
        sums = (
            buckets.alias("n").join(bounded(edge).alias("w"), same)
            .select("n.*", "w.rest", "w.before")
            .withColumn("reach", F.col("before") + F.sum("held").over(in_order))
        )
        edge = settled(
            sums.where("reach > rest")
            .groupBy("source").agg(F.min_by(F.struct(
                "bucket", "rest", (F.col("reach") - F.col("held")).alias("before"), "reach", "low", "high"
            ), "bucket").alias("b")).select("source", "b.*"),
            "mix-boundaries",
        )
        closer = (F.col("reach") - F.col("rest")) < (F.col("rest") - F.col("before"))
        single = F.col("low") == F.col("high")
        done = edge.where(single).select(
            "source", F.when(closer, F.col("low")).otherwise(F.col("low") - 1).alias("top")
        )
        found = done if found is None else found.unionByName(done)
        edge = edge.where(~single).select("source", "bucket", "rest", "before")
        if digits == DIGITS or edge.isEmpty():
            break
        inside = settled(
            inside.alias("n").join(
                bounded(edge).alias("w"), same & (_prefix(digits) == F.col("w.bucket")), "left_semi"
            ),
            "mix-boundary-rows",
        )
    return wanted.alias("w").join(found.alias("n"), same, "left").select(
        "w.*", F.coalesce("n.top", F.lit(-1)).alias("top")
    )


def planned(narrow: DataFrame) -> DataFrame:
    """Target and threshold of every source, as a settled table."""
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = settled(targets(sizes), "mix-targets")
    return settled(thresholds(narrow, wanted), "mix-thresholds")


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Id, size, size and target of its source, and the words taken, of every row."""
    narrow = settled(_narrow(docs, id_col, text_col, source_col), "mix-rows")
    plan = planned(narrow)
    times = F.col("w.times") + (F.col("n.place") <= F.col("w.top")).cast("bigint")
    return narrow.alias("n").join(bounded(plan).alias("w"), F.expr("n.source <=> w.source")).select(
        F.col("n.id").alias(id_col), "n.size", "w.source_size", "w.target",
        (times * F.col("n.size")).alias("taken"),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The mix itself: every row with all its columns, of any name, as often as it is taken."""
    plan = planned(settled(_narrow(docs, id_col, text_col, source_col), "mix-rows"))
    source, times, top = unused(docs.columns, "mix_source", "mix_times", "mix_top")
    plan = plan.select(
        F.col("source").alias(source), F.col("times").alias(times), F.col("top").alias(top)
    )
    own = place(F.col(f"`{id_col}`"), whole(text_col))
    often = F.col(times) + (own <= F.col(top)).cast("bigint")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), often))
    return (
        docs.join(bounded(plan), F.col(f"`{source_col}`").eqNullSafe(F.col(source)))
        .where(often > 0).withColumn(top, copies)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
