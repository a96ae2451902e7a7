"""Benchmark decontamination by templates, with DataFrame functions only.

**Templates.** Numbers, names and units become typed placeholders that still carry
their value: a number is a run of digits with inner points and commas, a unit is
a known word right after a number, a name is a capitalised word that follows a
small letter, a digit or a comma and a space. Everything else is lower-cased and
cut into words of letters. Texts are compared in three forms, and the best counts:
with these names, with every capitalised word a name, and without names. A template window is five words in a row, placeholders
reduced to their type; items of fewer words are one window of all they have. Where
every capitalised word is a name, only windows of five words, two of them plain,
count.

**Join.** Windows of the benchmark are a small table; its size is checked, and up
to ``BROADCAST_ROWS`` windows it is broadcast, so the corpus is scanned once and
only hits are shuffled. A larger benchmark is joined by shuffle. Items are first looked
for by their rarest windows, of which a contaminated text must hold one, then counted,
and only those with enough windows are aligned.

**Slots.** Hits of a document and an item that lie at the same offset form an
alignment. A re-parameterised question has every value replaced the same way
throughout: windows with a value of the item that stands for two of the document in
the alignment do not count, unless all their values are unchanged. Two values of the
item may both become the same one.

**Verdict.** A document is contaminated by an item if its remaining alignments
hold at least ``SHARE`` of the item's distinct windows.

A null text has no words; so has a null benchmark item, which contaminates
nothing. Rows are told apart by id and text, so repeated ids do not mix, and
repeated rows have the same verdict. Rows of the benchmark that repeat an id with
another text are looked for one by one, and an item may have no id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinrow.llm.common import BROADCAST_ROWS, settled, unused, whole

WORDS = 5
SHARE = 0.8

NAME, NUMBER, UNIT = "\u0002", "\u0003", "\u0004"
#: Marks capitalised words that are a name only where all of these are.
CAPITAL = "\u0005"
#: Forms of a text: names by context, every capitalised word a name, no names.
BY_CONTEXT, ALL_CAPITALS, NO_NAMES = range(3)
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g gram grams kg "
    "kilogram kilograms oz lb lbs pound pounds t ton tons ml cl l liter liters litre litres "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months "
    "year years hz khz mhz w kw mw v a j kj cal kcal pa kpa k c f percent euro euros dollar "
    "dollars cent cents usd eur"
).split()


def _cut(text: Column) -> Column:
    """Words of a text; placeholders and capitalised words are a mark and their value."""
    # The mark characters themselves are no letters and vanish in the cut.
    all_marks = NAME + NUMBER + UNIT + CAPITAL
    marks = reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in all_marks])
    plain = F.when(marks, F.translate(text, all_marks, "    ")).otherwise(text)
    names = F.regexp_replace(
        plain, r"\p{Lu}(?<=[\p{Ll}\p{Nd},] \p{Lu})\p{Ll}+", NAME + "$0"
    )
    capitals = F.regexp_replace(
        names, rf"\p{{Lu}}(?<![\p{{L}}\p{{M}}\p{{Nd}}{NAME}]\p{{Lu}})[\p{{Ll}}\p{{M}}]+", CAPITAL + "$0"
    )
    # One pass marks a number and the unit that may follow; a mark without a unit goes.
    numbers = F.regexp_replace(
        F.lower(capitals),
        rf"(\p{{Nd}}++(?:[.,]\p{{Nd}}++)*+)(?: ?({'|'.join(UNITS)})(?![\p{{L}}\p{{Nd}}]))?",
        f" {NUMBER}$1 {UNIT}$2 ",
    )
    inner = F.regexp_replace(numbers, r"[.,](?!\p{Nd})", " ")
    words = F.split(inner, rf"[^\p{{L}}\p{{M}}\p{{Nd}}{all_marks}.,]+")
    return F.filter(words, lambda w: ~w.isin("", UNIT))


def _form(words: Column, form: int) -> Column:
    """The words of ``_cut`` in one of the forms."""
    if form == BY_CONTEXT:
        return F.transform(words, lambda w: F.ltrim(w, F.lit(CAPITAL)))
    if form == ALL_CAPITALS:
        return F.transform(words, lambda w: F.when(w.startswith(CAPITAL), F.translate(w, CAPITAL, NAME)).otherwise(w))

    def bare(w: Column, i: Column) -> Column:
        # A capitalised unit is one again.
        value = F.substring(w, 2, 2**31 - 1)
        unit = (i > 0) & F.get(words, i - 1).startswith(NUMBER) & value.isin(UNITS)
        return F.when(
            w.startswith(NAME), F.when(unit, F.concat(F.lit(UNIT), value)).otherwise(value)
        ).otherwise(F.ltrim(w, F.lit(CAPITAL)))

    return F.transform(words, bare)


def marked_words(text: Column) -> Column:
    """Words of a text; placeholders are a mark followed by their value."""
    return _form(_cut(text), BY_CONTEXT)


def _with_types(rows: DataFrame) -> DataFrame:
    """A row for each ``form`` of the column ``cut``, with its ``words`` and ``types``: a
    hash of every word, or of its mark alone."""
    forms = [
        F.struct(F.lit(form).alias("form"), _form(F.col("cut"), form).alias("words"))
        for form in (BY_CONTEXT, ALL_CAPITALS, NO_NAMES)
    ]
    return rows.withColumn("one", F.explode(F.array(*forms))).drop("cut").select(
        "*", "one.form", "one.words"
    ).drop("one").withColumn(
        "types",
        F.transform(
            "words",
            lambda w: F.when(w < CAPITAL, F.xxhash64(F.substring(w, 1, 1))).otherwise(F.xxhash64(w)),
        ),
    )


def _windows(rows: DataFrame, size: int, exact: bool) -> DataFrame:
    """Template windows of ``words``: hash, place and the words themselves.

    ``exact`` takes only rows of exactly ``size`` words, otherwise all windows.
    """
    enough = F.size("types") == size if exact else F.size("types") >= size
    if size < WORDS:
        enough &= F.col("form") != ALL_CAPITALS
    # A filter would be pushed below and make Spark cut the text twice.
    places = F.when(enough, F.sequence(F.lit(0), F.size("types") - size))
    placed = rows.withColumn("at", F.explode(places))
    types = [F.get("types", F.col("at") + k) for k in range(size)]
    return placed.withColumn("hash", F.xxhash64(F.lit(size), "form", *types))


def benchmark_windows(
    benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Item, its id ``name``, and of each window size, hash, place and words. An item is
    told by a hash of its id and text."""
    id_, text = F.col(f"`{item_col}`"), whole(text_col)
    rows = _with_types(
        benchmark.select(F.xxhash64(id_, text).alias("item"), id_.alias("name"), text.alias("text"))
        .dropDuplicates(["item"])
        .select("item", "name", _cut(F.col("text")).alias("cut"))
    )
    every = reduce(
        DataFrame.unionByName,
        [
            _windows(rows, size, exact=size < WORDS).select(
                "item", "name", "form", F.lit(size).alias("size"), "hash", "at",
                F.slice("words", F.col("at") + 1, size).alias("own"),
            )
            for size in range(1, WORDS + 1)
        ],
    )
    plain = F.size(F.filter("own", lambda w: w >= CAPITAL))
    return every.where((F.col("form") != ALL_CAPITALS) | (plain >= 2))


def contaminations(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Pairs of document (``id`` and ``print``, a hash of its text) and item that
    contaminates it, with the share of the item's windows found."""
    windows = settled(benchmark_windows(benchmark, item_col, item_text), "benchmark-windows")
    sizes = [r["size"] for r in windows.select("size").distinct().collect()]
    totals = windows.groupBy("item", "form").agg(F.countDistinct("hash").alias("windows"))
    hashes = settled(windows.select("hash").distinct(), "benchmark-hashes")
    if hashes.count() <= BROADCAST_ROWS:
        hashes = F.broadcast(hashes)
    text = whole(text_col)
    rows = _with_types(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("print"),
        _cut(text).alias("cut"),
    ))
    hits = settled(
        reduce(
            DataFrame.unionByName,
            [
                _windows(rows, size, exact=False).join(hashes, "hash").select(
                    "id", "print", "hash", F.col("at").alias("spot"),
                    F.slice("words", F.col("at") + 1, size).alias("seen"),
                )
                for size in sizes or [WORDS]
            ],
        ),
        "window-hits",
    )
    # An item of which enough is there shares one of its rarest windows with the text:
    # all but one less than must be found. So windows that many items have join nothing
    # but the items that hold little else.
    which = ["id", "print", "item", "form"]
    of_items = windows.select("item", "form", "hash", "at", "own")
    sets = settled(windows.select("item", "form", "hash").distinct(), "item-windows")
    held_by = sets.groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    rarest = Window.partitionBy("item", "form").orderBy("items", "hash")
    spare = F.col("windows") - F.ceil(F.col("windows") * SHARE) + 1
    rare = settled(
        sets.join(held_by, "hash").join(totals, ["item", "form"])
        .withColumn("rank", F.row_number().over(rarest)).where(F.col("rank") <= spare)
        .select("item", "form", "hash", "windows"),
        "rare-windows",
    )
    seen = settled(hits.select("id", "print", "hash").distinct(), "texts-windows")
    likely = seen.join(rare, "hash").select(*which, "windows").distinct()
    enough = (
        likely.join(sets, ["item", "form"]).alias("a")
        .join(seen.alias("b"), F.expr("a.id <=> b.id and a.print = b.print and a.hash = b.hash"), "left_semi")
        .groupBy(*which, "windows").agg(F.count(F.lit(1)).alias("found"))
        .where(F.col("found") >= F.col("windows") * SHARE).drop("found")
    )
    enough = settled(enough, "covered-items")
    near = (
        hits.alias("a")
        .join(enough.alias("e"), F.expr("a.id <=> e.id and a.print = e.print"))
        .select("a.*", "e.item", "e.form", "e.windows")
        .join(of_items, ["item", "form", "hash"])
        .withColumn("shift", F.col("spot") - F.col("at"))
    )
    pair = F.arrays_zip(F.col("own").alias("own"), F.col("seen").alias("seen"))
    slots = F.filter(
        F.transform(
            pair, lambda p: F.struct(p["own"].alias("own"), p["seen"].alias("seen"))
        ),
        lambda p: F.substring(p["own"], 1, 1).isin(NAME, NUMBER, UNIT),
    )
    lane = [*which, "shift"]
    values = near.select(*lane, F.explode(slots).alias("slot")).select(*lane, "slot.*").distinct()
    clash = (
        values.groupBy(*lane, "own").count().where("count > 1")
        .groupBy(*lane).agg(F.collect_set("own").alias("bad"))
    )
    with_clash = near.withColumn("slots", slots).alias("n").join(
        clash.alias("c"),
        F.expr(
            "n.id <=> c.id and n.print = c.print and n.item = c.item and n.form = c.form and n.shift = c.shift"
        ),
        "left",
    ).select("n.*", "bad")
    true = with_clash.where(
        F.col("bad").isNull()
        | F.forall("slots", lambda p: p["own"] == p["seen"])
        | ~F.exists("slots", lambda p: F.array_contains("bad", p["own"]))
    )
    covered = (
        true.groupBy(*which, "windows").agg(F.countDistinct("hash").alias("found"))
        .where(F.col("found") >= F.col("windows") * SHARE)
    )
    return (
        covered.join(windows.select("item", "name").distinct(), "item")
        .groupBy("id", "print", F.col("name").alias("item"))
        .agg(F.max(F.col("found") / F.col("windows")).alias("share"))
    )


def marked(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """For every row: id, whether it is contaminated, by which items, greatest share."""
    found = settled(
        contaminations(docs, benchmark, id_col, text_col, **options)
        .groupBy("id", "print")
        .agg(
            # Structs, as a set of bare ids leaves out null.
            F.transform(F.sort_array(F.collect_set(F.struct("item"))), lambda s: s["item"]).alias("item_ids"),
            F.max("share").alias("share"),
        ),
        "contaminated",
    )
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(whole(text_col)).alias("print")
    )
    return rows.alias("d").join(
        found.alias("f"), F.expr("d.id <=> f.id and d.print = f.print"), "left"
    ).select(
        F.col("d.id").alias(id_col), F.col("share").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(found.schema["item_ids"].dataType)).alias("item_ids"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows that are not contaminated, with all their columns, of any name."""
    found = settled(
        contaminations(docs, benchmark, id_col, text_col, **options).select("id", "print").distinct(),
        "contaminated",
    )
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    id_, text = F.col(f"`{id_col}`"), whole(text_col)
    gone_id, gone_print = unused(docs.columns, "gone_id", "gone_print")
    gone = found.select(F.col("id").alias(gone_id), F.col("print").alias(gone_print))
    return docs.join(
        gone, id_.eqNullSafe(F.col(gone_id)) & (F.xxhash64(text) == F.col(gone_print)), "left_anti"
    )
