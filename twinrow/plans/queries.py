"""The registered queries, each with the SQL that must give the same rows.

Every query reads whole tables; those whose two sides are clicks and views keep the
events of these types. ``SQL`` lacks a query where plain SQL has no equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinrow.functions import render
from twinrow.operators import (
    agreement, diff, hash_tree, hashing, key_filter, profile, reconcile, runs, wide, windows,
    words,
)
from twinrow.plans import jobs, tables
from twinrow.session import folder_bytes, run_folder
from twinrow.sources import files, sinks, topics
from twinrow.streaming import bounded, running

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

HOUR = "1 hour"
DELAY = "10 minutes"
DIFF_FIELDS = ["event_id", "event_type", "props"]
DOC_COLUMNS = ["lang", "quality", "body"]
# Bytes of a table that go to one file of a stream.
FILE_BYTES = 32 << 20


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# ---------------------------------------------------------------- SQL pieces

ORDERS = f"""
base as (
  select cast(o_orderkey as varchar) as k, o_orderpriority as p, o_totalprice as t,
    {tables.LOST} as lost, {tables.ADDED} as added, {tables.DOUBLED} as doubled,
    case when {tables.RENAMED} then 'UNKNOWN' else o_orderpriority end as p2,
    o_totalprice + case when {tables.PRICED} then 1.0 else 0.0 end as t2
  from orders),
l as (select k as id, p as name, cast(cast(t as decimal(18,2)) as varchar) as val from base),
c as (select k, p2 as name, cast(cast(t2 as decimal(18,2)) as varchar) as val,
        lost, added, doubled from base),
r as (select k as id, name, val from c where not lost
      union all select k, name, val from c where doubled
      union all select '+' || k, name, val from c where added)"""

LABELLED = "md5('Id:' || id || '|Name:' || name || '|Val:' || val)"
ROW_JSON = "'\"' || id || '\"|\"' || name || '\"|\"' || val || '\"|'"
KEY_JSON = "'\"' || id || '\"|'"

HASHES = f"""
lh as (select md5({KEY_JSON}) as kh, md5({ROW_JSON}) as vh from l),
rh as (select md5({KEY_JSON}) as kh, md5({ROW_JSON}) as vh from r)"""

STATUS = """
lk as (select kh, count(*) as n, min(vh) as lo, max(vh) as hi from lh group by kh),
rk as (select kh, count(*) as n, min(vh) as lo, max(vh) as hi from rh group by kh),
ks as (
  select coalesce(lk.kh, rk.kh) as key_hash,
    cast(coalesce(lk.n, 0) as bigint) as left_rows,
    cast(coalesce(rk.n, 0) as bigint) as right_rows,
    case when rk.kh is null then 'LEFT_ONLY' when lk.kh is null then 'RIGHT_ONLY'
      when lk.lo = lk.hi and rk.lo = rk.hi and lk.lo = rk.lo then 'MATCH'
      else 'VALUE_MISMATCH' end as status
  from lk full outer join rk on lk.kh = rk.kh)"""

EVENTS = """
raw as (select ts, event_type, '{"event_id":' || event_id || ',"user_id":' || user_id ||
  ',"event_type":"' || event_type || '","value":' || cast(value as varchar) ||
  ',"props":' || props || '}' as text from events),
ev as (select *, json(text) as j from raw)"""


def _part(name: str) -> str:
    return f"coalesce(cast(j->'$.{name}' as varchar), 'null')"


def _event_row(names: list[str]) -> str:
    return " || ".join(f"{_part(n)} || '|'" for n in names)


def _strings(names: list[str]) -> str:
    return " || ".join(
        f"(case when json_type(j->'$.{n}') = 'VARCHAR' then j->>'$.{n}' else '' end) || '|'"
        for n in names
    )


def _string_keys(names: list[str]) -> str:
    return " || ".join(
        f"'{n}|' || (case when (j->'$.{n}') is null then '' "
        f"when json_type(j->'$.{n}') = 'VARCHAR' then j->>'$.{n}' else 'null' end) || '|'"
        for n in names
    )


EVENT_SIDES = EVENTS + f""",
sides as (select event_type, cast(j->'$.user_id' as varchar) as k,
    date_trunc('hour', ts) as w, ts,
    [{', '.join(_part(n) for n in DIFF_FIELDS)}] as f, text from ev),
cl as (select * from sides where event_type = 'click'),
vi as (select * from sides where event_type = 'view')"""


def _report_sql(sides: str, group: str, extra: str, names: list[str]) -> str:
    """Report of the tables ``cl`` and ``vi``, whose column ``f`` lists the rendered
    fields. ``group`` is the key, ``extra`` what to show before it."""
    shown = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return f"""
with {sides},
lx as (select {group}, unnest(f) as t, unnest(range(1, {len(names) + 1})) as pos from cl),
rx as (select {group}, unnest(f) as t, unnest(range(1, {len(names) + 1})) as pos from vi),
ln as (select {group}, pos, t, count(*) as n from lx group by all),
rn as (select {group}, pos, t, count(*) as n from rx group by all),
la as (select {group}, pos, sum(n) as n from ln group by all),
ra as (select {group}, pos, sum(n) as n from rn group by all)
select {extra} k as left_key, k as right_key, {shown}[pos] as left_field, t as left_value,
  {shown}[pos] as right_field, null as right_value,
  cast(ln.n as bigint) as left_rows, cast(ra.n - coalesce(rn.n, 0) as bigint) as right_rows
from ln join ra using ({group}, pos) left join rn using ({group}, pos, t)
where ra.n - coalesce(rn.n, 0) > 0
union all
select {extra} k, k, {shown}[pos], null, {shown}[pos], t,
  cast(la.n - coalesce(ln.n, 0) as bigint), cast(rn.n as bigint)
from rn join la using ({group}, pos) left join ln using ({group}, pos, t)
where la.n - coalesce(ln.n, 0) > 0"""


ORDER_SIDES = ORDERS + """,
cl as (select id as k, ['"' || name || '"', '"' || val || '"'] as f from l),
vi as (select id as k, ['"' || name || '"', '"' || val || '"'] as f from r)"""


# ------------------------------------------------------------ keys that differ


def _clicks_and_views(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [tables.event_records(spark, folder, kind) for kind in ("click", "view")]


def _both_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tables.orders(spark, folder), tables.orders_copy(spark, folder)


def _both_hashes(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [
        hashing.hash_rows(side, tables.ID_FIELDS, ["id"])
        for side in _both_orders(spark, folder)
    ]


@query(f"""
with {ORDERS}
select id, count(distinct l.rowid_) as left_rows, count(distinct r.rowid_) as right_rows
from (select *, {LABELLED} as d, row_number() over () as rowid_ from l) l
join (select *, {LABELLED} as d, row_number() over () as rowid_ from r) r using (id)
group by id having count(*) filter (l.d <> r.d) > 0""")
def mismatch_ids(spark: SparkSession, folder: str) -> DataFrame:
    return agreement.mismatch_ids(*_both_orders(spark, folder), "id", tables.LABELS)


@query(f"""
with {ORDERS}
select id, cast(count(*) as varchar) as pairs
from (select id, {LABELLED} as d from l) l join (select id, {LABELLED} as d from r) r using (id)
where l.d <> r.d group by id""")
def mismatch_pairs(spark: SparkSession, folder: str) -> DataFrame:
    found = agreement.mismatch_pairs(*_both_orders(spark, folder), "id", tables.LABELS)
    # As text: the count is exact beyond 64 bits.
    return found.select("id", F.col("pairs").cast("string").alias("pairs"))


@query(f"with {ORDERS}, {HASHES}, {STATUS} select * from ks")
def classify(spark: SparkSession, folder: str) -> DataFrame:
    return agreement.classify(*_both_hashes(spark, folder))


@query(f"""
with {ORDERS}, {HASHES}, {STATUS}
select status, count(*) as n_keys, cast(sum(left_rows) as bigint) as left_rows,
  cast(sum(right_rows) as bigint) as right_rows from ks group by status""")
def classify_counts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        agreement.classify(*_both_hashes(spark, folder))
        .groupBy("status")
        .agg(
            F.count("*").alias("n_keys"),
            F.sum("left_rows").alias("left_rows"),
            F.sum("right_rows").alias("right_rows"),
        )
    )


WIDE = """
wide as (select k as lk, case when not lost then k end as rk,
   md5(k || '|' || p || '|' || cast(cast(t as decimal(18,2)) as varchar) || '|') as lv,
   md5(k || '|' || p2 || '|' || cast(cast(t2 as decimal(18,2)) as varchar) || '|') as rv
   from base)"""


@query(f"""
with {ORDERS}, {WIDE}
select lk as left_key, rk as right_key, case when rk is null then 'LEFT_ONLY'
  when lv = rv then 'MATCH' else 'VALUE_MISMATCH' end as status from wide""")
def classify_wide(spark: SparkSession, folder: str) -> DataFrame:
    return agreement.classify_wide(tables.orders_wide(spark, folder)).select(
        "left_key", "right_key", "status"
    )


@query(f"""
with {ORDERS}, {WIDE}
select distinct md5(lk || '|') as key_hash from wide where rk is not null and lv <> rv""")
def mismatch_keys(spark: SparkSession, folder: str) -> DataFrame:
    return agreement.mismatch_keys(tables.orders_wide(spark, folder))


@query(f"""
with {ORDERS}, {HASHES}, {STATUS}
select id, name, val from r
where md5({KEY_JSON}) in (select key_hash from ks where status = 'VALUE_MISMATCH')""")
def keep_keys(spark: SparkSession, folder: str) -> DataFrame:
    left, right = _both_hashes(spark, folder)
    keys = agreement.classify(left, right).where("status = 'VALUE_MISMATCH'")
    return agreement.keep_keys(tables.orders_copy(spark, folder), keys, ["id"]).select(
        *tables.ID_FIELDS
    )


@query(SQL["classify"])
def classify_kept_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs kept in bucketed tables, compared without an exchange."""
    path = run_folder(spark, "kept-runs")
    kept = []
    for name, side in zip(("left", "right"), _both_orders(spark, folder)):
        side.write.parquet(f"{path}/{name}")
        run = runs.Run(f"kept_{uuid.uuid4().hex}", f"{path}/{name}-run")
        runs.keep_run(
            spark, run, lambda paths: spark.read.parquet(*paths), [f"{path}/{name}"],
            tables.ID_FIELDS, ["id"], buckets=8,
        )
        kept.append(run)
    return runs.compare_runs(spark, *kept)


@query(SQL["keep_keys"])
def keep_keys_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows, most others dropped at the scan by the bits of the key set."""
    left, right = _both_hashes(spark, folder)
    keys = agreement.classify(left, right).where("status = 'VALUE_MISMATCH'")
    return key_filter.keep_keys_filtered(tables.orders_copy(spark, folder), keys, ["id"]).select(
        *tables.ID_FIELDS
    )


# ------------------------------------------------------------ fields that differ


def _fields_sql(names: list[str]) -> str:
    return " union all ".join(
        f"select id as left_key, id as right_key, '{n}' as left_field, "
        f"'\"' || l.{n} || '\"' as left_value, '{n}' as right_field, "
        f"'\"' || r.{n} || '\"' as right_value from l join r using (id) where l.{n} <> r.{n}"
        for n in names
    )


MATCHED_SQL = " union all ".join(
    f"select k as left_key, k as right_key, '{l}' as left_field, '\"' || {lv} || '\"' as left_value, "
    f"'{r}' as right_field, '\"' || {rv} || '\"' as right_value from base where not lost and {lv} <> {rv}"
    for l, lv, r, rv in (
        ("name", "p", "label", "p2"),
        ("val", "cast(cast(t as decimal(18,2)) as varchar)",
         "amount", "cast(cast(t2 as decimal(18,2)) as varchar)"),
    )
)


@query(f"with {ORDERS} {MATCHED_SQL}")
def field_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Differences of records that are matched already."""
    pairs = tables.orders_matched(spark, folder)
    return diff.field_diff(pairs, ["name", "val"], ["label", "amount"])


@query(_report_sql(ORDER_SIDES, "k", "", ["name", "val"]))
def diff_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orders against their copy, where some ids have several rows on one side."""
    return diff.diff_report(*_both_orders(spark, folder), ["name", "val"], ["id"])


@query(f"with {ORDERS} {_fields_sql(['name', 'val'])}")
def diff_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The same by pairs, as no id repeats on both sides."""
    return diff.diff_pairs(*_both_orders(spark, folder), ["name", "val"], ["id"])


@query(_report_sql(EVENT_SIDES, "k", "", DIFF_FIELDS))
def diff_report_crowded(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks against views by user, where nearly every key repeats on both sides."""
    return diff.diff_report(*_clicks_and_views(spark, folder), DIFF_FIELDS, ["user_id"])


@query("""
select cast(o_orderkey as varchar) as left_key, cast(o_orderkey as varchar) as right_key,
  'c' || (o_custkey % 200) as left_field, 'c' || (o_custkey % 200) as right_field,
  case when o_custkey % 2 = 0 then cast(o_custkey + o_custkey % 200 as varchar)
    else '"' || o_orderpriority || '#' || (o_custkey % 200) || '"' end as left_value,
  case when o_custkey % 2 = 0 then '-1' else '"OTHER"' end as right_value
from orders where o_totalprice between 250000 and 250500""")
def wide_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Differing fields of orders with two hundred columns, level by level."""
    sides = [tables.orders_of_many_columns(spark, folder, faulty) for faulty in (False, True)]
    return wide.wide_diff(*sides, tables.WIDE_FIELDS, ["o_orderkey"])


# ------------------------------------------------------------ reconciliation

NETS = """
nets as (select kh as key_hash, vh as value_hash, cast(sum(s) as bigint) as net
  from (select kh, vh, 1 as s from lh union all select kh, vh, -1 from rh) group by kh, vh)"""


def _order_stream(left: DataFrame, right: DataFrame) -> DataFrame:
    return hashing.hash_both(left, right, tables.ID_FIELDS, ["id"], case_id=7, run_id=1)


@query(f"""
with {ORDERS}, {HASHES}, {NETS}
select cast(7 as bigint) as case_id, cast(1 as bigint) as run_id, key_hash, value_hash, net
from nets where net <> 0""")
def reconcile_outstanding(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.outstanding(
        reconcile.reconcile(_order_stream(*_both_orders(spark, folder)))
    )


@query(f"""
with {ORDERS}, {HASHES}, {NETS}
select cast(7 as bigint) as case_id, cast(1 as bigint) as run_id, key_hash,
  cast(sum(greatest(net, 0)) as bigint) as left_left,
  cast(sum(greatest(-net, 0)) as bigint) as right_left,
  case when max(net) > 0 and min(net) < 0 then 'VALUE_MISMATCH'
    when max(net) > 0 then 'LEFT_ONLY' else 'RIGHT_ONLY' end as status
from nets where net <> 0 group by key_hash""")
def reconcile_status(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.outstanding_status(
        reconcile.reconcile(_order_stream(*_both_orders(spark, folder)))
    )


LEFT_OVER = """
select key_hash, cast(sum(greatest(net, 0)) as bigint) as left_left,
  cast(sum(greatest(-net, 0)) as bigint) as right_left,
  case when max(net) > 0 and min(net) < 0 then 'VALUE_MISMATCH'
    when max(net) > 0 then 'LEFT_ONLY' else 'RIGHT_ONLY' end as status
from nets where net <> 0 group by key_hash"""


@query(f"""
with {ORDERS.split("c as (")[0]}
r as (select k as id, case when t between 250000 and 250500 then 'OTHER' else p end as name,
  cast(cast(t as decimal(18,2)) as varchar) as val from base),
{HASHES}, {NETS} {LEFT_OVER}""")
def hash_tree_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Orders against a copy of which a thousandth differs, range by range of the keys."""
    sides = [
        hashing.hash_rows(rows, tables.ID_FIELDS, ["id"])
        for rows in (tables.orders(spark, folder), tables.orders_nearly(spark, folder))
    ]
    return hash_tree.differences(*sides)


@query(f"with {ORDERS}, {HASHES}, {NETS} {LEFT_OVER}")
def stored_run_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Two stored runs of hash records compared by their digests."""
    run = run_folder(spark, "stored-runs")
    for name, hashed in zip(("left", "right"), _both_hashes(spark, folder)):
        hash_tree.store(hashed, f"{run}/{name}")
    return hash_tree.stored_differences(spark, f"{run}/left", f"{run}/right")


# ------------------------------------------------------------ hash records


def _event_hashes(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    return hashing.hash_rows(
        tables.event_records(spark, folder), tables.EVENT_FIELDS, ["event_id", "note"], mode=mode
    )


@query(f"""
with {EVENTS}, t as (select {_event_row(['event_id', 'note'])} as keys,
  {_event_row(tables.EVENT_FIELDS)} as vals from ev)
select keys, md5(keys) as key_hash, md5(vals) as value_hash from t""")
def row_hashes_json(spark: SparkSession, folder: str) -> DataFrame:
    return _event_hashes(spark, folder, "json")


@query(f"""
with {EVENTS}, t as (select {_string_keys(tables.EVENT_FIELDS)} as keys,
  {_strings(tables.EVENT_FIELDS)} as vals from ev)
select keys, md5(keys) as key_hash, md5(vals) as value_hash from t""")
def row_hashes_text(spark: SparkSession, folder: str) -> DataFrame:
    return _event_hashes(spark, folder, "text")


@query(f"""
with {EVENTS}, t as (select event_type = 'view' as malformed,
  case when event_type = 'view' then substr(text, 1, length(text) - 1) else text end as value,
  case when event_type = 'view' then 'malformed:' || substr(text, 1, length(text) - 1) || '|'
    else {_event_row(['event_id'])} end as keys from ev)
select value, malformed, keys, md5(keys) as key_hash from t""")
def malformed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events of which those of one type were cut short, marked and hashed by their text."""
    messages = tables.event_messages(tables.table(spark, folder, "events"))
    text = F.col("value").cast("string")
    cut = F.when(text.contains('"event_type":"view"'), F.substring(text, F.lit(1), F.length(text) - 1))
    records = topics.decode_json(
        messages.withColumn("value", F.coalesce(cut, text).cast("binary")), strict=False
    )
    keys = render.render_json(render.field_texts(records, ["event_id"]))
    return records.select(
        "value", "malformed", keys.alias("keys"), render.digest(keys).alias("key_hash")
    )


@query(f"with {ORDERS} select id as keys, md5(id) as key_hash, {LABELLED} as value_hash from r")
def row_hashes_labelled(spark: SparkSession, folder: str) -> DataFrame:
    return hashing.hash_rows(
        tables.orders_copy(spark, folder), tables.ID_FIELDS, ["id"], mode="labelled"
    )


@query("""
select 'RIGHT' as side, cast(3 as bigint) as case_id, cast(4 as bigint) as run_id,
  o_orderkey || '|' as keys, md5(o_orderkey || '|') as key_hash,
  md5('"' || o_orderstatus || '"|' || o_custkey || '|"' ||
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"|') as value_hash
from orders""")
def row_hashes_table(spark: SparkSession, folder: str) -> DataFrame:
    """Hash records of a typed table rather than of JSON text."""
    return hashing.hash_rows(
        tables.table(spark, folder, "orders"),
        ["o_orderstatus", "o_custkey", "o_orderdate"], ["o_orderkey"],
        hashing.RIGHT, case_id=3, run_id=4,
    )


@query(f"""
with {EVENTS}
select text as value, md5({_event_row(['user_id', 'event_type'])}) as key_hash,
  (j->>'$.user_id') || '|' || (j->>'$.event_type') as key_text from ev""")
def key_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Records kept whole, with the hash and the display text of their key."""
    events = tables.event_records(spark, folder)
    keys = ["user_id", "event_type"]
    return hashing.with_key_hash(events, keys).select(
        "value", "key_hash", render.key_text(events, keys).alias("key_text")
    )


@query(f"with {ORDERS} select id, name, val from r")
def sort_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return hashing.sort_partitions(tables.orders_copy(spark, folder), "id")


# ------------------------------------------------------------ blank fields

DOCUMENTS = r"""
docs as (select doc_id, lang, cast(quality as varchar) as quality,
  case when n_chars % 7 = 0 then repeat(case lang when 'fr' then chr(8195) when 'de' then chr(1)
    when 'es' then chr(160) else ' ' end, 3) else text end as body
  from documents left join labels using (doc_id))"""
BLANK = {
    "trim": r"[\x00-\x20]*",
    "unicode": (
        r"[\x09-\x0D\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}"
        r"\x{2028}\x{2029}\x{205F}\x{3000}]*"
    ),
}


def _blank(column: str, rule: str) -> str:
    return f"({column} is null or regexp_full_match({column}, '{BLANK[rule]}'))"


def _profile_sql(rule: str) -> str:
    counts = ", ".join(
        f"cast(coalesce(sum(cast({_blank(c, rule)} as int)), 0) as bigint) as {c}"
        for c in DOC_COLUMNS
    )
    return f"with {DOCUMENTS} select {counts} from docs"


def _kept_sql(rule: str, what: str) -> str:
    keep = " and ".join(f"not {_blank(c, rule)}" for c in DOC_COLUMNS)
    return f"with {DOCUMENTS} select {what} from docs where {keep}"


@query(_profile_sql("trim"))
def blank_profile_trim(spark: SparkSession, folder: str) -> DataFrame:
    return profile.blank_profile(tables.labelled_documents(spark, folder), DOC_COLUMNS, "trim")


@query(_profile_sql("unicode"))
def blank_profile_unicode(spark: SparkSession, folder: str) -> DataFrame:
    return profile.blank_profile(
        tables.labelled_documents(spark, folder), DOC_COLUMNS, "unicode"
    )


@query(_kept_sql("trim", "doc_id, lang, quality, md5(body) as body_md5"))
def drop_blank_trim(spark: SparkSession, folder: str) -> DataFrame:
    return profile.drop_blank(
        tables.labelled_documents(spark, folder), DOC_COLUMNS, "trim"
    ).select("doc_id", "lang", "quality", F.md5("body").alias("body_md5"))


@query(_kept_sql("unicode", "doc_id, lang, quality, md5(body) as body_md5"))
def drop_blank_unicode(spark: SparkSession, folder: str) -> DataFrame:
    return profile.drop_blank(
        tables.labelled_documents(spark, folder), DOC_COLUMNS, "unicode"
    ).select("doc_id", "lang", "quality", F.md5("body").alias("body_md5"))


@query(_kept_sql("unicode", "count(*) as n"))
def kept_count(spark: SparkSession, folder: str) -> DataFrame:
    return profile.drop_blank(
        tables.labelled_documents(spark, folder), DOC_COLUMNS, "unicode"
    ).agg(F.count("*").alias("n"))


# ------------------------------------------------------------ words


def _words_sql(*names: str) -> str:
    texts = " union all ".join(f"select text from {n}" for n in names)
    return f"""
with t as (select unnest(regexp_split_to_array(lower(text), '\\W+')) as word from ({texts}))
select word, count(*) as n from t where word <> '' group by word"""


@query(_words_sql("documents"))
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_count(*tables.text_lines(spark, folder, "documents"))


@query(_words_sql("documents", "benchmark"))
def word_count_union(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_count(
        words.union_lines(*tables.text_lines(spark, folder, "documents", "benchmark"))
    )


# ------------------------------------------------------------ windows


MATCHES = f"""{EVENT_SIDES},
n as (select k, w, count(*) filter (event_type = 'click') as ln,
        count(*) filter (event_type = 'view') as rn
      from sides where event_type in ('click', 'view') group by k, w),
m as (select *, strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, md5(k || '|') as key_hash
      from sides join n using (k, w)
      where event_type in ('click', 'view') and ln > 0 and rn > 0)"""


@query(f"""
with {MATCHES}
select window_start, key_hash, case when event_type = 'click' then 'LEFT' else 'RIGHT' end as side,
  text as value, ln as left_rows, rn as right_rows from m""")
def window_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The window join with its pairs not multiplied out."""
    return windows.window_matches(
        *_clicks_and_views(spark, folder), ["user_id"], width=HOUR
    ).select(
        _time("window_start").alias("window_start"), "key_hash", "side",
        F.col("record.value").alias("value"), "left_rows", "right_rows",
    )


@query(f"""
with {MATCHES}
select window_start, key_hash, case when event_type = 'click' then text end as left_value,
  case when event_type = 'view' then text end as right_value,
  case when event_type = 'click' then 1 else ln end as left_rows,
  case when event_type = 'click' then rn else 1 end as right_rows
from m""")
def window_join_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of the window join, told record by record."""
    matches = windows.window_matches(
        *_clicks_and_views(spark, folder), ["user_id"], width=HOUR
    )
    return windows.window_pairs(matches).select(
        _time("window_start").alias("window_start"), "key_hash",
        F.col("left.value").alias("left_value"), F.col("right.value").alias("right_value"),
        "left_rows", "right_rows",
    )


WINDOW_REPORT_SQL = _report_sql(EVENT_SIDES, "k, w", "w,", DIFF_FIELDS)


def _window_report_sql() -> str:
    return f"""
select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, left_key, right_key, left_field,
  left_value, right_field, right_value, left_rows, right_rows
from ({WINDOW_REPORT_SQL})"""


def _shown_report(report: DataFrame) -> DataFrame:
    return report.select(_time("window_start").alias("window_start"), *diff.REPORT)


@query(_window_report_sql())
def window_field_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _shown_report(
        windows.window_diff(
            *_clicks_and_views(spark, folder), DIFF_FIELDS, ["user_id"], width=HOUR
        )
    )


# ------------------------------------------------------------ streams


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of rows."""
    schema = tables.table(spark, folder, "events").schema
    # A glob, since a stream takes a plain path for a folder and the table may
    # be a single file.
    return spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/events.parque[t]")


def _event_streams(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Clicks and views as two streams of records."""
    return [
        topics.decode_json(
            tables.event_messages(_event_stream(spark, folder).where(F.col("event_type") == kind))
        )
        for kind in ("click", "view")
    ]


def _event_copies(spark: SparkSession, folder: str) -> list[DataFrame]:
    """All events and a faulty copy of all, as two streams of records."""
    return _copies(_event_stream(spark, folder))


def _copies(events: DataFrame) -> list[DataFrame]:
    """Events as records, and a faulty copy: views of little value are lost, clicks of
    little value have other props."""
    copy = events.where(f"not ({LOST_EVENTS})").withColumn(
        "props", F.when(F.expr(OTHER_EVENTS), F.lit('{"k": -1}')).otherwise(F.col("props"))
    )
    return [topics.decode_json(tables.event_messages(side)) for side in (events, copy)]


def _finished(run) -> None:
    run.awaitTermination()


STREAM_KEYS = ["user_id"]
STREAM_FIELDS = ["user_id", "props"]

LOST_EVENTS = "event_type = 'view' and value < 5"
OTHER_EVENTS = "event_type = 'click' and value < 5"

STREAM_HASHES = f"""
both_ as (select 'LEFT' as side, user_id, props from events
  union all select 'RIGHT', user_id, case when {OTHER_EVENTS} then '{{"k": -1}}' else props end
  from events where not ({LOST_EVENTS})),
ej as (select side, json('{{"user_id":' || user_id || ',"props":' || props || '}}') as j from both_),
sh as (select side, {_event_row(STREAM_KEYS)} as keys, md5({_event_row(STREAM_KEYS)}) as kh,
    md5({_event_row(STREAM_FIELDS)}) as vh from ej)"""


@query(f"""
with {EVENTS}, {STREAM_HASHES}
select cast(1 as bigint) as case_id, cast(2 as bigint) as run_id, side, keys,
  kh as key_hash, vh as value_hash from sh""")
def stream_hashes(spark: SparkSession, folder: str) -> DataFrame:
    hashed = hashing.hash_both(
        *_event_copies(spark, folder), STREAM_FIELDS, STREAM_KEYS, case_id=1, run_id=2
    )
    run = run_folder(spark, "stream-hashes")
    _finished(
        running.append_to_table(hashed, f"{run}/out", f"{run}/checkpoint", availableNow=True)
    )
    return spark.read.schema(hashed.schema).parquet(f"{run}/out")


@query(f"""
with {EVENTS}, {STREAM_HASHES},
nets as (select kh as key_hash, vh as value_hash,
  cast(sum(case side when 'LEFT' then 1 else -1 end) as bigint) as net from sh group by kh, vh)
select cast(1 as bigint) as case_id, cast(2 as bigint) as run_id, key_hash, value_hash, net
from nets where net <> 0""")
def stream_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    hashed = hashing.hash_both(
        *_event_copies(spark, folder), STREAM_FIELDS, STREAM_KEYS, case_id=1, run_id=2
    )
    run = run_folder(spark, "stream-reconcile")
    _finished(
        running.start_reconcile(hashed, f"{run}/out", f"{run}/checkpoint", availableNow=True)
    )
    return reconcile.outstanding(running.reconciled(spark, f"{run}/out"))


MATCHES_SQL = f"""
with {MATCHES}
select window_start, key_hash, case when event_type = 'click' then 'LEFT' else 'RIGHT' end as side,
  text as value, ln as left_rows, rn as right_rows from m"""


@query(MATCHES_SQL)
def stream_window_join(spark: SparkSession, folder: str) -> DataFrame:
    """The window join of two streams, its pairs not multiplied out."""
    run = run_folder(spark, "stream-window-join")
    _finished(
        running.start_window_matches(
            *_event_streams(spark, folder), STREAM_KEYS, f"{run}/out", f"{run}/checkpoint",
            width=HOUR, delay=DELAY, availableNow=True,
        )
    )
    running.finish_window_matches(spark, f"{run}/out", f"{run}/checkpoint")
    return running.stream_matches(spark, f"{run}/out").select(
        _time("window_start").alias("window_start"), "key_hash", "side",
        F.col("record.value").alias("value"), "left_rows", "right_rows",
    )


@query(_window_report_sql())
def stream_window_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Report of the windows the watermark closes, and of those open at the end."""
    run = run_folder(spark, "stream-window-diff")
    _finished(
        running.start_window_diff(
            *_event_streams(spark, folder), DIFF_FIELDS, STREAM_KEYS,
            f"{run}/out", f"{run}/checkpoint", width=HOUR, delay=DELAY, availableNow=True,
        )
    )
    running.finish_window_diff(spark, f"{run}/out", f"{run}/checkpoint", DIFF_FIELDS)
    return _shown_report(running.window_report(spark, f"{run}/out"))


def _in_parts(rows: DataFrame, source: str, path: str, parts: int) -> DataFrame:
    """Rows made from a table as a stream that gets them in shuffled parts, each a batch.

    A part is one file for each ``FILE_BYTES`` of the table, so tasks stay small however
    large the table is. Rows are dealt by all columns, as keys may repeat.
    """
    spark = rows.sparkSession
    n = parts * max(1, -(-folder_bytes(spark, source) // (parts * FILE_BYTES)))
    rows.repartition(n, F.xxhash64(*rows.columns)).write.parquet(path)
    written = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
    stream = spark.readStream.schema(rows.schema)
    return stream.option("maxFilesPerTrigger", -(-written // parts)).parquet(path)


def _events_in_parts(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """The events table as a stream of four batches."""
    return _in_parts(
        tables.table(spark, folder, "events"), tables.path_of(folder, "events"), path, 4
    )


@query(SQL["stream_reconcile"])
def stream_reconcile_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Reconciliation of a stream in several batches, whose state holds what is outstanding."""
    run = run_folder(spark, "stream-reconcile-bounded")
    events = _events_in_parts(spark, folder, f"{run}/in")
    hashed = hashing.hash_both(
        *_copies(events), STREAM_FIELDS, STREAM_KEYS, case_id=1, run_id=2
    )
    _finished(
        bounded.start_bounded_reconcile(
            hashed, f"{run}/out", f"{run}/checkpoint", fan_in=2, availableNow=True
        )
    )
    return bounded.outstanding_records(spark, f"{run}/out")


@query(_window_report_sql())
def stream_window_late(spark: SparkSession, folder: str) -> DataFrame:
    """Window report of events that arrive shuffled, so that most come behind the
    watermark, corrected by the late records that were kept."""
    run = run_folder(spark, "stream-window-late")
    events = _events_in_parts(spark, folder, f"{run}/in")
    sides = [
        topics.decode_json(tables.event_messages(events.where(F.col("event_type") == kind)))
        for kind in ("click", "view")
    ]
    _finished(
        bounded.start_window_report(
            *sides, DIFF_FIELDS, STREAM_KEYS, f"{run}/out", f"{run}/checkpoint",
            width=HOUR, delay=DELAY, fan_in=2, availableNow=True,
        )
    )
    return _shown_report(bounded.finish_window_report(spark, f"{run}/out", DIFF_FIELDS))


@query(SQL["blank_profile_trim"])
def stream_blank_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Blanks of every column of a stream, counted beside the filter."""
    run = run_folder(spark, "stream-blank-counts")
    documents = tables.labelled_documents(spark, folder)
    rows = _in_parts(documents, tables.path_of(folder, "documents"), f"{run}/in", 3)
    _finished(bounded.start_clean(rows, DOC_COLUMNS, f"{run}/out", f"{run}/checkpoint", availableNow=True))
    counts = bounded.clean_counts(spark, f"{run}/out")["blanks"]
    one = spark.range(1)
    return one.select(*[F.lit(counts.get(c, 0)).cast("bigint").alias(c) for c in DOC_COLUMNS])


# ------------------------------------------------------------ files and jobs


@query(f"with {ORDERS} select id, name, val from r")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "csv")
    sinks.write_csv(tables.orders_copy(spark, folder), path)
    return files.read_csv_rows(spark, path, tables.ID_FIELDS)


@query(f"""
with {ORDERS}
select id, name, val, cast(null as varchar) as line from r where not (name = 'UNKNOWN' or starts_with(id, '+'))
union all select null, null, null, id || ',' || name || ',' || val || ',' from r where name = 'UNKNOWN'
union all select null, null, null, id || ';' || name from r where starts_with(id, '+') and name <> 'UNKNOWN'""")
def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a CSV file of which some lines have too many or too few fields, and those lines."""
    path = run_folder(spark, "csv-quarantine")
    line = (
        F.when(F.col("name") == "UNKNOWN", F.concat_ws(",", "id", "name", "val", F.lit("")))
        .when(F.col("id").startswith("+"), F.concat_ws(";", "id", "name"))
        .otherwise(F.concat_ws(",", "id", "name", "val"))
    )
    sinks.write_text(tables.orders_copy(spark, folder).select(line.alias("value")), path)
    good, wrong = files.split_csv_rows(spark, path, tables.ID_FIELDS)
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(
        wrong.select("line"), allowMissingColumns=True
    )


@query(f"""
with {ORDERS} select '(' || id || ',' || name || ',' || val || ')' as value from r
union all select id from l""")
def text_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "text")
    left, right = _both_orders(spark, folder)
    sinks.write_text(right, f"{path}/rows")
    sinks.write_text(left.select("id"), f"{path}/ids")
    return files.read_lines(spark, f"{path}/rows", f"{path}/ids")


@query(f"""
with {ORDERS}
select distinct id from (select id, {LABELLED} as d from l) l
join (select id, {LABELLED} as d from r) r using (id) where l.d <> r.d""")
def job_compare_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "compare-csv")
    left, right = _both_orders(spark, folder)
    sinks.write_csv(left, f"{path}/left")
    sinks.write_csv(right, f"{path}/right")
    jobs.compare_csv(spark, f"{path}/left", f"{path}/right", f"{path}/out")
    return files.read_lines(spark, f"{path}/out").select(F.col("value").alias("id"))


@query("""
select cast(doc_id as varchar) as f0, lang as f1, source as f2,
  (select count(*) from documents where n_chars % 7 <> 0) as kept,
  (select count(*) from documents where n_chars % 7 = 0) as blanks
from documents where n_chars % 7 <> 0""")
def job_clean_triples(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as triples between semicolons, without those whose source is blank."""
    run = run_folder(spark, "clean-triples")
    source = F.when(F.col("n_chars") % 7 == 0, F.lit(" \x01")).otherwise(F.col("source"))
    triples = tables.table(spark, folder, "documents").select("doc_id", "lang", source.alias("source"))
    sinks.write_csv(triples, f"{run}/in", ";")
    seen = jobs.clean_triples(spark, f"{run}/in", f"{run}/out")
    return files.read_csv_rows(spark, f"{run}/out", jobs.TRIPLE).withColumns({
        "kept": F.lit(seen["kept"]).cast("bigint"), "blanks": F.lit(seen["blanks"][2]).cast("bigint"),
    })


@query("""
with t as (select unnest(regexp_split_to_array(lower(text), '\\W+')) as word
           from (select text from documents union all select text from benchmark))
select word || ' ' || count(*) as value from t where word <> '' group by word""")
def job_count_words(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "count-words")
    for name, text in zip("ab", tables.text_lines(spark, folder, "documents", "benchmark")):
        sinks.write_text(text, f"{path}/{name}")
    jobs.count_words(spark, [f"{path}/a", f"{path}/b"], f"{path}/out")
    return files.read_lines(spark, f"{path}/out")


@query(f"""
with {EVENTS}, t as (select {_event_row(['event_id'])} as keys,
  {_event_row(['event_type', 'props'])} as vals from ev)
select cast(to_json({{'testCaseId': 5, 'testCaseRunId': 6, 'comparisonSide': 'LEFT',
  'keys': keys, 'keyHash': md5(keys), 'valueHash': md5(vals)}}) as varchar) as value from t""")
def encoded_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """What goes out to a topic for the records that came in from one."""
    return topics.encode_hashes(
        hashing.hash_rows(
            tables.event_records(spark, folder), ["event_type", "props"], ["event_id"],
            hashing.LEFT, case_id=5, run_id=6,
        )
    )


@query(f"""
with {EVENTS}
select '{{"key":' || (j->>'$.event_id') || ',"value":' || text || '}}' as value,
  'null|' as missing, cast(j as varchar) || '|' as payload from ev""")
def enveloped_records(spark: SparkSession, folder: str) -> DataFrame:
    messages = tables.event_messages(tables.table(spark, folder, "events"))
    records = topics.decode_json(messages, envelope=True)
    return records.select(
        "value",
        render.render_json([render.json_field("event_id")]).alias("missing"),
        render.render_json([render.json_field("value")]).alias("payload"),
    )
