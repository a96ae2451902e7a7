"""The registered queries of this package, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from twinrow.llm import (
    alignment, exact, leaked_keys, leaks, maxent, mixing, pieces, pii, shards, simhash, spans, spelling, toxicity,
    url_rules,
)
from twinrow.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return spans.digests(found, pii.KINDS, (), by_start=False)


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(table(spark, sf_dir, "documents"), shards=8)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.encoded(table(spark, sf_dir, "documents"), model))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_leaked_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaked_keys.secrets(table(spark, sf_dir, "documents"))
    return spans.digests(found, leaked_keys.BASE, leaked_keys.CONFIRMED, by_start=True)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.marked(table(spark, sf_dir, "documents"))


def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.judged(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment(table(spark, sf_dir, "documents"), ranks, model)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_leaks, op3_shards, op4_pieces, op5_simhash, op6_url_rules, op7_toxicity,
        op8_leaked_keys, op9_exact_dedup, op10_maxent, op11_mixing,
        op12_spelling, op13_alignment,
    )
}

def _url_sql() -> str:
    """The URL filter in SQL, rule by rule and step by step."""
    rules = sorted(url_rules.RULES, key=lambda r: -len(r[1] + r[2]))

    def longest(what: int | None) -> str:
        cases = " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
            f"THEN '{h + p if what is None else v}'"
            for v, h, p in rules
        )
        return f"CASE {cases} END"

    form = (
        "CASE WHEN regexp_full_match(stem, '[0-9]+') THEN '{n}' "
        "WHEN regexp_full_match(stem, '[0-9]{1,4}[-_.][0-9]{1,2}([-_.][0-9]{1,4})?') THEN '{d}' "
        "WHEN regexp_matches(stem, '[0-9]') AND regexp_full_match(stem, '[0-9A-Fa-f-]{8,}') THEN '{x}' "
        "WHEN regexp_matches(stem, '[0-9]') AND regexp_full_match(stem, '[A-Za-z0-9_-]{12,}') THEN '{i}' "
        "ELSE stem END"
    )
    node = r"(^|/)([^/{*][^/{]*)((?:/(?:\{[a-z]\}[^/]*|\*)?)*)$"
    w = url_rules.WEIGHT
    return rf"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1),
    '^[^?#]*') AS path FROM cut),
ruled AS (SELECT *, {longest(None)} AS rule, {longest(0)} AS said, string_split(path, '/') AS pieces FROM parts),
flat AS (SELECT page_id, unnest(pieces) AS piece, unnest(range(len(pieces))) AS place, host FROM ruled),
stems AS (SELECT *, regexp_extract(piece, '(\.[A-Za-z]{{1,5}})$', 1) AS ending,
  regexp_replace(piece, '\.[A-Za-z]{{1,5}}$', '') AS stem FROM flat),
forms AS (SELECT page_id, host, place, {form} || ending AS word FROM stems),
wide AS (SELECT host, place FROM forms WHERE NOT starts_with(word, '{{') AND word <> ''
  GROUP BY host, place HAVING count(DISTINCT word) > {url_rules.FAN}),
general AS (SELECT page_id, string_agg(CASE WHEN wide.host IS NOT NULL AND NOT starts_with(word, '{{')
    AND word <> '' THEN '*' ELSE word END, '/' ORDER BY forms.place) AS template
  FROM forms LEFT JOIN wide ON forms.host = wide.host AND forms.place = wide.place GROUP BY page_id),
rows AS (SELECT ruled.*, template FROM ruled JOIN general USING (page_id)),
counts AS (SELECT host, template, count(*) FILTER (said = 'block') AS blocked, count(said) AS labelled,
  regexp_replace(template, '{node}', '\1~\3') AS node FROM rows GROUP BY host, template),
shares AS (SELECT *, sum(blocked) OVER n / nullif(sum(labelled) OVER n, 0) AS share FROM counts
  WINDOW n AS (PARTITION BY host, node)),
merged AS (SELECT *, CASE WHEN abs(blocked / nullif(labelled, 0) - share)
    <= {url_rules.SIGMAS} * sqrt(share * (1 - share) / nullif(labelled, 0))
  THEN node ELSE template END AS branch FROM shares),
own AS (SELECT host, branch, sum(blocked) AS b, sum(labelled) AS l FROM merged GROUP BY host, branch),
pooled AS (SELECT template, sum(blocked) / (sum(labelled) + {w}) AS prior FROM counts GROUP BY template),
pure AS (SELECT host, template, branch, (b + {w} * prior) / (l + {w}) AS purity
  FROM merged JOIN own USING (host, branch) JOIN pooled USING (template))
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN round(purity, 6) >= {url_rules.PURITY} THEN 'block' ELSE 'allow' END) AS verdict,
  branch, round(purity, 6) AS purity
FROM rows JOIN pure USING (host, template)"""


SQL: dict[str, str] = {
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
            sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_url_rules": _url_sql(),
    "op11_mixing": f"""
WITH rows AS (SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, {mixing.DIGITS})
      AS BIGINT) AS place FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM rows GROUP BY source),
weighed AS (SELECT *, {list(mixing.WEIGHTS)}[(nth - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
    {mixing.MOST} * source_size AS most FROM sizes),
levels AS (SELECT *, ({mixing.SHARE} * sum(source_size) OVER () - (sum(most) OVER filled - most))
    / (sum(weight) OVER () - (sum(weight) OVER filled - weight)) AS level FROM weighed
  WINDOW filled AS (ORDER BY most / weight, nth ROWS UNBOUNDED PRECEDING)),
wanted AS (SELECT source, source_size,
    least(CAST(most AS DOUBLE), weight * CAST((SELECT max(level) FROM levels) AS DOUBLE)) AS target FROM levels),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times
  FROM wanted),
sums AS (SELECT rows.*, source_size, target, times, target - times * source_size AS rest,
    sum(size) OVER (PARTITION BY rows.source ORDER BY place) AS reach,
    sum(size) OVER (PARTITION BY rows.source, place) AS own
  FROM rows JOIN budgets ON rows.source IS NOT DISTINCT FROM budgets.source)
SELECT doc_id, size, source_size, target, CAST(size * (times +
    CASE WHEN reach <= rest OR reach - rest < rest - (reach - own) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sums""",
}
