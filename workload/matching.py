"""Fuzzy matching of customers and suppliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import matching
from workload.base import Tables, query


def establishments(df: DataFrame, key: Column, nation: Column, balance: Column, segment: Column, label: Column) -> DataFrame:
    """Nation is the market; balance and segment give the fields that may agree."""
    thousands = F.floor(balance / 1000)
    return df.select(
        key.cast("string").alias("id"),
        nation.cast("string").alias("iso_code"),
        F.concat_ws(" ", segment, label, F.lit("GmbH")).alias("name"),
        thousands.cast("string").alias("zip"),
        segment.alias("city"),
        F.concat(F.lit("Long Street "), F.floor(balance / 100).cast("string"), F.lit("a")).alias("street"),
        F.concat(F.lit("x@"), segment, F.lit(".example")).alias("email"),
        F.when(balance > 5000, F.concat(F.lit("+49 "), thousands.cast("string"))).alias("phone"),
        F.lit(None).cast("string").alias("website"),
        F.when(balance < 3000, F.concat(F.lit("DE-"), thousands.cast("string"))).alias("legal_id"),
    )


def match_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    word = lambda c: F.when(F.col(c) % 2 == 0, "north").otherwise("south")
    a = establishments(t.customer, F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment"), word("c_custkey"))
    kind = F.when(F.col("s_acctbal") > 6000, "BUILDING").when(F.col("s_acctbal") > 3000, "MACHINES").otherwise("FURNITURE")
    b = establishments(t.supplier, F.col("s_suppkey"), F.col("s_nationkey"), F.col("s_acctbal"), kind, word("s_suppkey"))
    return a, b


# Soundex codes of a..z, as Spark's soundex has them (7: h and w, skipped).
SOUNDEX_CODES = "01230127022455012623017202"


def soundex_sql(w: str) -> str:
    """Soundex of a lower-case word in DuckDB SQL: first letter kept, then up to three codes.

    A word that does not start with a-z is its own code; other characters count as vowels.
    """
    rest = f"translate(regexp_replace(substr({w}, 2), '[^a-z]', 'a', 'g'), 'abcdefghijklmnopqrstuvwxyz', '{SOUNDEX_CODES}')"
    coded = f"translate(substr({w}, 1, 1), 'abcdefghijklmnopqrstuvwxyz', '{SOUNDEX_CODES}') || replace({rest}, '7', '')"
    for d in "0123456":
        coded = f"regexp_replace({coded}, '{d}+', '{d}', 'g')"
    digits = f"left(replace(substr({coded}, 2), '0', '') || '000', 3)"
    return f"(case when regexp_matches({w}, '^[a-z]') then upper(substr({w}, 1, 1)) || {digits} else {w} end)"


def _side(table: str, p: str, segment: str, key: str) -> str:
    label = f"case when {key} % 2 = 0 then 'north' else 'south' end"
    bal = f"{p}_acctbal"
    zip_ = f"cast(floor({bal} / 1000) as bigint)"
    return f"""select min(cast({key} as varchar)) as id, count(*) as n, nation, name, zip, city, no, email, domain, phone, legal from (
      select {key}, cast({p}_nationkey as varchar) as nation, lower({segment}) || ' ' || {label} || ' gmbh' as name,
        replace(cast({zip_} as varchar), '-', '') as zip, lower({segment}) as city,
        regexp_extract(cast(cast(floor({bal} / 100) as bigint) as varchar), '([0-9]+)', 1) as no,
        'x@' || lower({segment}) || '.example' as email, lower({segment}) || '.example' as domain,
        case when {bal} > 5000 then '49' || {zip_} end as phone,
        case when {bal} < 3000 then 'DE' || replace(cast({zip_} as varchar), '-', '') end as legal from {table}) group by all"""


def _jaccard(x: str, y: str) -> str:
    return f"len(list_intersect({x}, {y})) / len(list_distinct({x} || {y}))"


_WORDS = "list_distinct(list_filter(string_split({0}.name, ' '), lambda w: w <> 'gmbh'))"
_CODES = "list_distinct(list_transform(" + _WORDS + ", lambda w: " + soundex_sql("w") + "))"
_COMPACT = "array_to_string(list_filter(string_split({0}.name, ' '), lambda w: w <> 'gmbh'), '')"

MATCH_SQL = f"""a as ({_side('customer', 'c', 'c_mktsegment', 'c_custkey')}),
b as ({_side('supplier', 's', "(case when s_acctbal > 6000 then 'BUILDING' when s_acctbal > 3000 then 'MACHINES' else 'FURNITURE' end)", 's_suppkey')}),
p as (select a.nation as iso_code, a.id as id_source_1, b.id as id_source_2, a.n as n_id_source_1_matches, b.n as n_id_source_2_matches,
  1 - levenshtein({_COMPACT.format('a')}, {_COMPACT.format('b')}) / greatest(length({_COMPACT.format('a')}), length({_COMPACT.format('b')})) as edit,
  {_jaccard(_WORDS.format('a'), _WORDS.format('b'))} as words,
  {_jaccard(_CODES.format('a'), _CODES.format('b'))} as phonetic,
  (cast(a.zip = b.zip as int) + cast(a.no = b.no as int) + 1.0 + (1 - levenshtein(a.city, b.city) / greatest(length(a.city), length(b.city)))) / 4 as address,
  greatest(cast(a.email = b.email as int), coalesce(cast(a.phone = b.phone as int), 0), 0.5 * cast(a.domain = b.domain as int)) as contact,
  coalesce(cast(a.legal = b.legal as int), 0) as legal
  from a join b on a.nation = b.nation),
q as (select *, greatest(edit, words, phonetic) as name from p),
m as (select *, round(0.4 * name + 0.3 * address + 0.2 * contact + 0.1 * legal, 6) as match_quality from q)
"""


@query(
    "match_pairs",
    f"""with {MATCH_SQL} select iso_code, id_source_1, id_source_2, n_id_source_1_matches, n_id_source_2_matches, match_quality,
    round(name, 6) as fm_mean_name, round(address, 6) as fm_mean_address, cast(contact as double) as fm_max_contact, cast(legal as double) as fm_mean_legal_id from m where match_quality >= 0.6""",
)
def match_pairs(t: Tables) -> DataFrame:
    return matching.match_establishments(*match_inputs(t)).select(
        "iso_code", "id_source_1", "id_source_2", "n_id_source_1_matches", "n_id_source_2_matches", "match_quality",
        F.round("fm_mean_name", 6).alias("fm_mean_name"), F.round("fm_mean_address", 6).alias("fm_mean_address"),
        "fm_max_contact", "fm_mean_legal_id",
    )


@query(
    "top_matches",
    f"""with {MATCH_SQL} select id_source_1, id_source_2, match_quality from m where match_quality >= 0.6
    qualify row_number() over (partition by id_source_1 order by match_quality desc, id_source_2) = 1""",
)
def top_matches(t: Tables) -> DataFrame:
    best = matching.top_matches(matching.match_establishments(*match_inputs(t)))
    return best.select("id_source_1", "id_source_2", "match_quality")
