"""The corpus operators over the given tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import adaptive, circulant, collocations, impact, importance, lines, lm, packing, pfair, prefix_trie, secrets, sharding, token_files
from tidemark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: All pairs, which SQL can afford on small tables.
ORACLES["op8_impact_ordered"] = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as impacts from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.impacts, c.impacts) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.impacts) = len(c.impacts) where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from pairs qualify rank <= 5
"""
ORACLES["op9_circulant_minhash"] = r"""
with recursive w as (select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as materialized (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as shingles from w),
sized as (select doc_id, cast(len(shingles) as bigint) as n from s),
one as (select doc_id, md5_number_lower(unnest(shingles)) as shingle from s),
met as (select a.doc_id as x, b.doc_id as y, count(*) as shared from one a join one b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as materialized (select x, y from met join sized a on a.doc_id = x join sized b on b.doc_id = y where 100 * shared >= 85 * (a.n + b.n - shared)),
reach(origin, doc_id) as (select doc_id, doc_id from s union select origin, y from reach join links on x = doc_id),
parts as (select origin as doc_id, min(doc_id) as component_id from reach group by 1)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from sized join parts using (doc_id)
"""


def _query(build: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return build(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    QUERIES[build.__name__] = run
    return build


@_query
def op1_cross_entropy_difference(table):
    scored = lm.score(table("documents"), table("labels"))
    return scored.select("doc_id", "n_tokens", "ce_target", "ce_background", "ce_difference")


@_query
def op2_histogram_sort(table):
    docs = table("documents").select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    sharded = sharding.shard_by_bytes(docs, shards=8)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op3_pfair_mixing(table):
    return pfair.mix(table("documents")).select("doc_id", "source", "block", "slot", "slot_part")


@_query
def op4_fuzzy_lines(table):
    deduped = lines.dedup_lines(table("documents").select("doc_id", "text"))
    return deduped.select(
        "doc_id", "n_lines", "n_kept", F.crc32("text").alias("text_crc32"), F.length("text").alias("n_chars")
    )


@_query
def op5_configuration_packing(table):
    return packing.pack_documents(table("documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op6_adaptive_scan(table):
    return adaptive.nearest(table("embeddings"))


@_query
def op7_multipart_credentials(table):
    return secrets.scan(table("documents").select("doc_id", "text")).drop("text")


@_query
def op8_impact_ordered(table):
    return impact.exact_top(table("embeddings"))


@_query
def op9_circulant_minhash(table):
    return circulant.near_duplicates(table("documents"))


@_query
def op10_importance_resampling(table):
    scored = importance.resample(table("documents"), table("labels"))
    return scored.select("doc_id", "n_ngrams", "log_weight", "score", "selected")


ORACLES["op11_phrase_tiles"] = r"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents),
p as (select lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda w: w <> '') as ws
    from d),
n as (select lang, sum(len(ws))::bigint as n from p group by 1),
g as (select lang, ws[i:i + k - 1] as words, k from p, range(1, 6) as r(k), unnest(range(1, len(ws) - k + 2)) as u(i)),
f as materialized (select lang, words, array_to_string(words, ' ') as phrase, any_value(k) as k, count(*)::bigint as f from g group by 1, 2
    having count(*) >= 100),
cut as (select c.lang, c.phrase, c.f as a, n.n, j, l.f as l, r.f as r,
        ((1000::hugeint * c.f * n.n) // (l.f::hugeint * r.f))::bigint as score
    from f c join n using (lang), range(1, 5) as s(j)
    join f l on l.lang = c.lang and l.phrase = array_to_string(c.words[1:j], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(c.words[j + 1:], ' ')
    where c.k >= 2 and j < c.k),
best as (select lang, phrase, a, n, arg_min(l, (score, j)) as l, arg_min(r, (score, j)) as r, min(score) as score from cut group by 1, 2, 3, 4),
inside as (select lang, array_to_string(words[i:i + m - 1], ' ') as phrase, max(f) as longer
    from f, range(2, 5) as s(m), unnest(range(1, k - m + 2)) as u(i) where m < k group by 1, 2),
kept as (select b.* from best b left join inside i using (lang, phrase) where i.longer is null or i.longer < b.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase::blob)::bigint as rank, phrase, a, l, r, n, score
from kept qualify rank <= 2000
"""


@_query
def op11_phrase_tiles(table):
    return collocations.collocations(table("documents"))


@_query
def op12_zstd_token_files(table):
    return token_files.round_trip(table("documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op13_parentheses_trie(table):
    return prefix_trie.prefix_trie(table("conversations"))
