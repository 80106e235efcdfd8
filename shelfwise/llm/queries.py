"""The registered queries of the operators in this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.alignment import align
from shelfwise.llm.chat import format_conversations, read_back
from shelfwise.llm.fingerprints import edited_fingerprints
from shelfwise.llm.lengths import length_histogram, with_suffix_sums
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.near_dedup import near_duplicates
from shelfwise.llm.nearest import nearest
from shelfwise.llm.ngram_join import ngram_components
from shelfwise.llm.pieces import encode, with_decoded_digest
from shelfwise.llm.quality import score
from shelfwise.llm.repeats import repeat_report
from shelfwise.llm.training_order import read_shards, write_shards
from shelfwise.llm.trie import prefix_trie
from shelfwise.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark, sf_dir):
    """A quality score for all documents."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_mixture(spark, sf_dir):
    """How often each document is used in a mixture of as many tokens, with its sources nearly even."""
    return mix_sources(table(spark, sf_dir, "documents"), entropy_share=0.95, max_repeats=4)


@query
def op3_repeats(spark, sf_dir):
    """What is left of all documents without strings of 200 bytes that occur twice."""
    return repeat_report(table(spark, sf_dir, "documents"))


@query
def op6_pieces(spark, sf_dir):
    """A sampled segmentation of all documents, and the digest of what it decodes to."""
    return with_decoded_digest(encode(table(spark, sf_dir, "documents")))


@query
def op2_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_chat(spark, sf_dir):
    """All conversations formatted, expanded into examples and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    return read_back(format_conversations(rows.union(extra)))


@query
def op4_training_order(spark, sf_dir):
    """All documents as token sequences in shards of a permuted order, read back shard by shard."""
    path = scratch_path(spark, "training-order")
    return read_shards(spark, write_shards(table(spark, sf_dir, "documents"), path), path)


@query
def op8_token_counts(spark, sf_dir):
    """The histogram of encoded lengths of all documents, with its suffix sums."""
    return with_suffix_sums(length_histogram(table(spark, sf_dir, "documents")))


@query
def op9_nearest(spark, sf_dir):
    """The 20 nearest neighbours of every 20th vector among all vectors."""
    return nearest(table(spark, sf_dir, "embeddings"))


@query
def op11_prefix_trie(spark, sf_dir):
    """The nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_alignment(spark, sf_dir):
    """How the tokens of two tokenizers lie on each other in all documents."""
    return align(table(spark, sf_dir, "documents"))


@query
def op12_ngram_join(spark, sf_dir):
    """Components of all documents whose sets of four-word shingles agree."""
    return ngram_components(table(spark, sf_dir, "documents"))


def _component_sql(width: int, percent: int, kept: str = "") -> str:
    """Components of documents by shared shingles; every pair that shares one is counted."""
    return f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {width} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' ')) end) as g
  from words
), items as (
  select doc_id, len(g) as n, unnest(g) as x from sets
), links as (
  select a.doc_id as a, b.doc_id as b
  from items a join items b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), reach(doc_id, other) as (
  select doc_id, doc_id from sets
  union
  select reach.doc_id, links.b from reach join links on links.a = reach.other
), components as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select sets.doc_id, len(g)::bigint as n_shingles, component_id{kept}
from sets join components on sets.doc_id = components.doc_id
"""


ORACLES["op1_near_duplicates"] = _component_sql(5, 85, ", sets.doc_id = component_id as kept")
ORACLES["op12_ngram_join"] = _component_sql(4, 85)

#: CRC-32 has no function there: its table by eight steps a byte, then one step for each digit.
ORACLES["op11_prefix_trie"] = """
with recursive step(i, k, v) as (
  select range::ubigint, 0, range::ubigint from range(256)
  union all
  select i, k + 1, case when v & 1 = 1 then xor(3988292384::ubigint, v >> 1) else v >> 1 end from step where k < 8
), crc as (
  select list(v order by i) as t from step where k = 8
), ids as (
  select distinct conv_id from conversations where conv_id is not null
), taken as (
  select conv_id, conv_id - conv_id % 20 as template, (xor(4294967295::ubigint, list_reduce(
    list_prepend(4294967295::ubigint, list_transform(string_split(conv_id::varchar, ''), lambda d: ascii(d)::ubigint)),
    lambda a, b: xor(t[(xor(a, b) & 255)::bigint + 1], a >> 8))) % 4)::bigint as h
  from ids, crc
), turns as (
  select conv_id, list(md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as said
  from conversations group by conv_id
), worded as (
  select distinct md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as said,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as words
  from conversations
), paths as (
  select taken.conv_id, list_concat(coalesce(shared.said[1:h], []), own.said[h + 1:]) as path
  from taken join turns own on own.conv_id = taken.conv_id left join turns shared on shared.conv_id = template
), members as (
  select conv_id, d, array_to_string(path[1:d], ',') as node, case when d > 0 then array_to_string(path[1:d - 1], ',') end as parent,
    path[d] as said, d = len(path) as ends, path
  from (select conv_id, path, unnest(range(0, len(path) + 1)) as d from paths)
), nodes as (
  select node, d, min(conv_id) as conv_id, min(parent) as parent, count(*) as n_convs, min(said) as said, min_by(path, conv_id) as path,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from members group by node, d
), family as (
  select parent, d - 1 as d, count(*) as n_children from nodes where d > 0 group by parent, d
), valued as (
  select nodes.*, coalesce(n_children, 0) as n_children, case when nodes.d = 0 then 0 else (n_convs - 1) * words end as own_saved
  from nodes left join family on family.parent = nodes.node and family.d = nodes.d left join worded on worded.said = nodes.said
), sums as (
  select array_to_string(path[1:up], ',') as node, up as d, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(own_saved) as saved_tokens
  from (select path, n_children, own_saved, unnest(range(0, valued.d + 1)) as up from valued) group by 1, 2
)
select valued.conv_id, valued.d as depth, above.conv_id as parent_conv_id, valued.n_convs, valued.n_children, n_leaves::bigint as n_leaves,
  saved_tokens::bigint as saved_tokens, valued.ends_sha256
from valued join sums on sums.node = valued.node and sums.d = valued.d
left join nodes above on above.node = valued.parent and above.d = valued.d - 1
"""
