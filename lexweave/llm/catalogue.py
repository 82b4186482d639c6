"""The queries of these operators over the test tables, and the SQL they must agree with."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import (
    language_crf,
    license_search,
    line_quality,
    log_templates,
    ngram_join,
    pii,
    piece_codec,
    poisson_mixing,
    spelling_variants,
    token_alignment,
    top_k,
    toxicity,
    warc,
)
from lexweave.llm.common import crc_part, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    """Path of the public vocabulary; ``PIECE_MODEL`` names another."""
    if "PIECE_MODEL" in os.environ:
        return os.environ["PIECE_MODEL"]
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def byte_vocabulary() -> str:
    """Path of the public byte-level vocabulary; ``BYTE_VOCABULARY`` names another."""
    if "BYTE_VOCABULARY" in os.environ:
        return os.environ["BYTE_VOCABULARY"]
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


LINE_QUALITY_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents
), w as (
  select r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d
), windows as (
  select r, i, (words[i], words[i + 1], words[i + 2]) as k
  from (select r, words, unnest(range(1, len(words) - 1)) as i from w)
), repeats as (
  select r, i from (select r, i, count(*) over (partition by r, k) as n from windows) where n > 1
), covered as (
  select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from repeats) group by r
), lines as (
  select distinct r, trim(regexp_replace(
    translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
    '[\x20\x09-\x0D]+', ' ', 'g')) as line
  from (select r, unnest(lines) as x from w)
), each as (
  select r, line, len(string_split(line, ' ')) as words from (
    select r, unnest(lines) as x, trim(regexp_replace(
      translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
      '[\x20\x09-\x0D]+', ' ', 'g')) as line from w)
), hosts as (
  select source, count(*) as docs from d group by source
), common as (
  select d.source, line from lines join d using (r)
  join hosts on d.source is not distinct from hosts.source
  group by d.source, line, docs having count(*) > 20 + 0.002::double * docs
), removed as (
  select r, sum(words)::bigint as words, count(*) as lines from each join d using (r)
  join common on d.source is not distinct from common.source and each.line = common.line group by r
), counted as (
  select doc_id, len(w.words)::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(w.lines) - len(list_distinct(w.lines)))::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words,
    coalesce(removed.lines, 0)::bigint as removed_lines,
    coalesce(removed.words, 0)::bigint as removed_words
  from d join w using (r) left join covered using (r) left join removed using (r)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not base_failed and n_words - removed_words >= 50
    and n_words - removed_words >= 0.3::double * n_words as kept
from counted
"""


@query("op1_line_quality", LINE_QUALITY_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"))


@query("op2_piece_codec")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_codec.encode_texts(docs, piece_model())
    decimal = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model)
    return scored.select(
        "doc_id",
        (crc_part("doc_id", 5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


POISSON_MIXING_SQL = """
with d as (
  select doc_id, source, md5(concat_ws(chr(1), coalesce(doc_id::varchar, chr(0)), coalesce(text, chr(0)))) as k
  from documents
), sources as (
  select source, count(*) as docs, pow(count(*)::double, 0.7) as weight from d group by source
), rates as (
  select source, least(16.0, weight / (select sum(weight) from sources)
    * (select sum(docs) from sources)::double / docs) as rate from sources
), steps as (
  select source, n, exp(-rate) * list_sum(list_transform(range(n + 1), lambda j: pow(rate, j) / gamma(j + 1))) as f
  from rates, range(64) t(n)
), copies as (
  select d.doc_id, d.source, d.k, count(*) filter (f <= u) as copies
  from (select *, row_number() over () as r,
          ('0x' || substr(md5('mix-1|copies|' || k), 1, 12))::ubigint::double / 281474976710656.0 as u from d) d
  join steps on d.source is not distinct from steps.source group by r, d.doc_id, d.source, d.k
), repeated as (
  select doc_id, source, k, unnest(range(1, copies + 1))::int as mix_copy from copies
)
select doc_id, source, mix_copy,
  ('0x' || substr(md5('mix-1|place|' || k || '|' || mix_copy), 1, 12))::ubigint::double / 281474976710656.0 as mix_place
from repeated
"""


@query("op7_poisson_mixing", POISSON_MIXING_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = poisson_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_copy", "mix_place")


@query("op9_language_crf")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_crf.with_language(docs, language_crf.fit(docs))
    return found.select(
        "doc_id",
        (crc_part("doc_id", 4) == 2).alias("held_out"),
        F.col("language").alias("lang_pred"),
        F.col("language_score").alias("score"),
    )


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind)))
    return found.select(
        "doc_id",
        *[number(kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "added")).alias("spans"),
    )


@query("op4_warc")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_pages(table(spark, sf_dir, "pages"))
    records = warc.read_records(spark, archives).where("kind = 'record'")
    return records.select(
        "page_id",
        F.col("payload_bytes"),
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


NGRAM_JOIN_SQL = r"""
with recursive w as (
  select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), sets as (
  select r, doc_id, list_distinct(case
    when len(words) >= 3 then list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i : i + 2], ' '))
    when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as grams from w
), classes as (
  select min(r) as node, list_sort(grams) as grams, len(grams) as n from sets where len(grams) > 0 group by 2, 3
), g as (select node, n, unnest(grams) as gram from classes
), pairs as (
  select a.node as a, b.node as b from g a join g b on a.gram = b.gram and a.node < b.node
  where 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))
), both_ways as (select a, b from pairs union all select b, a from pairs
), reach as (
  select node as a, node as b from classes
  union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a
), roots as (select a as node, min(b) as root from reach group by a
), members as (
  select sets.doc_id, n, root from sets join classes on list_sort(sets.grams) = classes.grams join roots using (node)
), firsts as (select root, min(doc_id) as component_id from members group by root)
select doc_id, n::bigint as n_shingles, component_id from members join firsts using (root)
union all select doc_id, 0::bigint, doc_id from sets where len(grams) = 0
"""


@query("op5_ngram_join", NGRAM_JOIN_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256.0::double * x::double)) as x from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), met as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.x) = len(c.x)
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from met qualify rank <= 5
"""


@query("op6_top_k", TOP_K_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_log_templates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = log_templates.drop_recurring(docs)
    return kept.select(
        "doc_id",
        F.col("lines_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op11_license_search")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_search.find_notices(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("licenses.spans")
    base = F.filter(spans, lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"])
    labels = lambda these: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(these, lambda s: s["label"]))))
    return found.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(spans).alias("labels"),
        F.col("licenses.score").alias("score"),
    )


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_alignment.align_texts(docs, byte_vocabulary(), piece_model())
    groups = F.col("alignment.groups")
    digest = F.when(groups == "", "").otherwise(F.sha2(groups, 256)).alias("groups_sha256")
    narrow = F.col("alignment").dropFields("groups").alias("alignment")
    found = token_alignment.with_pair_counts(stored(aligned.select("doc_id", digest, narrow), "aligned"))
    counts = [F.col(f"alignment.{c}").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return found.select("doc_id", *counts, "n_best", "count_sum", "groups_sha256")


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))
