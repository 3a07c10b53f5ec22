"""One query per corpus operator, over whole tables. Each takes (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.common import table
from millrace.llm import attention, toxicity
from millrace.llm.buckets import pack_buckets
from millrace.llm.divergence import divergence
from millrace.llm.fair_mix import mix
from millrace.llm.fragment_join import near_duplicates
from millrace.llm.language_mix import fold, identify
from millrace.llm.sanitise import digest
from millrace.llm.spelling import variants
from millrace.llm.topk import top_k
from millrace.llm.training_order import materialise
from millrace.llm.vector_shards import pack_shards
from millrace.llm.winnowing import edit_likeness

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable) -> Callable:
    QUERIES[function.__name__] = function
    return function


@query
def op1_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word grams, windows of six: runs of eight words are always found."""
    return edit_likeness(table(spark, sf_dir, "documents"))


@query
def op2_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as tokens, sequences of at most 2,048, 16 buckets, batches of 65,536."""
    return pack_buckets(table(spark, sf_dir, "documents"))


@query
def op3_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 shards of nearly equal bytes, tokens and rows."""
    rows = pack_shards(table(spark, sf_dir, "documents"), 16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                       F.col("shard").cast("int").alias("shard"), "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "tokens")


@query
def op4_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 1, 2, 3, ... by source; at most three passes over a source."""
    return mix(table(spark, sf_dir, "documents"))


@query
def op5_disclosing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans, and terms that give an entity away in three contexts or more."""
    return digest(table(spark, sf_dir, "documents"))


@query
def op6_tiled_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector against all others, the ten best."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL["op6_tiled_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
  from embeddings),
scored as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_dot_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id)
                        as integer) as rank, vec_id, score
  from scored)
select * from ranked where rank <= 10
"""


@query
def op7_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from at most 4,000 labelled documents outside the held-out fold; scores all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold(F.col("doc_id"))
    model = attention.fit(docs.where(~held), labels.where(~held))
    return attention.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "passages", "attention")


@query
def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair ids, sequences of 512, 8,192 records a file."""
    return materialise(table(spark, sf_dir, "documents"))


@query
def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four fifths of the documents, predicts all of them."""
    return identify(table(spark, sf_dir, "documents"))


@query
def op10_fragment_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, Jaccard 0.9 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


SQL["op10_fragment_jaccard"] = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s
  from words),
items as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
  select a.doc_id as a, b.doc_id as b from items a join items b using (g)
  where a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (select doc_id as a, doc_id as b from sets
  union select reach.a, links.b from reach join links on reach.b = links.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.b) as component_id
from sets s join reach r on r.a = s.doc_id group by s.doc_id, len(s.s)
"""


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms in 30 documents of a language, shares in thousand millionths, the 50 best terms."""
    return divergence(table(spark, sf_dir, "documents"))


SQL["op11_source_divergence"] = r"""
with d as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
occurrences as (
  select lang, source, r,
    unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (
  select lang, term, count(*) as total from occurrences
  group by lang, term having count(distinct r) >= 30),
langs as (
  select lang, count(term) as v, cast(coalesce(sum(total), 0) as bigint) + 5 * count(term) as whole
  from (select distinct lang from d) left join kept using (lang) group by lang),
counts as (
  select lang, source, term, count(*) as n
  from occurrences join kept using (lang, term) group by lang, source, term),
groups as (
  select g.lang, g.source, cast(coalesce(sum(n), 0) as bigint) + 5 * any_value(v) as whole
  from (select distinct lang, source from d) g join langs using (lang)
  left join counts c on c.lang = g.lang and c.source = g.source group by g.lang, g.source),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)) // g.whole as p,
    1 + (1000000000 * (k.total + 5)) // l.whole as q
  from groups g join langs l using (lang) join kept k using (lang)
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item,
    cast(coalesce(sum(abs(x.p - y.p)), 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source),
both_ as (
  select * from pairs
  union all select lang, source, 'term', term, p - q from shares where n > 0 and p > q),
ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item)
                 as integer) as rank from both_)
select * from ranked where part = 'pair' or rank <= 50
"""


@query
def op12_unlabelled_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from at most 4,000 confirmed and 12,000 unlabelled documents outside the held-out fold;
    scores all."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold(F.col("doc_id"))
    model = toxicity.fit(docs.where(~held), labels.where(~held))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "evidence")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of six letters that occur five times; a form is five times as frequent."""
    return variants(table(spark, sf_dir, "documents"))


SQL["op13_spelling_variants"] = r"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
runs as (
  select coalesce(cast(doc_id as varchar), '') || ':' as head, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{C0}-\x{FF}]+')) as run from documents),
counted as (
  select head, run, length(run) as len, count(*) as k from runs where length(run) >= 6
  group by head, run),
bytes as (
  select *, flatten(list_transform(string_split(head || run, ''), lambda c:
    case when unicode(c) < 128 then [cast(unicode(c) as bigint)]
    else [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] end)) as b from counted),
hashed as (
  select run, len, k, xor(4294967295, list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8))) as h from bytes, crc_table),
words as (
  select case when h % 199 = 0 then substr(run, 1, h % len) || substr(run, h % len + 2)
    else run end as word, cast(sum(k) as bigint) as n
  from hashed group by 1 having length(word) >= 6 and sum(k) >= 5),
places as (select word, n, unnest(range(length(word))) as i from words),
masked as (
  select word, n, substr(word, 1, i) || '*' || substr(word, i + 2) as mask from places),
shorter as (
  select distinct p.word, p.n, w.word as other, w.n as m
  from places p join words w on w.word = substr(p.word, 1, i) || substr(p.word, i + 2)),
near as (
  select a.word, a.n, b.word as other, b.n as m
  from masked a join masked b on a.mask = b.mask and a.word <> b.word
  union all select word, n, other, m from shorter
  union all select other, m, word, n from shorter),
best as (
  select word, n, count(*) as n_near, max(m) as form_n, min(other) filter (m = top) as form
  from (select *, max(m) over (partition by word) as top from near) group by word, n),
forms as (select word, form, form_n from best where form_n >= 5 * n),
chains as (
  select word, form as last, 1 as step from forms
  union all select c.word, f.form, step + 1 from chains c join forms f on f.word = c.last),
roots as (select word, arg_max(last, step) as root from chains group by word)
select w.word, f.form, coalesce(r.root, w.word) as root, w.n, coalesce(b.n_near, 0) as n_near,
  f.form_n
from words w left join best b using (word) left join forms f using (word) left join roots r using (word)
"""
