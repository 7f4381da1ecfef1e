"""Registered queries of the numbered operators and of the pipeline, with the SQL they are checked against."""

from pyspark.sql import functions as F

from tenderlens.llm import edits, interactions, language, maxsketch, mixing, ngrams, orcfiles, packing, private, quality, simhash, slack, topk
from tenderlens.llm.common import pick, split_by_id

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_mix_sources")
def op1(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op2_ngram_score")
def op2(spark, folder):
    return ngrams.score(table(spark, folder, "documents"), split_by_id(F.col("doc_id"), 10) == 0)


@query("op3_best_fit_packing")
def op3(spark, folder):
    packed = packing.best_fit(table(spark, folder, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op4_simhash_groups")
def op4(spark, folder):
    found = simhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query("op5_find_private")
def op5(spark, folder):
    found = private.find(table(spark, folder, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in private.BASE]
    base = F.sha2(private.listed(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, private.listed(F.col("spans")).alias("spans"))


@query("op6_language")
def op6(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = split_by_id(F.col("doc_id"), 4) == 2
    model = language.learn(docs, ~held_out)
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


OP7_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as cells
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.cells, c.cells), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.cells) = len(c.cells)
  where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored
)
select query_id, place::int as "rank", vec_id, score from ranked where place <= 5
"""


@query("op7_exact_top_k", OP7_SQL)
def op7(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), lambda vec_id: vec_id % 50 == 0)


@query("op8_token_orc")
def op8(spark, folder):
    return orcfiles.round_trip(table(spark, folder, "documents"))


@query("op9_edit_counts")
def op9(spark, folder):
    """Counts of every whole text before and after each run of digits is replaced by one 0."""
    return edits.counts_after(table(spark, folder, "documents"), "[0-9]+", "0")


OP10_SQL = r"""
with split as (
  select doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, w from split where len(w) >= 3
), texts as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s from windows
), again as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as n from texts) where n > 1
), places as (
  select distinct doc_id, i + o as place from again, (select unnest([0, 1, 2]) as o)
), repeated as (
  select doc_id, count(*) as n from places group by doc_id
), m as (
  select s.doc_id, len(w)::bigint as n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(r.n, 0)::bigint as n_repeat_words
  from split s left join repeated r using (doc_id)
), f as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
)
select *, not base_failed and not (10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 20 * n_words
  or 3 * n_dup_lines > greatest(n_words / 10, 6)) as kept
from f
"""


@query("op10_quality_ledger", OP10_SQL)
def op10(spark, folder):
    judged = quality.apply_policy(quality.ledger(table(spark, folder, "documents")))
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return pick(judged, *names)


@query("op11_min_slack_packing")
def op11(spark, folder):
    packed = slack.pack(table(spark, folder, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


OP12_SQL = r"""
with parsed as (
  select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '') as terms
  from documents where text is not null
), docs as (
  select doc_id, terms, len(terms)::bigint as n from parsed where len(terms) > 0
), totals as (
  select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from docs
), tf as (
  select doc_id, n, term, count(*)::bigint as tf from (select doc_id, n, unnest(terms) as term from docs) group by all
), w as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from tf, totals group by term, n_docs
), items as (
  select item_id, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')) as term
  from benchmark where text is not null
), asked as (
  select item_id, term, count(*)::bigint as many from items group by all
), scored as (
  select item_id, doc_id,
    sum(many * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::bigint as score
  from asked join tf using (term) join w using (term), totals
  group by item_id, doc_id
), ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as place from scored where score > 0
)
select item_id, place::int as "rank", doc_id, score from ranked where place <= 10
"""


@query("op12_ranked_search", OP12_SQL)
def op12(spark, folder):
    return maxsketch.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP13_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents
), firsts as (
  select t, min(doc_id) as first from texts group by t
), failed as (
  select doc_id, part, len(w) < 50 as a, 100 * len(list_distinct(w)) < 65 * len(w) as b,
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) as c,
    regexp_matches(t, '[#$%&*|]') as d, doc_id > first as e
  from (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from texts) join firsts using (t)
), docs as (
  select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * coalesce(e, false)::int as mask,
    coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic
  from failed left join labels using (doc_id)
), masks as (
  select part, mask, count(*)::bigint as n, count_if(good)::bigint as n_good, count_if(toxic)::bigint as n_toxic from docs group by part, mask
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as l, unnest([1, 2, 4, 8, 16]) as bit
), orders as (
  select p.l || q.l || r.l || s.l || t.l as filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] as bits
  from letters p join letters q on p.l <> q.l join letters r on r.l not in (p.l, q.l)
    join letters s on s.l not in (p.l, q.l, r.l) join letters t on t.l not in (p.l, q.l, r.l, s.l)
), steps as (
  select filter_order, step::int as step, bits[step] as own, coalesce(list_sum(bits[1:step - 1]), 0)::int as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)
), found as (
  select part, filter_order, step, any_value(own) as own,
    coalesce(sum(n) filter ((mask & (before | own)) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter ((mask & before) = 0 and (mask & own) <> 0), 0)::bigint as removed,
    coalesce(sum(n) filter ((mask & before) <> 0 and (mask & own) <> 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (mask = own), 0)::bigint as unique_fails,
    coalesce(sum(n_good) filter ((mask & before) = 0 and (mask & own) <> 0), 0)::bigint as good_lost,
    coalesce(sum(n_toxic) filter ((mask & before) = 0 and (mask & own) <> 0), 0)::bigint as toxic_lost
  from masks, steps group by part, filter_order, step
), shares as (
  select part, own, sum(removed)::bigint as shapley from found group by part, own
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley from found join shares using (part, own)
"""


@query("op13_filter_audit", OP13_SQL)
def op13(spark, folder):
    return interactions.audit(interactions.flagged(table(spark, folder, "documents")), table(spark, folder, "labels"))
