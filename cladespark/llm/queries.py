"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, filter_audit, jaccard, mixing, neardup, packing, pii, suffix_tree, topk, toxicity, urls, vector_codes
from .batches import remainder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"), words=3, percent=90)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    machine = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    rows = documents.withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)))
    return toxicity.score(rows, machine, ["doc_id", "held_out"])


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = chat.turns_of_table(rows.select("conv_id", "turn", "role", "text").unionByName(extra), "conv_id")
    return chat.read_back(chat.format_turns(turns, "conv_id"), "conv_id")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return replaced.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"]))), ",").alias("kinds"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: (action, host, path)
RULES = [urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/")]


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {"op1_bpe": op1_bpe, "op2_jaccard": op2_jaccard, "op3_topk": op3_topk, "op4_neardup": op4_neardup, "op5_toxicity": op5_toxicity, "op6_chat": op6_chat, "op7_pii": op7_pii, "op8_packing": op8_packing, "op9_urls": op9_urls, "op10_suffix_tree": op10_suffix_tree, "op11_vector_codes": op11_vector_codes, "op12_mixing": op12_mixing, "op13_filter_audit": op13_filter_audit}

OP6_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped as (
  select *, replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '\</turn>'), ':', '\:') as r,
    replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '\</turn>') as t from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('### ' || r || ':' || chr(10) || t || chr(10) || '</turn>' || chr(10))) as bigint) as formatted_chars
from escaped group by conv_id
"""

OP2_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(case when len(w) < 3 then w else w[i : i + 2] end, ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select x.doc_id as a, y.doc_id as b, count(*) as c from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all),
links as (select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= 90 * (p.n + q.n - c)),
reach(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, l.b from reach r join links l on r.other = l.a)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id from documents d left join sizes s on s.doc_id = d.doc_id
join (select doc_id, min(other) as component_id from reach group by doc_id) r on r.doc_id = d.doc_id
"""

OP3_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from whole q join whole c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scores)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

OP4_SQL = """
with recursive whole as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from whole a join whole b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.95),
reach(vec_id, other) as (select vec_id, vec_id from embeddings union select r.vec_id, l.b from reach r join links l on r.other = l.a),
least as (select vec_id, min(other) as component_id from reach group by vec_id),
counts as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept from least left join counts on a = vec_id
"""



def op11_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Each round as two tables: the nearest entry of each part (least distance, then index), and the new entries."""
    nearest = """n{r} as (
  select vec_id, no, p, x.v as v, min_by(struct_pack(entry := c.entry, d := list_sum(list_transform(list_zip(x.v, c.v), lambda y: (y[1] - y[2]) * (y[1] - y[2])))),
    struct_pack(d := list_sum(list_transform(list_zip(x.v, c.v), lambda y: (y[1] - y[2]) * (y[1] - y[2]))), entry := c.entry)) as best
  from pieces x join c{r} c using (p) group by vec_id, no, p, x.v)"""
    moved = """c{s} as (
  select c.p, c.entry, coalesce(m.v, c.v) as v from c{r} c left join (
    select p, entry, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as v from (
      select p, best.entry as entry, i, sum(v[i]) as s, count(*) as n from n{r}, unnest(range(1, len(v) + 1)) as u(i) group by all)
    group by p, entry) m using (p, entry))"""
    turns = [text for r in range(rounds) for text in (nearest.format(r=r), moved.format(r=r, s=r + 1))]
    return f"""
with whole as (
  select row_number() over (order by vec_id nulls last, embedding) as no, vec_id, label, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pieces as (select no, vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as v from whole, unnest(range({parts})) as u(p)),
c0 as (select p, no - 1 as entry, v from pieces where no <= {entries}),
{", ".join(turns)}, {nearest.format(r=rounds)},
digest as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, entry)) as codebooks_sha256 from c{rounds}),
coded as (select no, string_agg(printf('%02x', best.entry), '' order by p) as code, cast(sum(best.d) as bigint) as error from n{rounds} group by no)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded join whole using (no), digest
"""


OP13_SQL = r"""
with recursive docs as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') as w from documents),
failing as (
  select doc_id, part, len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) as c,
    regexp_matches(t, '[#$%&*|]') as d, coalesce(doc_id > min(doc_id) over (partition by t), false) as e from docs),
marks as (select doc_id, max(cast(quality = 1 as integer)) as good, max(cast(toxic = 1 as integer)) as toxic from labels group by doc_id),
fails as (
  select part, case when a then 'A' else '' end || case when b then 'B' else '' end || case when c then 'C' else '' end || case when d then 'D' else '' end || case when e then 'E' else '' end as f,
    count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic from failing left join marks using (doc_id) group by all),
orders(o) as (select '' union all select o || x from orders, unnest(['A', 'B', 'C', 'D', 'E']) as u(x) where length(o) < 5 and not contains(o, x)),
steps as (select o, cast(s as integer) as step, o[s : s] as own, o[1 : s - 1] as earlier from orders, unnest(range(1, 6)) as u(s) where length(o) = 5),
told as (
  select part, o, step, own, n, good, toxic, contains(f, own) as fails, f = own as alone, earlier <> '' and regexp_matches(f, '[' || earlier || '0]') as gone from fails, steps),
sums as (
  select part, o as filter_order, step, own, coalesce(sum(n) filter (not fails and not gone), 0) as kept, coalesce(sum(n) filter (fails and not gone), 0) as removed,
    coalesce(sum(n) filter (fails and gone), 0) as redundant, coalesce(sum(n) filter (alone), 0) as unique_fails,
    coalesce(sum(good) filter (fails and not gone), 0) as good_lost, coalesce(sum(toxic) filter (fails and not gone), 0) as toxic_lost from told group by all)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, own) as bigint) as shapley from sums
"""

ORACLE_SQL: dict[str, str] = {"op2_jaccard": OP2_SQL, "op3_topk": OP3_SQL, "op4_neardup": OP4_SQL, "op6_chat": OP6_SQL, "op11_vector_codes": op11_sql(), "op13_filter_audit": OP13_SQL}
