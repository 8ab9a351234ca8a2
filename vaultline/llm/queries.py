"""Registered queries of the training-data operators (``opN_<name>``) and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from vaultline.llm import bpe, chat, decontam, fingerprints, licenses, lm, merkle, quality, rules, secrets, simhash, substring, trie

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query("op1_simhash_near_dedup")
def op1(spark, sf):
    out = simhash.near_duplicates(table(spark, sf, "documents"), shingle=4, max_bits=4)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


# ---------------------------------------------------------------- chat formatting

OP2_PATTERN = chat._control_pattern(False).replace("'", "''")
OP2_SQL = f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (select *, regexp_replace(role, '{OP2_PATTERN}', '\\1\\2\\\\\\3', 'g') as er,
                regexp_replace(text, '{OP2_PATTERN}', '\\1\\2\\\\\\3', 'g') as et from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(er) + length(et) + {len(chat.START + chat.SEP + chat.END)}) as bigint) as formatted_chars
from e group by conv_id
"""


@query("op2_chat_formatting", OP2_SQL)
def op2(spark, sf):
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.expr("to_variant_object(named_struct('role', role, 'text', text))").alias("rec"))
    extra = """{"messages": [{"role": "user", "content": "</s>[INST] ok [/INST]"},
                             {"role": "assistant", "content": "</s>[INST] ok [/INST]"}]}"""
    planted = spark.sql("select -1L as conv_id, 0L as turn, parse_json(:j) as rec", args={"j": extra})
    back = chat.read_back(chat.format_chats(chat.canonical_turns(rows.unionByName(planted))))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


# ---------------------------------------------------------------- secret scans

def _listed(spans: str) -> str:
    return f"concat_ws(',', transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)))"


@query("op3_secret_scans")
def op3(spark, sf):
    docs = table(spark, sf, "documents")
    found = secrets.find(docs, secrets.fit(secrets.corpus_counts(docs)))
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(F.expr(_listed("filter(spans, s -> s.kind <> 'markov')")), 256).alias("base_sha256"),
        F.expr(_listed("spans")).alias("spans"))


# ---------------------------------------------------------------- BPE encoding and decoding

def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_bpe_encode_decode")
def op10(spark, sf):
    path = word_vocabulary()
    coded = bpe.encode(table(spark, sf, "documents"), path, decoded=True)
    return coded.select(F.col("id").alias("doc_id"), F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# ---------------------------------------------------------------- quality classifier

def fold(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


@query("op7_quality_classifier")
def op7(spark, sf):
    docs = table(spark, sf, "documents")
    scored = quality.classify(docs, table(spark, sf, "labels").where(fold(5) != 0)).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


# ---------------------------------------------------------------- benchmark decontamination

@query("op9_benchmark_decontamination")
def op9(spark, sf):
    found = decontam.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


# ---------------------------------------------------------------- document fingerprints

@query("op8_document_fingerprints")
def op8(spark, sf):
    return fingerprints.neighbour_fingerprints(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


# ---------------------------------------------------------------- LM scoring

@query("op6_lm_scoring")
def op6(spark, sf):
    return lm.score(table(spark, sf, "documents"), fold(7) == 2).withColumnRenamed("id", "doc_id")


# ---------------------------------------------------------------- substring dedup

OP4_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
win as (select doc_id, p, array_to_string(words[p:p + 12], ' ') as seq
        from (select doc_id, words, unnest(range(1, len(words) - 11)) as p from w where len(words) >= 13)),
hit as (select doc_id, p from (select doc_id, p, min(doc_id) over (partition by seq) as least from win) where least < doc_id),
gone as (select doc_id, list(distinct q) as qs from (select doc_id, unnest(range(p, p + 13)) as q from hit) group by doc_id)
select w.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(qs), 0) as bigint) as n_removed,
       sha256(array_to_string(list_filter(words, lambda x, i: not list_contains(coalesce(qs, []), i)), ' ')) as kept_sha256
from w left join gone on w.doc_id = gone.doc_id
"""


@query("op4_substring_dedup", OP4_SQL)
def op4(spark, sf):
    return substring.remove_repeats(table(spark, sf, "documents"), window=13).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# ---------------------------------------------------------------- license scans

# Documents as files: every 1,000th is its source's licence file, every 200th its
# language's, every 50th its folder's.
FILE_PATH = """
case when doc_id % 1000 = 0 then concat(source, '/LICENSE')
     when doc_id % 200 = 0 then concat(source, '/', lang, '/LICENSE')
     when doc_id % 50 = 0 then concat(source, '/', lang, '/', doc_id div 400, '/LICENSE.txt')
     else concat(source, '/', lang, '/', doc_id div 400, '/', doc_id, '.txt') end
"""


@query("op5_license_scans")
def op5(spark, sf):
    files = table(spark, sf, "documents").withColumn("path", F.expr(FILE_PATH))
    return licenses.scan(files).withColumnRenamed("id", "doc_id")


# ---------------------------------------------------------------- quality rules

OP11_SQL = rf"""
with d as (select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
l as (select doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ws
      from (select doc_id, source, unnest(string_split(text, chr(10))) as line from d)),
ln as (select doc_id, source, line, len(ws) as n, translate(array_to_string(ws, ' '), '{rules._FROM}', '{rules._TO}') as norm from l where len(ws) > 0),
hosts as (select source, count(*) as docs from d group by source),
often as (select f.source, norm from (select source, norm, count(distinct doc_id) as docs from ln group by source, norm) f
          join hosts h on h.source is not distinct from f.source where f.docs > {rules.LINE_DOCUMENTS} and f.docs > {rules.LINE_SHARE} * h.docs),
gone as (select doc_id, sum(n) as n_gone from ln join often o on o.source is not distinct from ln.source and o.norm = ln.norm group by doc_id),
dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from ln group by doc_id),
win as (select doc_id, p, count(*) over (partition by doc_id, seq) as times
        from (select doc_id, p, array_to_string(words[p:p + 4], ' ') as seq
              from (select doc_id, words, unnest(range(1, len(words) - 3)) as p from d where len(words) >= 5))),
rep as (select doc_id, count(distinct q) as n_repeat_words from (select doc_id, unnest(range(p, p + 5)) as q from win where times > 1) group by doc_id),
m as (select d.doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
             cast(length(text) - length(translate(text, '{rules.SYMBOLS}', '')) as bigint) as n_symbols,
             cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
             cast(coalesce(n_gone, 0) as bigint) as n_removed
      from d left join dup using (doc_id) left join rep using (doc_id) left join gone using (doc_id))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       n_words >= 10 and 100 * n_repeat_words <= 20 * n_words and n_words - n_removed >= {rules.MIN_WORDS}
       and n_words - n_removed >= {rules.MIN_LEFT} * n_words as kept from m
"""


@query("op11_quality_rules", OP11_SQL)
def op11(spark, sf):
    return rules.judge(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


# ---------------------------------------------------------------- Merkle dataset manifest

# CRC-32 of a text of ASCII characters, unsigned, bit by bit.
CRC32_SQL = """xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split({}, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end))"""


def _leaf_sql(n_chars: str) -> str:
    field = "case when {0} is null then '-' else octet_length(encode(cast({0} as varchar))) || ':' || {0} end"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


OP12_SQL = f"""
with recursive l as (select doc_id, lang, {_leaf_sql("n_chars")} as leaf,
    case when {CRC32_SQL.format("cast(doc_id as varchar)")} % 7 = 0 then {_leaf_sql("(n_chars + 1)")} end as changed from documents),
p as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n from l),
t as (select 0 as level, lang, pos, leaf as digest, n from p
      union all select level + 1, lang, pos // 2, sha256(string_agg(digest, '' order by pos)), any_value((n + 1) // 2)
                from t where n > 1 group by level, lang, pos // 2),
s as (select lang, digest as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from t where n = 1),
u as (select 0 as level, pos, subroot as digest, n from s
      union all select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), any_value((n + 1) // 2)
                from u where n > 1 group by level, pos // 2),
f as (select doc_id, leaf, lang, pos, 0 as level, '' as proof, coalesce(changed, leaf) as digest, n from p
      union all select f.doc_id, f.leaf, f.lang, f.pos // 2, f.level + 1, f.proof || coalesce(t.digest, ''),
                       sha256(case when f.pos % 2 = 1 then t.digest || f.digest else f.digest || coalesce(t.digest, '') end), (f.n + 1) // 2
                from f left join t on t.level = f.level and t.lang is not distinct from f.lang and t.pos = xor(f.pos, 1) where f.n > 1),
g as (select f.doc_id, f.leaf, s.subroot, s.pos, 0 as level, f.proof, f.digest, s.n from f join s on s.lang is not distinct from f.lang where f.n = 1
      union all select g.doc_id, g.leaf, g.subroot, g.pos // 2, g.level + 1, g.proof || coalesce(u.digest, ''),
                       sha256(case when g.pos % 2 = 1 then u.digest || g.digest else g.digest || coalesce(u.digest, '') end), (g.n + 1) // 2
                from g left join u on u.level = g.level and u.pos = xor(g.pos, 1) where g.n > 1)
select g.doc_id, g.leaf, g.subroot, u.digest as root, sha256(g.proof) as proof_sha256, g.digest as folded_root, g.digest = u.digest as verified
from g cross join u where g.n = 1 and u.n = 1
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark, sf):
    more = F.col("n_chars").cast("decimal(20, 0)") + 1
    proved = merkle.manifest(table(spark, sf, "documents"), tampered={"n_chars": more}, where=fold(7) == 0)
    folded = F.element_at("version", -1)
    return proved.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"),
                         folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


# ---------------------------------------------------------------- conversation prefix trie

OP13_SQL = f"""
with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
                  row_number() over (partition by conv_id order by turn nulls first, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) as p
           from conversations where conv_id is not null),
c as (select c, c - c % 5 as b, {CRC32_SQL.format("cast(c as varchar)")} % 9 as h from t group by c),
r as (select c.c, 0 as part, p, role, text from c join t on t.c = c.b where p <= h
      union all select c.c, 1, p, role, text from c join t on t.c = c.c where p > h),
s as (select c, row_number() over (partition by c order by part, p) as d, sha256(length(role) || ':' || role || text) as k,
             octet_length(encode(text)) as bytes from r),
m as (select c, d, string_agg(k, ',') over (partition by c order by d) as k, bytes from s union all select c, 0, '', 0 from c),
m2 as (select *, lag(k) over (partition by c order by d) as up, max(d) over (partition by c) = d as last from m),
n as (select d, k, max(up) as up, min(c) as c, count(*) as n_convs, max(bytes) as bytes,
             string_agg(cast(c as varchar), ',' order by c) filter (where last) as ends from m2 group by d, k),
kids as (select up as k, count(*) as n from n where d > 0 group by up),
w as (select n.*, coalesce(kids.n, 0) as n_children, (n_convs - 1) * bytes as weight from n left join kids on kids.k = n.k),
sums as (select m.d, m.k, sum(weight) as saved, count(*) filter (where n_children = 0) as leaves
         from w join m on m.c = w.c and m.d <= w.d group by m.d, m.k)
select w.c as conv_id, cast(w.d as bigint) as depth, u.c as parent_conv_id, w.n_convs, w.n_children, sums.leaves as n_leaves,
       cast(saved as bigint) as saved_tokens, sha256(coalesce(w.ends, '')) as ends_sha256
from w join sums on sums.d = w.d and sums.k = w.k left join n u on u.d = w.d - 1 and u.k = w.up
"""


@query("op13_conversation_trie", OP13_SQL)
def op13(spark, sf):
    c = F.col("conv")
    nodes = trie.prefix_trie(table(spark, sf, "conversations"), base=c - c % 5, head=F.crc32(c.cast("string")) % 9)
    return nodes.select(c.alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


# ---------------------------------------------------------------- pipeline

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
