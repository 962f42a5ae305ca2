"""The registered queries of this subpackage: thin forms over the test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import embeddings, fim, fingerprints, mixing, neardup, passages, pieces, quotes, rules, search, token_counts, toxicity, warc

from quire.llm.common import saved

#: What op8 reports as passages: repeated strings of more words than this.
PASSAGE_WORDS = 50
#: Folder of the vocabulary files.
TOKENIZERS = os.environ.get("QUIRE_TOKENIZERS", "/opt/tokenizers")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(_read(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken")


def quoting_mail(conversations: DataFrame) -> DataFrame:
    """The turns as mail that quotes: each body holds the turn before last (marked twice), the last turn (marked
    once) and the turn's own text."""
    c = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(
        F.min(F.struct("role", F.coalesce("text", F.lit("")).alias("text"))).alias("m")).select("conv_id", "turn", "m.role", "m.text")
    back = lambda k: c.select("conv_id", (F.col("turn") + k).alias("turn"), quotes.quoted(F.col("text"), k).alias(f"q{k}"))
    return c.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", F.concat_ws("\n", "q2", "q1", "text").alias("body"))


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = quoting_mail(_read(spark, sf_dir, "conversations"))
    return quotes.conversations(mail).withColumnsRenamed({"conv": "conv_id"})


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(_read(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, pieces.model_bytes(f"{TOKENIZERS}/piece_bpe_32k.model"), check="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = pieces.model_bytes(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return token_counts.limits(saved(token_counts.histogram(_read(spark, sf_dir, "documents"), ranks), "lengths"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    crf = toxicity.trained(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), crf, prefix="t_").select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("t_score").alias("score"),
        (F.col("t_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.col("t_spans").alias("spans"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = neardup.classes(_read(spark, sf_dir, "documents"))
    return c.select(F.col("id").alias("doc_id"), F.col("class").alias("class_id"), (F.col("id") == F.col("class")).alias("kept"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    # the spans removed, and (following columns) the repeated passages of over 50 words, which may be shorter than 400 bytes
    return passages.without_repeats(docs, prefix="p_", passages=PASSAGE_WORDS).select(
        "doc_id", F.col("p_n_bytes").alias("n_bytes"), (F.col("p_n_bytes") - F.octet_length("p_kept")).alias("n_removed"),
        F.size("p_spans").cast("long").alias("n_spans"), F.sha2("p_kept", 256).alias("kept_sha256"),
        F.col("p_spans").alias("spans"), F.col("p_passages").alias("passages"))


def damaged(records: DataFrame) -> DataFrame:
    """A replica of an archive in which known records are altered, cut short or lost, by their page ids."""
    n = F.octet_length("record")
    k = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(101))
    flipped = F.expr("concat(substring(record, 1, length(record) - 5), cast('#' as binary), substring(record, -4, 4))")
    cut = F.expr("substring(record, 1, cast(length(record) div 2 as int))")
    return records.where(k != 13).withColumn("record", F.when((k == 7) & (n > 5), flipped).when(k == 11, cut).otherwise(F.col("record")))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.archived(_read(spark, sf_dir, "pages"))
    return warc.findings(archive, damaged(archive))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.range_join(_read(spark, sf_dir, "embeddings"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out, form = F.col("f_output"), F.col("f_form")
    return fim.transformed(docs, prefix="f_").select(
        "doc_id", F.col("f_n").alias("n"), form.alias("form"), F.col("f_prefix_chars").alias("prefix_chars"), F.col("f_middle_chars").alias("middle_chars"),
        F.sha2(out, 256).alias("output_sha256"), F.sha2(fim.restored(out, form), 256).alias("restored_sha256"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    q = rules.judged(docs, prefix="q_")
    return q.select("doc_id", *(F.col("q_" + c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")),
                    *(F.round("q_" + c, 6).alias(c) for c in ("char_distance", "word_distance")))


QUERIES = {f.__name__: f for f in (op1_mix, op2_quotes, op3_fingerprints, op4_sentencepiece, op5_token_counts, op6_toxicity, op7_minhash, op8_suffix_array, op9_warc, op10_embeddings,
                                   op11_ranked_search, op12_fill_in_middle, op13_quality_rules)}
#: Least id reachable by links ``link(a, b)``, for the rows ``node(id)``.
_REACH = """
reach(id, other) as (select id, id from node
  union select r.id, l.b from reach r join both_ways l on l.a = r.other),
component as (select id, min(other) as component_id from reach group by id)"""

_WORDS = "[^\\x20\\x09-\\x0D]+"
_CLASS_COUNTS = ", ".join(f"length(regexp_replace(text, '[^{c}]', '', 'g'))" for c in ("a-z", "A-Z", "0-9", "\\x20\\x09-\\x0D", "#*$%&|<>"))
_JS = "sqrt(greatest(0, sum(case when p > 0 then p * log2(p / ((p + r) / 2)) else 0 end + case when r > 0 then r * log2(r / ((p + r) / 2)) else 0 end) / 2))"

_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op11_ranked_search": f"""
with d as (select row_number() over () as k, doc_id, text from documents),
f as (select k, term, count(*) as tf from (select k, unnest({_TERMS}) as term from d) group by all),
n as (select k, sum(tf)::bigint as n from f group by k),
s as (select count(*) as docs, sum(n)::bigint as len from n),
q as (select distinct item_id, term from (select item_id, unnest({_TERMS}) as term from benchmark where item_id is not null)),
w as (select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from f, s group by term),
m as (select k, n, 50 + (50 * n * docs) // len as m from n, s),
score as (select item_id, f.k, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from q join f on f.term = q.term join w on w.term = f.term join m on m.k = f.k group by item_id, f.k),
best as (select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last, d.k) as rank, doc_id, score
  from score join d on d.k = score.k where score > 0)
select item_id, rank::int as rank, doc_id, score from best where rank <= 50""",
    "op12_fill_in_middle": """
with d as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
r as (select doc_id, text, length(text) as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
    ('0x' || substr(h, 17, 8))::bigint % 100 as h3, ('0x' || substr(h, 25, 8))::bigint % 100 as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= 90 then 'plain'
      when h4 < 20 then 'spm' else 'psm' end as form from r),
p as (select *, substr(text, 1, a) as head, substr(text, a + 1, b - a) as mid, substr(text, b + 1) as tail from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || head || '<S>' || tail || '<M>' || mid
    else '<S>' || tail || '<P>' || head || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256
from p""",
    "op13_quality_rules": f"""
with d as (select row_number() over () as k, doc_id, lang, coalesce(text, '') as text from documents),
w as (select k, doc_id, lang, text, regexp_extract_all(text, '{_WORDS}') as w from d),
x as (select k, unnest(w) as word, generate_subscripts(w, 1) as i from w),
v as (select k, i, word || ' ' || lead(word) over t || ' ' || lead(word, 2) over t as g from x window t as (partition by k order by i)),
again as (select k, i from (select *, count(*) over (partition by k, g) as c from v where g is not null) where c > 1),
covered as (select k, count(distinct i + j) as c from again, (select unnest([0, 1, 2]) as j) group by k),
line as (select k, count(*) - count(distinct l) as c from (select k, unnest(string_split(text, chr(10))) as l from d) where regexp_matches(l, '{_WORDS}') group by k),
b as (select w.k, doc_id, lang, len(w) as n_words, list_sum(list_transform(w, lambda y: length(y))) as word_chars,
    [{_CLASS_COUNTS}] as c, length(text) as n_chars, length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g')) as far_chars,
    coalesce(line.c, 0) as n_dup_lines, coalesce(covered.c, 0) as n_repeat_words
  from w left join line on line.k = w.k left join covered on covered.k = w.k),
m as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    c || [n_chars - list_sum(c) - far_chars, far_chars] as classes from b),
f as (select lang, word, count(*) as n from (select distinct m.lang, x.k, word from x join m on m.k = x.k where n_words >= 50 and m.lang is not null) group by all),
enough as (select lang from m where n_words >= 50 and lang is not null group by lang having count(*) >= 10),
common as (select lang, word, j from (select lang, word, row_number() over (partition by lang order by n desc, word) as j from f semi join enough using (lang)) where j <= 20),
hits as (select x.k, common.lang, j, count(*) as n from x join common on x.word = common.word group by all),
slot as (select lang, j from common union all select lang, 21 from enough),
held as (select m.k, m.lang as own, s.lang, s.j, base_failed, n_words,
    case when s.j = 21 then n_words - sum(coalesce(h.n, 0)) over (partition by m.k, s.lang) else coalesce(h.n, 0) end as n
  from m cross join slot s left join hits h on h.k = m.k and h.lang = s.lang and h.j = s.j),
wmed as (select lang, j, quantile_disc(n * 10000 // n_words, 0.5) as r from held where own = lang and not base_failed group by lang, j having count(*) >= 10),
wref as (select lang, j, r / sum(r) over (partition by lang) as r from wmed),
cls as (select k, lang, base_failed, unnest(classes) as n, generate_subscripts(classes, 1) as j, list_sum(classes) as total from m),
cmed as (select lang, j, quantile_disc(n * 1000 // total, 0.5) as r from cls where not base_failed and lang in (select lang from enough) group by lang, j having count(*) >= 10),
cref as (select lang, j, r / sum(r) over (partition by lang) as r from cmed),
wd as (select k, min(y) as y from (select k, lang, case when any_value(n_words) = 0 then 1 else {_JS} end as y
  from (select k, held.lang, n_words, n / greatest(n_words, 1) as p, r from held join wref on wref.lang = held.lang and wref.j = held.j) group by k, lang) group by k),
cd as (select k, min(y) as y from (select k, lang, case when any_value(total) = 0 then 1 else {_JS} end as y
  from (select k, cref.lang, total, n / greatest(total, 1) as p, r from cls join cref on cref.j = cls.j) group by k, lang) group by k)
select doc_id, n_words, coalesce(word_chars, 0)::bigint as word_chars, c[5] as n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(cd.y <= 0.18 and (n_words < 150 or wd.y <= 0.3), true) as kept, round(cd.y, 6) as char_distance, round(wd.y, 6) as word_distance
from m left join wd on wd.k = m.k left join cd on cd.k = m.k""",
    "op7_minhash": f"""
with recursive d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '\\S+') as w
  from documents where doc_id is not null),
s as (select doc_id, unnest(list_distinct(case when len(w) >= 5
    then list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as g from d),
size as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
link as (select a, b from shared join size x on x.doc_id = a join size y on y.doc_id = b where k >= 0.8 * (x.n + y.n - k)
  union select a.doc_id, b.doc_id from d a join d b on a.text = b.text and a.doc_id < b.doc_id),
both_ways as (select a, b from link union all select b, a from link),
node as (select doc_id as id from d),{_REACH}
select d.doc_id, c.component_id as class_id, d.doc_id = c.component_id as kept from d join component c on c.id = d.doc_id""",
    "op9_warc": """
with r as (select page_id, row_number() over (order by page_id) - 1 as number, strlen(coalesce(html, '')) as body, coalesce(html, '') as html,
    strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
      || coalesce(cast(page_id as varchar), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || cast(strlen(coalesce(html, '')) as varchar)) + 4
      + strlen(coalesce(html, '')) + 4 as size
  from pages),
f as (select *, number // 1024 as file, coalesce(page_id, 0) % 101 as k from r),
o as (select *, coalesce(sum(size) over (partition by file order by number rows between unbounded preceding and 1 preceding), 0) as file_offset from f)
select page_id, cast(number as bigint) as number, cast(file as bigint) as file, cast(file_offset as bigint) as file_offset,
  cast(size as bigint) as size, cast(case k when 7 then size when 11 then size // 2 end as bigint) as replica_size,
  case k when 7 then 'altered' when 11 then 'resized' else 'missing' end as kind
from o where (k = 7 and not ends_with(html, '#')) or k in (11, 13)""",
    "op10_embeddings": f"""
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings where vec_id is not null),
u as (select vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as n from v
  where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0),
link as (select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where a.n > 0 and b.n > 0 and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
both_ways as (select a, b from link),
node as (select vec_id as id from v),{_REACH},
n as (select a, count(*) as n_links from link group by a)
select v.vec_id, coalesce(n.n_links, 0) as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join component c on c.id = v.vec_id left join n on n.a = v.vec_id""",
}
