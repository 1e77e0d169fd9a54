"""Queries ``opN_<name>`` over the driver tables, with their SQL where SQL can say it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bytebpe, chatformat, decontaminate, divergence, htmltext, linededup, neardup, packing, quality, tokencounts, turnrepair, urlfilter, warc,
)
from millrace.llm.common import table

def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of benchmark passages in all documents; documents without any have no row."""
    return decontaminate.contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Host and path rules of the query. Fixed values.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query("op2_url_filter")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return urlfilter.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the line-first rules for all documents."""
    return quality.judged(table(spark, sf_dir, "documents"), with_text=False)


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens, as pieces with their places."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op5_line_dedup", """
with lines as (
  select doc_id, i, line, trim(line) <> '' as filled
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i from documents)
), filled as (
  select doc_id, i, trim(line) as t, row_number() over (partition by doc_id order by i) as p from lines where filled
), threes as (
  select doc_id, p, t as t1, lead(t) over w as t2, lead(t, 2) over w as t3 from filled window w as (partition by doc_id order by p)
), ranked as (
  select doc_id, p, row_number() over (partition by t1, t2, t3 order by doc_id, p) as r from threes where t3 is not null
), covered as (
  select distinct doc_id, p + unnest([0, 1, 2]) as p from ranked where r > 1
), judged as (
  select l.doc_id, l.i, l.line, l.filled, case when l.filled then c.p is null end as stays
  from lines l left join filled f on l.doc_id = f.doc_id and l.i = f.i left join covered c on f.doc_id = c.doc_id and f.p = c.p
), settled as (
  select *, coalesce(stays,
      coalesce(last_value(stays ignore nulls) over (partition by doc_id order by i rows between unbounded preceding and current row), false)
      or coalesce(first_value(stays ignore nulls) over (partition by doc_id order by i rows between current row and unbounded following), false)
      or not bool_or(filled) over (partition by doc_id)) as final
  from judged
)
select d.doc_id,
  case when d.text is not null then coalesce(string_agg(s.line, chr(10) order by s.i) filter (s.final), '') end as text,
  count(*) filter (s.filled) as n_lines, count(*) filter (s.filled and not s.final) as n_lines_removed
from documents d join settled s using (doc_id) group by d.doc_id, d.text
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the later places of repeated three-line windows."""
    return linededup.deduplicated(table(spark, sf_dir, "documents", "doc_id", "text"), words=None)


CONTROL = "\\### Assistant: </turn> ok"  # looks like marks of chat templates


@query("op6_chat_format", """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(19 + length(replace(replace(role || text, '&', '&amp;'), '<', '&lt;')))::bigint as formatted_chars
from turns group by conv_id
""")
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, as rows by turn, and conversation -7, as a list of messages, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_variant_object(F.struct("role", "text")).alias("record"))
    messages = json.dumps({"messages": [{"role": "user", "content": CONTROL}, {"role": "assistant", "content": CONTROL}]})
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.parse_json(F.lit(messages)).alias("record"))
    turns = chatformat.turn_rows(chatformat.canonical(rows.unionByName(extra)))
    back = chatformat.read_back(chatformat.formatted(turns))
    return back.select(
        "conv_id", "n_turns", F.sha2(F.encode("turns_text", "UTF-8"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


@query("op7_minhash", r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, case when len(w) = 1 then w[1] else w[k] || ' ' || w[k + 1] end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as k from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), ways as (
  select a, b from links union all select b, a from links
), reached as (
  select doc_id, doc_id as root from sizes
  union select b, root from reached join ways on a = doc_id
), components as (
  select doc_id, min(root) as component_id from reached group by doc_id
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(c.component_id, d.doc_id) as component_id, coalesce(c.component_id, d.doc_id) = d.doc_id as kept
from documents d left join sizes s using (doc_id) left join components c using (doc_id)
""")
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: two-word windows, similarity 0.8."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query("op8_warc", """
with p as (
  select page_id, coalesce(html, '') as html from pages
), q as (
  select page_id, strlen(html) as payload_bytes, sha1(html) as payload_digest,
    case when strlen(html) >= 1000 then max(page_id) over (partition by html) end as latest from p
)
select page_id, payload_bytes, payload_digest,
  case when latest <> page_id then 'revisit' else 'response' end as record_type,
  case when latest <> page_id then latest end as refers_to
from q
""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record in ZIP archives, read back by range."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_html_extraction")
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by the template of its host."""
    return htmltext.extracted(table(spark, sf_dir, "pages"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents before and after private data is taken out, encoding only what changed."""
    import public_tokenizers

    files = tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    edits = tokencounts.redactions(table(spark, sf_dir, "documents", "doc_id", "text"))
    after = tokencounts.recounted(edits.withColumn("n_edits", F.size("edits").cast("long")), *files)
    return after.select("doc_id", "n_tokens_before", "n_edits", "n_tokens", "n_encoded", F.size("tree.tokens").cast("long").alias("n_leaves"))


@query("op11_divergence", r"""
with docs as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), words as (
  select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
  select lang, term from words group by lang, term having count(distinct id) >= 30
), sizes as (
  select lang, count(*) as v from kept group by lang
), used as (
  select lang, source, term, count(*) as n from words join kept using (lang, term) group by all
), groups as (
  select d.lang, d.source, coalesce(v, 0) as v from (select distinct lang, source from docs) d left join sizes using (lang)
), filled as (
  select g.lang, g.source, g.v, k.term, coalesce(u.n, 0) as n from groups g join kept k on k.lang = g.lang
  left join used u on u.lang = g.lang and u.source = g.source and u.term = k.term
), shares as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang, source) + 5 * v) as p from filled
), whole as (
  select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang) + 5 * v) as q
  from (select lang, term, any_value(v) as v, sum(n) as n from filled group by lang, term)
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(d.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from shares x
             join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) d
    on d.lang = a.lang and d.source = a.source and d.item = b.source
), terms as (
  select lang, source, term as item, (p - q)::bigint as value from shares join whole using (lang, term) where n > 0 and p > q
), ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all
  select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) from terms
)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 50
""")
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the word use of each source of a language is from the others, and its most characteristic terms."""
    return divergence.audited(table(spark, sf_dir, "documents"))


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and the texts that they decode to."""
    import public_tokenizers

    files = tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bytebpe.encoded(table(spark, sf_dir, "documents"), *files)
    digest = F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256)
    read = bytebpe.decoded(coded, files[0], keep={"n_tokens": F.size("ids").cast("long"), "ids_sha256": digest})
    return read.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


@query("op13_turn_repair")
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of all conversations, after they were damaged."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    findings, left = turnrepair.repaired(turnrepair.damaged(turns))
    known = turnrepair.met(turnrepair.met(turns.select("conv_id").distinct(), findings, ["conv_id"], "left"), turnrepair.joined_hash(left), ["conv_id"], "left")
    return known.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
