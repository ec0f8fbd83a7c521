"""The queries of this subpackage: each operator over its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanfield.llm import cuckoo, dialogue, forest, gam, language, main_text, merkle, mixing, ngram_model, packing, repeats, revisits, sql, vantage
from gleanfield.session import configure

QUERIES, ORACLES = {}, {}
# Place of the tokenizer files; `tokenizer_path` may be replaced by a job's own setting.
TOKENIZER_CONF = "spark.gleanfield.tokenizer"


def query(oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark), folder))

        QUERIES[fn.__name__] = run
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def tokenizer_path(spark: SparkSession) -> str:
    import public_tokenizers

    return spark.conf.get(TOKENIZER_CONF, public_tokenizers.path("word_bpe_49k.json"))


@query()
def op4_quality_gam(t):
    return gam.quality(t.documents, t.labels)


@query(
    """
    with d as (
      select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) text_sha256
      from documents)
    select doc_id, max(doc_id) over w keep_id, count(*) over w group_size, doc_id = max(doc_id) over w kept, text_sha256
    from d window w as (partition by text_sha256)
    """
)
def op6_cuckoo_dedup(t):
    return cuckoo.dedup_exact(t.documents)


@query()
def op9_entropy_mix(t):
    return mixing.mix(t.documents)


@query()
def op10_spfhp_packing(t):
    return packing.pack(t.documents, tokenizer_path(t.spark))


@query()
def op8_lsh_forest(t):
    return forest.near_copies(t.documents)


@query()
def op2_language_bitmask(t):
    return language.identify(t.documents)


@query()
def op3_log_frequency_lm(t):
    return ngram_model.score(t.documents)


@query()
def op1_vantage_point_trees(t):
    return vantage.nearest(t.embeddings, "vec_id % 20 = 0")


@query()
def op7_main_text_mss(t):
    return main_text.main_text(t.pages)


# Captures told from `pages`: each page was fetched in full, and asked for again some time later with
# what was known of it; every third answer names no entity tag.
CAPTURES = """
with pages_ as (
  select page_id, url, md5({html}) tag, page_id % 3 kind,
    'last-modified: day ' || cast(cast(floor(page_id / 1000) as bigint) as varchar(20)) modified from pages)
select 'f' || cast(page_id as varchar(20)) record_id, url, page_id * 10 captured, 'response' kind, 200 status,
  'Content-Type: text/html' || {line} || 'ETag: "' || tag || '"' || {line} || modified || {line} || 'Age: 0' headers
from pages_
union all
select 'r' || cast(page_id as varchar(20)), url, page_id * 10 + 5 + 40000 * kind, 'revisit', 304,
  case when kind = 0 then '' else 'etag: W/"' || tag || '"' || {line} end || modified || {line}
    || 'Content-Type: text/plain' || {line} || 'Cache-Control: max-age=' || cast(page_id % 7 as varchar(20))
from pages_
"""


def captures(t) -> DataFrame:
    t.pages.createOrReplaceTempView("pages")
    return t.spark.sql(CAPTURES.format(html="cast(html as binary)", line="chr(10)"))


REVISITS = r"""
with captures as (
""" + CAPTURES.format(html="html", line="chr(10)") + r"""),
stripped as (
  select *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    url, '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.\-]*://', ''), '^([^/?]*):(80|443)($|[/?])', '\1\3'),
    '^([^/?]+)($|\?)', '\1/\2'), '([?&])utm_[^&]*(&|$)', '\1', 'g'), '[?&]+$', '') u
  from captures),
named as (
  select *, lower(regexp_extract(u, '^[^/]*')) || substr(u, length(regexp_extract(u, '^[^/]*')) + 1) canonical_url,
    map_from_entries(list_transform(string_split(headers, chr(10)),
      lambda x: {'k': lower(split_part(x, ': ', 1)), 'v': substr(x, length(split_part(x, ': ', 1)) + 3)})) h
  from stripped),
joined as (
  select r.record_id, r.canonical_url, r.captured, f.record_id refers_to, r.h rh, f.h fh,
    replace(r.h['etag'], 'W/', '') = f.h['etag'] tags, r.h['last-modified'] = f.h['last-modified'] dates
  from (select * from named where kind = 'revisit') r
  asof left join (select * from named where kind = 'response') f
    on r.canonical_url = f.canonical_url and r.captured > f.captured),
judged as (
  select *, case when refers_to is null then 'missing' when coalesce(tags, dates) then 'resolved'
    when coalesce(tags, dates) is null then 'unproven' else 'changed' end outcome from joined)
select record_id, canonical_url, captured, refers_to, outcome,
  array_to_string(list_transform(list_sort(case when outcome = 'resolved' then
      list_concat(
        list_filter(map_entries(fh), lambda e: e.key = 'content-type' or not list_contains(map_keys(rh), e.key)),
        list_filter(map_entries(rh), lambda e: e.key <> 'content-type'))
    else map_entries(rh) end), lambda e: e.key || ': ' || e.value), chr(10)) headers
from judged
"""


@query(REVISITS)
def op5_warc_revisits(t):
    found = revisits.resolve(captures(t))
    return found.withColumn("headers", revisits.header_text(F.col("headers")))


@query(sql.MERKLE)
def op11_merkle_manifest(t):
    return merkle.audit(t.documents)


@query(sql.REPEATS)
def op13_repeated_windows(t):
    found = repeats.drop_repeats(t.documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query(sql.REPAIR)
def op12_conversation_repair(t):
    return dialogue.report(t.conversations)
