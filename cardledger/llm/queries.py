"""The numbered operators over their whole tables, with production parameters; SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardledger.llm import (
    decontamination,
    hard_negatives,
    html_extraction,
    license_scans,
    line_dedup,
    ngram_jaccard_join,
    packing,
    periodic_runs,
    quality_rules,
    sharding,
    substring_dedup,
    suffix_array_dedup,
    url_filters,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> packing.Vocabulary:
    import public_tokenizers

    return packing.Vocabulary(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op1_ngram_jaccard_join(spark, d):
    return ngram_jaccard_join.join(table(spark, d, "documents"))


# The rules that the query judges by, as given.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op2_url_filters(spark, d):
    pages = table(spark, d, "pages")
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_filters.judge(pages, rules, url_filters.mirrored(pages, content=url_filters.article(F.col("html"))))


def op3_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), vocabulary())


def op4_license_scans(spark, d):
    return license_scans.scan(table(spark, d, "documents"))


def op5_decontamination(spark, d):
    scanned = decontamination.scan(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return decontamination.digest(scanned)


def op6_html_extraction(spark, d):
    pages = table(spark, d, "pages")
    weights = html_extraction.train(html_extraction.labelled_pages(pages))
    return html_extraction.main_text(pages, weights)


def op7_sharding(spark, d):
    return sharding.shard_documents(table(spark, d, "documents"))


def op8_line_dedup(spark, d):
    """Per document: its lines, the lines removed, and the digest of the text that is left."""
    return line_dedup.dedup_lines(table(spark, d, "documents"), growing=True).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op9_quality_rules(spark, d):
    docs = table(spark, d, "documents")
    return quality_rules.score(docs, quality_rules.learn(docs, table(spark, d, "labels")))


def op10_suffix_array_dedup(spark, d):
    return suffix_array_dedup.without_repeats(table(spark, d, "documents"), digest=True)


def op11_periodic_runs(spark, d):
    """Per document: its periodic runs, and the digest of its text with each run collapsed."""
    return periodic_runs.digest(periodic_runs.find(periodic_runs.with_planted(table(spark, d, "documents"))))


def op12_hard_negatives(spark, d):
    """For each anchor and positive, the best rows of another label in the window below the positive."""
    vectors = hard_negatives.labelled_vectors(table(spark, d, "embeddings"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


def op13_substring_dedup(spark, d):
    """Per document: its words, those removed, and the digest of the words that are left."""
    return substring_dedup.digest(substring_dedup.without_repeats(table(spark, d, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_url_filters,
        op3_packing,
        op4_license_scans,
        op5_decontamination,
        op6_html_extraction,
        op7_sharding,
        op8_line_dedup,
        op9_quality_rules,
        op10_suffix_array_dedup,
        op11_periodic_runs,
        op12_hard_negatives,
        op13_substring_dedup,
    )
}

_RULE_ROWS = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)

OP2_SQL = f"""
with parsed as (
  select page_id, url, html,
    case when url is null or instr(url, '://') = 0 then '' else substr(url, instr(url, '://') + 3) end rest
  from pages),
hosts as (select *, regexp_extract(rest, '^[^/?#]*') raw from parsed),
split as (
  select page_id, html,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') path
  from hosts),
rules as (
  select rule, verdict, regexp_extract(rule, '^[^/]*') rule_host,
    substr(rule, length(regexp_extract(rule, '^[^/]*')) + 1) rule_path
  from (values {_RULE_ROWS}) r(rule, verdict)),
fitting as (
  select s.page_id, s.host, s.path, r.rule, r.verdict,
    row_number() over (partition by s.page_id, s.host, s.path
      order by length(r.rule) desc, length(r.rule_host) desc) place
  from (select distinct page_id, host, path from split) s
  join rules r on (s.host = r.rule_host or ends_with(s.host, '.' || r.rule_host)) and starts_with(s.path, r.rule_path)),
served as (
  select distinct host || path address,
    nullif(regexp_extract(html, '(?si)<article[> \\t\\r\\n].*</article>'), '') article
  from split where host || path <> ''),
mirrors as (
  select distinct s.address from served s
  join (select article, min(address) first_one from served group by article) f
    on s.article = f.article and s.address > f.first_one)
select s.page_id, s.host, s.path, f.rule,
  coalesce(f.verdict, case when m.address is not null then 'block' else 'allow' end) verdict
from split s
left join fitting f on f.page_id = s.page_id and f.host = s.host and f.path = s.path and f.place = 1
left join mirrors m on m.address = s.host || s.path
"""

OP11_SQL = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
    xor(4294967295, list_reduce(
      list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
      lambda crc, byte: list_reduce(range(8),
        lambda c, k: xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end), xor(crc, byte)),
      cast(4294967295 as bigint))) h
  from documents),
sized as (select *, cast(len(w) as bigint) n, h // 10 g from texts),
planted as (select *, g % greatest(n, 1) a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) p from sized),
words as (
  select doc_id, n, i, w[1 + case when h % 10 = 0 and i >= a then a + (i - a) % p else i end] word
  from (select *, unnest(range(n)) i from planted)),
equal_words as (
  select x.doc_id, y.i - x.i q, x.i from words x join words y
    on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
islands as (select *, i - row_number() over (partition by doc_id, q order by i) island from equal_words),
stretches as (
  select doc_id, min(i) "start", count(*) + q length, q period from islands group by doc_id, q, island
  having count(*) + q >= greatest(6, 4 * q)),
runs as (
  select * from stretches
  qualify row_number() over (partition by doc_id, "start", length order by period) = 1),
best as (
  select * from runs
  qualify row_number() over (partition by doc_id
    order by cast(length as decimal(18, 0)) / period desc, "start", period) = 1),
listed as (
  select doc_id, count(*) n_runs, string_agg("start" || ',' || length || ',' || period || chr(10), '' order by "start", period) t
  from runs group by doc_id),
dropped as (select distinct doc_id, unnest(range("start" + period, "start" + length)) i from runs),
kept as (
  select w.doc_id, string_agg(w.word, ' ' order by w.i) t from words w
  left join dropped d on d.doc_id = w.doc_id and d.i = w.i where d.i is null group by w.doc_id)
select d.doc_id, coalesce(l.n_runs, 0) n_runs, b."start", b.length, b.period,
  1000 * b.length // b.period exponent_milli, sha256(coalesce(l.t, '')) runs_sha256, sha256(coalesce(k.t, '')) collapsed_sha256
from texts d left join listed l on l.doc_id = d.doc_id left join best b on b.doc_id = d.doc_id left join kept k on k.doc_id = d.doc_id
"""

OP12_SQL = """
with usable as (
  select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) label,
    list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id anchor_id, b.vec_id, a.label = b.label same, cast(list_inner_product(a.v, b.v) as bigint) score
  from usable a, usable b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, vec_id positive_id, score positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
  cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) as integer) "rank",
  n.vec_id negative_id, p.positive_score, n.score negative_score
from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
  and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) <= 3
"""

OP13_SQL = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
words as (select doc_id, unnest(w) word, unnest(range(len(w))) i from texts),
of_2 as (select *, word || ' ' || lead(word) over doc w2 from words window doc as (partition by doc_id order by i)),
of_4 as (select *, w2 || ' ' || lead(w2, 2) over doc w4 from of_2 window doc as (partition by doc_id order by i)),
of_8 as (select *, w4 || ' ' || lead(w4, 4) over doc w8 from of_4 window doc as (partition by doc_id order by i)),
of_20 as (
  select doc_id, i, word, w8 || ' ' || lead(w8, 8) over doc || ' ' || lead(w4, 16) over doc w20
  from of_8 window doc as (partition by doc_id order by i)),
windows as (
  select doc_id, i, word, w20 is not null and row_number() over (partition by w20 order by doc_id, i) > 1 again from of_20),
marked as (
  select doc_id, word, i,
    bool_or(again) over (partition by doc_id order by i rows between 19 preceding and current row) gone
  from windows),
kept as (
  select doc_id, count(*) filter (gone) n_removed, string_agg(word, ' ' order by i) filter (not gone) t
  from marked group by doc_id)
select t.doc_id, cast(len(t.w) as bigint) n_words, coalesce(k.n_removed, 0) n_removed, sha256(coalesce(k.t, '')) kept_sha256
from texts t left join kept k on k.doc_id = t.doc_id
"""

ORACLE: dict[str, str] = {
    "op2_url_filters": OP2_SQL,
    "op11_periodic_runs": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_substring_dedup": OP13_SQL,
}
