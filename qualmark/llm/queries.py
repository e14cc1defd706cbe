"""Registered queries of the operators, and their DuckDB SQL.

Each query runs its operator with production parameters over whole tables.
``ORACLE`` states a result in SQL of its own where SQL can express it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bottom_k, collocations, fm_decon, host_reputation, langid, line_dedup, lm_score, mixing, ngram_join, source_audit, suffix_dedup, vafile, warc_zst

RULES = [
    host_reputation.Rule("org", "/", "allow"),
    host_reputation.Rule("example.org", "/es/", "block"),
    host_reputation.Rule("example.org", "/en/1", "block"),
    host_reputation.Rule("com", "/fr/", "allow"),
    host_reputation.Rule("com", "/de/", "block"),
]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = _t(spark, sf_dir, "embeddings")
    return vafile.top_k(emb, emb.where("vec_id % 100 = 0"), k=10)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_t(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "line_dedup.*",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is that of the document with its id."""
    labels = _t(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1)
        .when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 0).alias("bad"))
    return host_reputation.filter_urls(_t(spark, sf_dir, "pages"), labels, RULES)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    out = langid.predict(docs, model, ["doc_id"])
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "source", mixing.token_count(F.col("text")).alias("n_tokens"))
    out = mixing.mix(docs)
    return out.select("doc_id", "source", "n_tokens", F.col("mix.repeats").alias("repeats"),
                      F.col("mix.epochs").alias("epochs"), F.round("mix.weight", 9).alias("weight"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _t(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("uri"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    path = scratch_path(spark, "warc")
    warc_zst.write_archives(warc_zst.with_revisits(pages), path, warc_zst.train_dictionary(pages), warc_zst.records_per_file(pages))
    return warc_zst.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_decon.contamination_report(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"))


QUERIES = {
    "op3_vector_topk": op3_vector_topk,
    "op4_line_dedup": op4_line_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_language_id": op6_language_id,
    "op7_source_mixing": op7_source_mixing,
    "op9_warc": op9_warc,
    "op10_decontamination": op10_decontamination,
}

ORACLE: dict[str, str] = {}

ORACLE["op3_vector_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id as vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from (select * from v where vec_id % 100 = 0) a join v b
    on a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rk from s)
select query_id, rk::int as rank, vec_id, score from r where rk <= 10
"""

ORACLE["op4_line_dedup"] = """
with l as (
  select doc_id, text, string_split(text, chr(10)) as ls from documents),
x as (select doc_id, ls, unnest(range(0, greatest(len(ls) - 2, 0))) as pos from l where text is not null),
w as (select doc_id, pos, ls[pos + 1] || chr(10) || ls[pos + 2] || chr(10) || ls[pos + 3] as win from x),
later as (
  select doc_id, pos from (
    select doc_id, pos, row_number() over (partition by win order by doc_id, pos) as nth from w) where nth > 1),
gone as (select distinct doc_id, pos + j as line from later, (values (0), (1), (2)) as o(j)),
g as (
  select doc_id, count(*) as n_removed, count(*) filter (where prev is null or prev < line - 1) as n_spans,
         list(line) as removed
  from (select doc_id, line, lag(line) over (partition by doc_id order by line) as prev from gone) group by doc_id)
select l.doc_id, coalesce(len(ls), 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans,
       sha256(coalesce(array_to_string(case when removed is null then ls
         else list_filter(ls, lambda e, i: not list_contains(removed, i - 1)) end, chr(10)), '')) as kept_sha256
from l left join g on l.doc_id = g.doc_id
"""

ORACLE["op5_url_filter"] = """
with p as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path
  from pages),
o as (
  select p.host, case when quality = 0 or toxic = 1 then 1 else 0 end as bad
  from p join labels on labels.doc_id = p.page_id where (quality = 0 or toxic = 1) or (quality is not null and toxic is not null)),
h0 as (
  select h.host, count(o.bad) as n, coalesce(sum(o.bad), 0) as k from (select distinct host from p) h
  left join o on o.host = h.host group by h.host),
h as (
  select *, string_split(bare, '.') as parts, regexp_matches(bare, '^[0-9]+(\\.[0-9]+){3}$|^\\[') as address
  from (select *, regexp_replace(host, ':[0-9]*$', '') as bare from h0)),
hm as (
  select *, len(parts) > 1 and regexp_matches(parts[-1], '^[a-z]{2}$')
            and list_contains(['ac', 'co', 'com', 'edu', 'go', 'gov', 'ne', 'net', 'or', 'org'], parts[-2]) as multi from h),
hh as (
  select host, n, k,
    case when address then bare when multi then array_to_string(parts[greatest(len(parts) - 2, 1):], '.')
         else array_to_string(parts[greatest(len(parts) - 1, 1):], '.') end as domain,
    case when address then bare when multi then array_to_string(parts[-2:], '.') else parts[-1] end as suffix from hm),
base as (select (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) as m from hh),
s0 as (select suffix, sum(n) as n, sum(k) as k, any_value(m) as m from hh, base group by suffix),
sc as (
  select least(greatest(coalesce((sum(pow(k / n - m, 2) * n) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.5),
         0.001), 0.5) as rho from s0 where n > 0),
s as (select suffix, (k + m * (1 / rho - 1)) / (n + (1 / rho - 1)) as rate from s0, sc),
d0 as (
  select hh.suffix, domain, sum(n) as n, sum(k) as k, any_value(s.rate) as m from hh join s on s.suffix = hh.suffix
  group by hh.suffix, domain),
dc as (
  select least(greatest(coalesce((sum(pow(k / n - m, 2) * n) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.5),
         0.001), 0.5) as rho from d0 where n > 0),
d as (select domain, (k + m * (1 / rho - 1)) / (n + (1 / rho - 1)) as rate from d0, dc),
r0 as (select hh.host, n, k, d.rate as m from hh join d on d.domain = hh.domain),
rc as (
  select least(greatest(coalesce((sum(pow(k / n - m, 2) * n) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0), 0.5),
         0.001), 0.5) as rho from r0 where n > 0),
r1 as (
  select host, k + m * (1 / rho - 1) as a, n - k + (1 - m) * (1 / rho - 1) as b from r0, rc),
r as (
  select host, a / (a + b) as mean, a + b as size from r1),
rules as (
  select * from (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) as t(rh, rp, rv)),
fit as (
  select page_id, host, path, max_by(rh || rp, length(rh || rp)) as rule, max_by(rv, length(rh || rp)) as rv
  from p join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id, host, path)
select p.page_id, p.host, p.path, fit.rule,
       coalesce(fit.rv, case when r.mean - 1.645 * sqrt(r.mean * (1 - r.mean) / (r.size + 1)) > 0.25
                             then 'block' else 'allow' end) as verdict
from p left join fit on fit.page_id = p.page_id and fit.host = p.host and fit.path = p.path
join r on r.host = p.host
"""

ORACLE["op7_source_mixing"] = """
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f\\x0B]+'))::bigint as n_tokens,
         md5('mix:' || doc_id::varchar) as hash from documents),
t as (select source, sum(n_tokens)::bigint as tokens from d group by source having sum(n_tokens) > 0),
tot as (select sum(tokens)::double as total, count(*) as n from t),
grid as (
  select i, ln(sum(pow(p, a))) - any_value(a) * sum(pow(p, a) * ln(p)) / sum(pow(p, a)) as h,
         max(pow(p, a) / tokens) * any_value(total) / sum(pow(p, a)) as most, any_value(n) as n
  from (select i, i / 1000000.0::double as a from range(0, 1000001) as r(i)),
       (select tokens, tokens / total as p, total, n from t, tot)
  group by i),
expo as (
  select greatest(coalesce(max(i) filter (h >= 0.9 * ln(n) - 1e-9), 0),
                  coalesce(min(i) filter (most <= 4.0), 1000000)) / 1000000.0::double as a from grid),
z as (select sum(pow(tokens / total, a)) as z from t, tot, expo),
plan as (
  select source, tokens, pow(tokens / total, a) / z as weight,
         floor(pow(tokens / total, a) / z * total + 1e-6)::bigint as due from t, tot, expo, z),
plan2 as (select source, weight, due // tokens as epochs, due % tokens as rest from plan),
walk as (
  select d.doc_id, d.source, n_tokens, epochs, weight, rest,
         sum(n_tokens) over (partition by d.source order by
           md5(concat_ws('|', 'mix', d.source, epochs::varchar, substr(hash, 1, 2))), hash, doc_id
           rows between unbounded preceding and current row) as upto
  from d left join plan2 on plan2.source = d.source)
select doc_id, source, n_tokens, coalesce(epochs + case when upto <= rest then 1 else 0 end, 0)::bigint as repeats,
       coalesce(epochs, 0)::bigint as epochs, round(coalesce(weight, 0), 9) as weight
from walk
"""

# op9: DuckDB has no SHA-1 in base32; op6: no SQL. Both are tested against other versions.

ORACLE["op10_decontamination"] = """
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from benchmark),
win as (
  select distinct item_id, k, array_to_string(ws[s + 1:s + k], ' ') as gram
  from (select item_id, ws, least(10, len(ws)) as k, unnest(range(0, len(ws) - least(10, len(ws)) + 1)) as s
        from b where len(ws) > 0)),
occ as (
  select doc_id, p, win.k, item_id
  from (select doc_id, k, p, array_to_string(ws[p + 1:p + k], ' ') as gram
        from (select doc_id, ws, k, unnest(range(0, len(ws) - k + 1)) as p from w, (select distinct k from win) where len(ws) >= k)) g
  join win on win.k = g.k and win.gram = g.gram),
hit as (select doc_id, count(distinct p + j) as n_hit from (select doc_id, p, unnest(range(0, k)) as j from occ) group by doc_id),
it as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items
  from (select distinct doc_id, item_id from occ) group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hit on hit.doc_id = w.doc_id left join it on it.doc_id = w.doc_id
"""


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled good and not toxic; background: all documents."""
    good = _t(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    out = lm_score.cross_entropy_difference(_t(spark, sf_dir, "documents"), good)
    return out.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("loss_target", "loss_background", "score")])


QUERIES["op2_lm_score"] = op2_lm_score

ORACLE["op2_lm_score"] = """
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
tok as (
  select doc_id, coalesce(good, false) as good, ws[i] as w, case when i = 1 then '' else ws[i - 1] end as v
  from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w)
  left join (select distinct doc_id as g_id, true as good from labels where quality = 1 and toxic = 0) on g_id = doc_id),
big as (select v, w, count(*) as b, count(*) filter (good) as t from tok group by v, w),
ctx as (select v, sum(b) as b, sum(t) as t from big group by v),
tot as (select count(distinct w) as vocab, sum(b) as nb, sum(t) as nt from big),
loss as (
  select big.v, big.w, ln(ctx.t + 0.01 * nt / nb * vocab) - ln(big.t + 0.01 * nt / nb) as lt,
         ln(ctx.b + 0.01 * vocab) - ln(big.b + 0.01) as lb
  from big join ctx on ctx.v = big.v, tot),
s as (
  select doc_id, count(*) as n, avg(lt) as lt, avg(lb) as lb from tok join loss on loss.v = tok.v and loss.w = tok.w group by doc_id)
select w.doc_id, len(ws)::bigint as n_tokens, round(lt, 6) as loss_target, round(lb, 6) as loss_background,
       round(lt - lb, 6) as score
from w left join s on s.doc_id = w.doc_id
"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(_t(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES["op8_suffix_dedup"] = op8_suffix_dedup


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(_t(spark, sf_dir, "documents"))


QUERIES["op1_ngram_join"] = op1_ngram_join


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence_report(_t(spark, sf_dir, "documents"))


QUERIES["op11_source_audit"] = op11_source_audit

ORACLE["op11_source_audit"] = """
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
t as (
  select row_number() over () as id, lang, source, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as ts from d),
o as (select id, lang, source, unnest(ts) as term from t),
kept as (select lang, term, count(*) as total from o group by lang, term having count(distinct id) >= 10),
g as (select distinct lang, source from d),
c as (
  select g.lang, g.source, kept.term, count(o.id) as n, any_value(total) as total
  from g join kept on kept.lang = g.lang left join o on o.lang = g.lang and o.source = g.source and o.term = kept.term
  group by g.lang, g.source, kept.term),
v as (select lang, count(*) as v, sum(total) as n from kept group by lang),
s as (select lang, source, sum(n) as n from c group by lang, source),
p as (
  select c.lang, c.source, c.term, c.n, 1 + (1000000000::hugeint * (c.n + 2)) // (s.n + 2 * v.v) as p,
         1 + (1000000000::hugeint * (c.total + 2)) // (v.n + 2 * v.v) as q
  from c join s on s.lang = c.lang and s.source = c.source join v on v.lang = c.lang),
pair as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from p a join p b on b.lang = a.lang and b.term = a.term and b.source <> a.source group by 1, 2, 3),
r as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from g a join g b on b.lang = a.lang and b.source <> a.source
  left join pair on pair.lang = a.lang and pair.source = a.source and pair.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from p where n > 0 and p > q)
select * from (
  select lang, source, part, item, value,
         row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank from r)
where part = 'pair' or rank <= 10
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_t(spark, sf_dir, "documents"))


QUERIES["op13_collocations"] = op13_collocations

ORACLE["op13_collocations"] = """
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as ws from p),
tot as (select lang, sum(len(ws))::hugeint as n from w group by lang),
g as (
  select lang, m, ws[s + 1:s + m] as gram
  from (select lang, m, ws, unnest(range(0, len(ws) - m + 1)) as s from w, (select unnest(range(1, 6)) as m) where len(ws) >= m)),
f as (select lang, m, gram, count(*)::hugeint as a from g group by lang, m, gram having count(*) >= 100),
inner_part as (
  select lang, gram[s + 1:s + k] as gram, max(a) as longer
  from (select lang, m, a, gram, k, unnest(range(0, m - k + 1)) as s
        from (select lang, m, a, gram, unnest(range(2, m)) as k from f where m > 2)) group by 1, 2),
cut as (select lang, m, gram, a, unnest(range(1, m)) as k from f where m > 1),
scored as (
  select cut.lang, cut.gram, cut.a, x.a as l, y.a as r, n, k, (1000 * cut.a * n) // (x.a * y.a) as score
  from cut join f x on x.lang = cut.lang and x.gram = cut.gram[1:k] join f y on y.lang = cut.lang and y.gram = cut.gram[k + 1:]
  join tot on tot.lang = cut.lang),
best as (
  select * from (select *, row_number() over (partition by lang, gram order by score, k) as nth from scored) where nth = 1),
kept as (
  select best.* from best left join inner_part i on i.lang = best.lang and i.gram = best.gram
  where longer is null or 100 * longer < 100 * a)
select * from (
  select lang, row_number() over (partition by lang order by score desc, a desc, encode(array_to_string(gram, ' ')))::bigint as rank,
         array_to_string(gram, ' ') as phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
  from kept) where rank <= 2000
"""


def op12_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text, of its edited text, and their likeness to each other and to
    the next document's. No SQL: DuckDB has no xxHash64."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = bottom_k.with_next(docs, {"sketch": bottom_k.sketch(bottom_k.shingles(F.col("text")))})
    n, half = F.col("n_chars"), F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n.cast("int") - half), F.substring("next.text", F.lit(1), half))
    made = pairs.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited) \
        .withColumn("edited_sketch", bottom_k.sketch(bottom_k.shingles(F.col("edited"))))
    return made.select(F.col("row.doc_id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       bottom_k.to_text(F.col("sketch")).alias("fingerprint"), bottom_k.to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       bottom_k.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       bottom_k.resemblance(F.col("sketch"), F.col("next.sketch")).alias("near_next"))


QUERIES["op12_fingerprint"] = op12_fingerprint
