"""Registered queries of the numbered operators: name -> (callable, SQL text or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import bestposition, decontaminate, divergence, htmltext, jaccard, langid, lm, mixing, secretscan, shards, substrings, topk, toxicity
from eventmart.llm.ship import ship
from eventmart.session import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
with sized as (
  select doc_id, source, md5('mix|' || coalesce(cast(doc_id as varchar), '')) as o,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
    [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight
  from sized group by source),
filled as (
  select *, source_size * 2 as cap,
    (1.5::double * sum(source_size) over ()
      - coalesce(sum(source_size * 2) over (order by source_size / weight, weight, source rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by source_size / weight, weight, source rows between current row and unbounded following) as level
  from sources),
goal as (
  select source, source_size, weight,
    least(cap::double, weight * (select min_by(level, source_size / weight) from filled where level * weight < cap)) as target
  from filled),
ranked as (
  select s.doc_id, s.size, g.source_size, g.target,
    case when g.source_size > 0 then floor(g.target / g.source_size) else 0 end as whole,
    sum(s.size) over (partition by s.source order by s.o, s.size rows unbounded preceding) as upto
  from sized s join goal g on s.source is not distinct from g.source)
select doc_id, size, source_size, target,
  cast(size * (whole + case when whole < 2 and 2 * upto - size <= 2 * (target - whole * source_size) then 1 else 0 end) as bigint) as taken
from ranked
"""


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), word_tokenizer(), end_id=49407)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(_table(spark, sf_dir, "documents")).drop("kept")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-shards")
    shards.write_shards(_table(spark, sf_dir, "documents"), path, word_tokenizer(), end_id=1)
    return shards.read_digests(spark, path)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP3_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from scored)
select * from ranked where rank <= 10
"""


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.counts(_table(spark, sf_dir, "documents"))


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN_SQL = "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r""")["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]"""
#: kind, expression, and expression a whole match must have to count
_SECRETS_SQL = [
    ("assign", _ASSIGN_SQL + "+", _ASSIGN_SQL + "{8,}"),
    ("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{12,}"),
    ("hex", "[0-9a-f]{32,}", ".*"),
    ("private_key", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----", ".*"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{16,}"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("login", "(https?|ftp|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%-]+@", ".*"),
]
OP11_SQL = (
    "with t as (select row_number() over () as rid, doc_id, coalesce(text, '') as x from documents), cut as ("
    + " union all ".join(
        f"select rid, {i} as k, '{kind}' as kind, '{only}' as fits, regexp_extract_all(x, '{pattern}') as m, string_split_regex(x, '{pattern}') as between from t"
        for i, (kind, pattern, only) in enumerate(_SECRETS_SQL)
    )
    + """), numbered as (
  select *, unnest(range(1, len(m) + 1)) as i from cut),
placed as (
  select rid, k, kind, fits, m[i] as hit,
    cast(list_sum(list_transform(between[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda p: length(p))), 0) as bigint) as start
  from numbered),
kept as (
  select rid, k, kind, start, kind || ':' || start || ':' || (start + length(hit)) as span from placed where regexp_full_match(hit, fits)),
joined as (
  select rid, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
    string_agg(span, ',' order by start, k) filter (k < 3) as base, string_agg(span, ',' order by start, k) as spans
  from kept group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join joined using (rid)
"""
)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = rf"""
with d as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all({_LOWER_SQL}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
occurrences as (select rid, lang, source, unnest(terms) as term from d),
kept as (select lang, term from occurrences group by lang, term having count(distinct rid) >= 30),
counted as (select lang, source, term, count(*) as n from occurrences join kept using (lang, term) group by all),
groups as (select lang, source from d group by all),
v as (select g.lang, count(k.term) as v from (select distinct lang from groups) g left join kept k on g.lang = k.lang group by all),
whole as (
  select lang, source, v, cast(coalesce(sum(n), 0) as bigint) + 5 * v as w
  from groups join v using (lang) left join counted using (lang, source) group by lang, source, v),
whole_lang as (select lang, cast(sum(n) as bigint) + 5 * v as w from counted join v using (lang) group by lang, v),
shares as (
  select lang, source, term, coalesce(n, 0) as n, 1 + cast((1000000000 * (coalesce(n, 0) + 5)::hugeint) // w as bigint) as p
  from whole join kept using (lang) left join counted using (lang, source, term)),
overall as (
  select lang, term, 1 + cast((1000000000 * (n + 5)::hugeint) // w as bigint) as q
  from (select lang, term, sum(n) as n from counted group by lang, term) join whole_lang using (lang)),
apart as (
  select a.lang, a.source, b.source as item, cast(sum(abs(a.p - b.p)) as bigint) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source),
terms as (
  select lang, source, 'term' as part, term as item, p - q as value from shares join overall using (lang, term) where n > 0 and p > q),
ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
  from (select * from pairs union all select * from terms))
select * from ranked where part = 'pair' or rank <= 50
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestposition.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_TERM_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP13_SQL = rf"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({_LOWER_SQL}, '{_TERM_SQL}') as terms from documents),
whole as (select count(*) filter (len(terms) > 0) as n_docs, cast(sum(len(terms)) as bigint) as n_terms from d),
tf as (select rid, doc_id, n, term, count(*) as tf from (select rid, doc_id, len(terms) as n, unnest(terms) as term from d) group by all),
asked as (select item_id, unnest(regexp_extract_all({_LOWER_SQL}, '{_TERM_SQL}')) as term from benchmark),
wanted as (select item_id, term, count(*) as repeats from asked group by all),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from tf cross join whole where term in (select term from asked) group by term, n_docs),
scored as (
  select item_id, doc_id, rid, cast(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) as bigint) as score
  from wanted join tf using (term) join weights using (term) cross join whole group by all),
ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank, doc_id, score from scored where score > 0)
select * from ranked where rank <= 20
"""


QUERIES = {
    "op1_decontamination": (op1_decontamination, None),
    "op2_mixing": (op2_mixing, OP2_SQL),
    "op3_top_k": (op3_top_k, OP3_SQL),
    "op4_language": (op4_language, None),
    "op5_html_text": (op5_html_text, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_lm_scores": (op7_lm_scores, None),
    "op8_jaccard_join": (op8_jaccard_join, None),
    "op9_substring_dedup": (op9_substring_dedup, None),
    "op10_token_shards": (op10_token_shards, None),
    "op11_secrets": (op11_secrets, OP11_SQL),
    "op12_source_divergence": (op12_source_divergence, OP12_SQL),
    "op13_ranked_search": (op13_ranked_search, OP13_SQL),
}
