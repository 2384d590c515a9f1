"""Queries of the thirteen operators over the driver's tables, with the SQL beside them where it can tell."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm import (
    bpe, decontaminate, language, lm, mixing, pii, quality, resampling, search, simhash, substrings,
    suffixes, toxicity,
)
from squall.llm.common import in_fold, prepared, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: query(prepared(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


@case("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior", "votes",
    )


WORDS_SQL = r"""list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

MIXING_SQL = f"""
with recursive sized as (
  select doc_id, source, len({WORDS_SQL})::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as key from documents),
ranked as (
  select source, sum(size)::bigint as source_size,
         case (row_number() over (order by source is null, source) - 1) % 3
           when 0 then 5 when 1 then 2 else 1 end as weight
  from sized group by source),
total as (select 1.5::double * sum(source_size) as words, sum(weight)::bigint as weights from ranked),
rounds(held, free) as (
  select 0::bigint, weights from total
  union
  select coalesce(sum(2 * source_size) filter (
           where free > 0 and weight * (words - held) / free > source_size * 2), 0)::bigint,
         coalesce(sum(weight) filter (
           where free > 0 and not (weight * (words - held) / free > source_size * 2)), 0)::bigint
  from rounds, total, ranked group by held, free),
level as (select held, free from rounds order by held desc, free limit 1),
targets as (
  select source, source_size, weight,
         case when free = 0 or weight * (words - held) / free > source_size * 2
              then (source_size * 2)::double
              else weight * (words - held) / free end as target
  from ranked, total, level),
placed as (
  select doc_id, size, source_size, weight::double as weight, target,
         round_even(target, 0)::bigint as demand,
         (sum(size) over (partition by s.source order by key, size desc, doc_id
                          rows unbounded preceding))::bigint - size as start
  from sized s join targets t on s.source is not distinct from t.source),
taken as (
  select *, greatest(0, least(size, demand - start)) as once,
         greatest(0, least(size, demand - start - source_size)) as twice,
         start::double / demand * (weight + 8.0::double / 3) / 2 as due,
         8.0::double / 3 - weight as slope
  from placed)
select doc_id, size, source_size, target, (once + twice)::bigint as taken,
       ((once > 0)::int + (twice > 0)::int)::int as times,
       case when once > 0 then
         round(2 * due / (weight + sqrt(greatest(weight * weight + 2 * slope * due, 0))), 6) end as position
from taken
"""


@case("op6_mix_sources", MIXING_SQL)
def op6_mix_sources(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = mixed.withColumn("times", F.size("positions")).withColumn(
        "position", F.round(F.get("positions", F.lit(0)), 6)
    )
    return first.drop("positions", "source").sort(F.asc_nulls_last("position"), "doc_id")


DECONTAMINATION_SQL = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
b as (
  select item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as n, w[i : i + least(len(w), 10) - 1] as gram
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from windows),
grams as (
  select doc_id, n, i, w[i : i + n - 1] as gram
  from (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hits as (select doc_id, i, g.n, item_id from grams g join windows v on g.n = v.n and g.gram = v.gram),
covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hits))
  group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join found using (doc_id)
"""


@case("op7_decontaminate", DECONTAMINATION_SQL)
def op7_decontaminate(spark, sf_dir):
    found = decontaminate.screen(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    n_hit = decontaminate.hit_words(F.col("found"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@case("op8_personal_data")
def op8_personal_data(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", base, "spans")


@case("op1_language_mixture")
def op1_language_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = language.train(docs.filter(~held_out))
    found = docs.select(
        "doc_id", held_out.alias("held_out"), language.predictor(model)("text").alias("p")
    )
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.languages")


@case("op3_simhash_duplicates")
def op3_simhash_duplicates(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


SUBSTRING_SQL = f"""
with d as (select doc_id, {WORDS_SQL} as w from documents),
windows as (
  select doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) as gram
  from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
repeated as (
  select doc_id, i from windows
  where gram in (select gram from windows group by gram having count(*) > 1)),
gone as (
  select doc_id, list(distinct p) as places
  from (select doc_id, unnest(range(i, i + 35)) as p from repeated) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
       sha256(array_to_string(case when places is null then w else
         list_select(w, list_filter(range(1, len(w) + 1), lambda p: not list_contains(places, p)))
       end, ' ')) as kept_sha256
from d left join gone using (doc_id)
"""


@case("op9_repeated_windows", SUBSTRING_SQL)
def op9_repeated_windows(spark, sf_dir):
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@case("op10_repeated_strings")
def op10_repeated_strings(spark, sf_dir):
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@case("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = toxicity.train_from(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), toxicity.scorer(model)("text").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@case("op2_attention_scores")
def op2_attention_scores(spark, sf_dir):
    return lm.score_texts(table(spark, sf_dir, "documents"))


@case("op11_byte_bpe")
def op11_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    encoded = docs.select("doc_id", bpe.encoder(spark)("text").alias("ids"))
    return encoded.select("doc_id", *bpe.digests(F.col("ids"), bpe.decoder(spark)))


@case("op12_resample_to_target")
def op12_resample_to_target(spark, sf_dir):
    ranked = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


SEARCH_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
b as (
  select row_number() over () as q, item_id, unnest(list_distinct(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> ''))) as term from benchmark),
total as (select count(*)::bigint as n_docs, sum(len(w))::bigint as n_terms from d where len(w) > 0),
held as (
  select r, term, count(*)::bigint as tf from (select r, unnest(w) as term from d)
  where term in (select term from b) group by r, term),
known as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as weight
  from held, total group by term, n_docs),
scored as (
  select q, item_id, r, sum(weight * ((1000000000 * tf) //
           (1000 * tf + 8 * (10 + (90 * len(w)::bigint * n_docs) // n_terms))))::bigint as score
  from b join known using (term) join held using (term) join d using (r), total group by q, item_id, r),
ranked as (
  select item_id, (row_number() over (partition by q order by score desc, doc_id))::int as rank, doc_id, score
  from scored join d using (r) where score > 0)
select * from ranked where rank <= 10
"""


@case("op13_ranked_search", SEARCH_SQL)
def op13_ranked_search(spark, sf_dir):
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
