"""The registered queries of the corpus operators, each over its whole table, with SQL twins where SQL can state them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination, exact_dedup, exact_top_k, hard_negative_mining, language_id, lexical_search, license_scan, pii,
    sentencepiece_fst, sharding, simhash, substring_dedup, token_counts,
)
from .common import documents

WORD_SPACE = r"[\x20\x09-\x0D]"
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_sentencepiece_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.encode_and_decode(documents(spark, sf_dir))


#: Small enough that the query splits to uneven depths on tables of every size.
OP2_SHARD_BYTES = 32 << 10


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", sharding.text_bytes().alias("n_bytes"))
    return sharding.assign(docs, shard_bytes=OP2_SHARD_BYTES)


OP2_SQL = f"""
with rows as (
    select row_number() over () as row, doc_id, coalesce(strlen(text), 0) as n_bytes,
           lpad(bin(('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint), 60, '0') as bits
    from documents
), nodes as (
    select row, doc_id, n_bytes, substr(bits, 1, depth) as shard, depth, (sum(n_bytes) over w)::bigint as shard_bytes, count(*) over w as shard_rows
    from rows, unnest(range(0, 61)) as depths(depth) window w as (partition by depth, substr(bits, 1, depth))
)
select doc_id, n_bytes, shard, depth, shard_bytes, shard_rows
from nodes where shard_bytes <= {OP2_SHARD_BYTES} or shard_rows = 1
qualify row_number() over (partition by row order by depth) = 1
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = language_id.fit(docs.where(fold != 2))
    told = language_id.identify(docs.select("doc_id", "text"), model)
    return told.select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"), F.col("lang_bits").alias("bits_per_byte"),
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_groups(documents(spark, sf_dir))
    return grouped.select("doc_id", simhash.hex_print().alias("fingerprint"), F.col("component").alias("component_id"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.matches_of_rows(documents(spark, sf_dir), benchmark, "doc_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(documents(spark, sf_dir).select("doc_id", "text"))
    edited = token_counts.update_counts(counted.withColumn("edits", token_counts.drawn_edits()))
    return edited.select(
        "doc_id", "n_tokens", F.col("new_tokens").alias("n_tokens_after"), F.size("leaf_chars").alias("n_leaves"),
        "n_applied", "n_rejected", "n_reencoded", F.sha2("new_text", 256).alias("new_text_sha256"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


OP8_SQL = f"""
with worded as (
    select row_number() over () as row, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '{WORD_SPACE}+'), lambda w: w <> '') as words
    from documents
), windows as (
    select row, doc_id, p, array_to_string(list_slice(words, p, p + {substring_dedup.WINDOW - 1}), ' ') as w
    from (select *, unnest(range(1, len(words) - {substring_dedup.WINDOW - 2})) as p from worded)
), firsts as (select md5(w) as w, min(doc_id) as least from windows group by 1
), gone as (
    select row, list_distinct(flatten(list(range(p, p + {substring_dedup.WINDOW})))) as spots
    from windows join firsts on md5(windows.w) = firsts.w where doc_id > least group by 1
), cut as (
    select doc_id, words, coalesce(spots, []) as spots from worded left join gone using (row)
), kept as (
    select doc_id, words, array_to_string(list_transform(list_filter(
        list_zip(words, range(1, len(words) + 1)), lambda z: not list_contains(spots, z[2])), lambda z: z[1]), ' ') as stay, spots
    from cut
)
select doc_id, len(words) as n_words, len(spots) as n_removed, sha256(stay) as kept_sha256 from kept
"""


def _listed(spans: str) -> Column:
    told = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["stop"].cast("string")))
    return F.array_join(told, ",")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.fit(docs))
    return found.select(
        "doc_id",
        *[_count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


OP5_SQL = f"""
with folded as (select doc_id, {FOLDED} as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from folded
"""

_UNITS = ", ".join(f"'{u}'" for u in decontamination.UNITS)


def _template_windows(table: str, key: str) -> str:
    d = decontamination
    return f"""
{table}_raw as (
    select {key}, row_number() over () as {table}_row, list_filter(string_split_regex(
        regexp_replace(regexp_replace(coalesce(text, ''), '{d.NAME_RULE}', '\\1' || chr(1) || '\\2', 'g'),
                       '{d.NUMBER_RULE}', '\\1' || chr(2) || '\\2', 'g'),
        '{d.BETWEEN_WORDS}'), lambda w: w <> '') as raw
    from {table}
), {table}_words as (
    select *, list_transform(raw, lambda w: case when w >= '0' and w < ':' then '{d.NUM}' when w < chr(2) then '{d.NAME}'
        when lower(w) in ({_UNITS}) then '{d.UNIT}' else lower(w) end) as words
    from {table}_raw where len(raw) > 0
), {table}_starts as (
    select *, unnest(range(1, greatest(len(words) - {d.WINDOW - 1}, 1) + 1)) as start from {table}_words
), {table}_windows as (
    select {key}, {table}_row, start, list_slice(words, start, start + {d.WINDOW - 1}) as words,
           list_slice(raw, start, start + {d.WINDOW - 1}) as raw
    from {table}_starts
)"""


# every document row is matched for itself; a doc_id that several rows share is summed up at the end
OP6_SQL = f"""
with {_template_windows("documents", "doc_id")}, {_template_windows("benchmark", "item_id")},
usable as (
    select * from benchmark_windows
    where len(list_filter(words, lambda w: w not in ('{decontamination.NUM}', '{decontamination.NAME}', '{decontamination.UNIT}')))
          >= least({decontamination.MIN_LITERALS}, len(words))
), sizes as (select benchmark_row, count(*) as n_windows from usable group by 1),
met as (
    select d.doc_id, u.benchmark_row, u.item_id, d.start - u.start as shift, u.start, u.words, u.raw, d.raw as doc_raw
    from documents_windows d join usable u on d.words = u.words
), slots as (
    select doc_id, benchmark_row, shift, unnest(words) as kind, unnest(raw) as value, unnest(doc_raw) as doc_value from met
), told as (
    select doc_id, benchmark_row, shift, count(distinct (kind, value, doc_value)) as pairs,
           count(distinct (kind, value)) as ours, count(distinct (kind, doc_value)) as theirs, bool_and(value = doc_value) as exact
    from slots where kind in ('{decontamination.NUM}', '{decontamination.NAME}', '{decontamination.UNIT}') group by 1, 2, 3
), aligned as (
    select doc_id, benchmark_row, item_id, shift, count(*) as matched from met group by 1, 2, 3, 4
), consistent as (
    select a.*, coalesce(t.exact, true) as exact
    from aligned a left join told t
      on a.doc_id is not distinct from t.doc_id and a.benchmark_row = t.benchmark_row and a.shift = t.shift
    where t.pairs is null or (t.pairs = t.ours and t.pairs = t.theirs)
), best as (
    select doc_id, benchmark_row, item_id, max(matched) as matched, arg_max(exact, matched * 2 + exact::int) as exact
    from consistent group by 1, 2, 3
)
select doc_id, item_id, n_windows, matched, exact
from best join sizes using (benchmark_row) where matched >= least(n_windows, {decontamination.MIN_WINDOWS})
"""

_GRAMS = ", ".join(f"({n}, '{name}', {size}, '{gram}')" for n, name, size, gram in license_scan.template_bigrams(license_scan.TEMPLATES))

OP10_SQL = f"""
with known(template, licence, template_size, gram) as (values {_GRAMS}),
units as (
    select row, doc_id, unnest(list_distinct(list_concat(
        string_split(text, chr(10)), string_split_regex(text, '{license_scan.BLANK_LINE}'), [text]))) as unit
    from (select row_number() over () as row, doc_id, text from documents)
), worded as (
    select row_number() over () as unit, doc_id,
           list_filter(string_split_regex(lower(unit), '{license_scan.BETWEEN_WORDS}'), lambda w: w <> '') as words
    from units
), sets as (
    select unit, doc_id,
           list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) as grams
    from worded
), met as (
    select unit, doc_id, template, licence, 2.0::double * count(*) / (any_value(size) + any_value(template_size)) as dice
    from (select unit, doc_id, len(grams) as size, unnest(grams) as gram from sets) join known using (gram)
    group by 1, 2, 3, 4
), best as (
    select unit, doc_id, licence, dice from met where dice >= {license_scan.THRESHOLD}
    qualify row_number() over (partition by unit order by dice desc, licence desc) = 1
)
select doc_id, licence, max(dice) as dice, count(*) as n_units from best group by 1, 2
"""


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("vec_id")
    label = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negative_mining.mine(_embeddings(spark, sf_dir), number % 100 == 0, label)


def op12_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k.search(_embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0)


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.search(documents(spark, sf_dir), benchmark)


_VECTORS = """
usable as (
    select row_number() over () as row, vec_id, label, list_transform(embedding, lambda v: floor(256 * v::double)) as x
    from embeddings
    where embedding is not null and not list_contains(list_transform(embedding, lambda v: coalesce(isfinite(v), false)), false)
)"""

OP11_SQL = f"""
with {_VECTORS}, labelled as (
    select row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, x from usable where label is not null
), scored as materialized (
    select a.row as anchor, a.vec_id as anchor_id, c.row, c.vec_id, a.label = c.label as same, list_dot_product(a.x, c.x)::bigint as score
    from labelled a join labelled c on a.vec_id % 100 = 0 and a.row <> c.row
), positives as (
    select anchor, anchor_id, row as positive, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor order by score desc, vec_id nulls last, row) <= {hard_negative_mining.POSITIVES}
)
select p.anchor_id, positive_id, (row_number() over (partition by p.anchor, positive order by score desc, vec_id nulls last))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives p join scored s on p.anchor = s.anchor
where not same and {hard_negative_mining.LEAST_PERCENT} * positive_score <= 100 * score
  and 100 * score <= {hard_negative_mining.MOST_PERCENT} * positive_score
qualify rank <= {hard_negative_mining.NEGATIVES}
"""

OP12_SQL = f"""
with {_VECTORS}
select q.vec_id as query_id, (row_number() over (partition by q.row order by list_dot_product(q.x, c.x) desc, c.vec_id nulls last))::int as rank,
       c.vec_id, list_dot_product(q.x, c.x)::bigint as score
from usable q join usable c on q.vec_id % 50 = 0 and q.row <> c.row
qualify rank <= {exact_top_k.TOP}
"""

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP13_SQL = f"""
with docs as (
    select row, doc_id, terms, len(terms) as n from (select row_number() over () as row, doc_id, {_TERMS} as terms from documents)
    where len(terms) > 0
), stats as (select count(*)::bigint as total, sum(n)::bigint as words from docs),
asked as (select item, item_id, unnest(list_distinct(terms)) as term from (select row_number() over () as item, item_id, {_TERMS} as terms from benchmark)),
postings as (
    select row, doc_id, n, term, count(*) as tf from (select row, doc_id, n, unnest(terms) as term from docs)
    where term in (select term from asked) group by all
), weights as (
    select term, floor(1000 * ln((2 * total + 2)::double / (2 * count(*) + 1)))::bigint as w from postings, stats group by term, total
), scored as (
    select item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // words))))::bigint as score
    from asked join postings using (term) join weights using (term), stats group by all
)
select item_id, (row_number() over (partition by item order by score desc, doc_id nulls last))::int as rank, doc_id, score
from scored where score > 0 qualify rank <= {lexical_search.TOP}
"""

QUERIES = {
    "op1_sentencepiece_encode_decode": op1_sentencepiece_encode_decode,
    "op2_sharding": op2_sharding,
    "op3_language_id": op3_language_id,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pii": op9_pii,
    "op10_license_scan": op10_license_scan,
    "op11_hard_negative_mining": op11_hard_negative_mining,
    "op12_exact_top_k_search": op12_exact_top_k_search,
    "op13_ranked_lexical_search": op13_ranked_lexical_search,
}
ORACLES = {
    "op2_sharding": OP2_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op10_license_scan": OP10_SQL,
    "op11_hard_negative_mining": OP11_SQL,
    "op12_exact_top_k_search": OP12_SQL,
    "op13_ranked_lexical_search": OP13_SQL,
}
