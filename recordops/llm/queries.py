"""The registered queries of the operators, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordops.llm import (
    block_labeller,
    byte_pairs,
    cross_polytope,
    decontamination,
    license_notices,
    minhash_forest,
    phrases,
    quality,
    ranked_search,
    source_mix,
    suffix_sort,
    token_files,
    warc,
)
from recordops.llm.base import table


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("items")


def op2_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    return cross_polytope.search(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def op3_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    found = license_notices.scan(table(spark, folder, "documents"))
    return found.drop("spans")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs)).select("doc_id", "quality_score", "quality_kept")


def op5_suffix_sort(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_sort.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op6_minhash_forest(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, folder, "documents"), size=3, percent=85)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    read = warc.archive(pages)
    refers = F.col("refers_to").cast(pages.schema["page_id"].dataType)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", refers.alias("refers_to"))


def op8_block_labeller(spark: SparkSession, folder: str) -> DataFrame:
    return block_labeller.extract(table(spark, folder, "pages"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    read = token_files.round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_pairs.encode(table(spark, folder, "documents"), path, keep_ids=False)


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_cross_polytope,
        op3_license_notices,
        op4_quality,
        op5_suffix_sort,
        op6_minhash_forest,
        op7_warc,
        op8_block_labeller,
        op9_token_files,
        op10_byte_pairs,
        op11_phrases,
        op12_ranked_search,
        op13_source_mix,
    )
}
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES_SQL = f"""
with pieces as (
    select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words
    from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents)
),
totals as (select lang, cast(sum(len(words)) as bigint) as n from pieces group by lang),
sizes as (select unnest([1, 2, 3]) as size),
runs as (
    select lang, size, words[i : i + size - 1] as words, count(*) as f
    from (select lang, size, words, unnest(range(1, len(words) - size + 2)) as i from pieces join sizes on len(words) >= size)
    group by all having count(*) >= 10
),
cuts as (
    select c.lang, c.words, c.f as a, k, l.f as l, r.f as r,
        1000000::hugeint * c.f * c.f // (l.f::hugeint * r.f) as score
    from (select *, unnest(range(1, size)) as k from runs where size > 1) c
    join runs l on l.lang = c.lang and l.words = c.words[1 : k]
    join runs r on r.lang = c.lang and r.words = c.words[k + 1 : c.size]
),
worst as (
    select * from cuts qualify row_number() over (partition by lang, words order by score, k) = 1
),
inside as (
    select lang, part as words, max(f) as longer
    from (select lang, f, unnest([words[1 : 2], words[2 : 3]]) as part from runs where size = 3)
    group by all
),
ranked as (
    select w.*, row_number() over (partition by w.lang order by score desc, a desc, array_to_string(w.words, ' ')) as rank
    from worst w left join inside i on i.lang = w.lang and i.words = w.words
    where longer is null or 100 * longer < 50 * a
)
select lang, rank, array_to_string(words, ' ') as phrase, a, l, r, n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""

RANKED_SQL = r"""
with terms as (
    select doc_id, row_number() over () as row,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as words
    from documents
),
totals as (select count(*) as docs, cast(sum(len(words)) as bigint) as words from terms where len(words) > 0),
tfs as (select row, term, count(*) as tf from (select row, unnest(words) as term from terms) group by all),
dfs as (select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from tfs, totals group by term, docs),
items as (
    select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
),
lengths as (select row, doc_id, 50 + (50 * len(t.words) * docs) // totals.words as m from terms t, totals where len(t.words) > 0),
scores as (
    select item_id, row, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
    from items join tfs using (term) join dfs using (term) join lengths using (row)
    group by all having score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores) where rank <= 50
"""

MIX_SQL = r"""
with rows as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
        (cast('0x' || substr(md5(concat_ws(chr(10), 'mix', coalesce(cast(doc_id as varchar), '-'), coalesce(text, '-'))), 1, 13) as bigint) + 0.5)
            / 4503599627370496.0::double as u
    from documents
),
sources as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
weighted as (
    select *, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sources
),
filled as (
    select *, 2 * source_size as cap,
        coalesce(sum(2 * source_size) over earlier, 0) as caps, coalesce(sum(weight) over earlier, 0) as weights
    from weighted
    window earlier as (order by 2 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)
),
rated as (
    select *, (sum(source_size) over () * 1.5::double - caps) / (sum(weight) over () - weights) as rate from filled
),
targets as (
    select source, source_size,
        case when rate * weight > cap then cast(cap as double)
            else (select min_by(rate, (cap / weight, caps)) from rated where rate * weight <= cap) * weight end as target
    from rated
),
planned as (
    select r.*, source_size, target, floor(coalesce(target / nullif(source_size, 0), 0)) as whole,
        coalesce(target / nullif(source_size, 0), 0) - floor(coalesce(target / nullif(source_size, 0), 0)) as p
    from rows r join targets t on r.source is not distinct from t.source
),
ordered as (
    select *, case when p > 0 and size > 0 then u / (1 - u) * (1 - p) / p end as place from planned
),
run as (
    select *, sum(size) over (partition by source order by place nulls last, doc_id rows between unbounded preceding and current row) as run,
        sum(whole * size) over (partition by source) as certain
    from ordered
)
select doc_id, size, source_size, target,
    cast((whole + (place is not null and 2 * run - size <= 2 * (target - certain))::int) * size as bigint) as taken
from run
"""

ORACLES: dict[str, str] = {"op11_phrases": PHRASES_SQL, "op12_ranked_search": RANKED_SQL, "op13_source_mix": MIX_SQL}
