"""Registered queries of this subpackage, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedplan.llm import alignment, bpe, chosen_path, decontaminate, hard_negatives, langid, licenses, packing, pii, repetition, secret_scan, substring_dedup, token_counts


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.span_digests(_table(spark, folder, "documents"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files below a directory for each source, a hundred documents to the innermost directory."""
    path = F.concat_ws(
        "/", F.coalesce("source", F.lit("unknown")), F.expr("cast(doc_id div 1000 as string)"), F.expr("cast(doc_id div 100 % 10 as string)"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    path = F.when(F.col("doc_id").isNotNull(), path)
    return licenses.scanned(_table(spark, folder, "documents"), licenses.templates(spark), "doc_id", path)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(_table(spark, folder, "documents"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.span_digests(_table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.joined(_table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.verdicts(_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.deduplicated(_table(spark, folder, "documents"))


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path
    return alignment.aligned(_table(spark, folder, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_personal_data": op1_personal_data,
        "op2_licenses": op2_licenses,
        "op3_language": op3_language,
        "op4_secrets": op4_secrets,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_token_counts": op6_token_counts,
        "op7_repetition": op7_repetition,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_decontaminate": op10_decontaminate,
        "op11_alignment": op11_alignment,
        "op12_packing": op12_packing,
        "op13_hard_negatives": op13_hard_negatives,
    }


_SHINGLES_SQL = """
    select {id} id, list_distinct(case when len(w) between 1 and 4 then [array_to_string(w, ' ')]
        else [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] end) s
    from (select {id}, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') w from {table}) where len(w) > 0
"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TERMS = "regexp_extract_all(lower(text), '[a-z0-9]+(?:[.][0-9]+)*')"
_KNOWN = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES))
_MATCHING = licenses.Matching()

_LICENSES_SQL = f"""
with known as (select * from (values {_KNOWN}) t(template, licence, text)),
files as (
    select doc_id, coalesce(text, '') as text, case when doc_id is not null then concat_ws('/', coalesce(source, 'unknown'),
        cast(doc_id // 1000 as varchar), cast(doc_id // 100 % 10 as varchar), concat(doc_id, '.txt')) end as path from documents),
marked as (
    select *, coalesce(regexp_matches(path, {_quoted(licenses.LICENCE_FILE)}), false) as named,
        regexp_matches(text, {_quoted(licenses.NOTICE)}) as noticed, string_split(text, chr(10)) as lines from files),
noted as (
    select doc_id, path, regexp_extract(path, '^(.*/)[^/]*$', 1) as dir, named,
        case when named and regexp_matches(text, '\\S') then text when noticed then array_to_string(list_transform(list_filter(lines,
            lambda l: regexp_matches(l, {_quoted(licenses.NOTICE)})), lambda l: trim(l)), chr(10)) end as notice,
        case when noticed then len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) end as n_words from marked),
parts as (
    select notice, unnest(list_distinct(list_concat([notice], string_split(notice, chr(10))))) as text
    from (select distinct notice from noted where notice is not null)),
texts as (select distinct text from parts),
ours as (select text as key, term, count(*) as times from (select text, unnest({_TERMS}) as term from texts) group by all),
theirs as (select template, term, count(*) as times from (select template, unnest({_TERMS}) as term from known) group by all),
total as (select (select count(*) from texts) + (select count(*) from known) as total),
rarity as (
    select term, ln((total + 1.0) / (n + 1.0)) + 1 as idf
    from (select term, sum(n) as n from (select term, count(*) as n from ours group by term union all
        select term, count(*) from theirs group by term) group by term), total),
a as (select key, term, (ln(times) + 1) * idf as w from ours join rarity using (term)),
b as (select template, term, (ln(times) + 1) * idf as v from theirs join rarity using (term)),
cosines as (
    select key, licence, round(dot / (norm * other), 6) as cosine
    from (select key, template, sum(w * v) as dot from a join b using (term) group by all)
    join (select key, sqrt(sum(w * w)) as norm from a group by key) using (key)
    join (select template, sqrt(sum(v * v)) as other from b group by template) using (template)
    join known using (template)),
best as (
    select notice, licence, cosine from parts join cosines on key = parts.text
    qualify row_number() over (partition by notice order by cosine desc, licence) = 1),
matched as (
    select doc_id, path, dir, case when cosine >= {_MATCHING.cosine} then licence end as own, case when cosine >= {_MATCHING.cosine} then cosine end as cosine,
        coalesce(cosine >= {_MATCHING.cosine}, false) and (named or coalesce(len(regexp_extract_all(noted.notice, '[^\\x20\\x09-\\x0D]+'))
            >= {_MATCHING.share} * n_words, false)) as is_licence_file
    from noted left join best on best.notice = noted.notice),
speaks as (
    select dir as above, own as licence from matched where is_licence_file and path is not null
    qualify row_number() over (partition by dir order by cosine desc, own) = 1),
above as (
    select dir, unnest(list_transform(range(0, len(string_split(dir, '/'))), lambda i: array_to_string(list_transform(
        string_split(dir, '/')[1:i], lambda p: p || '/'), ''))) as above from (select distinct dir from matched where path is not null)),
nearest as (
    select dir, licence as inherited, above as inherited_from from above join speaks using (above)
    qualify row_number() over (partition by dir order by length(above) desc) = 1)
select doc_id, path, coalesce(own, inherited) as licence,
    case when own is not null then 'header' when inherited is not null then 'inherited' else 'none' end as licence_from,
    case when own is null then inherited_from end as inherited_from, cosine, is_licence_file
from matched left join nearest on nearest.dir = matched.dir and matched.path is not null
"""

_JOIN_SQL = f"""
with recursive shingled as ({_SHINGLES_SQL.format(id="doc_id", table="documents")}),
keyed as (select id, s, sha256(array_to_string(list_sort(s), chr(1))) as k from shingled),
sets as (select k, min(id) as node, count(*) as copies, any_value(s) as s from keyed group by k),
items as (select node, copies, len(s) as n, unnest(s) as g from sets),
pairs as (
    select a.node as x, b.node as y, any_value(b.copies) as copies, count(*) as c, any_value(a.n) + any_value(b.n) as n
    from items a join items b on a.g = b.g and a.node <> b.node group by 1, 2),
linked as (select x, y, copies from pairs where c >= 0.8 * (n - c) - 1e-9),
reach as (select node, node as r from sets union select reach.node, y from reach join linked on x = r),
roots as (select node, min(r) as class_id from reach group by node),
links as (select x as node, sum(copies) as n from linked group by x)
select doc_id, coalesce(class_id, doc_id) as class_id, coalesce(node, doc_id) as copy_of,
    cast(coalesce(copies - 1 + coalesce(n, 0), 0) as bigint) as n_links
from documents left join keyed on id = doc_id left join sets using (k) left join roots using (node) left join links using (node)
"""

def _matches_sql(kind: int, pattern: str) -> str:
    """(doc_id, start, kind, match) of a pattern: pieces between the matches tell where each one starts."""
    found, between = f"regexp_extract_all(text, {_quoted(pattern)})", f"regexp_split_to_array(text, {_quoted(pattern)})"
    size = "coalesce(list_sum(list_transform({}, lambda p: length(p))), 0)"
    start = f"{size.format('pieces[1:k]')} + {size.format('found[1:k - 1]')}"
    return f"""select doc_id, {start} as start, {kind} as kind, found[k] as match from (
        select doc_id, found, pieces, unnest(range(1, len(found) + 1)) as k from (select doc_id, {found} as found, {between} as pieces from texts))"""


_WINDOWS = secret_scan.Windows()
_SECRETS_SQL = f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
known as (
    select doc_id, start, kind, start + length(match) as stop from (
        {_matches_sql(0, secret_scan.ASSIGN)} union all {_matches_sql(1, secret_scan.ACCESS)} union all {_matches_sql(2, secret_scan.HEX)})
    where kind > 0 or length(regexp_extract(match, {_quoted(secret_scan.ASSIGN)}, 1)) >= {secret_scan.LEAST_VALUE}),
candidates as (
    select *, case when regexp_matches(match, '^[0-9a-fA-F]+$') and regexp_matches(match, '[0-9]') and regexp_matches(match, '[a-fA-F]') then {_WINDOWS.hexadecimal}
        when regexp_matches(match, '[0-9].*[0-9].*[0-9]') and regexp_matches(match, '[A-Z]') and regexp_matches(match, '[a-z]') then {_WINDOWS.mixed}
        when regexp_matches(match, '[0-9].*[0-9].*[0-9]') and regexp_matches(match, '[a-z]') then {_WINDOWS.lower} end as threshold
    from ({_matches_sql(3, f"{_WINDOWS.candidate}{{{_WINDOWS.size},}}")})
    where regexp_matches(match, '[0-9]') and not ({" or ".join(f"regexp_matches(match, {_quoted(p)})" for p in secret_scan.ALLOWED)})),
windows as (
    select doc_id, start, match, threshold, i, string_split(match[i + 1 : i + {_WINDOWS.size}], '') as cs
    from (select *, unnest(range(0, length(match) - {_WINDOWS.size - 1})) as i from candidates)),
hits as (
    select doc_id, start + min(i) as start, 3 as kind, start + max(i) + {_WINDOWS.size} as stop from windows
    where log2({_WINDOWS.size}) - list_sum(list_transform(list_distinct(cs), lambda c: len(list_filter(cs, lambda x: x = c))
        * log2(len(list_filter(cs, lambda x: x = c))))) / {_WINDOWS.size} >= threshold
    group by doc_id, windows.start, match),
spans as (
    select * from known union all select * from hits h
    where not exists (select 1 from known k where k.doc_id = h.doc_id and k.start < h.stop and h.start < k.stop)),
named as (select *, concat({_quoted("|".join(secret_scan.KINDS))}.split('|')[kind + 1], ':', start, ':', stop) as span from spans)
select t.doc_id, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access, count(*) filter (where kind = 2) as n_hex,
    sha256(coalesce(string_agg(span, ',' order by start, kind) filter (where kind < 3), '')) as base_sha256,
    coalesce(string_agg(span, ',' order by start, kind), '') as spans
from texts t left join named n on n.doc_id = t.doc_id group by t.doc_id
"""

ORACLE = {
    "op2_licenses": _LICENSES_SQL,
    "op4_secrets": _SECRETS_SQL,
    "op5_jaccard_join": _JOIN_SQL,
    "op8_substring_dedup": """
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w from documents),
starts as (select doc_id, unnest(range(1, len(w) - 33)) s, w from words where len(w) >= 35),
windows as (select doc_id, s, sha256(array_to_string(w[s : s + 34], ' ')) h from starts),
again as (select h from windows group by h having count(*) > 1),
hits as (select doc_id, list(s) l from windows semi join again using (h) group by doc_id),
gone as (select doc_id, list_distinct(flatten(list_transform(l, lambda s: range(s, s + 35)))) g from hits)
select doc_id, len(w)::bigint n_words, coalesce(len(g), 0)::bigint n_removed,
    sha256(coalesce(array_to_string(list_filter(w, lambda x, i: g is null or not list_contains(g, i)), ' '), '')) kept_sha256
from words left join gone using (doc_id)
""",
    "op10_decontaminate": f"""
with items as (select id item_id, unnest(s) shingle, len(s) n_shingles from ({_SHINGLES_SQL.format(id="item_id", table="benchmark")})),
docs as (select id doc_id, unnest(s) shingle from ({_SHINGLES_SQL.format(id="doc_id", table="documents")})),
shared as (
    select doc_id, item_id, count(*) n_shared, any_value(n_shingles) n_shingles
    from docs join items using (shingle) group by doc_id, item_id)
select doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles containment
from shared where n_shared >= ceil(n_shingles * 0.8 - 1e-9)
""",
    "op13_hard_negatives": """
with rows as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: coalesce(not isfinite(x), true))) = 0),
scores as (
    select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
    from rows a, rows b where a.vec_id % 100 = 0),
positives as (
    select anchor_id, id as positive_id, score as positive_score from scores where same and id <> anchor_id
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
windows as (
    select anchor_id, positive_id, positive_score, id as negative_id, score as negative_score,
        row_number() over (partition by anchor_id, positive_id order by score desc, id)::integer as rank
    from positives join scores using (anchor_id)
    where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from windows where rank <= 5
""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
