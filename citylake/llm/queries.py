"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm import (
    centroids,
    divergence,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    packing,
    pii,
    quality_rules,
    secret_scan,
    simhash,
    topk,
    url_filter,
)
from citylake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_columns(pii.spans(table(spark, sf_dir, "documents")))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.annotate(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """The votes in SQL: word pairs against the templates' pairs, by diagonal, merged, verified, per document."""
    rows = [
        (number, label, exact, len(words) - 1, at, *words[at : at + 2])
        for number, (text, label, exact) in enumerate(
            [(*p, True) for p in license_scan.PHRASES] + [(*n, False) for n in license_scan.NOTICES]
        )
        for words in [text.split()]
        for at in range(len(words) - 1)
    ]
    values = ", ".join(f"({n}, '{label}', {exact}, {runs}, {t}, '{a}', '{b}')" for n, label, exact, runs, t, a, b in rows)
    return f"""
    with words as (
        select row_number() over () as r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
        from documents
    ), pairs as (
        select r, p, w[p] as a, w[p + 1] as b from (select r, w, unnest(range(1, len(w))) as p from words)
    ), templates(template, label, exact, runs, t, a, b) as (values {values}),
    diagonals as (
        select r, template, label, exact, runs, p - 1 - t as d, list(t) as ts
        from pairs join templates using (a, b) group by r, template, label, exact, runs, d
    ), stepped as (
        select *, exact or coalesce(d - lag(d) over (partition by r, template order by d) > {license_scan.MAX_STEP}, true) as apart
        from diagonals
    ), placed as (
        select *, sum(apart::int) over (partition by r, template order by d) as place from stepped
    ), merged as (
        select r, template, label, exact, runs, min(d + list_min(ts)) as first_word, max(d + list_max(ts)) + 2 as end_word,
            len(list_distinct(flatten(list(ts)))) / runs as coverage
        from placed group by r, template, label, exact, runs, place
    ), good as (
        select * from merged where case when exact then coverage = 1 else coverage >= {license_scan.MIN_COVERAGE}
            and end_word - first_word <= {license_scan.MAX_STRETCH} * (runs + 1) end
    )
    select doc_id, len(w) as n_words, count(first_word) filter (exact) as n_base,
        min(first_word) filter (exact) as first_word, max(first_word) filter (exact) as last_word,
        coalesce(string_agg(distinct label, ',' order by label) filter (exact), '') as base_labels,
        coalesce(string_agg(distinct label, ',' order by label), '') as labels, coalesce(max(coverage), 0.0)::double as score
    from words left join good using (r) group by r, doc_id, w
    """


ORACLES["op2_license_scan"] = _license_sql()


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = exact_dedup.DigestIndex.temporary(spark, docs)
    found = exact_dedup.annotate_table(docs, index)
    index.close()
    return found


ORACLES["op3_exact_dedup"] = """
    with texts as (
        select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
        from documents
    ), kept as (
        select t, max(doc_id) as keep_id, count(*) as group_size from texts group by t
    )
    select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256
    from texts join kept using (t)
"""


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest_columns(secret_scan.scan(table(spark, sf_dir, "documents")))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.annotate(table(spark, sf_dir, "documents"))


@query
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc.*", "copy", "n_copies", "shuffle_key")


ORACLES["op7_source_mix"] = """
    with recursive sized as (
        select source, sum(length(coalesce(text, ''))) as size from documents group by source
    ), rated as (
        select source, case when size > 0
            then sqrt(size::double) / sum(sqrt(size::double)) over () * sum(size) over () / size else 1.0 end as rate
        from sized
    ), parted as (
        select source, greatest(ceil(rate / 16.0), 1) as parts, rate / greatest(ceil(rate / 16.0), 1) as mean from rated
    ), steps as (
        select source, parts, mean, 0 as k, exp(-mean) as p, exp(-mean) as total from parted
        union all
        select source, parts, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1) from steps where k < 80
    ), drawn as (
        select doc_id, source, part,
            ('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, '') || ':' || part), 1, 13))::bigint::double
                / 4503599627370496.0 as u
        from documents join (select *, unnest(range(1, parts::bigint + 1)) as part from parted) using (source)
    ), counted as (
        select doc_id, count(*)::int as n_copies
        from drawn join steps using (source) where total <= u group by doc_id
    )
    select d.*, c.copy::int as copy, n_copies, md5('mix-1:order:' || doc_id || ':' || c.copy) as shuffle_key
    from documents d join (select *, unnest(range(1, n_copies + 1)) as copy from counted) c using (doc_id)
"""


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


@query
def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


ORACLES["op11_topk_search"] = f"""
    with whole as (
        select vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::double)) as v
        from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
    )
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
    from scored qualify rank <= {topk.K}
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = f"""
    with docs as (
        select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
        from documents
    ), occurring as (
        select lang, source, term, count(*) as n, count(distinct r) as docs
        from (select r, lang, source, unnest(w) as term from docs) group by all
    ), kept as (
        select lang, term, sum(n) as total from occurring group by all having sum(docs) >= {divergence.MIN_DOCS}
    ), groups as (select distinct lang, source from docs),
    counted as (
        select lang, source, term, coalesce(n, 0)::hugeint as n, total::hugeint as total
        from groups join kept using (lang) left join occurring using (lang, source, term)
    ), shared as (
        select lang, source, term, n,
            1 + ({divergence.UNIT} * (n + 1)) // (sum(n) over (partition by lang, source) + count(*) over (partition by lang, source)) as p,
            1 + ({divergence.UNIT} * (total + 1)) // (sum(total) over (partition by lang, source) + count(*) over (partition by lang, source)) as q
        from counted
    ), pairs as (
        select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
        from shared a join shared b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
    ), parts as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
        union all
        select lang, source, 'term', term, (p - q) * (p - q) // q from shared where n > 0 and p > q
    )
    select lang, source, part, item, value::bigint as value,
        cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
    from parts qualify part = 'pair' or rank <= {divergence.TOP_TERMS}
"""


@query
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def _clusters_sql() -> str:
    """Rounds written out: assignment by the sum of squared differences, then the floor of the mean of every dimension."""
    parts = [
        f"""whole as materialized (
            select row_number() over () as r, vec_id,
                list_transform(embedding, lambda x: floor({centroids.SCALE} * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(embedding) = {centroids.DIMS}
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        "cells as materialized (select r, unnest(range(1, len(v) + 1)) as d, unnest(v) as x from whole)",
        f"""chosen as (select v, row_number() over (order by sha256('{centroids.SEED}:' || vec_id), v) - 1 as c
            from whole qualify c < {centroids.CLUSTERS})""",
        "c0 as materialized (select c, unnest(range(1, len(v) + 1)) as d, unnest(v) as y from chosen)",
    ]
    for k in range(centroids.ROUNDS + 1):
        parts.append(f"""a{k} as materialized (
            select r, arg_min(c, (far, c)) as c, min(far) as far
            from (select r, c, sum((x - y) * (x - y)) as far from cells join c{k} using (d) group by r, c) group by r)""")
        if k < centroids.ROUNDS:
            parts.append(f"""c{k + 1} as materialized (
                select c, d, coalesce((s - ((s % n) + n) % n) // n, y) as y
                from c{k} left join (
                    select c, d, sum(x)::hugeint as s, count(*)::hugeint as n from cells join a{k} using (r) group by c, d
                ) using (c, d))""")
    last = centroids.ROUNDS
    return f"""with {', '.join(parts)}
        select vec_id, c::integer as cluster, far::bigint as distance, (sum(far) over (partition by c))::bigint as cluster_inertia,
            (sum(far) over ())::bigint as inertia, centroid_sha256
        from whole join a{last} using (r)
        join (select c, sha256(string_agg(y::bigint::varchar, ',' order by d)) as centroid_sha256 from c{last} group by c) using (c)"""


ORACLES["op13_centroid_clusters"] = _clusters_sql()
