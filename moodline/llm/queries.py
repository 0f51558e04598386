"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.llm import alignment, bpe, exact_dedup, html, langid, lm, mixing, ngram_join, pii, quality, runs, topk, toxicity
from moodline.llm.common import fold_of, table
from moodline.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(configure(spark), sf, "embeddings")
    return topk.search(vectors, F.col("vec_id") % 50 == 0, 5)


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(configure(spark), sf, "documents"), table(spark, sf, "labels")
    chain = toxicity.fit(docs, labels, toxicity.label_categories(labels), "toxic")
    return toxicity.score(docs, chain)


def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.mark_copies(table(configure(spark), sf, "documents"))


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.tokenize(table(configure(spark), sf, "documents"), path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_lm(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(configure(spark), sf, "documents")
    scores = lm.score(docs, fold_of("doc_id", 7) != 2)
    return scores.select("doc_id", (fold_of("doc_id", 7) == 2).alias("held_out"), *scores.columns[1:])


def op7_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(configure(spark), sf, "pages")
    return html.extract(pages, html.fit(pages))


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find(table(configure(spark), sf, "documents")))


def op8_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_copies(table(configure(spark), sf, "documents"))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(configure(spark), sf, "documents"))


def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(configure(spark), sf, "documents")
    model = langid.fit(docs, fold_of("doc_id", 5) != 0)
    found = langid.predict(docs, model)
    return found.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    return runs.digest(table(configure(spark), sf, "documents"))


def op12_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(configure(spark), sf, "documents"), table(spark, sf, "labels")
    found = quality.classify(docs, labels, fold_of("doc_id", 5) != 0)
    return found.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    first, second = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    hashed = alignment.align(
        table(configure(spark), sf, "documents"),
        first,
        second,
        groups_as=lambda g: F.when(g == "", F.lit("")).otherwise(F.sha2(g, 256)),
    )
    return hashed.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Query] = {
    name: fn for name, fn in list(globals().items()) if name.startswith("op") and callable(fn)
}

ORACLE: dict[str, str] = {
    "op1_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q
            from embeddings
            where vec_id is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
            from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
        r as (
            select query_id, row_number() over (
                partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
            from s)
        select query_id, rank, vec_id, score from r where rank <= 5""",
    "op8_ngram_join": r"""
        with recursive
        split as (
            select doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
            from documents),
        sets as (
            select doc_id, list_distinct(case
                when len(w) = 0 then []
                when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
            from split),
        shingles as (select doc_id, len(s) as n, unnest(s) as g from sets),
        links as (
            select a.doc_id as a, b.doc_id as b
            from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n
            having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach as (
            select doc_id as a, doc_id as b from sets
            union
            select reach.a, links.b from reach join links on reach.b = links.a)
        select doc_id, len(s) as n_shingles, c as component_id
        from sets join (select a, min(b) as c from reach group by a) on a = doc_id""",
    "op3_exact_dedup": r"""
        with hashed as (
            select doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as sha
            from documents)
        select doc_id,
               min(doc_id) over (partition by sha) as keep_id,
               count(*) over (partition by sha) as group_size,
               doc_id = min(doc_id) over (partition by sha) as kept,
               sha as text_sha256
        from hashed""",
}


def registered() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
