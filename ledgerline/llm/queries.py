"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    decontaminate, divergence, langid, linededup, onlinepack, packing, pii, quality, simhash, suffixdedup, toolcalls, vectorfile, whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def count(kind: int, name: str) -> Column:  # a lambda's second parameter would be the element's index
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{name}")

    counts = [count(k, name) for k, name in enumerate(pii.KINDS)]
    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(every).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))


# What the calls derived from conversations must look like.
TOOLS = {
    name: {
        "type": "object",
        "required": ["limit", "query"],
        "properties": {
            "query": {"type": "string", "minLength": 1},
            "limit": {"type": "integer", "minimum": 0, "maximum": most},
            "after": {"type": "string"},
        },
        "additionalProperties": False,
    }
    for name, most in (("lookup", 40), ("search", 30), ("summarise", 20))
}


def tool_messages(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls from user turns and results from assistant turns; a call follows the one two turns before."""
    names = F.array(*[F.lit(n) for n in TOOLS])
    size = F.length(F.col("text"))
    before = F.when(F.col("turn") >= 2, F.struct(F.concat(F.lit("c"), F.col("turn") - 2).alias("$ref")))
    arguments = F.to_json(F.struct(F.col("text").alias("query"), (size % 45).alias("limit"), before.alias("after")))
    calls = conversations.where("role = 'user'").select(
        "conv_id", "turn", F.concat(F.lit("c"), "turn").alias("call_id"), F.get(names, size % 3).alias("name"), arguments.alias("arguments"))
    results = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", F.concat(F.lit("c"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_messages(table(spark, sf_dir, "conversations"))
    return toolcalls.link(calls, results, TOOLS)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    return quality.classify(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.decide(table(spark, sf_dir, "documents")).drop("key")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorfile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onlinepack.pack(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontamination, op2_suffix_dedup, op3_pii, op4_tool_calls, op5_packing, op6_quality,
              op7_line_dedup, op8_simhash, op9_language_id, op10_exact_top_k, op11_embedding_whitening,
              op12_source_divergence, op13_online_packing)
}

ORACLES: dict[str, str] = {
    "op10_exact_top_k": """
        with v as (
            select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
            from embeddings
            where vec_id is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                   cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
            from v q join v c on c.vec_id <> q.vec_id
            where q.vec_id % 50 = 0
        ), ranked as (
            select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
}
ORACLES["op12_source_divergence"] = """
    with d as (
        select row_number() over () as rid, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source
        from documents
    ), tok as (
        select rid, lang, source,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
        from d
    ), vocab as (
        select lang, term from tok group by lang, term having count(distinct rid) >= 30
    ), kept as (select lang, count(*)::hugeint as nv from vocab group by lang),
    gc as (select lang, source, term, count(*)::hugeint as c from tok join vocab using (lang, term) group by all),
    groups as (
        select g.lang, g.source, coalesce(t.total, 0)::hugeint as total, coalesce(k.nv, 0)::hugeint as nv
        from (select distinct lang, source from d) g
        left join (select lang, source, sum(c) as total from gc group by all) t using (lang, source)
        left join kept k using (lang)
    ), grid as (
        select g.lang, g.source, v.term, coalesce(gc.c, 0)::hugeint as c, g.total, g.nv
        from groups g join vocab v using (lang) left join gc using (lang, source, term)
    ), pg as (
        select lang, source, term, c, 1 + (1000000000::hugeint * (c + 5)) // (total + 5 * nv) as p from grid
    ), lang_p as (
        select lang, term, 1 + (1000000000::hugeint * (sum(c) + 5)) // (sum(sum(c)) over (partition by lang) + 5 * any_value(nv)) as q
        from grid group by lang, term
    ), pair as (
        select a.lang, a.source, b.source as item,
               coalesce((select sum(abs(x.p - y.p)) from pg x join pg y using (lang, term)
                         where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
    ), term as (
        select pg.lang, pg.source, pg.term as item, (pg.p - lang_p.q)::bigint as value
        from pg join lang_p using (lang, term) where pg.c > 0 and pg.p > lang_p.q
    ), parts as (
        select lang, source, 'pair' as part, item, value from pair
        union all select lang, source, 'term' as part, item, value from term
    ), ranked as (
        select *, (row_number() over (partition by lang, source, part order by value desc, item))::integer as rank from parts
    )
    select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""
