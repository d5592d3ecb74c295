"""The registered queries of these operators: thin views of their results on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/documents.parquet")


def _rest(modulus: int):
    """crc32 of the document's id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op1_language_id(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.language_id import language_id

    docs = _documents(spark, root).select("doc_id", "text", "lang")
    return language_id(docs, _rest(4) != 2).select("doc_id", (_rest(4) == 2).alias("held_out"), "lang_pred", "score")


def op2_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.suffix_dedup import suffix_dedup

    r = suffix_dedup(_documents(spark, root).select("doc_id", "text"))
    return r.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.packing import pack_documents

    return pack_documents(_documents(spark, root)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.substring_dedup import substring_dedup

    r = substring_dedup(_documents(spark, root).select("doc_id", "text"))
    return r.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_multiset_fingerprint(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.multiset_hash import edited_fingerprints

    return edited_fingerprints(_documents(spark, root))


def op6_ngram_lm(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.ngram_lm import lm_scores

    return lm_scores(_documents(spark, root), _rest(7) != 2)


def op7_pareto_mixing(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.mixing import copies

    return copies(_documents(spark, root)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_toxicity(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.toxicity import score_toxicity

    labels = spark.read.parquet(f"{root}/labels.parquet")
    r = score_toxicity(_documents(spark, root), labels, _rest(3) != 1)
    return r.select("doc_id", (_rest(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_nearest_neighbours(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.ann import nearest

    return nearest(spark.read.parquet(f"{root}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op10_simhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.simhash import simhash_components

    r = simhash_components(_documents(spark, root))
    return r.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id")


def op11_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.secrets import BASE, find_secrets

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    r = find_secrets(_documents(spark, root).select("doc_id", "text"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return r.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
                    F.sha2(listed(of(*BASE)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op12_token_alignment(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.token_alignment import align, link_counts

    aligned = align(_documents(spark, root).select("doc_id", "text"))
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise(F.lit(""))
    r = link_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return r.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_lexical_search(spark: SparkSession, root: str) -> DataFrame:
    from tillroll.llm.lexical_search import search

    return search(_documents(spark, root), spark.read.parquet(f"{root}/benchmark.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_suffix_dedup, op3_best_fit_packing, op4_substring_dedup, op5_multiset_fingerprint, op6_ngram_lm,
    op7_pareto_mixing, op8_toxicity, op9_nearest_neighbours, op10_simhash_near_dedup, op11_secret_scan,
    op12_token_alignment, op13_lexical_search)}

# The others have no SQL form: hashes (XXH64, crc32 of token ids), learned models, random ranks, tokenisers or
# approximate search.  They are held against brute force, exact recomputation or held-out rows in tests/llm.
ORACLE: dict[str, str] = {
    "op4_substring_dedup": """
        with w as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws
            from documents),
        win as (
            select doc_id, i, array_to_string(ws[i:i + 49], ' ') as win
            from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
        low as (select md5(win) as h, min(doc_id) as first_doc from win group by 1),
        hit as (select win.doc_id, win.i from win join low on md5(win.win) = low.h where low.first_doc < win.doc_id),
        gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from hit),
        word as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from w),
        kept as (
            select doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
            from word anti join gone using (doc_id, p) group by 1)
        select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
               sha256(coalesce(kept, '')) as kept_sha256
        from w left join kept using (doc_id)""",
    "op13_lexical_search": """
        with doc as (
            select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
            from documents),
        asked as (
            select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
            from benchmark),
        q as (select item_id, term, count(*) as times from asked group by all),
        size as (select count(*) as docs, sum(len(terms))::bigint as total from doc where len(terms) > 0),
        tf as (
            select r, term, count(*) as tf
            from (select r, unnest(terms) as term from doc) where term in (select term from q) group by all),
        df as (select term, count(*) as df from tf group by 1),
        w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w from df, size),
        part as (
            select r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(terms) * docs) // total))) as part
            from tf join w using (term) join doc using (r), size),
        score as (
            select item_id, r, sum(times * part)::bigint as score from q join part using (term) group by all),
        ranked as (
            select item_id, doc_id, score,
                   row_number() over (partition by item_id order by score desc, doc_id) as rank
            from score join doc using (r) where score > 0)
        select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10""",
}
