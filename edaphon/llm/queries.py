"""The registered queries of this folder: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.llm import centroids
from edaphon.llm.base import sha256_hex, table, word_count
from edaphon.llm.bpe import decode_documents, encode_documents
from edaphon.llm.centroids import centroid_clusters, clusters_sql, with_inertia
from edaphon.llm.licenses import known_licenses, scan_licenses, scan_sql
from edaphon.llm.line_dedup import remove_repeated_lines
from edaphon.llm.mixing import copies, mixing_plan, short_first
from edaphon.llm.ngram_lm import held_out, score, train
from edaphon.llm.packing import pack_documents
from edaphon.llm.personal_data import KINDS, find_personal_data, spans_text
from edaphon.llm.quality_rules import apply_rules, rules_sql
from edaphon.llm.simhash import near_duplicates
from edaphon.llm.spelling import spelling_variants, word_counts
from edaphon.llm.substring_dedup import removal_sql, remove_repeats
from edaphon.llm.topk import QUERY_STEP, integer_vectors, top_k

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", sha256_hex(F.col("kept_text")).alias("kept_sha256"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    plan, sizes = mixing_plan(docs, word_count(F.col("text")), short_first(F.col("size")))
    out = copies(sizes, plan)
    return out.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_personal_data(table(spark, sf_dir, "documents"))
    plain = F.transform("base", lambda x: F.struct(x["kind"], x["start"], x["end"], x["value"]))
    return out.select(
        "doc_id", *[f"n_{kind}" for kind in KINDS],
        sha256_hex(spans_text(plain)).alias("base_sha256"), spans_text(F.concat(plain, "found")).alias("spans"),
    )


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, F.col("vec_id") % QUERY_STEP == 0)


OP4_SQL = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
),
scored as (
  select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 10"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_equal", "n_near", sha256_hex(F.col("kept_text")).alias("kept_sha256"))


def op6_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    out = score(docs, model)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_words"
    )


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = centroid_clusters(centroids.integer_vectors(table(spark, sf_dir, "embeddings")))
    return with_inertia(assigned, found)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spelling_variants(word_counts(table(spark, sf_dir, "documents")))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    coded = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    out = decode_documents(coded, path)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256_hex(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_personal_data": op3_personal_data,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash_duplicates": op6_simhash_duplicates,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_license_scan": op9_license_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_bpe_round_trip": op13_bpe_round_trip,
}
SQL: dict[str, str] = {
    "op1_substring_dedup": removal_sql(),
    "op4_exact_top_k": OP4_SQL,
    "op9_license_scan": scan_sql(),
    "op10_quality_rules": rules_sql(),
    "op11_centroid_clusters": clusters_sql(),
}
