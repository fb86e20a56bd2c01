"""The operators of this subpackage applied to whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.llm import cover_tree, dart_minhash, decontaminate, fuzzy_lines, html_template, merkle, packing, pair_counts, run_index, secrets, sharding, sql, toxicity, warc
from frostline.llm.common import Stages, table
from frostline.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(documents, table(spark, sf_dir, "labels"), Stages(spark))
    return toxicity.score_texts(documents, lexicon).select(
        "doc_id", (toxicity.fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "toxic_weight", "toxic_hits", "toxic_words")


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(documents, secrets.fit(documents)).drop("text")
    base = F.filter("findings", lambda f: f["kind"] != "learned")
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(secrets.digest(base), 256).alias("base_sha256"),
                        secrets.digest(F.col("findings")).alias("spans"), count("learned").alias("n_learned"))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json")


@query("op8_html_template")
def op8_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_template.main_text(table(spark, sf_dir, "pages"), Stages(spark))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), 40, Stages(spark))
    return sharding.with_slots(placed).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                              F.lit(None).cast("int").alias("grown_shard"))


@query("op6_cover_tree")
def op6_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"), Stages(spark))


@query("op5_dart_minhash")
def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dart_minhash.near_duplicates(documents, Stages(spark)).select("doc_id", "class_id", "class_rows", "keeper")


@query("op7_fuzzy_lines")
def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(documents, Stages(spark)).select("doc_id", "n_lines", "n_removed", "n_left", "text")


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_run_index")
def op9_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = run_index.remove_repeats(documents, Stages(spark))
    # what is left, as text; of a character that a span cuts in two a mark is shown
    kept = F.make_valid_utf8(F.col("kept").cast("string"))
    share = F.when(F.col("n_bytes") > 0, F.col("n_removed") / F.col("n_bytes")).otherwise(0.0)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", kept.alias("text"),
                      share.alias("removed_share"))


@query("op11_merkle")
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"), Stages(spark))


@query("op12_pair_counts")
def op12_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pair_counts.align(documents, pair_counts.Tokenizers.public(), Stages(spark))


@query("op13_warc")
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"), Stages(spark))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op11_merkle"] = sql.MERKLE
ORACLES["op13_warc"] = sql.WARC
