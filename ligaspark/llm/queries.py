"""The queries ``opN_<name>`` of this subpackage: each applies its operator to its whole table and gives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat_format, decontaminate, language, license_scan, mixing, packing, quality, secrets_scan, simhash, structure_repair, topk, toxicity
from .common import remainder, table


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(language.train_rows(docs)))
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.find_secrets(table(spark, sf_dir, "documents"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    kinds = F.transform("spans", lambda s: s["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *count, F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.Mix(table(spark, sf_dir, "documents")).dealt()
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")



#: A conversation whose texts are themselves control strings.
TRAP = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.union(spark.createDataFrame(TRAP, "conv_id long, turn long, role string, text string"))
    read = chat_format.read_back(chat_format.format_conversations(turns))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = [F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256")]
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), *loss, "formatted_chars")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of ``conversations`` after the damage that op13 is to mend, told by a hash of conversation and turn."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text"))
    role = F.when(hit == 4, "user").otherwise(one("role"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = structure_repair.repair(damaged(table(spark, sf_dir, "conversations")), copies="copies")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2("repaired", 256).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (op1_pack, op2_licenses, op3_toxicity, op4_quality, op5_secrets, op6_topk, op7_decontaminate, op8_language, op9_simhash, op10_mix, op11_chat, op12_clusters, op13_repair)}
