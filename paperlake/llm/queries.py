"""The registered queries of this package: each applies its operator to the whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.llm import ann, chat, codes, decontaminate, jaccard, labelled, mixing, nbsvm, resample, rules, secrets, substrings, toxicity, urls

RULES = [
    urls.Rule.read("allow", "com/"),
    urls.Rule.read("block", "example.com/en/"),
    urls.Rule.read("allow", "www.example.com/en/"),
    urls.Rule.read("block", "net/es/"),
    urls.Rule.read("block", "net/fr/"),
]
CONVERSATION = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return urls.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def _scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = nbsvm.train(docs, table(spark, sf, "labels"), "quality")
    return _scored(docs, nbsvm.score(docs, F.col("text"), model), 0.7)


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = substrings.remove_repeated(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf, "labels"), "toxic")
    return _scored(docs, toxicity.score(docs, F.col("text"), model), 0.3)


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    first = mixing.mix(docs).where("copy IS NULL OR copy = 0")
    return first.select("doc_id", "size", "source_size", "target", "taken")


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex", "random")],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = rules.train(docs, table(spark, sf, "labels"), "quality")
    return rules.judge(docs, model).drop("text")


def op6_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf, "documents").select("doc_id", "text"))


def op7_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONVERSATION).alias("text"),
    )
    return chat.digest(chat.format_conversations(turns.unionByName(marked)))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.contaminated(docs, table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "covered", "longest")


def op11_nearest(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return ann.search(ann.build_index(vectors, k=10), vectors.where("vec_id % 100 = 0"))


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = codes.compress(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_secrets": op4_secrets,
    "op5_quality_rules": op5_quality_rules,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_chat_format": op7_chat_format,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_nearest": op11_nearest,
    "op12_vector_codes": op12_vector_codes,
    "op13_resampling": op13_resampling,
}
