"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal.llm import (
    centroids,
    chat,
    decontaminate,
    importance,
    mixing,
    near_dup,
    quality_rules,
    sharding,
    target_sampling,
    token_files,
    url_lists,
    vector_search,
    warc,
)
from zonal.llm.common import new_folder
from zonal.operators.staging import stage

TOKENIZER = "byte_bpe_50k.json"
SHARDS = 24

# Fixed value: the conversation that the contract adds.
ADDED = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, in the order in which training first meets them."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), None)
    return plan.orderBy(F.asc_nulls_last(F.get("positions", F.lit(0))), "doc_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read back from token files."""
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path(), end_id=2)
    return token_files.read_documents(spark, folder)


def observed_entries(pages: DataFrame, day: Column, marks: int = 3) -> DataFrame:
    """List entries kept by a reviewer who looks at every capture: one with at least `marks`
    marked words (ending in ***, ###, $$$, %%% or &&&) puts its page and its host on the list,
    one without any takes both off, each from the next day."""
    found = F.regexp_count(F.coalesce("html", F.lit("")), F.lit(r"\w(?:\*{3}|#{3}|\${3}|%{3}|&{3})"))

    def action(n: Column) -> Column:
        return F.when(n >= marks, F.lit(url_lists.BLOCK)).when(n == 0, F.lit(url_lists.REMOVE))

    url = F.col("url")
    addresses = F.array(url_lists.page_of(url), url_lists.host_of(url))

    def rows(n: Column) -> Column:
        return F.transform(addresses, lambda a: F.struct(a.alias("address"), action(n).alias("action")))

    # inside the generator's array the count is taken once, and no filter can be moved below it
    told = pages.select(F.date_add(day, 1).alias("day"), F.inline(F.flatten(F.transform(F.array(found), rows))))
    return told.where("address is not null and action is not null").select("address", "day", "action")


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the lists of its fetch day. Pages carry no date: page_id gives one of
    1,000 days, in an order of its own."""
    pages = table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2021-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(1000)).cast("int"))
    captures = pages.select("page_id", "url", day.alias("day"))
    return url_lists.judge(captures, observed_entries(pages, day))


def op4_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps."""
    chosen, _ = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return chosen.withColumn("kept", F.lit(True))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted conversations, digested from the written output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", ADDED), (-7, 1, "assistant", ADDED)], rows.schema)
    chats = stage(chat.format_chats(rows.unionByName(added), tokenizer_path()))
    return chat.digest_chats(chats)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.shuffle_into_shards(docs, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures read back from the archive through its index."""
    folder = new_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    return warc.read_captures(spark, folder).drop("url")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and verdicts; the source of a document stands for its host."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), F.col("source"))
    return judged.withColumn("host_rate", F.round("host_rate", 9))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items they hold."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every twentieth vector."""
    return vector_search.search(table(spark, sf_dir, "embeddings"), k=20, scale=64)


def op12_centroid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their cluster after five rounds, and digests of the clustering."""
    return centroids.digest(*centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256, dims=64, seed=2))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight towards the benchmark, and the rank of those drawn."""
    return target_sampling.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from documents to shards."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_token_files,
        op3_url_lists,
        op4_importance,
        op5_chat,
        op6_shards,
        op7_near_duplicates,
        op8_warc,
        op9_quality_rules,
        op10_decontaminate,
        op11_vector_files,
        op12_centroid_search,
        op13_target_resampling,
        pipeline,
    )
}
