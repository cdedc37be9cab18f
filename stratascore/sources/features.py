"""The three wide tables (key, rare 0/1 label, numeric features) derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratascore.sources.tables import read_table

CUSTOMER_FEATURES = [
    "n_orders", "n_lines", "sum_qty", "sum_price", "max_price", "avg_disc", "avg_tax",
    "ret_share", "done_share", "sd_qty", "one_flag", "sum_price_x2",
]
# without the constant and the exact double of another feature
CUSTOMER_CORE = [f for f in CUSTOMER_FEATURES if f not in ("one_flag", "sum_price_x2")]
DOCUMENT_FEATURES = ["n_chars", "n_digit", "n_upper", "n_punct", "n_space", "n_nl"]
EMBEDDING_DIM = 64
EMBEDDING_FEATURES = [f"e{i}" for i in range(EMBEDDING_DIM)]


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer.

    Lines are summed per order before the join and orders per customer after it, so each shuffle
    carries partial sums and a customer with a third of all orders stays one row per map task.
    """
    lines = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("q"),
        F.sum(F.col("l_quantity") * F.col("l_quantity")).alias("qq"),
        F.sum("l_extendedprice").alias("p"),
        F.max("l_extendedprice").alias("p_max"),
        F.sum("l_discount").alias("d"),
        F.sum("l_tax").alias("t"),
        F.count_if(F.col("l_returnflag") == "R").alias("r"),
    )
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    per_customer = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            *[F.sum(c).alias(c) for c in ("n", "q", "qq", "p", "d", "t", "r")],
            F.max("p_max").alias("p_max"),
            F.sum(F.when(F.col("o_orderstatus") == "F", F.col("n"))).alias("f"),
        )
    )
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    joined = customer.join(per_customer, customer.c_custkey == per_customer.o_custkey, "left")

    n, q = F.col("n"), F.col("q")

    def per_line(c: str):
        return F.coalesce(F.col(c) / n, F.lit(0.0))

    spread = F.greatest(F.col("qq") - q * q / n, F.lit(0.0)) / (n - 1)
    return joined.select(
        F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") < 0).cast("int").alias("label"),
        F.col("c_mktsegment").alias("grp"),
        F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(q, F.lit(0.0)).alias("sum_qty"),
        F.coalesce("p", F.lit(0.0)).alias("sum_price"),
        F.coalesce("p_max", F.lit(0.0)).alias("max_price"),
        per_line("d").alias("avg_disc"),
        per_line("t").alias("avg_tax"),
        per_line("r").alias("ret_share"),
        per_line("f").alias("done_share"),
        F.when(n > 1, F.sqrt(spread)).otherwise(F.lit(0.0)).alias("sd_qty"),
        F.lit(1).alias("one_flag"),
        (2 * F.coalesce("p", F.lit(0.0))).alias("sum_price_x2"),
    )


def document_features(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    """Character-class counts over the whole text: one row per labelled document, or per document with a null label.

    The counts are taken below the join, so the shuffle carries six numbers per document, not texts.
    """
    text = F.col("text")

    def count_of(pattern: str):
        return F.regexp_count(text, F.lit(pattern)).cast("bigint")

    documents = read_table(spark, folder, "documents").select(
        "doc_id",
        F.col("lang").alias("grp"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        count_of("[0-9]").alias("n_digit"),
        count_of("[A-Z]").alias("n_upper"),
        count_of("[.,;:!?]").alias("n_punct"),
        count_of(" ").alias("n_space"),
        count_of("\n").alias("n_nl"),
    )
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    return documents.join(labels, "doc_id", "inner" if labelled else "left").select(
        F.col("doc_id").alias("id"), F.col("label").cast("int").alias("label"), "grp", *DOCUMENT_FEATURES
    )


def embedding_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per vector; the ten vector classes are the segments, class 9 is the rare outcome."""
    return read_table(spark, folder, "embeddings").selectExpr(
        "vec_id AS id",
        "cast(label as int) AS cluster",
        "cast(label = 9 as int) AS label",
        *[f"cast(embedding[{i}] as double) AS {f}" for i, f in enumerate(EMBEDDING_FEATURES)],
    )
