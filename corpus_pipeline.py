"""From raw documents to tokens: quality, near-duplicates, secrets, mixing, tokens.

Each stage takes the rows that the one before kept. ``run`` writes every stage to the
shared folder and goes on from the written table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.functions.workspace import stored
from opsledger.llm import jaccard, mixing, pieces, quality, secret_scan
from opsledger.llm.ship import ship

#: The classifier's weights come from training, which SQL cannot express.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return jaccard.one_of_each_group(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    ship(spark)
    size = "n_chars" if "n_chars" in docs.columns else None
    return secret_scan.mask_secrets(docs, secret_scan.fit(docs), size=size)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship(spark)
    return mixing.mixed_rows(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to the text again."""
    ship(spark)
    path = pieces.default_model()
    coded = pieces.encode_and_decode(docs.select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    sf_dir = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
