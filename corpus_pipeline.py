"""Documents to training sequences: toxic documents go, of near copies one stays, secrets are
blanked, and what is left is packed.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns
of documents. ``run`` writes each stage's rows and reads them again for the next one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm import jaccard_join, packing, secret_scan, toxicity
from cabmill.llm.common import Work, read, small_batches

#: Ids that may be broadcast (8 bytes each); beyond, Spark picks the join.
BROADCAST_ROWS = 1_000_000
_ROW = "_cabmill_row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on these and their labels, does not reject.

    A null text is scored as an empty one; rows are judged one by one, so repeated rows, and rows
    without an id, stay or go by their own text. Without labels of both classes all stay. Other
    columns pass unchanged, whatever their names.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model, keep=True)
    return scored.where("predicted = 0").select(*docs.columns)


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id, and of rows that repeat it one.

    Rows are told apart by a written key, so an id may have several texts. Rows without an id are
    no copies of rows with one; of theirs in a group one stays. Texts without words have no copies,
    but rows that repeat an id and such a text stay once.
    """
    with Work(spark, "near-copies") as work:
        keyed = work.write(docs.withColumn(_ROW, F.monotonically_increasing_id()), keep=True)
        groups = jaccard_join.jaccard_components(keyed.select(F.col(_ROW).alias("doc_id"), "text")).select(
            F.col("doc_id").alias(_ROW), F.col("component_id").alias("group")
        )
        blank = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True)) & F.col("doc_id").isNotNull()
        told = keyed.select(
            _ROW, F.col("doc_id").alias("id"), blank.alias("blank"),
            F.when(blank, F.sha2("text", 256)).alias("text"),
        )
        rows = work.write(groups.join(told, _ROW).select(
            _ROW, "id", F.when(~F.col("blank"), F.col("group")).alias("group"),
            F.col("id").isNull().alias("nameless"), F.when(F.col("blank"), F.col("id")).alias("blank_id"), "text",
        ))
        first = rows.groupBy("group", "nameless", "blank_id", "text").agg(F.min(F.struct("id", _ROW))[_ROW].alias(_ROW))
        gone = work.write(rows.select(_ROW).join(first, _ROW, "left_anti"), keep=True)
    return keyed.join(_small(gone), _ROW, "left_anti").select(*docs.columns)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret, and n_chars of the new text.

    A null text stays null, and n_chars changes only with the text. Rows are told apart by their
    texts alone, so ids may be null or repeated. Other columns pass unchanged.
    """
    with Work(spark, "blank") as work:
        found = secret_scan.blob_findings(work, docs.select("text"), work.path(keep=True))
    spans = found.where(F.size("spans") > 0).select(
        F.col("blob").alias("_cabmill_blob"), F.col("spans").alias("_cabmill_spans")
    )
    joined = docs.join(
        spans, secret_scan.blob_of(docs["text"]) == F.col("_cabmill_blob"), "left"
    )
    text = F.when(
        F.col("_cabmill_spans").isNull(), docs["text"]
    ).otherwise(secret_scan.redacted(docs["text"], F.col("_cabmill_spans")))
    return joined.withColumn("_cabmill_text", text).select(*(
        F.col("_cabmill_text").alias("text") if c == "text"
        else F.when(F.col("_cabmill_spans").isNull(), docs[c]).otherwise(F.length("_cabmill_text")).cast(t).alias(c)
        if c == "n_chars" else docs[c]
        for c, t in docs.dtypes
    ))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences; written here, as workers get texts in small batches."""
    import public_tokenizers

    with Work(spark, "pack") as work, small_batches(spark):
        return work.write(packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")), keep=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", blank_secrets),
    ("packing", pack),
]

# A fitted model decides what the first stage keeps; SQL can't restate it. The tests compare the
# pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    with Work(spark, "pipeline") as work:
        for i, (_, stage) in enumerate(STAGES):
            before, docs = docs, work.write(stage(spark, docs, sf_dir), keep=i == len(STAGES) - 1)
            work.drop(before)
    return docs
