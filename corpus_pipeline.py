"""From raw documents to packed sequences: quality, lines, near duplicates, private data, packing.

``STAGES`` are run in order by ``run``: each is given all documents that the one before kept, its result is
written as Parquet to the shared folder and read again. All but the last return the columns of
``documents``; the last returns a row per piece with its sequence.

The stages bound the Arrow batches of their session by bytes, where it has no such limit of its own. It stays set, as the
frames that stages return do their work when they are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import line_dedup, near_dedup, packing, private_data, quality_model
from quayside.llm.common import table
from quayside.llm.queries import GOOD, SEPARATOR_ID, SEQUENCE, WORD_BPE
from quayside.session import materialize

#: Bytes of one Arrow batch, however long the texts. Buffers of this size are pooled by the JVM and used again; the large
#: ones of Spark's own limit (10,000 rows) are the system's, whose remains add up in an executor that runs all stages.
BATCH_BYTES = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _same_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """The columns of the documents; n_chars, where there is one, follows the text."""
    count = F.char_length("text").cast(before.schema["n_chars"].dataType) if "n_chars" in before.columns else None
    return after.select(*[count.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in before.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of ``GOOD`` and above; null and empty texts are scored like others."""
    labels = table(spark, sf_dir, "labels")
    # A score column of the documents' own stays theirs.
    labelled = docs.select("doc_id", "text").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    stats = materialize(quality_model.document_statistics(labelled), "statistics")
    model = quality_model.train(stats, labels)
    own = docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"own_{c}") for c in docs.columns])
    good = quality_model.score_documents(own, model).where(F.col("score") >= GOOD)
    return good.select(*[F.col(c if c in ("doc_id", "text") else f"`own_{c}`").alias(c) for c in docs.columns])


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three documents share; a document left without text stays, with an empty one."""
    own = docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"own_{c}") for c in docs.columns])
    cleaned = line_dedup.dedup_lines(own)
    back = cleaned.select(*[F.col(c if c in ("doc_id", "text") else f"`own_{c}`").alias(c) for c in docs.columns])
    return _same_columns(docs, back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 80 %)."""
    return near_dedup.deduplicated(docs, near_dedup.MinHash())


def remove_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced and disclosing terms generalised or removed."""
    return _same_columns(docs, private_data.sanitise(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with the sequence and offset where each lies."""
    return packing.pack_documents(docs.select("doc_id", "text"), WORD_BPE, SEQUENCE, SEPARATOR_ID)


def _bounded(stage: Callable) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in a session whose Arrow batches are bounded by bytes: ``BATCH_BYTES``, or its own limit."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_classifier", _bounded(keep_good)),
    ("line_dedup", _bounded(drop_shared_lines)),
    ("minhash_near_dedup", _bounded(drop_near_duplicates)),
    ("private_data", _bounded(remove_private_data)),
    ("best_fit_packing", _bounded(pack)),
]

#: SQL has no form of the classifier, MinHash, tokenizer or packing; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
