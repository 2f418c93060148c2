"""A corpus pipeline of five stages over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and is written and read
again before the next.  All but the last return the columns of ``documents``:
quality rules drop rejected documents, near duplicates leave the first document
of each group, personal data is masked, sources are mixed to target weights
(documents are repeated, cut or left out) and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm import mixing, ngram_join, packing, pii, quality
from tillworks.llm.common import settings, table
from tillworks.llm.queries import vocabulary
from tillworks.session import drop_folders, materialize, own, release, scratch


# The folders of intermediate tables that the stages have left, by stage.
_left: dict[str, list[str]] = {}


def owning(name: str, stage):
    """The stage, owner of its intermediate folders.

    Its result may read them until it has been written.  It has been when a later
    stage is called, which reads what was written: that call deletes them.
    """

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        settings(spark)
        for earlier in names[: names.index(name)]:
            drop_folders(spark, _left.get(earlier, []))
        with scratch(spark, delete=False) as made:
            result = stage(spark, docs, sf_dir)
        _left.setdefault(name, []).extend(made)
        return result

    return run


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null or empty text fails, rows without an id are judged like others."""
    return quality.judge_quality(docs, docs.columns).filter("_q_kept").select(docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a key of single rows: ids can be null or shared.  Written, so that it stays the same."""
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest id; rows without an id come last.

    Texts without words are near nothing and stay, as does an empty table.
    """
    rows = numbered(docs)
    joined = ngram_join.near_duplicates(rows, id_column="_row")
    own([joined._written_to])
    found = joined.select("_row", "component_id")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "_row")
    kept = (
        rows.select("_row", place.alias("_place")).join(found, "_row")
        .groupBy("component_id").agg(F.min("_place").alias("_first")).select(F.col("_first._row").alias("_row"))
    )
    return rows.join(kept, "_row", "left_semi").select(docs.columns)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, each span of personal data replaced by its kind; a null text stays null, ``n_chars`` follows."""
    masked = pii.redact(docs, pii.train(docs, "doc_id", "text"), "text")
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them, in the order of its schedule.

    Rows without words are never taken; rows that share an id, or have none, are
    taken each for itself; an empty table stays empty.
    """
    rows = numbered(docs)
    mixed = mixing.take_texts(rows, mixing.mix(rows, row="_row")[0], "_row", "text")
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, as ``op1_packing`` gives them; a null text is empty."""
    packed = packing.pack(docs, "doc_id", "text", vocabulary())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


names = ["quality", "near_duplicates", "private", "mix", "pack"]
STAGES = [
    (name, owning(name, stage))
    for name, stage in zip(names, (keep_quality, drop_near_duplicates, mask_private, mix_sources, pack_sequences), strict=True)
]

# Estimated rule accuracies, links and packing are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; only the folder of the result is left."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    for folders in _left.values():
        drop_folders(spark, folders)
    return docs
