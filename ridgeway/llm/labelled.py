"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import held_out


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, label: str = "quality", doc_id: str = "doc_id"
) -> DataFrame:
    """Columns (doc_id, text, label) of about ``rows`` documents whose labels may be learnt from.

    Ids are taken by a hash of the id, at a rate from their exact number, so the sample
    is the same in every run and at most a little over ``rows`` (Poisson). The ids taken
    are broadcast: their number is bounded by that parameter. Labels of held-out
    documents, null ids and null labels are not used; of several labels of an id the
    least counts, and of several documents of an id one.
    """
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label is not null")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    rate = min(1.0, rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(rate * (1 << 32)))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
