"""Token counts: the tokenizer runs in Arrow functions that return lengths only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import slices
from .sentencepieces import PieceModel


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: the tokens of every whole text under the sentencepiece model at ``model``.

    One row per row of ``docs``, in any number and with any ids, also null and
    repeated ones. A null text counts as empty: 0 bytes, 0 tokens. Batches are
    sliced by bytes; the texts of a slice are cut where no token can lie across,
    their distinct pieces are given to the library in one call, and the numbers of
    tokens are added up per text. An unbroken run without spaces or signs stays
    one piece. Further columns of ``docs`` are not read. Nothing is shuffled.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def lengths(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        counter = PieceModel(model)
        for batch in batches:
            for first, texts in slices(batch):
                columns = [batch.column("doc_id").slice(first, len(texts)), pc.binary_length(texts).cast(pa.int64()), pa.array(counter.counts(texts))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    counted = narrow.mapInArrow(lengths, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
