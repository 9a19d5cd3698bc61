"""Token counts by a compiled finite-state tokenizer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.scan import release, slices
from pairmill.llm.transducer import TEXT_BYTES, texts_of, transducer
from pairmill.llm.vocabulary import broadcast_vocabulary
from pairmill.session import ship_package


def token_counts(
    documents: DataFrame, vocabulary_path: str, limit: int = 2048, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit), one per input row.

    Counts equal those of the vocabulary's own library without begin, end or added tokens. Null
    and empty texts have no bytes and no tokens, repeated rows are counted each, an empty table
    gives an empty table, other columns are not read. Memory holds one slice of texts and one
    machine per worker; a text of any length is cut into chunks.
    """
    spark = documents.sparkSession
    ship_package(spark)
    shared = broadcast_vocabulary(spark, vocabulary_path)
    source = documents.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text")
    )
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches):
        machine = transducer(shared.value)
        for batch in batches:
            for part in slices(batch.column(1), TEXT_BYTES, tidy=False):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.size),
                        pa.array(np.diff(part.bounds)),
                        pa.array(machine.count(texts_of(part))),
                    ],
                    names=["_id", "n_bytes", "n_tokens"],
                )
        release()

    counted = source.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed(
        "_id", id_column
    )
