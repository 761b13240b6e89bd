"""Cut Arrow text batches into slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession

# Characters handled at once by the NumPy code; a longer text is a slice of its own.
SLICE_CHARS = 1 << 18

# Rows and bytes of an Arrow batch of texts.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Have the session send whole texts to Python in batches of bounded size.

    The default of 10,000 rows is made for numbers; of long texts it is gigabytes.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(texts: Iterable[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Lists of texts with about ``chars`` characters in each, in order; NULL becomes the empty text."""
    held: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
