"""What several of the text operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.session import ship_with_jobs, stage

TAG = "row_tag"
# further names that operators add to whole rows
RESERVED = ("row_epochs", "row_epoch")
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"
# texts handled at once in a Python worker
SLICE_BYTES = 4 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    only_ascii = F.length(text) == F.octet_length(text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACES)), F.lit(0)).cast("bigint")


def fold_of(id_column: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(folds).cast("bigint"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a unique ``row_tag``, for use by one job that stores what comes of it.

    Read again, rows may get other tags; ``tagged`` stores them.
    """
    return rows.withColumn(TAG, F.monotonically_increasing_id())


def tagged(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written once with a unique ``row_tag`` as last column.

    The tag tells repeated rows apart and stays the same however often the
    rows are read again. Columns that clash with it, with ``RESERVED`` names or
    with one another get underscores; ``untagged`` gives the names back.
    """
    seen: set[str] = {TAG, *RESERVED}
    names = []
    for column in docs.columns:
        new = column
        while new.lower() in seen:
            new += "_"
        seen.add(new.lower())
        names.append(new)
    return stage(docs.toDF(*names).withColumn(TAG, F.monotonically_increasing_id()), name)


def untagged(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``tagged(docs)`` without the tag, under the names of ``docs``."""
    return rows.drop(TAG).toDF(*docs.columns)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Consecutive parts of a batch with about ``limit`` bytes of text, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(lengths, dtype=np.int64) // limit
    starts = np.flatnonzero(np.diff(parts, prepend=-1)) if len(parts) else []
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def restored(kind: type, state: dict):
    """An object with the given ``vars``.

    Broadcasts are pickled by reference to their classes, which executors may
    lack; plain state goes out instead, and the class comes with the task.
    """
    made = object.__new__(kind)
    vars(made).update(state)
    return made


def word_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of every text in ASCII lower case, split at ASCII white space.

    Returns the words of all texts as codes, the distinct words they index,
    and the number of words of each text.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        words, owner = words.filter(pa.array(full)), owner[full]
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.bincount(owner, minlength=len(lists))


ship_with_jobs(__name__)
