"""A pass over the texts of a table in Arrow batches, and the words and word windows of a text.

A word is a run of bytes other than space and 0x09-0x0D, which is what ``bytes.split()`` gives. Words are hashed
to 64 bits by XXH3; a window of words has a 64-bit hash made from those of its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

Texts = list[bytes | None]
Scan = Callable[[Texts], Sequence[pa.Array | Sequence]]

WINDOW_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that no word of a window loses bits
#: Texts that are Python objects at the same time, with what is made from them.
ROWS_AT_ONCE = 256


def fields(ddl: str) -> StructType:
    """``name type`` pairs as a schema."""
    return _parse_datatype_string(ddl)


def map_texts(docs: DataFrame, keep: Sequence[str], found: str | StructType, make: Callable[[], Scan]) -> DataFrame:
    """One row for each row of ``docs``: its columns ``keep``, then the columns ``found`` made from its text.

    ``make()`` runs once a task and returns a function that takes the texts of a batch, as UTF-8 or None, and
    returns a list or an Arrow array for each column of ``found``. Other columns of ``docs`` are not read. The
    names of ``found`` must not be among ``keep``.
    """
    found = fields(found) if isinstance(found, str) else found
    schema = StructType([*(docs.schema[c] for c in keep), *found.fields])
    types = _arrow_types(found)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make()
        for part in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            *kept, text = part.columns
            made = scan(text.cast(pa.binary()).to_pylist())
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], names)

    return docs.select(*keep, F.col("text").alias("_text_to_scan")).mapInArrow(run, schema)


def _arrow_types(schema: StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema.fields]


def free_prefix(df: DataFrame, stem: str) -> str:
    """A prefix that no column of ``df`` starts with."""
    while any(c.startswith(stem) for c in df.columns):
        stem += "_"
    return stem


def held_out(modulus: int, remainder: int, key: str = "doc_id"):
    """Whether a row is kept from learning: CRC-32 of its id as text. A row without id is learned from."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window of ``length`` words, by its first word. Doubled from the windows of half the length."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    if length == 1:
        return hashes
    half = length // 2
    halves = window_hashes(hashes, half)
    n = len(hashes) - length + 1
    out = halves[:n] * WINDOW_BASE**half + halves[half:half + n]
    return out if length == 2 * half else out * WINDOW_BASE + hashes[length - 1:]


def covered(starts: np.ndarray, length: int, n_words: int) -> np.ndarray:
    """Which of ``n_words`` words lie in a window of ``length`` words at one of ``starts``."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Leave the cluster's ``spark.checkpoint.dir`` as it is; a local session without one (tests) gets its own."""
    if spark.sparkContext.getCheckpointDir() is None:
        from telescale.session import shared_dir

        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))
