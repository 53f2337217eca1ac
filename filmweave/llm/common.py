"""Helpers of the training-data operators: sampling, slices of Arrow texts, words as codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels no model may learn from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, ``whole``: what an operator adds beside it can't clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lowest_hash(ids: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """At most ``count`` rows: those whose key hashes lowest. The same rows at every run; no full sort."""
    return ids.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(count)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Parts of ``texts`` of at most ``most`` bytes, a longer single text as its own part, nulls as empty texts."""
    if pa.types.is_dictionary(texts.type):
        texts = texts.dictionary_decode()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def by_slices(run, texts: pa.Array, kind: pa.DataType) -> pa.Array:
    """``run`` over each slice, joined to one array of ``kind``."""
    parts = [pa.array(run(part), type=kind) for part in slices(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], type=kind)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lower-cased words between whitespace: a code for each word in order, where each text starts, the words by code."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    starts = split.offsets.to_numpy().astype(np.int64)
    flat = split.values.slice(starts[0], starts[-1] - starts[0])
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts - starts[0], coded.dictionary


def per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]
