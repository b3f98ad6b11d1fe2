"""Token counts of whole texts, huge ones by overlapping chunks that are spliced at stable boundaries.

A null or empty text has no tokens. Repeated rows are counted like any other; a text of any length is encoded
in chunks, so the memory beyond the text itself does not grow with it, unless it has no place to splice:
then the overlap, and at last the chunk, is widened until it has one or the text ends.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.llm.tokens import cuts_at_spaces, encoder

CHUNK = 1 << 15  # code points encoded at a time
OVERLAP = 1 << 9

# A space between two non-space characters: a piece always begins there (see tokens.py), so two encodings
# that both hold the three characters agree on everything that follows.
_STABLE = re.compile(r"(?<=\S) (?=\S)")


def count_spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of a byte-level tokenizer, from chunks whose borders are found again in the next one."""
    count = 0
    at = 0  # tokens before this place are counted
    begin, size, shared = 0, chunk, overlap
    starts, ends = _offsets(tokenizer, text, 0, size)
    while begin + size < len(text):
        end = begin + size
        following = max(end - shared, at)
        if following == at and at > 0 or following <= begin:
            # The overlap has reached the last splice: widen the chunk itself.
            size, shared = 2 * size, min(2 * shared, size)
            starts, ends = _offsets(tokenizer, text, begin, size)
            continue
        next_starts, next_ends = _offsets(tokenizer, text, following, chunk + shared)
        place = next(
            (m.start() for m in _STABLE.finditer(text, following + 1, end)
             if m.start() + 1 < end and _breaks(starts, ends, m.start()) and _breaks(next_starts, next_ends, m.start())),
            None,
        )
        if place is None:
            shared *= 2
            continue
        count += int(np.searchsorted(starts, place) - np.searchsorted(starts, at))
        at, begin, size, shared = place, following, chunk + shared, overlap
        starts, ends = next_starts, next_ends
    return count + len(starts) - int(np.searchsorted(starts, at))


def _offsets(tokenizer, text: str, begin: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    offsets = tokenizer.encode(text[begin : begin + size], add_special_tokens=False).offsets
    pairs = np.array(offsets, np.int64).reshape(-1, 2) + begin
    return pairs[:, 0], pairs[:, 1]


def _breaks(starts: np.ndarray, ends: np.ndarray, place: int) -> bool:
    """Whether a token begins at the space at ``place``; some tokenizers leave the space out of the offsets."""
    k = int(np.searchsorted(starts, place))
    return k < len(starts) and starts[k] <= place + 1 and (k == 0 or ends[k - 1] <= place)


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _counts(texts: list, path: str, chunk: int, overlap: int) -> np.ndarray:
    if path.endswith(".model"):
        return np.fromiter((len(x) for x in _pieces(path).encode([t or "" for t in texts], num_threads=1)), np.int64)
    own = encoder(path)
    long = {k for k, t in enumerate(texts) if t and len(t) > chunk} if cuts_at_spaces(path) else set()
    counts = own.encode([None if k in long else t for k, t in enumerate(texts)])[1]
    for k in long:
        counts[k] = count_spliced(own.tokenizer, texts[k], chunk, overlap)
    return counts


def token_count(text: Column | str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Number of tokens of each text by the tokenizer file: ``.json`` (tokenizers) or ``.model`` (sentencepiece).

    No begin, end or other tokens are added; special strings inside a text are handled as by the library's default.
    """

    def count(texts: pa.Array) -> pa.Array:
        return pa.array(_counts(texts.to_pylist(), path, chunk, overlap), pa.int64())

    return F.arrow_udf(count, "long")(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, bytes, tokens and whether the tokens exceed ``limit``."""
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text_col), path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
