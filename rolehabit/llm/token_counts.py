"""Token counts of whole texts, huge ones in overlapping chunks.

Method: overlap resynchronisation.  A text beyond ``chunk_chars`` is cut into chunks
that overlap.  Every chunk is encoded with the byte offset of each of its tokens, and
two neighbours are spliced at a place both have as a token boundary and that no
context can move.  Where an overlap holds no such place it is widened, at last to the
end of the text, so the count is always that of the whole text.

A place is stable if a letter stands before it and white space or closing punctuation
after it: in the pre-tokenizer's pattern a letter is followed, within one match, by
letters only, so every match that holds the letter ends there whatever stands around,
and a match begins there whose extent depends on what follows alone.  The only
special string holds none of the characters in question.

The counts are those of the ``tokenizers`` library for the vocabulary named.  The
encoder that is run is ``tiktoken`` over the same vocabulary and merge ranks, four
times as fast; tests hold one to the other.  What it cannot match (about a million white-space
characters in a row) is encoded by the library itself.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession

from rolehabit.llm.common import map_batches, query, table

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
#: What may stand behind a letter at a stable place.
CLOSERS = frozenset(" \n.,;:!?、。，！？")


class Encoder:
    """Token ids and token lengths of a byte-level vocabulary in rank form."""

    def __init__(self, ranks_path: str, special: dict[str, int], library_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.special, self.library_path = special, library_path
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        lengths = {b: len(a) for a, b in ranks.items()} | {b: len(a) for a, b in special.items()}
        self.lengths = np.zeros(max(lengths) + 1, np.int64)
        self.lengths[list(lengths)] = list(lengths.values())

    @cached_property
    def library(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_file(self.library_path)

    def ids(self, text: str) -> list[int]:
        try:
            return self.encoding.encode(text, allowed_special="all")
        except ValueError:  # its pattern backtracks beyond its stack
            return self.library.encode(text, add_special_tokens=False).ids

    def ends(self, text: str) -> np.ndarray:
        """Byte offset behind each token of the text."""
        return np.cumsum(self.lengths[self.ids(text)])


@cache
def encoder(vocabulary: str = "byte_bpe_50k.tiktoken", special: str = "<|endoftext|>", special_id: int = 50256) -> Encoder:
    library = f"{vocabulary.removesuffix('.tiktoken')}.json"
    return Encoder(public_tokenizers.path(vocabulary), {special: special_id}, public_tokenizers.path(library))


def stable_places(text: str, start: int, stop: int) -> Iterator[int]:
    """Places from start to stop whose boundary holds in every context, from the middle on."""
    middle = (start + stop) // 2
    for place in [*range(middle, stop), *range(start + 1, middle)]:
        if 0 < place < len(text) and text[place] in CLOSERS and text[place - 1].isalpha():
            yield place


def count_in_chunks(text: str, coder: Encoder, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of the whole text; at most about chunk + overlap characters are encoded at once."""
    total = 0
    start = 0  # all tokens before it are counted; a stable place, or the beginning
    while True:
        wide = overlap
        while True:
            cut = start + chunk
            stop = min(len(text), cut + wide)
            left = coder.ends(text[start:stop])
            if stop == len(text):
                return total + len(left)
            spliced = _splice(text, coder, start, cut, stop, left)
            if spliced is not None:
                break
            wide *= 2
        start, counted = spliced
        total += counted


def _splice(text: str, coder: Encoder, start: int, cut: int, stop: int, left: np.ndarray) -> tuple[int, int] | None:
    """A stable place in the overlap that is a boundary of both chunks, and the tokens before it."""
    # the next chunk begins at the cut, wherever that falls
    right = None
    for place in stable_places(text, cut, stop):
        at = len(text[start:place].encode())
        k = int(np.searchsorted(left, at))
        if k == len(left) or left[k] != at:
            continue
        if right is None:
            right = coder.ends(text[cut:stop])
        behind = len(text[cut:place].encode())
        j = int(np.searchsorted(right, behind))
        if j < len(right) and right[j] == behind:
            return place, k + 1
    return None


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens.  Repeated rows and null keys keep
    one row each; other columns are left behind, so their names cannot clash; an empty
    table gives an empty one.  One pass without a shuffle.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder()
        for batch in rows:
            sizes, counts = [], []
            for value in batch.column(1):
                content = value.as_py() or ""
                sizes.append(len(content.encode()))
                if len(content) <= CHUNK_CHARS:
                    counts.append(len(coder.ids(content)))
                else:
                    counts.append(count_in_chunks(content, coder))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                [key, "n_bytes", "n_tokens", "over_limit"],
            )

    return map_batches(
        docs.select(key, text), batches, f"`{key}` {key_type}, n_bytes long, n_tokens long, over_limit boolean"
    )


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
