"""Token counts of whole texts with a public tokenizer's own library.

Arrow batches are regrouped by size, their texts cut at safe boundaries, and the library encodes the
distinct segments in batches; only lengths leave the workers. Words repeat, so most segments of a
group have been met before, and their lengths are added up without encoding them again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Texts are cut and encoded in groups of about this many UTF-8 bytes.
BATCH_BYTES = 1_000_000
#: Lengths of so many segments are remembered by a worker; beyond that it starts anew.
REMEMBERED = 600_000

# Byte-level BPE splits a text before it merges. No part of that split runs from a character that is not
# white space on to one that is, nor from a letter or digit on to a punctuation mark. So a cut before a
# blank or line feed that follows other than white space, or before a mark that follows a Latin
# letter or digit, leaves all tokens as they are.
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n])|(?<=[A-Za-zÀ-ÖØ-öø-ÿ0-9])(?=[,.!?;:*#$%&])")


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a file of the `tokenizers` library, once per worker, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for token in tokenizer.get_added_tokens_decoder().values():
        if len(safe_segments(token.content)) > 1 or token.lstrip or token.rstrip:
            raise ValueError(f"a safe cut could change the added token {token.content!r}")
    return tokenizer


def safe_segments(text: str) -> list[str]:
    """Cut a text at every safe boundary; a stretch without one stays whole, however long."""
    return SAFE_CUT.split(text)


def utf8_size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def by_size(texts: list[str], budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts that hold at most `budget` UTF-8 bytes each, or one text."""
    start, size = 0, 0
    for row, text in enumerate(texts):
        own = utf8_size(text)
        if row > start and size + own > budget:
            yield start, row
            start, size = row, 0
        size += own
    if start < len(texts):
        yield start, len(texts)


class LengthCounter:
    """Token counts of texts, by the library's batch encoding of the segments not seen yet."""

    def __init__(self, tokenizer, remembered: int = REMEMBERED):
        self.tokenizer, self.remembered, self.known = tokenizer, remembered, {"": 0}

    def learn(self, segments: list[str], budget: int) -> None:
        for a, b in by_size(segments, budget):
            encoded = self.tokenizer.encode_batch_fast(segments[a:b], add_special_tokens=False)
            self.known.update(zip(segments[a:b], map(len, encoded)))

    def count(self, texts: list[str], budget: int = BATCH_BYTES) -> list[int]:
        counts = []
        for a, b in by_size(texts, budget):
            cut = [safe_segments(text) for text in texts[a:b]]
            if len(self.known) > self.remembered:
                self.known = {"": 0}
            new = set().union(*cut).difference(self.known)
            # Encodings hold ids and token strings, several times the text: a tenth at once is enough.
            self.learn(list(new), budget // 10)
            counts.extend(sum(map(self.known.__getitem__, segments)) for segments in cut)
        return counts


def token_counts(
    docs: DataFrame, tokenizer_file: str, limit: int = 1024, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit for every row of `docs`.

    Only lengths leave the Python workers. Null texts count as empty: no bytes, no tokens. Special
    strings inside a text are what the tokenizer takes them for by default; none are added. Repeated
    rows are counted each, ids may be null, other columns are ignored, and an empty table gives an
    empty result. `tokenizer_file` must exist under this path on every executor.
    """
    out = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
        ("over_limit", pa.bool_()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = LengthCounter(load_tokenizer(tokenizer_file))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tokens = counter.count(texts, batch_bytes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                schema=out,
            )

    plain = common.pick(docs, "doc_id", "text").selectExpr(
        "CAST(doc_id AS BIGINT) AS doc_id", "coalesce(text, '') AS text",
        "CAST(octet_length(coalesce(text, '')) AS BIGINT) AS n_bytes",
    )
    return common.in_arrow(plain, count, "doc_id BIGINT, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN")
