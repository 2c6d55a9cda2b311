"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file (base64 token and rank a line); a parameter of every operator that counts tokens. Never copied here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How a byte-level BPE of this kind cuts text before merging. Fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``df(doc_id, text, ...)`` with n_tokens instead of text. Null and empty texts have 0 tokens; a marker of a special
    token in a text counts as ordinary text."""
    others = [f for f in df.schema.fields if f.name not in ("text", "n_tokens")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoding(vocabulary)
        for batch in batches:
            sizes = [len(own.encode_ordinary(t)) if t else 0 for t in batch.pop("text")]
            yield batch.assign(n_tokens=sizes)

    columns = [f.name for f in others]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others) + ", n_tokens long"
    return df.select(*columns, F.col("text")).mapInPandas(run, schema)
