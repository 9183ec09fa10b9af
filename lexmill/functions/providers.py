"""Outside services as columns: embeddings and answers come from a function over batches of texts.

A provider is called with a list of texts and gives as many results. The ones here need no network: they serve tests and
stand in for real services.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Provider = Callable[[list[str]], list]


def hashed_embedding(dim: int = 64) -> Provider:
    """Unit vectors of the texts' hashed words: like texts get like vectors."""

    def embed(texts: list[str]) -> list:
        import xxhash

        out = []
        for t in texts:
            v = np.zeros(dim, dtype=np.float32)
            for w in t.lower().split():
                h = xxhash.xxh3_64_intdigest(w)
                v[h % dim] += 1.0 if h >> 32 & 1 else -1.0
            n = float(np.linalg.norm(v))
            out.append((v / n if n else v).tolist())
        return out

    return embed


def _called(provider: Provider, kind: str, batch: int):
    @F.pandas_udf(kind)
    def call(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = [None] * len(texts)
            asked = [i for i, t in enumerate(texts) if t is not None and t.strip()]
            for b in range(0, len(asked), batch):
                at = asked[b : b + batch]
                got = provider([texts.iloc[i] for i in at])
                if len(got) != len(at):
                    raise ValueError(f"the provider gave {len(got)} results for {len(at)} texts")
                for i, x in zip(at, got, strict=True):
                    out[i] = x
            yield pd.Series(out, dtype=object)

    return call


def with_embeddings(rows: DataFrame, text: str, provider: Provider, to: str = "embedding", batch: int = 100) -> DataFrame:
    """``rows`` with the vectors that are missing; null and blank texts keep none."""
    made = _called(provider, "array<float>", batch)(F.col(text))
    if to not in rows.columns:
        return rows.withColumn(to, made)
    # only rows without a vector go to the provider
    todo = rows.where(F.col(to).isNull()).withColumn(to, made)
    return rows.where(F.col(to).isNotNull()).unionByName(todo)


def with_answers(rows: DataFrame, text: str, provider: Provider, to: str = "answer", batch: int = 20) -> DataFrame:
    """``rows`` with a provider's answers as text."""
    return rows.withColumn(to, _called(provider, "string", batch)(F.col(text)))


def unicode_folded(text: Column) -> Column:
    """Compatibility composition (NFKC), which the built-in functions lack."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    return fold(text)
