"""Problem 8: encoding a whole corpus with a public byte-level BPE vocabulary.

Method: prefix-sharing trie traversal. The distinct words of a task go into a trie of bytes. Going down the trie, each
prefix gets one state, its last token: the one vocabulary token that ends the prefix and can stand beside the last token
of what is left before it. A prefix shared by many words is worked out once, and a word's ids are read back along its
last tokens. Two tokens can stand side by side if merging their joined bytes by rank gives them back; those answers are
kept for the life of a worker.

No row moves: a task encodes its own documents, and its trie grows with the distinct words it meets, up to
``TRIE_NODES`` nodes of some 300 bytes each (0.3 GB a worker), when it starts afresh with nothing lost but work. The rank
file is read by the driver and broadcast, so that no other machine needs it; it is refused beyond ``MOST_BYTES``.

Defined cases: null, empty and blank texts: null and empty give [], blank text is encoded as the white space it is; the
strings of special tokens are ordinary text; a repeated row gives a repeated result row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

TOKENIZERS = "/opt/tokenizers"
TRIE_NODES = 1_000_000
#: of a rank file; those of public vocabularies have one to four million
MOST_BYTES = 64_000_000
#: answers of pairs kept, of some 100 bytes each
MOST_PAIRS = 2_000_000
#: the split of the public byte-level vocabularies: a fixed value
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TrieEncoder:
    """Encodes words by last-token states along a trie of their bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        # the tokens that end a prefix, longest first, are found by walking a trie of reversed tokens
        self.tails: list[dict[int, int]] = [{}]
        self.tail_id: list[int] = [-1]
        for token, i in ranks.items():
            at = 0
            for b in reversed(token):
                to = self.tails[at].get(b)
                if to is None:
                    to = self.tails[at][b] = len(self.tails)
                    self.tails.append({})
                    self.tail_id.append(-1)
                at = to
            self.tail_id[at] = i
        self.beside: dict[int, bool] = {}
        self.size = len(ranks) + 1
        self.clear()

    def clear(self) -> None:
        self.child: list[dict[int, int]] = [{}]
        self.last: list[int] = [-1]
        self.before: list[int] = [-1]

    def _merged(self, data: bytes) -> list[bytes]:
        """``data`` merged pair by pair in order of rank; only ever two tokens long."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _can_stand(self, a: int, b: int) -> bool:
        key = a * self.size + b
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) > MOST_PAIRS:
                self.beside.clear()
            x, y = self.bytes_of[a], self.bytes_of[b]
            known = self.beside[key] = self._merged(x + y) == [x, y]
        return known

    def encode(self, word: bytes) -> list[int]:
        """The ids of ``word``; prefixes that an earlier word had are not worked out again."""
        child, last, before, path = self.child, self.last, self.before, [0]
        at = 0
        for n, b in enumerate(word, 1):
            to = child[at].get(b)
            if to is None:
                to = child[at][b] = len(child)
                child.append({})
                tail, choices = 0, []
                for k in range(n - 1, max(-1, n - 1 - self.longest), -1):
                    tail = self.tails[tail].get(word[k], -1)
                    if tail < 0:
                        break
                    if self.tail_id[tail] >= 0:
                        choices.append((self.tail_id[tail], k))
                token, start = choices[0] if len(choices) == 1 else next((t, k) for t, k in reversed(choices) if (k == 0 and len(self._merged(word[:n])) == 1) or (k > 0 and self._can_stand(last[path[k]], t)))
                last.append(token)
                before.append(path[start])
            at = to
            path.append(at)
        out = []
        while at:
            out.append(last[at])
            at = before[at]
        return out[::-1]


_ENCODERS: dict[bytes, TrieEncoder] = {}


def encoder(content: bytes) -> TrieEncoder:
    """The encoder of a rank file's content (base64 token and rank a line), one for each worker process."""
    key = hashlib.sha256(content).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = TrieEncoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())})
    return _ENCODERS[key]


def encode_batches(batches: Iterator, content: bytes) -> Iterator:
    """Arrow batches (doc_id, text) -> (doc_id, ids)."""
    from itertools import chain

    import pyarrow as pa
    import regex

    enc, find = encoder(content), regex.compile(PATTERN).findall
    ids_of: dict[str, list[int]] = {}
    for batch in batches:
        lists = []
        for text in batch.column(1).to_pylist():
            if not text:
                lists.append([])
                continue
            words = find(text)
            try:
                lists.append([ids_of[w] for w in words])
            except KeyError:
                for w in words:
                    if w not in ids_of:
                        ids_of[w] = enc.encode(w.encode("utf-8"))
                lists.append([ids_of[w] for w in words])
            if len(enc.child) > TRIE_NODES:
                enc.clear()
                ids_of.clear()
        flat = [list(chain.from_iterable(x)) for x in lists]
        offsets = np.zeros(len(flat) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in flat], out=offsets[1:])
        values = np.fromiter(chain.from_iterable(flat), dtype=np.int32, count=int(offsets[-1]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "ids"])


def encode_corpus(documents: DataFrame, tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """documents(doc_id, text) -> (doc_id, ids), ids being the tokens of the whole text."""
    with open(f"{tokenizers}/{name}.tiktoken", "rb") as f:
        content = f.read(MOST_BYTES + 1)
    if len(content) > MOST_BYTES:
        raise ValueError(f"the rank file has more than {MOST_BYTES} bytes")
    ranks = documents.sparkSession.sparkContext.broadcast(content)
    return documents.select("doc_id", "text").mapInArrow(lambda batches: encode_batches(batches, ranks.value), "doc_id long, ids array<int>")
