"""Byte-level BPE encoding and decoding as a tree reduction.

Encodings of neighbouring stretches can be joined, whatever they are, so a text is
encoded by halves:

* A text longer than ``TEXT_LEAF`` characters is cut in the middle, anywhere. The halves'
  matches of the splitting pattern are joined by matching a window around the cut again.
  A match depends only on the text from its start to at most two characters behind its
  end (three behind its start, for contractions), so a match of the left half that ends
  before that horizon stands; and once a match of the window ends where a match of the
  right half ends, all later ones stand. Until then the window grows.
* A match longer than ``PIECE_LEAF`` bytes is cut in the middle too. The halves' tokens
  are joined by encoding a window of the tokens next to the cut again. A sequence of
  tokens is the encoding of its bytes exactly if each two neighbours are the encoding of
  theirs, so the tokens outside stand once the pairs at both ends of the window do;
  until then the window doubles.

Decoding joins the bytes of halves. Rows need nothing from each other: there is no
shuffle, and a task holds one Arrow batch of texts.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.llm.common import col, own_name

TEXT_LEAF = 8192
PIECE_LEAF = 64
KNOWN = 200_000  # matches whose tokens a worker remembers
ROWS = 256  # rows in an output batch


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Coder(dict):
    """Tokens of matches of the pattern, worked out when first asked for."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.pattern = regex.compile(pattern)
        self.pairs: dict[tuple[int, int], bool] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= KNOWN:
            self.clear()
        out = self[piece] = tuple(self.piece(piece.encode()))
        return out

    # Bytes of one match.

    def merged(self, b: bytes) -> list[int]:
        """Tokens by merging the two neighbours of the lowest rank, the first of equals, while there are any."""
        if len(b) > PIECE_LEAF:
            return self.merged_by_heap(b)
        ranks = self.ranks
        parts = [b[i : i + 1] for i in range(len(b))]
        costs = [ranks.get(b[i : i + 2], 1 << 60) for i in range(len(b) - 1)]
        while costs:
            low = min(costs)
            if low == 1 << 60:
                break
            i = costs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
            if i < len(costs):
                costs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
        return [ranks[p] for p in parts]

    def merged_by_heap(self, b: bytes) -> list[int]:
        ranks = self.ranks
        part: list[bytes | None] = [b[i : i + 1] for i in range(len(b))]
        after, prior = list(range(1, len(b) + 1)), list(range(-1, len(b) - 1))
        heap = [(r, i, 2) for i in range(len(b) - 1) if (r := ranks.get(b[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= len(b) or len(part[i]) + len(part[j]) != size:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[j] < len(b):
                prior[after[j]] = i
            for x, y in ((prior[i], i), (i, after[i])):
                if x >= 0 and y < len(b) and (r := ranks.get(part[x] + part[y])) is not None:
                    heapq.heappush(heap, (r, x, len(part[x]) + len(part[y])))
        return [ranks[p] for p in part if p is not None]

    def stands(self, a: int, b: int) -> bool:
        """Whether the two tokens are the encoding of their bytes."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= KNOWN:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return ok

    def piece(self, b: bytes) -> list[int]:
        whole = self.ranks.get(b)
        return [whole] if whole is not None else self.halves(b)

    def halves(self, b: bytes) -> list[int]:
        if len(b) <= PIECE_LEAF:
            return self.merged(b)
        cut = len(b) // 2
        return self.join(self.halves(b[:cut]), self.halves(b[cut:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        wide = 2
        while True:
            a, c = left[-wide:], right[:wide]
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, a + c)))
            firm = len(a) == len(left) or self.stands(left[-wide - 1], window[0])
            if firm and (len(c) == len(right) or self.stands(window[-1], right[wide])):
                return left[: len(left) - len(a)] + window + right[len(c) :]
            wide *= 2

    # Matches of a text.

    def split(self, text: str) -> list[str]:
        if len(text) <= TEXT_LEAF:
            return self.pattern.findall(text)
        cut = len(text) // 2
        return self.join_splits(self.split(text[:cut]), self.split(text[cut:]))

    def join_splits(self, left: list[str], right: list[str]) -> list[str]:
        # Matches of the left that could look past its end; `behind`: characters from a match's end to the left's.
        keep, behind = len(left), 0
        for at in range(len(left) - 1, -1, -1):
            size = len(left[at])
            if behind >= 2 and behind + size >= 3:
                break
            keep, behind = at, behind + size
        head = "".join(left[keep:])
        wide = 4
        while wide < len(right):
            window = head + "".join(right[:wide])
            ends, at = {}, len(head)
            for i, piece in enumerate(right[:wide], 1):
                at += len(piece)
                ends[at] = i
            new, at = [], 0
            for piece in self.pattern.findall(window):
                start, at = at, at + len(piece)
                if max(at + 2, start + 3) > len(window):
                    break
                new.append(piece)
                if at in ends:
                    return left[:keep] + new + right[ends[at] :]
            wide *= 2
        return left[:keep] + self.pattern.findall(head + "".join(right))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= TEXT_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        cut = len(ids) // 2
        return self.decode(ids[:cut]) + self.decode(ids[cut:])


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(read_ranks(path), pattern)


def encode(df: DataFrame, text: str = "text", ids: str = "token_ids", ranks: str | None = None, pattern: str | None = None):
    """``df`` with the array ``ids`` of the whole text's tokens; a null text is empty.

    ``ranks``: a file of tokens and ranks that every executor can open. Special tokens
    are ordinary text. Columns named ``ids`` are replaced.
    """
    ranks, pattern = ranks or default_ranks(), pattern or default_pattern()
    taken = own_name(df, "whole")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks, pattern)
        for whole in it:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [np.array(bpe.encode(t or ""), np.int32) for t in batch.column(taken).to_pylist()]
                offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
                flat = np.concatenate(found) if found else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                names = [n for n in batch.schema.names if n != taken]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), lists], [*names, ids])

    rest = df.drop(ids)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    schema = f"{fields}, `{ids}` array<int>" if fields else f"`{ids}` array<int>"
    return df.withColumn(taken, col(text)).drop(ids).mapInArrow(batches, schema)


def decode(df: DataFrame, ids: str = "token_ids", out: str = "decoded", ranks: str | None = None) -> DataFrame:
    """``df`` with the binary ``out``: the bytes of the token ids (null: empty)."""
    ranks, pattern = ranks or default_ranks(), default_pattern()

    @F.pandas_udf("binary")
    def to_bytes(column: pd.Series) -> pd.Series:
        bpe = coder(ranks, pattern)
        return pd.Series([bpe.decode([] if x is None else x.tolist()) for x in column], dtype=object)

    return df.withColumn(out, to_bytes(col(ids)))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its id, number of tokens, digest of the ids and of the bytes they decode to.

    A null text is empty and has no tokens; repeated rows give equal rows; an empty table
    gives an empty result. A text of any length is encoded whole, in halves. Of equal
    ranks the leftmost pair is joined first. Further columns play no part.
    """
    rows = encode(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")))
    rows = decode(rows.drop("text"))
    return rows.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
