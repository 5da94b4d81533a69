"""Token counts by byte-pair merging, without making the tokens."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, text_of

# Pieces of text whose count one worker remembers; emptied when full.
REMEMBERED = 300_000

BLANK = "▁"  # stands for a space in the vocabulary


class MergeCounter(dict):
    """Counts the tokens of a text for a byte-pair model of the sentencepiece kind.

    A piece of text starts as a linked list of its characters. A heap holds the rank of every
    adjacent pair that is in the vocabulary; the lowest rank, leftmost first, is popped and
    merged, and the merged symbol's two new pairs are pushed. Pairs whose symbols have
    changed since are skipped. The count is the number of characters less the merges; a
    character that is not in the vocabulary can't merge and counts its UTF-8 bytes.

    No merge crosses two characters that stand side by side in no vocabulary entry, so a
    text is cut there, and the counts of pieces are added up and remembered.
    """

    def __init__(self, path: str):
        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = {
            model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.rank = entries
        self.single = {c for c in entries if len(c) == 1}
        self.beside = {entry[i:i + 2] for entry in entries for i in range(len(entry) - 1)}
        self.parts: dict[str, int] = {}

    def __call__(self, text: str) -> int:
        """The text is cut at its spaces, which only begin entries unless they are all spaces."""
        if not text:
            return 0
        words = text.split(" ")
        if "" in words or BLANK in text:
            return self.pieces(BLANK + text.replace(" ", BLANK))
        return sum(map(self.__getitem__, words))

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self.pieces(BLANK + word)
        if len(word) <= 64:
            self[word] = count
        return count

    def pieces(self, text: str) -> int:
        beside, parts, total, start = self.beside, self.parts, 0, 0
        for i in range(1, len(text) + 1):
            if i == len(text) or text[i - 1:i + 1] not in beside:
                part = text[start:i]
                count = parts.get(part)
                if count is None:
                    if len(parts) >= REMEMBERED:
                        parts.clear()
                    count = self.merged(part)
                    if len(part) <= 64:
                        parts[part] = count
                total += count
                start = i
        return total

    def merged(self, text: str) -> int:
        n = len(text)
        if n == 1:
            return 1 if text in self.single else len(text.encode())
        rank = self.rank.get
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        end = list(range(1, n + 1))  # a symbol is text[i:end[i]]; a merged-away one ends at 0
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(text[i:i + 2])) is not None]
        heapify(heap)
        count = n
        while heap:
            _, i, stop = heappop(heap)
            j = after[i]
            if not end[i] or j >= n or end[j] != stop:
                continue  # one of the two has merged since
            end[i], end[j] = stop, 0
            k = after[i] = after[j]
            count -= 1
            if k < n:
                before[k] = i
                if (r := rank(text[i:end[k]])) is not None:
                    heappush(heap, (r, i, end[k]))
            if (h := before[i]) >= 0 and (r := rank(text[h:stop])) is not None:
                heappush(heap, (r, h, stop))
        return count


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One per worker process, kept between tasks."""
    return MergeCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text, without begin or end tokens.

    A null or empty text has no bytes and no tokens. Null doc_ids are kept; rows with the
    same doc_id, and equal rows, are counted each for itself. An empty table gives no rows.
    Other columns are not read. There is no shuffle.
    """
    prepare(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            n = pa.array([count(text) for text in batch.column("text").to_pylist()], pa.int64())
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), n],
                                  ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text_of()).cast("long").alias("n_bytes"),
        text_of().alias("text"),
    ).mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
