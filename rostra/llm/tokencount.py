"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A task sorts the distinct pre-tokens it meets, which is a trie in depth-first order: a
pre-token continues from its common prefix with the one before. The forward score of a
prefix, the best of all ways to cut it into pieces, is computed when the walk enters its
node and shared by all pre-tokens below; the count at a terminal node is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from rostra.llm.common import append_columns, blocks, schema_with

# The mark before a word, and how much worse than the worst piece a
# character is that no piece covers.
MARK = "▁"
UNKNOWN = 10.0
# Pre-tokens that a task remembers.
_REMEMBERED = 500_000


def read_pieces(path: str) -> dict[str, float]:
    """Normal pieces of a SentencePiece model and their scores."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return {
        model.IdToPiece(i): model.GetScore(i)
        for i in range(model.GetPieceSize())
        if not (model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i))
    }


def trie_counts(words: list[str], pieces: dict[str, float]) -> dict[str, int]:
    """Number of tokens in the best cut of every word.

    The best cut has the largest sum of scores, then the fewest tokens. A character that
    is no piece stands for its UTF-8 bytes, one token each, with the score of an unknown.
    """
    longest = max(map(len, pieces), default=1)
    unknown = min(pieces.values(), default=0.0) - UNKNOWN
    found = {}
    scores, counts = [0.0], [0]
    path = ""
    for word in sorted(words):
        shared = 0
        for a, b in zip(path, word):
            if a != b:
                break
            shared += 1
        del scores[shared + 1 :], counts[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            best, fewest = None, 0
            for start in range(max(0, end - longest), end):
                score = pieces.get(word[start:end])
                if score is not None:
                    total, n = scores[start] + score, counts[start] + 1
                    if best is None or total > best or (total == best and n < fewest):
                        best, fewest = total, n
            if word[end - 1] not in pieces:
                total = scores[end - 1] + unknown
                n = counts[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                if best is None or total > best or (total == best and n < fewest):
                    best, fewest = total, n
            scores.append(best)
            counts.append(fewest)
        path = word
        found[word] = counts[-1]
    return found


def count_tokens(rows: DataFrame, pieces: dict[str, float], text: str = "text") -> DataFrame:
    """The rows with ``n_words`` and ``n_tokens``.

    A word is a run of characters other than ASCII white space and a token sequence of
    its own, with a mark in front. Null and empty texts, and those of white space alone,
    have 0 of both. Columns of these names are replaced, others passed on.
    """
    rows = rows.drop("n_words", "n_tokens")
    # A vocabulary has a fixed number of pieces, whatever the rows.
    shared = rows.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for block in blocks(batches, text):
            # Bytes are cut at ASCII white space alone, as the words are.
            cut = [(t or "").encode("utf-8", "surrogatepass").split() for t in block.column(text).to_pylist()]
            met = {word for words in cut for word in words}
            new = met - known.keys()
            if len(known) + len(new) > _REMEMBERED:
                known.clear()
                new = met
            marked = {MARK + word.decode("utf-8", "surrogatepass"): word for word in new}
            for word, n in trie_counts(list(marked), shared.value).items():
                known[marked[word]] = n
            yield append_columns(
                block,
                n_words=pa.array([len(words) for words in cut], pa.int64()),
                n_tokens=pa.array([sum(map(known.__getitem__, words)) for words in cut], pa.int64()),
            )

    return rows.mapInArrow(run, schema_with(rows, "n_words long", "n_tokens long"))
