"""Byte-level BPE by recursive queries.

Every task contracts the pre-tokens it meets in an in-process DuckDB: rows of
(word, position, token) join the merge table, and each round contracts the pairs
of least rank in every word, leftmost first, until no pair of a word merges.
Decoding is an ordered aggregate over (position, token) rows.

A text is cut into units, white space with the characters after it. A match of the
pattern never crosses from such characters into white space, so a unit can be
pre-tokenised by itself and its ids be reused wherever it occurs: texts are sequences of
numbers of units, and what is known of a unit is taken by its number.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rostra.llm.common import BLOCK_CHARS, append_columns, blocks, kept, schema_with

# Fixed value: Unicode white space, as the pattern's \s understands it.
_SPACE = "\t-\r \x85\xa0  -     　"
# Rounds of a query before its finished words are set aside.
_ROUNDS = 24
# Bytes that a worker remembers of units with their results, of words, and of runs of ids, each.
REMEMBERED = 160_000_000
# Bytes of an entry of a dictionary beside its key, about, and of words in one query.
_ENTRY, _PORTION = 150, 200_000
# Words of more bytes contract all occurrences of their least pair in a round.
_LONG = 48

_STATE = """
WITH RECURSIVE state AS (
  SELECT 0 AS round, word, pos, tok FROM start
  UNION ALL (
    WITH pairs AS MATERIALIZED (
      SELECT s.*, m.id
      FROM (SELECT *, lead(pos) OVER around AS after, tok::BIGINT << 32 | lead(tok) OVER around AS pair
            FROM state WINDOW around AS (PARTITION BY word ORDER BY pos)) s
      LEFT JOIN merges m USING (pair)),
    {contract}))
SELECT word, pos, tok, round
FROM state JOIN (SELECT word, max(round) AS round FROM state GROUP BY word) USING (word, round)
ORDER BY word, pos
"""
# The leftmost pair of least rank; positions stay dense, so the next token is at pos + 1.
_LEFTMOST = """
    least AS (SELECT word, min(id::BIGINT << 32 | pos) AS id FROM pairs GROUP BY word)
    SELECT round + 1, word, pos - (pos > hit)::INT, CASE WHEN pos = hit THEN joined ELSE tok END
    FROM pairs JOIN (SELECT word, (id & 4294967295)::INT AS hit, (id >> 32)::INT AS joined
                     FROM least WHERE id IS NOT NULL) USING (word)
    WHERE pos <> hit + 1 AND round < {rounds}
"""
# All occurrences of the least pair that do not overlap, taken from the left: in a
# stretch of adjoining occurrences every other one.
_EVERY = """
    least AS (SELECT word, min(id) AS id FROM pairs GROUP BY word HAVING min(id) IS NOT NULL),
    found AS (SELECT word, pos, after, sum((before IS DISTINCT FROM pos)::INT)
                OVER (PARTITION BY word ORDER BY pos) AS stretch
              FROM (SELECT word, pos, after, lag(after) OVER (PARTITION BY word ORDER BY pos) AS before
                    FROM pairs JOIN least USING (word, id))),
    hits AS (SELECT word, pos, after FROM found
             QUALIFY row_number() OVER (PARTITION BY word, stretch ORDER BY pos) % 2 = 1)
    SELECT p.round + 1, p.word, p.pos, CASE WHEN h.pos IS NULL THEN p.tok ELSE p.id END
    FROM pairs p SEMI JOIN least USING (word)
    LEFT JOIN hits h ON h.word = p.word AND h.pos = p.pos
    ANTI JOIN hits g ON g.word = p.word AND g.after = p.pos
    WHERE p.round < {rounds}
"""
_DECODE = """
SELECT run, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes FROM tokens JOIN vocabulary USING (id) GROUP BY run
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_rows(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """Every pair of tokens whose joined bytes are a token: (left, right, joined)."""
    rows = []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                rows.append((left, right, rank))
    return rows


def is_regular(ranks: dict[bytes, int]) -> bool:
    """Whether every token arises from its own bytes through lower ranks alone.

    Then a contraction never opens a pair of lower rank than its own: the bytes of
    such a pair would have been joined before. All occurrences of the least pair can
    be contracted in one round, with the same result as one after the other.
    """
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        last = -1
        while len(parts) > 1:
            found = [(ranks.get(a + b, -1), i) for i, (a, b) in enumerate(pairwise(parts))]
            least = min((f for f in found if f[0] >= 0), default=None)
            if least is None or least[0] < last:
                return False
            last, at = least
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(token) > 1 and last != rank:
            return False
    return True


class _Codes(dict):
    """Units numbered in the order in which they are met."""

    def __missing__(self, unit: str) -> int:
        self[unit] = code = len(self)
        return code


class _Memory(dict):
    """Results by key, forgotten all at once when they take more than ``limit`` bytes."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0

    def learn(self, items: Iterable[tuple]) -> None:
        for key, value in items:
            self[key] = value
            self.held += len(key) + len(value) + _ENTRY

    def make_room(self) -> None:
        if self.held > self.limit:
            self.clear()
            self.held = 0


def _joined(pool: pa.Array, codes: np.ndarray, ends: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """Bytes of the pool's values at ``codes`` one after the other, and where each text begins and ends.

    A text has the codes up to its entry of ``ends``, after those of the text before.
    """
    taken = pool.take(pa.array(codes))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(codes) + 1]
    data = taken.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b""), offsets[np.concatenate([[0], ends])]


def _portions(words: list[tuple[str, bytes]], limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """Words in lists of about ``limit`` bytes."""
    part, size = [], 0
    for word in words:
        part.append(word)
        size += len(word[1])
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


class ByteBpe:
    """Encoder and decoder of one Python worker."""

    def __init__(
        self,
        ranks: dict[bytes, int],
        pattern: str,
        regular: bool,
        remembered: int = REMEMBERED,
        rounds: int = _ROUNDS,
    ):
        import duckdb
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.unit = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
        self.bytes_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        rows = np.array(merge_rows(ranks), np.int64).reshape(-1, 3)
        self._table("merges", pair=rows[:, 0] << 32 | rows[:, 1], id=rows[:, 2].astype(np.int32))
        self._table(
            "vocabulary",
            id=np.array(list(ranks.values()), np.int32),
            hex=pa.array([token.hex() for token in ranks]),
        )
        self.rounds, self.regular, self.remembered = rounds, regular, remembered
        self.decimals = {rank: b"%d," % rank for rank in ranks.values()}
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self.words = _Memory(remembered)
        self.runs: dict[bytes, bytes] = {}
        self._forget_units()

    def _forget_units(self) -> None:
        """Units by number, and by that number their ids, the ids in decimals, and their decoded bytes."""
        self.codes = _Codes()
        self.pools = {name: pa.array([], pa.large_binary()) for name in ("ids", "listed", "decoded")}

    def _table(self, name: str, **columns) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _contracted(self, words: list[bytes], contract: str) -> list[bytes]:
        """Ids (as int32 bytes) of distinct words."""
        query = _STATE.format(contract=contract.format(rounds=self.rounds))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        out: list[bytes] = [b""] * len(words)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(len(word)) - np.repeat(starts, lengths)).astype(np.int32)
        tok = self.bytes_ids[np.frombuffer(b"".join(words), np.uint8)]
        while len(word):
            self.con.register("start", pa.table({"word": word, "pos": pos, "tok": tok}))
            state = self.con.sql(query).to_arrow_table()
            self.con.unregister("start")
            word, pos, tok, spent = (state[c].to_numpy() for c in ("word", "pos", "tok", "round"))
            going = spent == self.rounds
            done, ids = word[~going], tok[~going]
            cuts = np.flatnonzero(np.diff(done, prepend=-1, append=-1)) if len(done) else np.zeros(0, int)
            raw = ids.tobytes()
            for index, a, b in zip(done[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                out[index] = raw[4 * a : 4 * b]
            word, pos, tok = word[going], pos[going], tok[going]
        return out

    def _learn_words(self, met: Iterable[str]) -> None:
        self.words.make_room()
        short, long = [], []
        for word in dict.fromkeys(met):
            if word in self.words:
                continue
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.words.learn([(word, rank.to_bytes(4, "little"))])
            else:
                (long if len(raw) > _LONG and self.regular else short).append((word, raw))
        for words, contract in ((short, _LEFTMOST), (long, _EVERY)):
            # Bytes of words in one query: what it holds follows from them.
            for part in _portions(words, _PORTION):
                found = self._contracted([raw for _, raw in part], contract)
                self.words.learn(zip((word for word, _ in part), found))

    def _learn(self, units: list[str]) -> None:
        """Results of units that were met for the first time, in the order of their numbers."""
        cut = [self.pattern.findall(unit) for unit in units]
        self._learn_words(word for words in cut for word in words)
        known = self.words.__getitem__
        ids = [b"".join(map(known, words)) for words in cut]
        numbers = [np.frombuffer(i, np.int32) for i in ids]
        decimals = self.decimals.__getitem__
        new = {
            "ids": ids,
            "listed": [b"".join(map(decimals, n.tolist())) for n in numbers],
            "decoded": self._decoded(numbers, {}),
        }
        self.pools = {
            name: pa.concat_arrays([pool, pa.array(new[name], pa.large_binary())]) for name, pool in self.pools.items()
        }

    def _coded(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, and how many there are up to the end of each."""
        held = sum(pool.nbytes for pool in self.pools.values()) + len(self.codes) * _ENTRY
        if held > self.remembered:
            self._forget_units()
        known = len(self.codes)
        cut = [self.unit.findall(text or "") for text in texts]
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        total = int(ends[-1]) if len(ends) else 0
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(cut)), np.int64, total)
        if len(self.codes) > known:
            self._learn(list(islice(self.codes, known, None)))
        return codes, ends

    def _texts(self, name: str, codes: np.ndarray, ends: np.ndarray) -> list[memoryview]:
        data, cuts = _joined(self.pools[name], codes, ends)
        return [data[a:b] for a, b in pairwise(cuts.tolist())]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text."""
        return [np.frombuffer(raw, np.int32) for raw in self._texts("ids", *self._coded(texts))]

    def round_trip(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[memoryview]]:
        """Ids of every text, and the bytes that they decode to."""
        coded = self._coded(texts)
        return [np.frombuffer(raw, np.int32) for raw in self._texts("ids", *coded)], self._texts("decoded", *coded)

    def digested(self, texts: list[str | None]) -> tuple[list[int], list[str], list[str]]:
        """Number of ids, digest of their decimals joined by commas, and of the bytes that they decode to."""
        coded = self._coded(texts)
        _, cuts = _joined(self.pools["ids"], *coded)
        listed = [sha256(raw[:-1]).hexdigest() for raw in self._texts("listed", *coded)]
        return (np.diff(cuts) // 4).tolist(), listed, [sha256(raw).hexdigest() for raw in self._texts("decoded", *coded)]

    def _decoded(self, texts: list[np.ndarray], known: dict[bytes, bytes]) -> list[bytes]:
        """Bytes of every sequence of ids; equal ones, and those that are known, are decoded once."""
        raw = [ids.tobytes() for ids in texts]
        known.update(self._decode_runs([run for run in dict.fromkeys(raw) if run and run not in known]))
        known[b""] = b""
        return [known[run] for run in raw]

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """Bytes of every sequence of ids; runs that begin with a space are decoded once."""
        cut = []
        for ids in texts:
            starts = np.flatnonzero(self.opens[ids])
            at = [0, *(starts[starts > 0]).tolist(), len(ids)]
            cut.append([ids[a:b] for a, b in pairwise(at)])
        if sum(map(len, self.runs)) + len(self.runs) * _ENTRY > self.remembered:
            self.runs = {}
        found = iter(self._decoded(list(chain.from_iterable(cut)), self.runs))
        return [b"".join(islice(found, len(runs))) for runs in cut]

    def _decode_runs(self, runs: list[bytes]) -> dict[bytes, bytes]:
        known = {}
        for first in range(0, len(runs), 50_000):
            part = runs[first : first + 50_000]
            lengths = np.fromiter((len(run) // 4 for run in part), np.int64, len(part))
            ends = np.cumsum(lengths)
            run = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
            pos = (np.arange(len(run)) - np.repeat(ends - lengths, lengths)).astype(np.int32)
            ids = np.frombuffer(b"".join(part), np.int32)
            self.con.register("tokens", pa.table({"run": run, "pos": pos, "id": ids}))
            found = self.con.sql(_DECODE).to_arrow_table()
            self.con.unregister("tokens")
            texts = found["bytes"].to_pylist()
            known.update(zip((part[index] for index in found["run"].to_pylist()), texts, strict=True))
        return known


def _map(
    rows: DataFrame,
    path: str,
    pattern: str,
    column: str,
    new: list[str],
    work: Callable[[ByteBpe, pa.RecordBatch], dict[str, pa.Array]],
    remembered: int,
) -> DataFrame:
    clash = [name.split()[0] for name in new if name.split()[0] in rows.columns]
    rows = rows.drop(*clash)
    ranks = read_ranks(path)
    # A vocabulary has a fixed number of tokens, whatever the rows.
    shared = rows.sparkSession.sparkContext.broadcast(
        (ranks, pattern, is_regular(ranks), remembered)
    )

    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(key, lambda: ByteBpe(*shared.value))
        for block in blocks(batches, column, keeps=key) if new[0] != "decoded binary" else batches:
            yield append_columns(block, **work(codec, block))

    return rows.mapInArrow(run, schema_with(rows, *new))


def _ids_array(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(
    rows: DataFrame, path: str, pattern: str, text: str = "text", remembered: int = REMEMBERED
) -> DataFrame:
    """The rows with ``ids array<int>`` and ``n_tokens long``.

    Null and empty texts have no ids. Columns of these names are replaced, all others
    are passed on. Rows are independent: repeated rows give repeated results.
    """

    def work(codec, block):
        ids = codec.encode(block.column(text).to_pylist())
        return {"ids": _ids_array(ids), "n_tokens": pa.array([len(i) for i in ids], pa.int64())}

    return _map(rows, path, pattern, text, ["ids array<int>", "n_tokens long"], work, remembered)


def decode(
    rows: DataFrame, path: str, pattern: str, ids: str = "ids", remembered: int = REMEMBERED
) -> DataFrame:
    """The rows with ``decoded binary``, the bytes of their ids; null ids give no bytes."""

    def work(codec, block):
        given = [np.array(i or [], np.int32) for i in block.column(ids).to_pylist()]
        return {"decoded": pa.array(codec.decode(given), pa.binary())}

    return _map(rows, path, pattern, ids, ["decoded binary"], work, remembered)


def round_trip(
    rows: DataFrame, path: str, pattern: str, text: str = "text", remembered: int = REMEMBERED
) -> DataFrame:
    """Encode, then decode the ids in the same task: both results beside the rows.

    Adds ``ids``, ``n_tokens`` and ``decoded`` as ``encode`` and ``decode`` do, without
    sending the ids through the JVM in between.
    """

    def work(codec, block):
        ids, decoded = codec.round_trip(block.column(text).to_pylist())
        return {
            "ids": _ids_array(ids),
            "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
            "decoded": pa.array([bytes(d) for d in decoded], pa.binary()),
        }

    columns = ["ids array<int>", "n_tokens long", "decoded binary"]
    return _map(rows, path, pattern, text, columns, work, remembered)


def digests(
    rows: DataFrame, path: str, pattern: str, text: str = "text", remembered: int = REMEMBERED
) -> DataFrame:
    """Encode and decode as ``round_trip`` does, keeping only digests of the results.

    Adds ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas) and
    ``decoded_sha256``, both in lowercase hex.
    """

    def work(codec, block):
        counts, listed, decoded = codec.digested(block.column(text).to_pylist())
        return {
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(listed, pa.string()),
            "decoded_sha256": pa.array(decoded, pa.string()),
        }

    columns = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    return _map(rows, path, pattern, text, columns, work, remembered)
