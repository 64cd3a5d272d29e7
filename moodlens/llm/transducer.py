"""Byte-level BPE as a lazily determinised transducer, and decoding through an incremental UTF-8 state machine."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import fresh, sliced

#: States, remembered pieces and remembered pairs a worker keeps; beyond that it drops them and makes those it meets anew.
MAX_STATES, MAX_PIECES, MAX_PAIRS = 300_000, 300_000, 300_000
#: Characters of a piece that may be remembered.
PIECE_CHARS = 32
#: Rank of a pair that does not merge.
_NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file, one in base64 with its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merge_bytes(body: bytes, ranks: dict[bytes, int], parts: int = 1) -> tuple[int, ...]:
    """Ids of a short byte string by merging the pair of lowest rank, the leftmost of equals, until none or ``parts`` are left."""
    row = [body[i : i + 1] for i in range(len(body))]
    while len(row) > parts:
        rank, at = min((ranks.get(row[i] + row[i + 1], _NEVER), i) for i in range(len(row) - 1))
        if rank == _NEVER:
            break
        row[at : at + 2] = [row[at] + row[at + 1]]
    return tuple(ranks[p] for p in row)


class MergeTransducer:
    """The merges of a rank file as a transducer from bytes to ids.

    Cutting the encoding of a string at a token's end leaves the encoding of that prefix, and a sequence of tokens is an encoding exactly
    if every two neighbours are the encoding of their joined bytes. So each prefix has one last token, and reading a byte only asks which
    token ends there behind a prefix whose last token it may follow. A prefix is open while the bytes after it begin some token. A
    state holds, for each open prefix, those bytes, its last token and the tokens not settled that lead to it; what all of them share
    is settled and emitted, at the latest after as many bytes as the longest token has. States and their steps are made when a text
    first needs them.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.tokens = {rank: token for token, rank in ranks.items()}
        # beginnings of tokens by number, 0 being the empty one: what the next byte makes of them, and the token if it is a whole one
        self.longer: dict[int, int] = {}
        self.ending = [-1]
        for token, rank in ranks.items():
            at = 0
            for byte in token:
                at = self.longer.setdefault(at << 8 | byte, len(self.ending))
                if at == len(self.ending):
                    self.ending.append(-1)
            self.ending[at] = rank
        self.follows: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[bytes]] = {}
        self.whole: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        start = ((0, -1, ()),)
        self.known = {start: 0}
        self.states = [start]
        # by state and byte; a step that settles nothing is only the next state
        self.steps: dict[int, int | tuple[int, tuple[int, ...]]] = {}

    def _reachable(self, token: int) -> bool:
        """Whether the merges make this token of its own bytes."""
        if token not in self.whole:
            self.whole[token] = merge_bytes(self.tokens[token], self.ranks) == (token,)
        return self.whole[token]

    def _edge(self, token: int, side: int) -> list[bytes]:
        """What stands at the left (0) or right (-1) edge of a token while it is merged, from its outer byte to the whole."""
        if (token, side) not in self.edges:
            body = self.tokens[token]
            halves = merge_bytes(body, self.ranks, parts=2)
            outer = self._edge(halves[side], side) if len(body) > 1 else []
            self.edges[token, side] = [*outer, body]
        return self.edges[token, side]

    def _may_follow(self, first: int, second: int) -> bool:
        """Whether the joined bytes of two tokens are encoded as these two.

        Merges happen in the order of their ranks, so the edges on both sides of the border grow in that order too; the tokens part
        there unless the two edges merge with each other before the one of lower rank grows (of equal ranks the left merges first).
        """
        if first < 0:
            return True
        pair = first << 32 | second
        parted = self.follows.get(pair)
        if parted is None:
            if len(self.follows) >= MAX_PAIRS:
                self.follows.clear()
            left, right, ranks = self._edge(first, -1), self._edge(second, 0), self.ranks
            i = j = 0
            while True:
                grows_left = ranks[left[i + 1]] if i + 1 < len(left) else _NEVER
                grows_right = ranks[right[j + 1]] if j + 1 < len(right) else _NEVER
                across = ranks.get(left[i] + right[j], _NEVER)
                parted = across >= grows_left or across > grows_right
                if not parted or grows_left == grows_right == _NEVER:
                    break
                if grows_left <= grows_right:
                    i += 1
                else:
                    j += 1
            self.follows[pair] = parted
        return parted

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after ``byte`` and the ids that it settles."""
        longer, ending, still_open, token, path = self.longer, self.ending, [], -1, ()
        for after, last, way in self.states[state]:
            after = longer.get(after << 8 | byte)
            if after is None:
                continue
            still_open.append((after, last, way))
            if token < 0 <= ending[after] and self._reachable(ending[after]) and self._may_follow(last, ending[after]):
                token, path = ending[after], (*way, ending[after])
        still_open.append((0, token, path))
        shared, first = 0, still_open[0][2]
        if first:
            # what the first and the last of all in order share, all share
            ways = [way for _, _, way in still_open]
            low, high = min(ways), max(ways)
            while shared < len(low) and low[shared] == high[shared]:
                shared += 1
            if shared:
                still_open = [(after, last, way[shared:]) for after, last, way in still_open]
        key = tuple(still_open)
        number = self.known.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        self.steps[state << 8 | byte] = (number, first[:shared]) if shared else number
        return number, first[:shared]

    def run(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        token = self.ranks.get(piece)
        if token is not None and not self._reachable(token):
            # a token that merges cannot make is still the id of a piece that equals it
            return [token]
        if len(self.states) > self.max_states:
            self._forget()
        state, out, known = 0, [], self.steps.get
        for byte in piece:
            step = known(state << 8 | byte)
            if step.__class__ is int:
                state = step
            else:
                state, settled = step or self._step(state, byte)
                out += settled
        return [*out, *self.states[state][-1][2]]


class _Pieces(dict):
    """Ids of pieces as bytes of 32-bit numbers; one that is missing is looked up among those met before the present ones, or made."""

    def __init__(self, transducer: MergeTransducer):
        self.transducer = transducer
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.transducer.run(piece.encode()), np.int32).tobytes()
        if len(piece) <= PIECE_CHARS:
            if len(self) >= MAX_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class ByteEncoder:
    """Ids of whole texts: every match of ``pattern`` runs through the transducer by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = MergeTransducer(ranks)
        self.split = regex.compile(pattern).findall
        # a piece that is met again is found without a line of Python
        self.pieces = _Pieces(self.transducer)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), np.int32)


class Utf8Machine:
    """Incremental UTF-8 decoder: bytes in, whole characters out; a broken sequence becomes U+FFFD.

    The state is what a lead byte still asks for: the number of bytes to come, the bits so far and the range of the next byte, which
    rules out overlong forms, surrogates and numbers beyond U+10FFFF. A byte that does not fit ends the sequence and is read again.
    Between sequences, those that are whole in the bytes at hand are taken in one go; they lead back to the same state.
    """

    # fixed values: range of lead bytes, bytes that follow, bits of the lead byte, range of the first byte that follows
    LEADS = (
        (0xC2, 0xDF, 1, 0x1F, 0x80, 0xBF),
        (0xE0, 0xE0, 2, 0x0F, 0xA0, 0xBF),
        (0xE1, 0xEC, 2, 0x0F, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x0F, 0x80, 0x9F),
        (0xEE, 0xEF, 2, 0x0F, 0x80, 0xBF),
        (0xF0, 0xF0, 3, 0x07, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x07, 0x80, 0xBF),
        (0xF4, 0xF4, 3, 0x07, 0x80, 0x8F),
    )
    _BY_BYTE = {byte: (follow, bits, low, high) for first, last, follow, bits, low, high in LEADS for byte in range(first, last + 1)}
    # the same sequences as a pattern of their bytes
    _WHOLE = re.compile(
        b"(?:[\x00-\x7f]+|" + b"|".join(b"[\\x%02x-\\x%02x][\\x%02x-\\x%02x]" % (first, last, low, high) + b"[\\x80-\\xbf]" * (follow - 1) for first, last, follow, _, low, high in LEADS) + b")+"
    )

    def __init__(self) -> None:
        self.left, self.value, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, body: bytes) -> str:
        """The characters that ``body`` completes."""
        out, at, size = [], 0, len(body)
        while at < size:
            byte = body[at]
            if self.left:
                if self.low <= byte <= self.high:
                    self.left, self.value, self.low, self.high = self.left - 1, self.value << 6 | byte & 0x3F, 0x80, 0xBF
                    at += 1
                    if not self.left:
                        out.append(chr(self.value))
                else:
                    self.left, self.low, self.high = 0, 0x80, 0xBF
                    out.append("\ufffd")
            elif whole := self._WHOLE.match(body, at):
                out.append(whole[0].decode())
                at = whole.end()
            else:
                at += 1
                lead = self._BY_BYTE.get(byte)
                if lead is None:
                    out.append("\ufffd")
                else:
                    self.left, bits, self.low, self.high = lead
                    self.value = byte & bits
        return "".join(out)

    def finish(self) -> str:
        """What an unfinished sequence at the end becomes."""
        cut, self.left, self.low, self.high = self.left > 0, 0, 0x80, 0xBF
        return "\ufffd" if cut else ""


class ByteDecoder:
    """Bytes of ids, looked up as one Arrow ``take``; an id the vocabulary lacks gives no bytes."""

    #: Ids decoded at once.
    STEP = 1 << 16

    def __init__(self, ranks: dict[bytes, int]):
        table = [b""] * (max(ranks.values(), default=-1) + 2)
        for token, rank in ranks.items():
            table[rank] = token
        self.table = pa.array(table, pa.large_binary())

    def chunks(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes of ``ids``, a bounded number of ids at a time."""
        last = len(self.table) - 1
        for at in range(0, len(ids), self.STEP):
            part = ids[at : at + self.STEP]
            taken = self.table.take(pa.array(np.where((part < 0) | (part > last), last, part)))
            _, offsets, values = taken.buffers()
            bounds = np.frombuffer(offsets, np.int64, len(taken) + 1, taken.offset * 8)
            yield values.to_pybytes()[int(bounds[0]) : int(bounds[-1])] if values else b""

    def decode(self, ids: np.ndarray) -> tuple[bytes, str]:
        """The bytes of ``ids`` and the text that the state machine reads in them."""
        machine, bodies, texts = Utf8Machine(), [], []
        for body in self.chunks(ids):
            bodies.append(body)
            texts.append(machine.feed(body))
        return b"".join(bodies), "".join([*texts, machine.finish()])


# a worker process serves many tasks; the vocabulary, the states and the pieces it has met stay with it
@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def _decoder(path: str) -> ByteDecoder:
    return ByteDecoder(read_ranks(path))


def _encode_task(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in sliced(batches):
            found = [encoder.encode(text or "") for text in batch.column(batch.num_columns - 1).to_pylist()]
            bounds = np.concatenate(([0], np.cumsum([len(ids) for ids in found]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])

    return run


def _decode_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(path)
        for batch in sliced(batches):
            found = [decoder.decode(np.array([] if ids.values is None else ids.values.to_numpy(zero_copy_only=False), np.int32)) for ids in batch.column(batch.num_columns - 1)]
            bodies, texts = (pa.array([row[k] for row in found], kind) for k, kind in ((0, pa.binary()), (1, pa.string())))
            yield pa.RecordBatch.from_arrays([*batch.columns, bodies, texts], [*batch.schema.names, "body", "text"])

    return run


def _typed(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.select(*names).schema.fields)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``ids``, the ids of the whole text by the rank file at ``path``.

    Every match of ``pattern`` is encoded by itself and no special tokens are known. A null or empty text has no ids. Repeated rows and
    null ids stay as they are; other columns are ignored; an empty table gives no rows. Nothing is shuffled, and no more than some rows
    of a batch are turned into Python objects at a time.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return texts.mapInArrow(_encode_task(path, pattern), "doc_id long, ids array<int>")


def decode_documents(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with ``body``, the bytes of its ids, and ``text``, those bytes read as UTF-8.

    Null ids decode to no bytes, an id that the vocabulary lacks to none of its own. Bytes that are no UTF-8 stay in ``body`` and become
    U+FFFD in ``text``. Columns named ``body`` or ``text`` are replaced; the others stay, copies too.
    """
    kept = [name for name in tokens.columns if name.lower() not in (ids.lower(), "body", "text")]
    own = fresh(tokens.select(*kept), "_ids")[0] if kept else "_ids"
    rows = tokens.select(*kept, F.col(ids).cast("array<int>").alias(own))
    decoded = rows.mapInArrow(_decode_task(path), f"{_typed(rows, rows.columns)}, body binary, text string")
    return decoded.withColumnRenamed(own, ids)


def _round_trip_task(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decode_task(path)(_encode_task(path, pattern)(batches))

    return run


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encode_documents``, then ``decode_documents``, in one pass, so that a worker holds one vocabulary."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return texts.mapInArrow(_round_trip_task(path, pattern), "doc_id long, ids array<int>, body binary, text string")
