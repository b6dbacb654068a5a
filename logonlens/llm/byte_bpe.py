"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

**Encoding.** A sequence of tokens is the BPE encoding of its bytes exactly when every
token is its own encoding and every two neighbours are the encoding of their
concatenation. So each prefix of the input has one encoding, and its last token is the
one suffix that fits the encoding of what stands before it. The transducer reads one byte
at a time. Its state is what can still matter: the last emitted token and the open
alternatives, each the tokens read since then and the trie node of the entry being read
(the subset construction, with exactly one alternative that ends at the present byte). A
token is emitted as soon as all open alternatives share it, so the lookahead is bounded by
the longest vocabulary entries. States and transitions are made when first met
(lazy determinisation), and both tables are emptied when they reach a bound.

**Decoding.** Ids are turned into bytes chunk by chunk; a UTF-8 state machine holds back an
incomplete character until its remaining bytes arrive and replaces ill-formed bytes.

Nulls: a NULL text is the empty text (no tokens); a NULL ids value decodes to the empty
text. Repeated rows each give a row. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import ctypes
import gc
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logonlens.llm.common import document_rows, split_at_spaces

MAX_STATES = 600_000        # transducer moves kept per worker
MAX_PAIRS = 800_000         # pairs of tokens kept per worker
MAX_MEMO = 700_000          # encoded pieces kept per worker
MAX_MEMO_CHARS = 48         # longer pieces are not kept
NEVER = 1 << 62             # later than any rank
ROOT = 2                    # the trie's root


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(tok): int(rank) for tok, rank in (x.split() for x in lines if x.strip())}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], below: int | None = None) -> list[int]:
    """Plain BPE of a short piece: again and again join the leftmost pair of lowest rank
    (only of ranks less than ``below``, if given)."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None or below is not None and best >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class _State:
    """What can still matter: the last emitted token, and each open alternative as (tokens
    since then, trie node of the entry being read)."""
    __slots__ = ("before", "open", "moves", "ending")

    def __init__(self, before, alternatives):
        self.before, self.open, self.moves, self.ending = before, alternatives, {}, None


class Transducer:
    """The lazily determinised transducer of one vocabulary of byte strings."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES, max_pairs: int = MAX_PAIRS):
        self.ranks, self.max_states, self.max_pairs = ranks, max_states, max_pairs
        self.bytes_of = {rank: tok for tok, rank in ranks.items()}
        # (node << 8 | byte) -> node. A node's lowest bits tell whether an entry ends there
        # (1) and whether entries go on (2); the root is node 2.
        parents = {tok[:i] for tok in ranks for i in range(len(tok))}
        node_of = {tok: n << 2 | (tok in ranks) | (tok in parents) << 1
                   for n, tok in enumerate(parents | ranks.keys(), 1)}
        node_of[b""] = ROOT
        self.edges = {node_of[tok[:-1]] << 8 | tok[-1]: node for tok, node in node_of.items() if tok}
        self.token_at = {node_of[tok]: rank for tok, rank in ranks.items()}
        self.spines: dict[tuple[int, bool], list] = {}
        self.own: dict[int, bool] = {}           # is a token the encoding of its own bytes?
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.start = _State(None, (((), ROOT),))
        self.states: dict[tuple, _State] = {}
        self.made = 0

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """The parts that successively stand at one edge while ``token`` is being merged,
        each with the rank at which it is taken into the next (the whole: never)."""
        known = self.spines.get((token, right))
        if known is None:
            whole, known = self.bytes_of[token], []
            died = NEVER
            while True:
                known.append((whole, died))
                if len(whole) == 1:
                    break
                died = self.ranks[whole]
                halves = merge_by_rank(whole, self.ranks, below=died)
                whole = self.bytes_of[halves[-1 if right else 0]]
            known.reverse()
            self.spines[token, right] = known
        return known

    def _may_follow(self, before: int | None, token: int) -> bool:
        """Are the two tokens the encoding of their concatenation? Both are merged in step,
        and no merge across the boundary may come first (equal ranks: the left one)."""
        own = self.own.get(token)
        if own is None:
            own = self.own[token] = merge_by_rank(self.bytes_of[token], self.ranks) == [token]
        if not own:
            return False
        if before is None:
            return True
        left, right = self._spine(before, True), self._spine(token, False)
        i = j = 0
        while True:
            (x, x_died), (y, y_died) = left[i], right[j]
            rank = self.ranks.get(x + y)
            if rank is not None and rank < x_died and rank <= y_died:
                return False
            if x_died == y_died == NEVER:
                return True
            if x_died <= y_died:
                i += 1
            else:
                j += 1

    def _move(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        edge, pairs = self.edges.get, self.pairs
        alternatives, complete = [], None
        for path, node in state.open:
            child = edge(node << 8 | byte)
            if child is None:
                continue
            if child & 2:
                alternatives.append((path, child))
            if child & 1 and complete is None:
                token = self.token_at[child]
                before = path[-1] if path else state.before
                key = token if before is None else (before + 1) << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) > self.max_pairs:
                        pairs.clear()
                    fits = pairs[key] = self._may_follow(before, token)
                if fits:
                    complete = (*path, token)
        if complete is None:
            raise ValueError("the vocabulary has no entry for a byte of the input")
        self.made += 1
        if alternatives and not alternatives[0][0]:      # the oldest one shares nothing yet
            alternatives.append((complete, ROOT))
            return _State(state.before, tuple(alternatives)), ()
        shared = len(complete)
        for path, _ in alternatives:
            shared = min(shared, len(path))
            while path[:shared] != complete[:shared]:
                shared -= 1
        emitted = complete[:shared]
        alternatives.append((complete, ROOT))
        rest = tuple([(path[shared:], node) for path, node in alternatives])
        key = (emitted[-1] if emitted else state.before, rest)
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = _State(*key)
        return target, emitted

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece (one match of the split pattern)."""
        whole = self.ranks.get(piece)
        if whole is not None:      # a piece that is an entry is that entry
            return [whole]
        if self.made > self.max_states:
            self._reset()
        state, out = self.start, []
        for byte in piece:
            move = state.moves.get(byte)
            if move is None:
                move = state.moves[byte] = self._move(state, byte)
            state, emitted = move
            if emitted:
                out.extend(emitted)
        out.extend(state.open[-1][0])      # the alternative that ends here
        return out


class Memo(dict):
    """A bounded memo of ``make``: when it is full it becomes the old half, whose entries
    come back when they are met again."""

    def __init__(self, make, bound: int = MAX_MEMO, max_chars: int = MAX_MEMO_CHARS):
        super().__init__()
        self.make, self.bound, self.max_chars, self.old = make, bound, max_chars, {}

    def __missing__(self, piece):
        made = self.old.get(piece)
        if made is None:
            made = self.make(piece)
        if len(piece) <= self.max_chars:
            if len(self) >= self.bound:
                self.old = dict(self)
                self.clear()
            self[piece] = made
        return made


class Encoder:
    """Text to little-endian unsigned 32-bit ids: split pattern, then the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_memo: int = MAX_MEMO, max_states: int = MAX_STATES,
                 max_pairs: int = MAX_PAIRS):
        self.transducer = Transducer(ranks, max_states, max_pairs)
        self.matches = regex.compile(pattern).findall
        self.packed = Memo(self._pack, max_memo)

    def _pack(self, piece: str) -> bytes:
        """A piece of several matches is put together from theirs, which may be known."""
        matches = self.matches(piece)
        if len(matches) > 1:
            return b"".join(map(self.packed.__getitem__, matches))
        ids = self.transducer.encode(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        pieces = split_at_spaces(text)
        pieces[1:] = [" " + piece for piece in pieces[1:]]
        return b"".join(map(self.packed.__getitem__, pieces))


# ---------------------------------------------------------------- decoding

# Well-formed UTF-8: (first byte of the lead range, last, the range its second byte must be
# in, how many bytes follow).
_LEADS = ((0xC2, 0xDF, 0x80, 0xBF, 1), (0xE0, 0xE0, 0xA0, 0xBF, 2), (0xE1, 0xEC, 0x80, 0xBF, 2),
          (0xED, 0xED, 0x80, 0x9F, 2), (0xEE, 0xEF, 0x80, 0xBF, 2), (0xF0, 0xF0, 0x90, 0xBF, 3),
          (0xF1, 0xF3, 0x80, 0xBF, 3), (0xF4, 0xF4, 0x80, 0x8F, 3))


def _utf8_machine() -> list[list[int]]:
    """``moves[state][byte]`` -> next state; 0 = between characters, 1 = ill-formed, 2.. =
    inside a character (states 2, 3, 4 await 1, 2, 3 ordinary continuation bytes; the others
    await a restricted second byte)."""
    moves = [[1] * 256 for _ in range(5)]
    moves[0][:0x80] = [0] * 0x80
    for state, after in ((2, 0), (3, 2), (4, 3)):
        moves[state][0x80:0xC0] = [after] * 0x40
    for low, high, second_low, second_high, more in _LEADS:
        if (second_low, second_high) == (0x80, 0xBF):
            state = more + 1
        else:
            state = len(moves)
            moves.append([1] * 256)
            moves[state][second_low:second_high + 1] = [more] * (second_high - second_low + 1)
            if more == 1:
                raise AssertionError("two-byte leads take any continuation byte")
        moves[0][low:high + 1] = [state] * (high - low + 1)
    return moves


class Utf8Stream:
    """Incremental UTF-8 decoding: ``feed`` returns the characters completed so far, the
    bytes of an unfinished character (at most three) wait for the next call. Ill-formed
    bytes become U+FFFD, one for each maximal ill-formed part."""

    MOVES = _utf8_machine()

    def __init__(self):
        self.held = b""

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        moves, state, begun = self.MOVES, 0, len(data)
        for at in range(max(0, len(data) - 3), len(data)):     # only the tail can be open
            if state == 0 or data[at] & 0xC0 != 0x80:
                begun, state = at, moves[0][data[at]]
            else:
                state = moves[state][data[at]]
            if state == 1:
                state = 0
        whole, self.held = (data[:begun], data[begun:]) if state > 1 else (data, b"")
        try:
            return whole.decode("ascii") if whole.isascii() else whole.decode("utf-8")
        except UnicodeDecodeError:
            return self._repair(whole)

    def close(self) -> str:
        held, self.held = self.held, b""
        return self._repair(held)

    def _repair(self, data: bytes) -> str:
        out, state, begun, at = [], 0, 0, 0
        while at < len(data):
            after = self.MOVES[state][data[at]]
            if after == 1:
                out.append("�")
                at += state == 0        # a byte that cannot continue starts anew
                state, begun = 0, at
                continue
            at, state = at + 1, after
            if state == 0:
                out.append(data[begun:at].decode("utf-8"))
                begun = at
        if state > 1:
            out.append("�")
        return "".join(out)


class Decoder:
    def __init__(self, ranks: dict[bytes, int], chunk_ids: int = 4096, bytes_of: dict[int, bytes] | None = None):
        self.bytes_of = {rank: tok for tok, rank in ranks.items()} if bytes_of is None else bytes_of
        self.chunk = 4 * chunk_ids

    def chunks(self, packed: bytes) -> Iterator[bytes]:
        for at in range(0, len(packed), self.chunk):
            ids = memoryview(packed)[at:at + self.chunk].cast("I")
            yield b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, packed: bytes) -> tuple[bytes, str]:
        """The bytes of the ids, and the text that the stream of characters gives."""
        stream, raw, text = Utf8Stream(), [], []
        for chunk in self.chunks(packed):
            raw.append(chunk)
            text.append(stream.feed(chunk))
        text.append(stream.close())
        return b"".join(raw), "".join(text)


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str, max_memo: int = MAX_MEMO, max_states: int = MAX_STATES,
             max_pairs: int = MAX_PAIRS) -> Encoder:
    return Encoder(read_ranks(path), pattern, max_memo, max_states, max_pairs)


@lru_cache(maxsize=2)
def _decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


SLICE_ROWS = 256     # rows handled at once, so that very long texts never pile up


def rarer_gc() -> None:
    """The tables hold millions of small objects that live on; looking through them again
    and again would take half the time."""
    gc.set_threshold(500_000, 50, 100)


def give_back() -> None:
    """Memory that a finished task's arrays leave free in a worker goes back to the machine: workers
    outlive their stage and stand beside the next one's. Arrow keeps freed memory in a pool of its own."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:                   # not a glibc system
        pass


def giving_back(work):
    """``work`` (a generator function over a task's batches), and :func:`give_back` once its own
    variables are gone: while it runs, its last rows are still held."""
    def run(batches):
        yield from work(batches)
        give_back()

    return run


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit ids, binary) for every row of ``df``.

    Map-only: the vocabulary file is read once per worker from ``ranks_path``, which must
    be present on every machine."""
    def work(batches):
        rarer_gc()
        encoder = _encoder(ranks_path, pattern)
        for part in slices(batches):
            ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return document_rows(df, id_col, text_col).mapInArrow(work, "doc_id long, ids binary")


def decode(df: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, decoded, text``: the bytes of the ids, and the text as the streaming
    decoder gives it (ill-formed bytes replaced)."""
    def work(batches):
        decoder = _decoder(ranks_path)
        for part in slices(batches):
            both = [decoder.decode(x) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([b for b, _ in both], pa.binary()),
                 pa.array([t for _, t in both], pa.string())], ["doc_id", "ids", "decoded", "text"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    return rows.mapInArrow(work, "doc_id long, ids binary, decoded binary, text string")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", keep: tuple[str, ...] = (), max_memo: int = MAX_MEMO,
               max_states: int = MAX_STATES, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``doc_id, ids, decoded``: :func:`encode`, and the ids' bytes by the streaming decoder,
    in one pass. ``keep`` names further columns of ``df`` to hand on; rows stay in their order.
    ``max_memo``, ``max_states`` and ``max_pairs`` bound what a worker keeps, for its lifetime, to
    save time."""
    def work(batches):
        rarer_gc()
        encoder = _encoder(ranks_path, pattern, max_memo, max_states, max_pairs)
        decoder = Decoder({}, bytes_of=encoder.transducer.bytes_of)     # no second copy of the vocabulary
        for part in slices(batches):
            ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array([decoder.decode(x)[0] for x in ids], pa.binary()),
                 *part.columns[2:]], ["doc_id", "ids", "decoded", *keep])

    docs = document_rows(df, id_col, text_col, keep)
    kept = "".join(f", `{name}` {kind}" for name, kind in docs.dtypes[2:])
    return docs.mapInArrow(giving_back(work), "doc_id long, ids binary, decoded binary" + kept)


def digests(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode every text and decode the ids: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``."""
    return round_trip(df, ranks_path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
