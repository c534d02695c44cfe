"""Byte-level BPE: merges compiled into a lazily determinised transducer, and streaming decoding.

The transducer reads a pre-token byte by byte. For every position the encoding of the bytes so far is known by its last token: the one token
that ends there and may follow the last token at its own start (two tokens may follow each other when merging their bytes gives back
just these two). A position can still matter while the bytes after it begin some longer token; tokens before the point where the ways to all
such positions meet are final and are emitted. A state is (last emitted token, bytes after it); states and transitions are made when first met.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.llm.worker import store

MOST_STATES, MOST_PIECES, MOST_PAIRS = 100_000, 400_000, 500_000  # kept per worker; dropped when full, results do not change
DECODE_CHUNK = 4096
SHORT_REST = 256  # bytes that are encoded to the end at once; longer rests go state by state and emit as they go


class _State:
    """Pending bytes, the last token at each position in them with its start, and the starts a longer token could have."""

    __slots__ = ("alive", "back", "next", "pending", "rest", "tokens")

    def __init__(self, pending: bytes, tokens: list[int], back: list[int], alive: list[tuple[int, int]]):
        self.pending, self.tokens, self.back, self.alive = pending, tokens, back, alive
        self.next: dict[int, tuple[_State, tuple[int, ...]] | None] = {}
        self.rest: tuple[int, ...] | None = None


class Transducer:
    """Encoder of pre-tokens by merge ranks (bytes -> id)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        # trie of the tokens: (node * 256 + byte) -> node; its token, or -1; whether it has children
        self.trie: dict[int, int] = {}
        self.token_at, self.inner = [-1], [True]
        for b, i in ranks.items():
            node = 0
            for byte in b:
                self.inner[node] = True
                child = self.trie.get(node << 8 | byte)
                if child is None:
                    child = self.trie[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = child
            self.token_at[node] = i
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.start = _State(b"", [-1], [0], [(0, 0)])
        self.states: dict[tuple[int, bytes], _State] = {(-1, b""): self.start}

    def merged(self, piece: bytes) -> list[int]:
        """Merging by rank, as defined: the lowest-ranked neighbours first, the leftmost of equal ones. For short pieces."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if best[0] == 1 << 60:
                break
            parts[best[1]: best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        if a < 0:
            return True
        known = self.pairs.get(a << 32 | b)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        trie, token_at, inner, tokens = self.trie, self.token_at, self.inner, state.tokens
        n, found, origin, alive = len(tokens), -1, 0, []
        for node, start in state.alive:
            child = trie.get(node << 8 | byte)
            if child is not None:
                if found < 0 and token_at[child] >= 0 and self.may_follow(tokens[start], token_at[child]):
                    found, origin = token_at[child], start
                if inner[child]:
                    alive.append((child, start))
        if found < 0:
            raise ValueError(f"no token ends at byte {byte}: the ranks lack single bytes")
        tokens, back = [*tokens, found], [*state.back, origin]
        # the ways to all positions that can still be a token's start meet at `keep`
        keep = n
        for _, start in alive:
            low = start
            while keep != low:
                if keep > low:
                    keep = back[keep]
                else:
                    low = back[low]
        out, at = [], keep
        while at > 0:
            out.append(tokens[at])
            at = back[at]
        pending = (state.pending + bytes((byte,)))[keep:]
        key = (tokens[keep], pending)
        made = self.states.get(key)
        if made is None:
            if keep:
                tokens, back, alive = tokens[keep:], [max(0, b - keep) for b in back[keep:]], [(c, s - keep) for c, s in alive]
            alive.append((0, n - keep))
            made = self.states[key] = _State(pending, tokens, back, alive)
        out.reverse()
        return made, tuple(out)

    def _to_end(self, state: _State, rest: bytes) -> list[int]:
        """All tokens of the state's pending bytes and ``rest``, without making states: for ways that are met for the first time."""
        get, token_at, inner, pairs = self.trie.get, self.token_at, self.inner, self.pairs.get
        tokens, back, alive = [*state.tokens], [*state.back], state.alive
        for byte in rest:
            found, longer = -1, []
            for way in alive:
                child = get(way[0] << 8 | byte)
                if child is not None:
                    if found < 0 and token_at[child] >= 0:
                        before, token = tokens[way[1]], token_at[child]
                        fits = pairs(before << 32 | token)
                        if fits or (fits is None and self.may_follow(before, token)):
                            found, origin = token, way[1]
                    if inner[child]:
                        longer.append((child, way[1]))
            if found < 0:
                raise ValueError(f"no token ends at byte {byte}: the ranks lack single bytes")
            longer.append((0, len(tokens)))
            tokens.append(found)
            back.append(origin)
            alive = longer
        out, at = [], len(tokens) - 1
        while at > 0:
            out.append(tokens[at])
            at = back[at]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > MOST_STATES:
            self._reset()
        state, out = self.start, []
        for at, byte in enumerate(piece):
            step = state.next.get(byte)
            if step is None:
                if byte not in state.next and len(piece) - at <= SHORT_REST:  # a way becomes a state when it is met again
                    state.next[byte] = None
                    return out + self._to_end(state, piece[at:])
                step = state.next[byte] = self._step(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        if state.rest is None:
            rest, at = [], len(state.pending)
            while at > 0:
                rest.append(state.tokens[at])
                at = state.back[at]
            state.rest = tuple(reversed(rest))
        out += state.rest
        return out


# Lead bytes of UTF-8 -> (bytes that follow, least and greatest second byte); other bytes from 0x80 on lead nothing.
_LEADS = (
    {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)} | {b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)} | {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F)}
    | {b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)} | {0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)})


class Utf8Machine:
    """Incremental UTF-8: text of the bytes fed so far, up to the last whole character; invalid bytes become U+FFFD.

    The machine's state is the begun character at the end of a chunk, at most three bytes; the transitions are walked over these only.
    """

    def __init__(self):
        self.begun = b""

    @staticmethod
    def open_tail(data: bytes) -> int:
        """How many bytes at the end begin a character that can still be completed."""
        for n in range(1, min(3, len(data)) + 1):
            lead = data[-n]
            if lead in _LEADS:
                need, low, high = _LEADS[lead]
                follow = data[len(data) - n + 1:]
                return n if n <= need and all((low if i == 0 else 0x80) <= b <= (high if i == 0 else 0xBF) for i, b in enumerate(follow)) else 0
            if not 0x80 <= lead <= 0xBF:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        n = self.open_tail(data)
        self.begun = data[len(data) - n:] if n else b""
        return (data[:-n] if n else data).decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of base64 bytes and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


class Codec:
    """Encoding and decoding of texts with a rank file and the pattern that splits texts; ids of met pieces are kept."""

    def __init__(self, raw: bytes, pattern: str, kept: int = MOST_PIECES):
        self.kept = kept
        self.transducer = Transducer(read_ranks(raw))
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str]] = {}  # the pieces known before `known` was last full

    def pieces(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """For each pre-token its ids, and their decimal form."""
        split = self.split(text)
        out = list(map(self.known.get, split))
        if None not in out:
            return out
        known, older = self.known, self.older
        for i, met in enumerate(out):
            if met is None:
                p = split[i]
                met = known.get(p) or older.get(p)
                if met is None:
                    ids = tuple(self.transducer.encode(p.encode()))
                    met = (ids, " ".join(map(str, ids)))
                if len(p) <= 64:
                    if len(known) >= self.kept:
                        self.older = older = known
                        self.known = known = {}
                    known[p] = met
                out[i] = met
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(p[0] for p in self.pieces(text)))

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.transducer.bytes_of.__getitem__, ids))

    def decode_stream(self, ids: list[int], chunk: int = DECODE_CHUNK) -> Iterator[tuple[bytes, str]]:
        """(bytes, text) per chunk of ids; a character cut by a chunk's end comes with the next text."""
        machine = Utf8Machine()
        for i in range(0, len(ids), chunk):
            data = self.decode_bytes(ids[i: i + chunk])
            yield data, machine.feed(data)
        if machine.begun:
            yield b"", machine.close()


def codec(raw: bytes, pattern: str, kept: int = MOST_PIECES) -> Codec:
    """One codec per worker process and vocabulary, until another operator uses the worker."""
    codecs = store("bpe")
    key = (hashlib.sha256(raw).digest(), pattern, kept)
    if key not in codecs:
        codecs.clear()
        codecs[key] = Codec(raw, pattern, kept)
        gc.set_threshold(200_000, 20, 100)  # states and pieces are many small objects that live long
    return codecs[key]


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", kept: int = MOST_PIECES) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 (decimal ids, one space between), decoded_sha256 (decoded bytes), decoded_chars.

    No special tokens. Null and empty texts have no ids. Rows are independent: repeated rows and ids are repeated in the result, empty tables
    give none, other columns are ignored. The rank file is read once, by the driver. ``kept``: pieces
    whose ids a worker keeps, twice; results do not depend on it.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # the size of the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value, pattern, kept)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text in b.column(1):
                found = c.pieces(text.as_py() or "")
                ids = list(chain.from_iterable([p[0] for p in found]))
                digest, chars = hashlib.sha256(), 0
                for data, said in c.decode_stream(ids):
                    digest.update(data)
                    chars += len(said)
                for column, v in zip(out, (len(ids), hashlib.sha256(" ".join([p[1] for p in found]).encode()).hexdigest(), digest.hexdigest(), chars)):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long")
    return made.withColumnRenamed("id", id_col)
