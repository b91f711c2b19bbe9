"""Byte-level BPE: a lazily determinised transducer encodes, an incremental UTF-8 machine decodes.

After each byte of a piece there is exactly one encoding of the bytes so far, and its last token must fit the token
before it: the two stay as they are when their bytes are merged together. A state holds the bytes that some token could
still continue, with the last token up to each place among them. What the tokens up to all these places share is
certain, whatever follows, and is emitted; no token waits longer than for the longest token's bytes and a fixed stretch.
States and transitions are made when first met and kept up to a bound. Pieces are cached up to a bound as well.

Cases: null and empty texts have no tokens; a very long text, or a very long piece of one, takes time in proportion to
its length; special strings in texts are ordinary text. Decoding bytes that are no UTF-8 puts U+FFFD for each bad part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from struct import pack

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from catchlake.llm.common import TwoAges, kept_in_worker, with_text_columns

NO_LIMIT = 1 << 60
BYTES = [bytes((b,)) for b in range(256)]
NEVER: dict = {}  #: the transitions of a state that isn't kept


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file, one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """How each token came to be, and which tokens can stand side by side."""

    def __init__(self, ranks: dict[bytes, int], pairs: int = 200_000):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.prefixes = {t[:i] for t in ranks for i in range(1, len(t) + 1)}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.fit = TwoAges(self._fit_key, pairs)  #: by left << 32 | right

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a byte, or for a token that merging never makes."""
        if token not in self.halves:
            self.halves[token] = self._last_merge(self.tokens[token], token)
        return self.halves[token]

    def _last_merge(self, data: bytes, token: int) -> tuple[int, int] | None:
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 2:
            found = [(self.ranks.get(a + b, NO_LIMIT), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, at = min(found)
            if rank >= token:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None

    def _fit_key(self, key: int) -> bool:
        return self._fit(key >> 32, key & 0xFFFFFFFF)

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two. Their merges are undone from the last to the first;
        they don't fit if at some time the neighbours at the seam would have been merged before one of them was."""
        left_until = right_until = NO_LIMIT  # when the neighbours at the seam are merged away
        while True:
            merged = self.ranks.get(self.tokens[left] + self.tokens[right], NO_LIMIT)
            # of equal ranks the leftmost pair goes first: inside left before the seam, the seam before inside right
            if merged < left_until and merged <= right_until and merged != NO_LIMIT:
                return False
            left_made = left if len(self.tokens[left]) > 1 else -1
            right_made = right if len(self.tokens[right]) > 1 else -1
            if left_made < 0 and right_made < 0:
                return True
            if left_made >= right_made:
                left_until, left = left, self.split(left)[1]
            else:
                right_until, right = right, self.split(right)[0]


class State:
    """window: the bytes at the end that a token could continue. lasts: the last token up to each place, from before the
    window's first byte to after its last; -1 where the piece begins."""

    __slots__ = ("window", "lasts", "next")

    def __init__(self, window: bytes, lasts: tuple[int, ...]):
        self.window, self.lasts, self.next = window, lasts, NEVER


class Transducer:
    """Bytes of one piece in, token ids out; deterministic states are made on demand.

    A run carries a register for each place of its state: the chain of tokens up to there. A transition says which place
    the new token follows and how many places at the front nothing can follow any more.
    """

    def __init__(self, ranks: dict[bytes, int], states: int = 300_000, look: int = 64):
        self.merges, self.limit, self.look = Merges(ranks), states, look
        self.whole = {t: r for t, r in ranks.items() if len(t) == 1 or self.merges.split(r)}
        self.states: dict[tuple, State] = {}
        self.start = self._state(b"", (-1,))

    def _state(self, window: bytes, lasts: tuple[int, ...]) -> State:
        """The kept state, or a new one, which is kept as well while there is room. Runs through states that aren't kept
        make their steps anew, so the machine stays bounded and frequent states, met early, stay."""
        key = (window, lasts)
        state = self.states.get(key)
        if state is None:
            state = State(window, lasts)
            if len(self.states) < self.limit:
                self.states[key] = state
                state.next = {}
        return state

    def _step(self, state: State, byte: int) -> tuple[State, int, int, int]:
        window, whole, fit, place = state.window + BYTES[byte], self.whole, self.merges.fit, 0
        for last in state.lasts:  # the longest token first
            token = whole.get(window[place:])
            if token is not None and (last < 0 or fit[last << 32 | token]):
                break
            place += 1
        else:
            raise ValueError("the ranks lack a single byte")
        cut, prefixes, end = 0, self.merges.prefixes, len(window)
        while cut < end and window[cut:] not in prefixes:
            cut += 1
        move = self._state(window[cut:], state.lasts[cut:] + (token,)), place, token, cut
        if state.next is not NEVER:
            state.next[byte] = move
        return move

    def encode(self, data: bytes) -> list[int]:
        """Token ids of a short piece at once."""
        state, chains = self.start, [None]
        for byte in data:
            move = state.next.get(byte)
            state, place, token, cut = move if move is not None else self._step(state, byte)
            chains.append((chains[place], token))
            if cut:
                del chains[:cut]
        return self._unrolled(chains[-1])

    def feed(self, data: bytes) -> Iterator[int]:
        """Token ids of a piece, each at most a token's length and look bytes after it is certain."""
        state, chains = self.start, [None]
        for n, byte in enumerate(data, 1):
            state, place, token, cut = state.next.get(byte) or self._step(state, byte)
            chains.append((chains[place], token))
            if cut:
                del chains[:cut]
            if not n % self.look:
                sure, chains = self._certain(chains)
                yield from sure
        yield from self._unrolled(chains[-1])

    @staticmethod
    def _unrolled(chain: tuple | None) -> list[int]:
        out = []
        while chain is not None:
            chain, token = chain
            out.append(token)
        return out[::-1]

    def _certain(self, chains: list) -> tuple[list[int], list]:
        """What all places' chains begin with is certain whatever follows; the chains go on without it."""
        paths = [self._unrolled(c) for c in chains]
        sure = 0
        while all(len(p) > sure and p[sure] == paths[0][sure] for p in paths):
            sure += 1
        rest = []
        for p in paths:
            chain = None
            for token in p[sure:]:
                chain = (chain, token)
            rest.append(chain)
        return paths[0][:sure], rest


class Codec:
    """Encoder and decoder of texts. The packed ids of short pieces are kept, up to a bound."""

    SHORT = 64

    def __init__(self, ranks: dict[bytes, int], pattern: str, pieces: int = 400_000, states: int = 300_000):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.transducer = Transducer(ranks, states)
        self.tokens = self.transducer.merges.tokens
        self.pieces = TwoAges(self._packed, pieces)

    def _packed(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        rank = self.ranks.get(data)
        if rank is not None:
            return rank.to_bytes(4, "little")
        if len(data) <= self.SHORT:
            ids = self.transducer.encode(data)
            return pack(f"<{len(ids)}I", *ids)
        return np.fromiter(self.transducer.feed(data), "<u4").tobytes()

    def encode_packed(self, text: str | None) -> bytes:
        """Token ids of a whole text as little-endian unsigned 32-bit integers."""
        pieces = self.find(text or "")
        if max(map(len, pieces), default=0) > self.SHORT:
            return b"".join([self.pieces[p] if len(p) <= self.SHORT else self._packed(p) for p in pieces])
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode_stream(self, ids: Iterable[Iterable[int]]) -> Iterator[str]:
        """Text of blocks of ids, each part as soon as its characters are complete."""
        machine = Utf8Machine()
        for block in ids:
            yield machine.feed(b"".join(map(self.tokens.__getitem__, block)))
        yield machine.finish()

    def decode_packed(self, packed: bytes, block: int = 1 << 16) -> Iterator[str]:
        ids = np.frombuffer(packed, "<u4")
        return self.decode_stream(ids[a:a + block].tolist() for a in range(0, len(ids), block))


class Utf8Machine:
    """Bytes in, complete characters out. The state is the begun character: its bytes, of which at most three wait."""

    def __init__(self):
        self.begun = b""

    @staticmethod
    def awaited(data: bytes) -> int:
        """How many bytes at the end are the beginning of a character that isn't complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                length = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if byte < 0xF8 and back < length else 0
            if byte < 0x80:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        cut = len(data) - self.awaited(data)
        self.begun = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.begun = self.begun.decode("utf-8", "replace"), b""
        return out


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The plain definition, for tests: merge the leftmost adjacent pair of the lowest rank until none is left."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while found := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]:
        at = min(found)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def codec(path: str, pattern: str, pieces: int, states: int) -> Codec:
    """The codec of a rank file."""
    return Codec(read_ranks(path), pattern, pieces, states)


def _round_trip(path: str, pattern: str, ids_too: bool, pieces: int, states: int):
    own = kept_in_worker(codec, path, pattern, pieces, states)

    def work(texts: list) -> list:
        n, ids, decoded, kept = [], [], [], []
        for text in texts:
            packed = own.encode_packed(text)
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            digest = hashlib.sha256()
            for part in own.decode_packed(packed):
                digest.update(part.encode("utf-8"))
            decoded.append(digest.hexdigest())
            kept.append(packed)
        return [n, ids, decoded, kept] if ids_too else [n, ids, decoded]

    return work


def encode_and_decode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
                      ids: str | None = None, pieces: int = 400_000, states: int = 300_000) -> DataFrame:
    """Digests of each text's ids and of the text decoded from them. Rows stay where they are: no shuffle.

    ids names a column for the ids themselves, packed as little-endian unsigned 32-bit integers. pieces and states bound what a
    worker keeps, about 1 KB for each state and 250 bytes for each piece; fewer take less memory and more time.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    fields += [T.StructField(ids, T.BinaryType())] if ids else []
    return with_text_columns(docs, text, fields, partial(_round_trip, path, pattern, ids is not None, pieces, states), [key], keeps=True)
