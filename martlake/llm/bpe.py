"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

Encoding.  Two neighbouring tokens are *compatible* when merging their joined bytes by rank
gives the same two tokens again; a token sequence is the BPE encoding of its bytes exactly
when every neighbouring pair is compatible.  So the last token of the encoding of each
prefix of the input follows from those of shorter prefixes, and merges compile into a
transducer whose state is the bytes read since the last token emitted: reading a byte extends
the tree of last tokens, and the tokens common to every boundary at which a longer token could
still start are emitted.  The lookahead is therefore bounded by the longest token.  States
and transitions are made when first needed and kept up to ``max_states``; at that point the
table is dropped and grows anew, so memory is bounded for any input.

Decoding.  Tokens are joined to bytes; a UTF-8 state machine, advanced by whole tokens,
holds back the bytes of a code point whose end has not arrived, so text can be emitted token
by token.  Bytes that are no UTF-8 become U+FFFD in the text; the bytes are kept exact.

Defined cases: null text is empty and has no tokens; special-token strings are ordinary
text; repeated rows encode alike; empty input gives an empty table.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import ship

_NONE = -1
_ANY = -2


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_NEVER = 1 << 60


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition: join the neighbours whose join has the lowest rank, leftmost first."""
    p = [piece[i:i + 1] for i in range(len(piece))]
    join = [ranks.get(x + y, _NEVER) for x, y in zip(p, p[1:])]
    while join:
        low = min(join)
        if low == _NEVER:
            break
        i = join.index(low)
        p[i:i + 2] = [p[i] + p[i + 1]]
        del join[i]
        if i:
            join[i - 1] = ranks.get(p[i - 1] + p[i], _NEVER)
        if i < len(join):
            join[i] = ranks.get(p[i] + p[i + 1], _NEVER)
    return [ranks[x] for x in p]


class State:
    """What the transducer knows: the bytes read since the last token it emitted, and for each
    prefix of them the last token of its encoding (its start follows from its length).
    ``before`` is that last token where it matters, else ``_ANY``."""

    __slots__ = ("before", "pending", "last", "step", "end")

    def __init__(self, before: int, pending: bytes, last: tuple[int, ...]):
        self.before, self.pending, self.last = before, pending, last
        # byte -> next state, ids emitted, last token emitted or _NONE, token to test or _NONE
        self.step: dict[int, tuple[State, bytes, int, int]] = {}
        self.end: bytes | None = None


class Transducer:
    """States are shared by all last tokens (``_ANY``) as far as these allow: the transition that
    makes the pending bytes one token names it, and when the register (the last token emitted)
    doesn't agree with it, the state of just that register takes over until it emits."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 250_000, max_pairs: int = 400_000):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.id_bytes = [b""] * len(self.bytes_of)
        for b, i in ranks.items():
            self.bytes_of[i] = b
            self.id_bytes[i] = i.to_bytes(4, "little")
        self.longest = max(map(len, ranks))
        # beginnings of tokens that go on: a boundary before one of them is still open
        self.begun = {b[:k] for b in ranks for k in range(1, len(b))}
        self.max_states, self.max_pairs = max_states, max_pairs
        self.pairs: dict[int, bool] = {}
        self.derived: dict[int, tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]] | None] = {}
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple[int, bytes], State] = {}
        self.start = self._state(_ANY, b"", ())

    def _state(self, before: int, pending: bytes, last: tuple[int, ...]) -> State:
        key = before, pending
        s = self.states.get(key)
        if s is None:
            s = self.states[key] = State(before, pending, last)
        return s

    def _derive(self, t: int) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]] | None:
        """The merges that make token ``t`` of its bytes, in order: the rank of each with the
        token at the right edge after it, and with the one at the left edge; None if the bytes
        merge to something else."""
        known = self.derived.get(t, 0)
        if known != 0:
            return known
        p = [self.bytes_of[t][i:i + 1] for i in range(len(self.bytes_of[t]))]
        right, left = [], []
        while len(p) > 1:
            join = [self.ranks.get(x + y, _NEVER) for x, y in zip(p, p[1:])]
            low = min(join)
            if low == _NEVER:
                break
            i = join.index(low)
            p[i:i + 2] = [p[i] + p[i + 1]]
            right.append((low, p[-1]))
            left.append((low, p[0]))
        out = self.derived[t] = (right, left) if len(p) == 1 else None
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Does merging the joined bytes of ``a`` and ``b`` give (a, b)?  With no or any ``a``:
        is ``b`` what its own bytes merge to?

        The two derivations run side by side, the lower rank first and the left one of equals;
        a join over the boundary that comes before the next merge of either would replace it.
        """
        if a < 0:
            return self._derive(b) is not None
        known = self.pairs.get(a << 32 | b)
        if known is None:
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = self._run_both(a, b)
        return known

    def _run_both(self, a: int, b: int) -> bool:
        one, two = self._derive(a), self._derive(b)
        if one is None or two is None:
            return False
        one, two, ranks = one[0], two[1], self.ranks
        x, y, i, j = self.bytes_of[a][-1:], self.bytes_of[b][:1], 0, 0
        over = ranks.get(x + y, _NEVER)
        while i < len(one) or j < len(two):
            ra = one[i][0] if i < len(one) else _NEVER
            rb = two[j][0] if j < len(two) else _NEVER
            if ra <= rb:
                if over < ra:
                    return False
                edge, i = one[i][1], i + 1
                if edge is not x:
                    x = edge
                    over = ranks.get(x + y, _NEVER)
            else:
                if over <= rb:
                    return False
                edge, j = two[j][1], j + 1
                if edge is not y:
                    y = edge
                    over = ranks.get(x + y, _NEVER)
        return over == _NEVER

    def _last(self, before: int, known: tuple[int, ...], u: bytes) -> tuple[int, int]:
        """Last token of the encoding of ``u`` and its start, from those of its prefixes."""
        n = len(u)
        for j in range(max(0, n - self.longest), n):
            t = self.ranks.get(u[j:])
            if t is not None and self.compatible(known[j - 1] if j else before, t):
                return t, j
        raise ValueError("a byte has no token of its own")

    def _path(self, last, n: int) -> list[int]:
        """Tokens of the encoding of the first ``n`` pending bytes."""
        out = []
        while n:
            t = last[n - 1]
            out.append(t)
            n -= len(self.bytes_of[t])
        return out[::-1]

    def _shared(self, u: bytes) -> tuple[int, ...]:
        """Last tokens of the prefixes of ``u`` when what stands before doesn't matter."""
        known = self.states.get((_ANY, u))
        if known is not None:
            return known.last
        last: tuple[int, ...] = ()
        for k in range(1, len(u) + 1):
            last += (self._last(_ANY, last, u[:k])[0],)
        return last

    def advance(self, s: State, byte: int) -> tuple[State, bytes, int, int]:
        """Make the transition of a state on one byte.  A full table is dropped first, also in
        the middle of a piece; the state goes on in the new one."""
        if len(self.states) > self.max_states:
            self.reset()
            s = self._state(s.before, s.pending, s.last)
        u = s.pending + bytes((byte,))
        token, start = self._last(s.before, s.last, u)
        last, n = s.last + (token,), len(u)
        # paths to the boundaries where a token may still start; what they share is decided
        paths = [self._path(last, j) for j in range(n + 1) if j == n or u[j:] in self.begun]
        low, high, common = min(paths), max(paths), 0
        while common < len(low) and low[common] == high[common]:
            common += 1
        done = low[:common]
        test = token if s.before == _ANY and start == 0 else _NONE
        if done:
            size = sum(len(self.bytes_of[t]) for t in done)
            rest, left = u[size:], last[size:]
            before = _ANY if left == self._shared(rest) else done[-1]
            out = self._state(before, rest, left), b"".join(self.id_bytes[t] for t in done), done[-1], test
        else:
            out = self._state(s.before, u, last), b"", _NONE, test
        s.step[byte] = out
        return out

    def finish(self, s: State) -> bytes:
        if s.end is None:
            s.end = b"".join(self.id_bytes[t] for t in self._path(s.last, len(s.pending)))
        return s.end

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of one pretoken as little-endian unsigned 32-bit integers.  A piece that is a
        token as a whole is that token, as in the reference encoder."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return self.id_bytes[whole]
        s, register, out = self.start, _NONE, []
        for b in piece:
            nxt, ids, emitted, test = s.step.get(b) or self.advance(s, b)
            if test >= 0 and register >= 0 and not self.compatible(register, test):
                s = self._state(register, s.pending, s.last)
                nxt, ids, emitted, test = s.step.get(b) or self.advance(s, b)
            s = nxt
            if ids:
                out.append(ids)
                register = emitted
        out.append(self.finish(s))
        if len(self.states) > self.max_states:
            self.reset()
        return b"".join(out)


class PieceMemo(dict):
    """Encodings of pretokens met before; bounded, and long pieces are not kept."""

    def __init__(self, transducer: Transducer, limit: int = 450_000, longest: int = 48):
        super().__init__()
        self.transducer, self.limit, self.longest = transducer, limit, longest

    def __missing__(self, piece: str) -> bytes:
        ids = self.transducer.encode_piece(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids


# UTF-8 state machine.  States: 0 between code points, 1-3 continuation bytes still due,
# 4-7 a restricted second byte is due (after E0, ED, F0, F4), 8 invalid.
_BAD = 8


def _utf8_table() -> np.ndarray:
    t = np.full((9, 256), _BAD, dtype=np.uint8)
    t[0, :0x80] = 0
    t[0, 0xC2:0xE0] = 1
    t[0, 0xE1:0xF0] = 2
    t[0, 0xF1:0xF4] = 3
    t[0, [0xE0, 0xED, 0xF0, 0xF4]] = (4, 5, 6, 7)
    for state in (1, 2, 3):
        t[state, 0x80:0xC0] = state - 1
    t[4, 0xA0:0xC0] = 1
    t[5, 0x80:0xA0] = 1
    t[6, 0x90:0xC0] = 2
    t[7, 0x80:0x90] = 2
    return t


class Decoder:
    """Bytes and text of token ids.  ``moves[s, t]`` is the UTF-8 state after token ``t`` read
    in state ``s``, so the machine advances by whole tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        table = _utf8_table()
        self.moves = np.repeat(np.arange(9, dtype=np.uint8)[:, None], len(self.bytes_of), axis=1)
        size = np.array([len(b) for b in self.bytes_of])
        for k in range(int(size.max())):
            at = np.flatnonzero(size > k)
            col = np.frombuffer(bytes(self.bytes_of[i][k] for i in at), dtype=np.uint8)
            self.moves[:, at] = table[self.moves[:, at], col]

    def states(self, ids: np.ndarray) -> np.ndarray:
        """UTF-8 state after each token.  Only runs that leave state 0 are walked one by one."""
        out = self.moves[0][ids]
        odd = np.flatnonzero(out)
        at = 0
        while at < len(odd):
            i = int(odd[at])
            s = int(out[i])
            while s not in (0, _BAD) and i + 1 < len(ids):
                i += 1
                s = out[i] = int(self.moves[s, ids[i]])
            if s == _BAD:
                out[i:] = _BAD
                break
            at = int(np.searchsorted(odd, i + 1))
        return out

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def stream(self, ids):
        """Text as it becomes certain: each token's complete code points, then what is left."""
        held, state, table = b"", 0, self.moves
        for t in ids:
            held += self.bytes_of[t]
            state = int(table[state, t]) if state != _BAD else _BAD
            if state == 0:
                yield held.decode("utf-8")
                held = b""
            elif state == _BAD:
                # emit what can't change any more; a tail that may still be completed stays
                tail = next((k for k in range(min(3, len(held)), 0, -1) if _opens(held[-k:])), 0)
                done, held = held[:len(held) - tail], held[len(held) - tail:]
                yield done.decode("utf-8", "replace")
                state = _run(held)
            elif len(held) > 4:
                tail = next(k for k in range(3, 0, -1) if _opens(held[-k:]))
                done, held = held[:-tail], held[-tail:]
                yield done.decode("utf-8")
        if held:
            yield held.decode("utf-8", "replace")


def _run(data: bytes) -> int:
    table, s = _utf8_table(), 0
    for b in data:
        s = int(table[s, b])
    return s


def _opens(tail: bytes) -> bool:
    """Is ``tail`` the beginning of one code point whose end is due?"""
    return tail[0] >= 0xC2 and _run(tail) not in (0, _BAD)


@lru_cache(maxsize=4)
def _coder(path: str, pattern: str, share: int = 1):
    """``share`` divides the bounds of states, pairs and pieces that are kept."""
    ranks = read_ranks(path)
    made = Transducer(ranks, max_states=250_000 // share, max_pairs=400_000 // share)
    return regex.compile(pattern), PieceMemo(made, limit=450_000 // share), Decoder(ranks)


def encode(text: str | None, path: str, pattern: str) -> np.ndarray:
    """Token ids of ``text`` as unsigned 32-bit integers."""
    split, memo, _ = _coder(path, pattern)
    return np.frombuffer(b"".join(map(memo.__getitem__, split.findall(text or ""))), dtype="<u4")


def add_tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               share: int = 1) -> DataFrame:
    """``(doc_id, ids binary, decoded binary, valid boolean)``: the ids of each text as
    little-endian 32-bit integers, the bytes they decode to, and whether these are UTF-8.

    Python workers live on from task to task and keep the transducer's states with them.  For jobs whose
    other stages need the memory a ``share`` above 1 keeps that part of the states only, and drops them at a task's end.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "ids", "decoded", "valid"]

    def run(batches):
        split, memo, decoder = _coder(path, pattern, share)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids, decoded, valid = [], [], []
                for text in part.column(1).to_pylist():
                    raw = b"".join(map(memo.__getitem__, split.findall(text or "")))
                    own = np.frombuffer(raw, dtype="<u4")
                    ids.append(raw)
                    decoded.append(decoder.decode_bytes(own))
                    valid.append(not len(own) or int(decoder.states(own)[-1]) == 0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()),
                                                  pa.array(decoded, pa.binary()), pa.array(valid)], names=names)
        if share > 1:
            _coder.cache_clear()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids binary, decoded binary, valid boolean")


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row."""
    return add_tokens(docs, path, pattern, id_col, text_col).select(
        "doc_id", F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
