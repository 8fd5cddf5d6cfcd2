"""Byte-level BPE encoding and decoding with a lazily determinised transducer.

The merges define a non-deterministic transducer.  A thread of it holds the
last finished token and a place in the byte trie of the vocabulary; when the
place is a whole token that may follow the last one, the thread may finish it
and start anew at the root.  "May follow" is where the merges come in: token
``u`` may be followed by ``v`` exactly if merging the bytes of both by rank
gives back ``u, v``.  A token sequence is the rank-merge encoding of its bytes
exactly if that holds for each neighbouring pair, so every prefix of the input
has one thread at the root, and the last one's output is the encoding.

The subset construction is done lazily: a deterministic state is the set of
threads with what each has yet to emit beyond their common prefix; states and
transitions are built when first met, kept in a table of bounded bytes, and the
common prefix is emitted as soon as all threads agree on it, which is after a
lookahead bounded by the longest tokens.  Decoding joins token bytes chunk by
chunk into an incremental UTF-8 state machine that holds back an incomplete
sequence until its remaining bytes arrive.

Defined results: null text encodes as the empty text (no ids); repeated rows
give repeated results; an empty table gives an empty one; other columns pass
through, and columns of the operator's output names are replaced.  Bytes that
are no UTF-8 decode to U+FFFD (texts of Spark columns always are UTF-8).
"""

from __future__ import annotations

import array
import base64
import codecs
import gc
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, slices, text_or_empty

#: Bytes that a worker's tables may grow to beside the vocabulary, by estimate: states and their edges, two generations
#: of pieces, and pairs of tokens.  A full table of states stays until it was passed by RENEWAL times as many states as it
#: holds; the older pieces, or the pairs, are dropped when their table is full.
TABLE_BYTES = 128 << 20
STATE_BYTES, PIECE_BYTES, PAIR_BYTES = TABLE_BYTES // 2, TABLE_BYTES * 3 // 16, TABLE_BYTES // 8
#: What an entry takes beside its contents: a state with its edges, a thread, a piece, a pair.
STATE_COST, THREAD_COST, PIECE_COST, PAIR_COST = 520, 130, 240, 90
LONG_PIECE, CHUNK, RENEWAL = 64, 4096, 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Textbook merging: join the pair of lowest rank, leftmost first."""
    return merge_parts([data[i:i + 1] for i in range(len(data))], ranks)


def merge_parts(parts: list[bytes], ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Merge neighbouring parts until none can be merged or ``until`` are left."""
    while len(parts) > until:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


class State:
    """A deterministic state: its threads, what ends the input here, its known edges."""

    __slots__ = ("edges", "final", "threads")

    def __init__(self, threads: tuple, final: tuple):
        self.threads, self.final, self.edges = threads, final, {}


class Transducer:
    """Encodes one piece of bytes at a time."""

    def __init__(self, ranks: dict[bytes, int], state_bytes: int = STATE_BYTES, pair_bytes: int = PAIR_BYTES):
        self.ranks, self.state_bytes, self.max_pairs = ranks, state_bytes, max(1, pair_bytes // PAIR_COST)
        self.tokens = {i: t for t, i in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for t, i in ranks.items():
            node = 0
            for b in t:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = nxt
            self.ends[node] = i
        self.after: dict[int, dict[int, bool]] = {}
        self.known_pairs = 0
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.states: dict[tuple, State] = {}
        self.held_bytes = self.passed = 0
        self.start = State(((-1, 0, ()),), ())

    def _split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge makes the token; None for a byte or a token no merge makes."""
        if token not in self.halves:
            parts = merge_parts([token[i:i + 1] for i in range(len(token))], self.ranks, until=2)
            made = len(parts) == 2 and parts[0] + parts[1] in self.ranks
            self.halves[token] = (parts[0], parts[1]) if made else None
        return self.halves[token]

    def _joins(self, u: bytes, v: bytes) -> bool:
        """Whether merging by rank keeps u and v apart.

        Takes the merges inside u and v back, last one first, and looks at each
        moment whether a pair across the boundary would have been merged before
        the merge just taken back: left of the boundary a merge of equal rank
        comes first, right of it the one across does.
        """
        rank, limit = self.ranks, 1 << 60
        while True:
            if rank.get(u + v, 1 << 60) < limit:
                return False
            a, b = self._split(u), self._split(v)
            if a is None and b is None:
                return True
            if b is None or a is not None and rank[u] > rank[v]:
                limit, u = rank[u], a[1]
            else:
                limit, v = rank[v] + 1, b[0]

    def _allowed(self, u: int, v: int) -> bool:
        """Whether token v may stand after token u (-1: at the beginning)."""
        if self.known_pairs >= self.max_pairs:
            self.after, self.known_pairs = {}, 0
        t = self.tokens[v]
        fits = len(t) == 1 or self._split(t) is not None if u < 0 else self._joins(self.tokens[u], t)
        self.after.setdefault(u, {})[v] = fits
        self.known_pairs += 1
        return fits

    def _step(self, state: State, byte: int) -> tuple[State, tuple]:
        """The edge for one byte: the next state and the tokens all threads agree on."""
        threads, final, children, after = [], None, self.children, self.after
        for last, node, owed in state.threads:
            nxt = children[node].get(byte)
            if nxt is None:
                continue
            if children[nxt]:
                threads.append((last, nxt, owed))
            if final is None:
                v = self.ends[nxt]
                if v >= 0:
                    fits = after[last].get(v) if last in after else None
                    if self._allowed(last, v) if fits is None else fits:
                        final = (*owed, v)
                        threads.append((v, 0, final))
        agreed = threads[0][2]
        n = len(agreed)
        if n:
            for t in threads:
                while t[2][:n] != agreed[:n]:
                    n -= 1
        key = tuple([(a, b, owed[n:]) for a, b, owed in threads]) if n else tuple(threads)
        nxt_state = self.states.get(key)
        if nxt_state is None:
            nxt_state = State(key, final[n:])
            if self.held_bytes >= self.state_bytes:
                self.passed += 1
                if self.passed >= RENEWAL * len(self.states):
                    self._forget()
                return nxt_state, agreed[:n]  # a full table stays: the state lives for this piece only
            self.states[key] = nxt_state
            self.held_bytes += STATE_COST + THREAD_COST * len(key)
        state.edges[byte] = edge = (nxt_state, agreed[:n])
        return edge

    def _forget(self) -> None:
        """Empty the table of states; without their edges they are no cycles, so they are freed at once."""
        for s in self.states.values():
            s.edges.clear()
        self.start.edges.clear()
        self.states.clear()
        self.held_bytes = self.passed = 0

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out = self.start, []
        for b in piece[:-1]:
            edge = state.edges.get(b) or self._step(state, b)
            state = edge[0]
            if edge[1]:
                out += edge[1]
        out += self._finish(state, piece[-1])
        return out

    def _finish(self, state: State, byte: int) -> tuple:
        """What is left to emit when the input ends with this byte: no state is made for it."""
        edge = state.edges.get(byte)
        if edge is not None:
            return edge[1] + edge[0].final
        children, ends, after = self.children, self.ends, self.after
        for last, node, owed in state.threads:
            v = ends[children[node].get(byte, 0)]
            if v >= 0:
                fits = after[last].get(v) if last in after else None
                if self._allowed(last, v) if fits is None else fits:
                    return (*owed, v)
        raise AssertionError("every byte is a token")


class Encoder:
    """Whole texts: split by the pattern, each match through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_bytes = 0

    def _piece(self, piece: str) -> bytes:
        """A piece not seen lately; of two tables the older one goes when the newer is full."""
        ids = self.known.get(piece) or self.older.get(piece)
        if ids is None:
            ids = array.array("i", self.transducer.encode(piece.encode("utf-8"))).tobytes()
        if len(piece) <= LONG_PIECE:
            if self.known_bytes >= PIECE_BYTES:
                self.older, self.known, self.known_bytes = self.known, {}, 0
            self.known[piece] = ids
            self.known_bytes += PIECE_COST + len(piece) + len(ids)
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers in the machine's order."""
        get, out = self.known.get, []
        for p in self.find(text):
            out.append(get(p) or self._piece(p))
        return b"".join(out)


class StreamDecoder:
    """Ids in, text out; an unfinished UTF-8 sequence waits for the next ids."""

    def __init__(self, tokens: dict[int, bytes]):
        self.get = tokens.__getitem__
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.get, ids)))

    def end(self) -> str:
        out = self.machine.decode(b"", True)
        self.machine.reset()
        return out


#: What a Python worker keeps from task to task: the tables of the vocabularies it has met, at most two.
_WORKER: dict[int, tuple[Encoder, StreamDecoder]] = {}


def _tables(ranks: dict[bytes, int], pattern: str) -> tuple[Encoder, StreamDecoder]:
    """The worker's encoder and decoder for a vocabulary, made when its first task comes."""
    name = hash((pattern, frozenset(ranks.items())))
    if name not in _WORKER:
        if len(_WORKER) >= 2:
            _WORKER.clear()
        _WORKER[name] = Encoder(ranks, pattern), StreamDecoder({i: t for t, i in ranks.items()})
    return _WORKER[name]


def _id_lists(texts: list[str | None], encoder: Encoder) -> pa.Array:
    collecting = gc.isenabled()
    gc.disable()  # tables of tuples without cycles: scanning them takes a quarter of the time
    try:
        rows = [encoder.encode(t or "") for t in texts]
    finally:
        if collecting:
            gc.enable()
    offsets = list(accumulate((len(r) // 4 for r in rows), initial=0))
    ids = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(rows))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)


def _texts(lists: pa.Array, stream: StreamDecoder) -> pa.Array:
    values, ends, out = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist(), []
    for a, b in zip(ends, ends[1:]):
        row = [stream.feed(values[i:min(i + CHUNK, b)].tolist()) for i in range(a, b, CHUNK)]
        out.append("".join([*row, stream.end()]))
    return pa.array(out, pa.string())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int): the byte-level BPE ids of each whole text.

    ``ranks`` (one vocabulary, a megabyte) goes to the executors with the task.
    """
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, _ = _tables(ranks, pattern)
        for texts in batches:
            yield pa.concat_arrays([_id_lists(t.to_pylist(), encoder) for t in slices(texts)])

    return bounded_batches(docs).withColumn(ids, run(text_or_empty(text)))


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids",
           decoded: str = "decoded") -> DataFrame:
    """Add ``decoded`` (string): the text of each row's ids; null ids give an empty text."""
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        stream = StreamDecoder({i: t for t, i in ranks.items()})
        for lists in batches:
            yield pa.concat_arrays([_texts(t, stream) for t in slices(lists)])

    return bounded_batches(docs).withColumn(decoded, run(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, ids and decoded (the text of the ids), both in one Python worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream = _tables(ranks, pattern)
        for part in (x for b in batches for x in slices(b)):
            ids = _id_lists(part.column(1).to_pylist(), encoder)
            yield pa.RecordBatch.from_arrays([part.column(0), ids, _texts(ids, stream)], ["doc_id", "ids", "decoded"])

    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
