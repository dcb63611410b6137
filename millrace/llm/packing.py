"""Packing token streams into fixed windows by Karmarkar-Karp multiway differencing.

Every document becomes its token ids and one end id. Whole windows are cut
straight from long documents; what is left of each document is collected in
blocks of ``block_pieces`` and split into windows of near-equal sums by multiway
differencing: partial partitions are kept in a heap by the spread of their
sums, and the two with the widest spread are merged so that the heavy bins of one
meet the light bins of the other. If a bin would exceed the window, the block is
differenced again with more bins. What is left of a document is cut into even
pieces of at most ``piece_tokens``, as differencing levels many small pieces far better than
few large ones. All of it happens inside a map task: there is no shuffle, memory is bounded by a block, and a lost task is simply redone.

Only the last block of a task can be too small to fill its bins. Its surplus
over whole windows is cut off first and written as power-of-two sequences, which
need no padding.

Defined cases: null text counts as empty (its end id only); very long texts are cut into whole windows and one
rest; partial partitions with equal spread, and bins with equal sums, are taken in the order they were made; null document ids pass
through; repeated rows are packed as often as they occur; an empty table gives an
empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.bytewords import release

PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


_SPLIT_PUNCTUATION = re.compile(rb"([a-z0-9])([!-/:-@\[-`{-~])")
#: How byte-level tokenizers write bytes as characters: printable ones as themselves, the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
_ENCODERS: dict[str, ChunkEncoder] = {}


class ChunkEncoder:
    """Encodes whole texts by the pieces they consist of.

    The tokenizer ignores case, drops white space and never joins across it, nor from a letter or digit to a
    punctuation mark, so the ids of a text are those of its pieces in order. Pieces recur, so their ids are
    remembered in two generations of at most ``known`` pieces each: when the young one is full it replaces the old.
    Texts with a special token's opening are encoded as they stand, as those tokens do depend on case.
    """

    def __init__(self, path: str, known: int = 300_000, longest: int = 48):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.written = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.known, self.longest, self.young, self.old = known, longest, {}, {}

    @staticmethod
    def shared(path: str) -> ChunkEncoder:
        """One encoder for each worker process, whatever task it works on."""
        if path not in _ENCODERS:
            _ENCODERS[path] = ChunkEncoder(path)
        return _ENCODERS[path]

    def _piece(self, piece: bytes) -> bytes | None:
        """The ids of a piece that is one word in composed form, plain to lower: those go to the model directly."""
        if piece.isalpha():  # ASCII letters only
            word = piece.decode("ascii")
        else:
            word = piece.decode("utf-8", "replace")
            low = word.lower()
            if word.isascii() or not word.isalpha() or "Σ" in word or len(low) != len(word) or not (low.isalpha() and unicodedata.is_normalized("NFC", word) and unicodedata.is_normalized("NFC", low)):
                return None
            word = low.encode().decode("latin-1").translate(_BYTE_CHARS)
        written = self.written
        return b"".join([written[t.id] for t in self.model.tokenize(word)])

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in pieces], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in out]

    def encode(self, text: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if b"<|" in text:
            return self._encode([text])[0]
        pieces = _SPLIT_PUNCTUATION.sub(rb"\1 \2", text.lower()).split()
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        if None in found:
            other, long = [], {}
            for p in {p for p, v in zip(pieces, found, strict=True) if v is None}:
                v = old.get(p) or self._piece(p)
                if v is None:
                    other.append(p)
                elif len(p) <= self.longest:
                    young[p] = v
                else:
                    long[p] = v
            for p, v in zip(other, self._encode(other) if other else [], strict=True):
                (young if len(p) <= self.longest else long)[p] = v
            found = map(young.__getitem__, pieces) if not long else [long[p] if p in long else young[p] for p in pieces]
            if len(young) > self.known:
                self.old, self.young = young, {}
        return b"".join(found)


def _merge(a: tuple[list, list], b: tuple[list, list], bins: int) -> tuple[list, list]:
    """Two partial partitions as one. Each is (sums falling, members of each bin); absent bins are empty."""
    (xs, xm), (ys, ym) = a, b
    n, m = len(xs), len(ys)
    over = n + m - bins
    if over <= 0:
        pairs = [*zip(xs, xm), *zip(ys, ym)]
    else:  # the over lightest bins of each meet, light with heavy
        pairs = [*zip(xs[: n - over], xm[: n - over]), *zip(ys[: m - over], ym[: m - over])]
        pairs += [(xs[n - over + i] + ys[m - 1 - i], (xm[n - over + i], ym[m - 1 - i])) for i in range(over)]
    pairs.sort(key=lambda p: -p[0])
    return [p[0] for p in pairs], [p[1] for p in pairs]


def difference(sizes: list[int], bins: int) -> list[list[int]]:
    """Indexes of sizes in ``bins`` groups with near-equal sums (some may be empty)."""
    heap = [(-s, i, ([s], [i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        c = _merge(a, b, bins)
        spread = c[0][0] - (c[0][-1] if len(c[0]) == bins else 0)
        heapq.heappush(heap, (-spread, tie, c))
        tie += 1
    out: list[list[int]] = []
    for tree in heap[0][2][1] if heap else []:
        members, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                members.append(x)
        out.append(members)
    return out + [[] for _ in range(bins - len(out))]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Groups of at most ``capacity``; the number of groups rises until none exceeds it."""
    if not sizes:
        return []
    bins = -(-sum(sizes) // capacity)
    while True:
        groups = difference(sizes, bins)
        if all(sum(sizes[i] for i in g) <= capacity for g in groups):
            return [g for g in groups if g]
        bins += max(1, bins // 200)


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Packer:
    def __init__(self, window: int, block: int, piece: int, seed: int):
        self.window, self.block, self.piece, self.next = window, block, piece, seed << 36
        self.rows: list[tuple] = []
        self.held: list[tuple] = []  # (doc_id, start, length, ids, doc_tokens)

    def _sequence(self, pieces: list[tuple]) -> None:
        total, offset = sum(p[2] for p in pieces), 0
        for doc, start, length, ids, tokens in pieces:
            self.rows.append((doc, start, length, ids, tokens, self.next, offset, total))
            offset += length
        self.next += 1

    def add(self, doc: object, ids: bytes) -> None:
        tokens, w = len(ids) // 4, self.window
        whole = tokens - tokens % w
        for start in range(0, whole, w):
            self._sequence([(doc, start, w, ids[4 * start : 4 * (start + w)], tokens)])
        n = -(-(tokens - whole) // self.piece)
        cuts = [whole + (tokens - whole) * k // n for k in range(n + 1)] if n else []
        self.held += [(doc, a, b - a, ids[4 * a : 4 * b], tokens) for a, b in zip(cuts, cuts[1:], strict=False)]
        if len(self.held) >= self.block:
            self._flush()

    def _flush(self) -> None:
        for group in windows([p[2] for p in self.held], self.window):
            self._sequence([self.held[i] for i in group])
        self.held = []

    def _cut(self, n: int) -> list[tuple]:
        """Takes n tokens off the end of the held pieces."""
        taken = []
        while n:
            doc, start, length, ids, tokens = self.held.pop()
            k = min(n, length)
            taken.append((doc, start + length - k, k, ids[4 * (length - k) :], tokens))
            if k < length:
                self.held.append((doc, start, length - k, ids[: 4 * (length - k)], tokens))
            n -= k
        return taken

    def close(self) -> None:
        """The last block: a slack of one part in 256 lets the bins be level; the rest becomes powers of two."""
        total = sum(p[2] for p in self.held)
        bins = int(total // (self.window * 255 / 256))
        surplus = max(0, total - int(bins * self.window * 255 / 256)) if bins else total
        for size in _powers(surplus):
            self._sequence(self._cut(size))
        self._flush()


def pack(docs: DataFrame, tokenizer: str, *, id_column: str = "doc_id", text_column: str = "text", end_id: int = 2, window: int = 4096, block_pieces: int = 1024, piece_tokens: int = 1024) -> DataFrame:
    """Pieces of sequences of at most ``window`` tokens.

    ``tokenizer`` is a path that exists on every machine. Returns doc_id, start (the document's ids before the
    piece), length, ids (little-endian unsigned 32-bit), doc_tokens (with the end id), sequence_id, offset (in
    the sequence, gapless from 0) and sequence_tokens.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    schema = PIECES.format(id=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, end, types = ChunkEncoder.shared(tokenizer), end_id.to_bytes(4, "little"), None
        packer = _Packer(window, block_pieces, piece_tokens, TaskContext.get().partitionId())

        def emit() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) if packer.rows else [()] * 8
            packer.rows = []
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]
            return pa.RecordBatch.from_arrays([pa.array(c, types if i == 0 else pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(columns)], names)

        for batch in batches:
            types = batch.schema.field(0).type
            texts = batch.column(1).cast(pa.large_binary())
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                packer.add(doc, encoder.encode(text.as_py() or b"") + end)
                if len(packer.rows) >= 4096:
                    yield emit()
        packer.close()
        if packer.rows:
            yield emit()
        release()

    return source.mapInArrow(run, schema)
