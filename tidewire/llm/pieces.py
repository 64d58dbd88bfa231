"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The vocabulary file is read once on the driver; its pieces travel with the tasks. A text is cut
where no piece can reach across: in front of every run of word marks, and between characters that
no chain of pieces connects (letters and punctuation). Each distinct word so cut is encoded once
per task and remembered. New words of a batch are laid out as one flat numpy array of symbols. A round takes every word's lowest pair rank, merges its leftmost pair of that rank in all
words at once, and closes the gaps; the rounds end when no pair is left. Words of more than
`LONG_WORD` symbols would need as many rounds, so each of them is merged with a heap in the same
order. A character without a piece becomes its UTF-8 bytes' pieces.

Nulls count as empty texts; an empty text has the begin and end ids only. Equal rows give equal
rows, an empty table gives an empty one, and columns other than the named ones are never touched.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewire.llm.common import in_batches, sha256, texts

MARK = "▁"
LONG_WORD = 512
CACHED_WORDS = 800_000
NONE = np.int64(1 << 40)
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Vocabulary:
    """Pieces of a BPE model without text normalisation, and its pairs ranked by score."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    unknown_surface: str
    begin: int
    end: int
    ids: dict[str, int] = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        if (
            norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces and trainer.byte_fallback)
            or trainer.treat_whitespace_as_suffix
            or trainer.model_type != trainer.BPE
        ):
            raise ValueError("only BPE models with byte fallback, a word mark in front and no normalisation are supported")
        pieces = model.pieces
        if any(p.type == USER for p in pieces) or any(
            re.search(f"[^{MARK}]{MARK}", p.piece) for p in pieces if p.type == NORMAL
        ):
            raise ValueError("pieces that reach across words are not supported")
        return cls(
            [p.piece for p in pieces],
            [p.score for p in pieces],
            [p.type for p in pieces],
            trainer.unk_surface,
            trainer.bos_id,
            trainer.eos_id,
        )

    def prepare(self) -> Encoder:
        return Encoder(self)


class Encoder:
    """The tables of one task and the words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.ids = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds, strict=True)) if k in (NORMAL, UNUSED)}
        order = {s: r for r, s in enumerate(sorted({v.scores[i] for i in self.ids.values()}, reverse=True))}
        self.size = len(v.pieces)
        pairs = sorted(
            (self.ids[p[:k]] * self.size + self.ids[p[k:]], order[v.scores[i]], i)
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in self.ids and p[k:] in self.ids
        )
        table = np.array(pairs or [(-1, NONE, 0)], dtype=np.int64)
        self.pair_keys, self.pair_ranks, self.pair_ids = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()
        self.segment = re.compile(self._segment_pattern())
        self.char_ids = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.surfaces: list[bytes] = []
        for i, (piece, kind) in enumerate(zip(v.pieces, v.kinds, strict=True)):
            if kind == BYTE:
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surfaces.append(bytes([value]))
            elif kind == CONTROL:
                self.surfaces.append(b"")
            else:
                surface = v.unknown_surface if kind == UNKNOWN else piece.replace(MARK, " ")
                self.surfaces.append(surface.encode())
        self.controls = {i for i, k in enumerate(v.kinds) if k == CONTROL}
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.pool = np.empty(0, dtype=np.int64)
        self.starts = np.empty(0, dtype=np.int64)
        self.lengths = np.empty(0, dtype=np.int64)

    def _segment_pattern(self) -> str:
        """Word marks, then characters all inside or all outside the largest set that pieces connect."""
        parent: dict[str, str] = {}

        def root(c: str) -> str:
            while parent.setdefault(c, c) != c:
                parent[c] = c = parent[parent[c]]
            return c

        for piece in self.ids:
            chars = piece.lstrip(MARK)
            for a, b in zip(chars, chars[1:], strict=False):
                parent[root(a)] = root(b)
        sets: dict[str, list[str]] = {}
        for c in parent:
            sets.setdefault(root(c), []).append(c)
        inside = "".join(map(re.escape, sorted(max(sets.values(), key=len, default=["a"]))))
        return f"{MARK}*[{inside}]+|{MARK}*[^{MARK}{inside}]+|{MARK}+"

    # --- merging ------------------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of symbol pairs; symbols below zero have no piece."""
        keys = np.where((left < 0) | (right < 0), -2, left * self.size + right)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        found = self.pair_keys[at] == keys
        return np.where(found, self.pair_ranks[at], NONE), self.pair_ids[at]

    def _symbols(self, words: str) -> np.ndarray:
        """Piece ids of characters; a character without one is below zero."""
        points = np.frombuffer(words.encode("utf-32-le"), dtype="<u4").astype(np.int64)
        ids = self.char_ids[points].astype(np.int64)
        return np.where(ids < 0, -points - 1, ids)

    def merge_rounds(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges flat symbols until no pair is left. `words` numbers each symbol's word, ascending."""
        done_symbols, done_words = [], []
        while len(symbols):
            rank = np.full(len(symbols), NONE)
            merged = np.zeros(len(symbols), dtype=np.int64)
            inside = np.flatnonzero(words[:-1] == words[1:])
            rank[inside], merged[inside] = self._ranks(symbols[inside], symbols[inside + 1])
            while True:
                first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
                counts = np.diff(np.r_[first, len(words)])
                least = np.repeat(np.minimum.reduceat(rank, first), counts)
                hits = np.flatnonzero((rank == least) & (least < NONE))
                if not len(hits):
                    done_symbols.append(symbols)
                    done_words.append(words)
                    symbols = symbols[:0]
                    break
                hits = hits[np.r_[True, words[hits[1:]] != words[hits[:-1]]]]
                symbols[hits] = merged[hits]
                keep = np.ones(len(symbols), dtype=bool)
                keep[hits + 1] = False
                # Only the pairs on both sides of a merged symbol are new.
                rank[hits] = rank[hits + 1]
                place = np.cumsum(keep) - 1
                symbols, words, rank, merged = symbols[keep], words[keep], rank[keep], merged[keep]
                at = place[hits]
                for left in (at - 1, at):
                    left = left[(left >= 0) & (left + 1 < len(words))]
                    same = words[left] == words[left + 1]
                    rank[left[~same]] = NONE
                    left = left[same]
                    rank[left], merged[left] = self._ranks(symbols[left], symbols[left + 1])
                rank[at[at == len(words) - 1]] = NONE
                if np.count_nonzero(least == NONE) * 2 > len(least):
                    # Most words are finished: set them aside and go on with the rest.
                    ended = (least == NONE)[keep]
                    done_symbols.append(symbols[ended])
                    done_words.append(words[ended])
                    symbols, words = symbols[~ended], words[~ended]
                    break
        if not done_symbols:
            return symbols, words
        symbols, words = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """The same merges for one long word, from a heap of pairs by rank and place."""
        n = len(symbols)
        before, after, live = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        ranks, merged = self._ranks(np.array(symbols[:-1]), np.array(symbols[1:]))
        known = {}
        heap = [
            (int(r), i, symbols[i], symbols[i + 1], int(m))
            for i, (r, m) in enumerate(zip(ranks, merged, strict=True))
            if r < NONE
        ]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, piece = heapq.heappop(heap)
            j = after[i]
            if not live[i] or symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], live[j], after[i] = piece, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n:
                    key = (symbols[a], symbols[b])
                    if key not in known:
                        r, m = self._ranks(np.array([key[0]]), np.array([key[1]]))
                        known[key] = (int(r[0]), int(m[0]))
                    r, m = known[key]
                    if r < NONE:
                        heapq.heappush(heap, (r, a, *key, m))
        return [s for s, alive in zip(symbols, live, strict=True) if alive]

    def _learn(self, new: list[str]) -> None:
        """Encodes words and adds their ids to the pool."""
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        symbols, words = self._symbols("".join(new)), np.repeat(np.arange(len(new)), sizes)
        if (sizes > LONG_WORD).any():
            cuts = np.split(symbols, np.cumsum(sizes)[:-1])
            # Nothing is left to merge in them; the rounds pass them on.
            cuts = [np.array(self.merge_long(c.tolist())) if len(c) > LONG_WORD else c for c in cuts]
            symbols, words = np.concatenate(cuts), np.repeat(np.arange(len(new)), list(map(len, cuts)))
        symbols, words = self.merge_rounds(symbols, words)
        missing = symbols < 0
        if missing.any():
            spelled = [np.frombuffer(chr(-s - 1).encode(), np.uint8) for s in symbols[missing].tolist()]
            sizes = np.ones(len(symbols), dtype=np.int64)
            sizes[missing] = [len(b) for b in spelled]
            out = np.repeat(symbols, sizes)
            out[np.repeat(missing, sizes)] = self.byte_ids[np.concatenate(spelled)]
            symbols, words = out, np.repeat(words, sizes)
        lengths = np.bincount(words, minlength=len(new))
        starts = len(self.pool) + np.cumsum(lengths) - lengths
        base = len(self.words)
        self.words.update((w, base + n) for n, w in enumerate(new))
        self.pool = np.concatenate([self.pool, symbols])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of every text, with the begin and the end id."""
        if len(self.words) > CACHED_WORDS:
            self._forget()
        cut = [self.segment.findall(MARK + t.replace(" ", MARK)) if t else [] for t in batch]
        new = list(set().union(*cut).difference(self.words))
        if new:
            self._learn(new)
        ends = (np.array([self.vocabulary.begin]), np.array([self.vocabulary.end]))
        out = []
        for words in cut:
            at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            lengths = self.lengths[at]
            skip = np.cumsum(lengths) - lengths
            ids = self.pool[np.repeat(self.starts[at] - skip, lengths) + np.arange(lengths.sum())]
            out.append(np.concatenate([ends[0], ids, ends[1]]).astype("<u4"))
        return out

    # --- decoding -----------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the first piece's word mark and control pieces vanish, bad bytes become U+FFFD."""
        joined = b"".join(map(self.surfaces.__getitem__, ids))
        kinds = self.vocabulary.kinds
        first = next((i for i in ids if kinds[i] != CONTROL), None)
        strip = first is not None and kinds[first] in (NORMAL, UNUSED) and self.surfaces[first].startswith(b" ")
        if self.controls.isdisjoint(ids[1:-1]):
            try:
                return joined[strip:].decode()
            except UnicodeDecodeError:
                pass
        # A control piece inside ends a run of bytes, too.
        return self._decode_runs(ids)[strip:]

    def _decode_runs(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.vocabulary.kinds[i] == BYTE:
                run += self.surfaces[i]
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    run = run[1:]
            if i is not None:
                out.append(self.surfaces[i].decode())
        return "".join(out)


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, `n_tokens` and `ids` with begin and end ids."""
    vocabulary = Vocabulary.load(model_path)
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        ids = encoder.encode(texts(batch, text))
        sizes = np.array([len(i) for i in ids])
        offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        values = pa.array(np.concatenate(ids).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [batch.column(key), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, values)],
            [key, "n_tokens", "ids"],
        )

    return in_batches(docs.select(key, text), work, f"`{key}` {kind}, n_tokens bigint, ids array<int>", vocabulary.prepare)


def round_trip(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, `n_tokens`, digests of its ids and of the text decoded from them.

    Ids are digested as little-endian unsigned 32-bit integers, the text as UTF-8. They are encoded
    and decoded in one pass, so that ids do not travel.
    """
    vocabulary = Vocabulary.load(model_path)
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
        ids = encoder.encode(texts(batch, text))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(key),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([sha256(i.tobytes()) for i in ids]),
                pa.array([sha256(encoder.decode(i.tolist()).encode()) for i in ids]),
            ],
            [key, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return in_batches(docs.select(key, text), work, schema, vocabulary.prepare)
