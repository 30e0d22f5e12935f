"""Encoding and decoding with merge-type piece vocabularies, by an agenda of adjacent pairs.

The text's symbols start as single characters. All adjacent pairs whose joined text is a piece
wait in an agenda ordered by score, then by place; the best pair is joined, its neighbours form
new pairs, until none is left. Characters outside the vocabulary become byte pieces. No piece
crosses certain borders (before a space, around characters that occur in no longer piece), so
each stretch between them has an agenda of its own, and each task remembers stretches it has met.
The new short stretches of an Arrow batch are taken together: in every round, numpy finds the
best entry of each one's agenda. Long stretches keep theirs in a heap.

With `check`, the library encodes every new stretch of a batch and decodes every text's ids as
well, and `verified` tells whether all agree.

Defined cases: a missing or empty text has the begin and end ids only and decodes to the empty
text; strings of control pieces are ordinary text; U+2581 reads back as a space; repeated rows
and rows without an id are encoded like others; all columns but `doc_id` and `text` are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import batched, chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from kerbside.llm.common import slices, texts

SPACE = "▁"
CACHED = 300_000
# Characters of a stretch that goes with others; longer ones have a heap each.
SHORT = 64
# Stretches that the library checks in one call.
TOGETHER = 100


class Vocabulary:
    """Pieces, scores and text rules of a model file, with space in place of U+2581."""

    def __init__(self, model: bytes):
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        kinds = proto.ModelProto.SentencePiece
        trainer, normal = spec.trainer_spec, spec.normalizer_spec
        if trainer.model_type != proto.TrainerSpec.BPE:
            raise ValueError("the model is not of the merge type")
        if (normal.precompiled_charsmap or normal.remove_extra_whitespaces
                or not normal.escape_whitespaces or trainer.treat_whitespace_as_suffix):
            raise ValueError("only models that leave the text as it is are supported")
        if any(p.type == kinds.USER_DEFINED for p in spec.pieces):
            raise ValueError("pieces of one's own are not supported")
        self.prefix = " " if normal.add_dummy_prefix else ""
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.unused: set[str] = set()
        self.byte_ids: dict[int, int] = {}
        # What each id reads as.
        self.surface: list[bytes] = []
        # 0: text, 1: byte piece, 2: control piece. Byte pieces next to each other read together.
        self.kind = np.zeros(len(spec.pieces), dtype=np.int8)
        self.unknown = 0
        for i, piece in enumerate(spec.pieces):
            text = piece.piece.replace(SPACE, " ")
            surface = text.encode()
            if piece.type == kinds.BYTE:
                value = int(piece.piece[3:-1], 16)
                self.byte_ids[value] = i
                self.kind[i] = 1
                surface = bytes([value])
            elif piece.type == kinds.CONTROL:
                surface, self.kind[i] = b"", 2
            elif piece.type == kinds.UNKNOWN:
                self.unknown, surface = i, trainer.unk_surface.encode()
            else:
                self.ids[text], self.scores[text] = i, piece.score
                if piece.type == kinds.UNUSED:
                    self.unused.add(text)
            self.surface.append(surface)
        self.fallback = trainer.byte_fallback
        self.begin, self.end = trainer.bos_id, trainer.eos_id

    @cached_property
    def stretches(self) -> re.Pattern:
        """Matches the stretches of a text that no piece crosses."""
        longer = [p for p in self.scores if len(p) > 1]
        if any(re.search("[^ ] ", p) for p in longer):
            return re.compile(r"(?s).+")
        joined = sorted(set("".join(longer)) - {" "})
        inner = "[" + "".join(map(re.escape, joined)) + "]" if joined else "(?!)"
        return re.compile(rf"(?s) *{inner}+| +|.")

    def merge(self, stretch: str) -> list[str]:
        """The pieces of one stretch."""
        symbols, scores = list(stretch), self.scores
        last = len(symbols)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        agenda: list[tuple[float, int, int, int]] = []
        halves: dict[str, tuple[str, str]] = {}

        def offer(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            score = scores.get(joined)
            if score is not None:
                heapq.heappush(agenda, (-score, left, right, len(joined)))
                if joined in self.unused:
                    halves[joined] = symbols[left], symbols[right]

        for at in range(last - 1):
            offer(at, at + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one of the two has been joined meanwhile
            symbols[left], symbols[right] = a + b, ""
            after[left] = after[right]
            if after[left] < last:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        found: list[str] = []
        rest = [s for s in reversed(symbols) if s]
        while rest:
            piece = rest.pop()
            if piece in halves:  # pieces that may not be used are taken apart again
                rest += reversed(halves[piece])
            else:
                found.append(piece)
        return found

    def packed(self, pieces: list[str]) -> bytes:
        """The ids of pieces as little-endian unsigned 32-bit integers."""
        ids: list[int] = []
        for piece in pieces:
            found = self.ids.get(piece)
            if found is not None:
                ids.append(found)
            elif self.fallback:
                ids += [self.byte_ids[b] for b in piece.replace(" ", SPACE).encode()]
            else:
                ids.append(self.unknown)
        return np.array(ids, dtype="<u4").tobytes()

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of pairs of ids that join, in order; the ids they give; the scores' ranks by id."""
        size = len(self.surface)
        found = {
            self.ids[p[:k]] * size + self.ids[p[k:]]: i
            for p, i in self.ids.items() for k in range(1, len(p))
            if p[:k] in self.ids and p[k:] in self.ids
        }
        keys = np.array(sorted(found), dtype=np.int64)
        scores = np.full(size, -np.inf)
        scores[list(self.ids.values())] = [self.scores[p] for p in self.ids]
        ranks = np.unique(-scores, return_inverse=True)[1]
        return keys, np.array([found[k] for k in keys.tolist()], dtype=np.int64), ranks

    @cached_property
    def _characters(self) -> tuple[np.ndarray, np.ndarray]:
        """Code points that are pieces, in order, and their ids."""
        found = sorted((ord(p), i) for p, i in self.ids.items() if len(p) == 1)
        return tuple(np.array(c, dtype=np.int64) for c in zip(*found, strict=True))

    def merge_many(self, stretches: list[str]) -> list[bytes]:
        """The packed ids of short stretches, one agenda each, all advanced together."""
        if self.unused or not self.ids or not stretches:
            return [self.packed(self.merge(s)) for s in stretches]
        keys, gives, ranks = self._pairs
        points, point_ids = self._characters
        size = len(self.surface)
        none = np.iinfo(np.int64).max
        sizes = np.array([len(s) for s in stretches])
        code = np.frombuffer("".join(stretches).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(points, code), len(points) - 1)
        # A character outside the vocabulary is below zero and joins nothing.
        symbol = np.where(points[at] == code, point_ids[at], -code - 1)
        owner = np.repeat(np.arange(len(stretches)), sizes)

        def entries(left: np.ndarray) -> np.ndarray:
            """What the symbols at `left` give with the next ones, or -1."""
            a, b = symbol[left], symbol[left + 1]
            pair = np.where((a < 0) | (b < 0) | (owner[left] != owner[left + 1]), -1,
                            a * size + b)
            place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            return np.where(keys[place] == pair, gives[place], -1)

        def order(joined: np.ndarray, left: np.ndarray) -> np.ndarray:
            return np.where(joined < 0, none, (ranks[joined] << 32) + left)

        done: list[tuple[np.ndarray, np.ndarray]] = []
        joined = np.append(entries(np.arange(max(len(symbol) - 1, 0))), -1) if len(symbol) else symbol
        while len(symbol):
            place = np.arange(len(symbol))
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(order(joined, place), starts)
            left = (best[best != none] & 0xFFFFFFFF)
            symbol[left] = joined[left]
            stays = np.ones(len(symbol), dtype=bool)
            stays[left + 1] = False
            # Stretches without an entry are done.
            over = np.repeat(best == none, np.diff(np.append(starts, len(symbol))))
            done.append((owner[over], symbol[over]))
            stays &= ~over
            moved = np.cumsum(stays) - 1
            symbol, owner, joined = symbol[stays], owner[stays], joined[stays]
            if len(symbol):
                # The entries of a joined symbol and of the one before it.
                changed = np.zeros(len(symbol), dtype=bool)
                changed[moved[left]] = True
                changed[:-1] |= changed[1:]
                changed[-1] = False
                joined[-1] = -1
                changed = np.flatnonzero(changed)
                joined[changed] = entries(changed)
        owner = np.concatenate([o for o, _ in done])
        symbol = np.concatenate([s for _, s in done])
        by_owner = np.argsort(owner, kind="stable")
        symbol, bounds = symbol[by_owner], np.searchsorted(owner[by_owner],
                                                           np.arange(len(stretches) + 1))
        strange = np.unique(owner[by_owner][symbol < 0])
        raw, step = symbol.astype("<u4").tobytes(), 4 * bounds
        out = [raw[a:b] for a, b in zip(step[:-1].tolist(), step[1:].tolist(), strict=True)]
        for i in strange.tolist():
            out[i] = b"".join(
                np.uint32(s).tobytes() if s >= 0 else self.packed([chr(-s - 1)])
                for s in symbol[bounds[i] : bounds[i + 1]].tolist())
        return out


class Codec:
    """Encodes and decodes texts, remembering the stretches it has met."""

    def __init__(self, model: bytes, check: bool = False):
        self.vocabulary = Vocabulary(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model) if check else None
        self.known: dict[str, bytes] = {}
        # Stretches that the library encodes otherwise.
        self.odd: set[str] = set()
        self.open, self.close = (
            np.array([i] if i >= 0 else [], dtype="<u4").tobytes()
            for i in (self.vocabulary.begin, self.vocabulary.end))
        self.surface = np.array(self.vocabulary.surface, dtype=object)

    def encode(self, batch: list[str]) -> tuple[list[bytes], list[bool]]:
        """The packed ids of texts, with the begin and end ids; and whether the library agrees."""
        find, prefix = self.vocabulary.stretches.findall, self.vocabulary.prefix
        known = self.known
        if len(known) > CACHED:
            known.clear()
        cut = [find(prefix + t.replace(SPACE, " ")) if t else [] for t in batch]
        new = set(chain.from_iterable(cut)).difference(known)
        short = [s for s in new if len(s) <= SHORT]
        fresh = dict(zip(short, self.vocabulary.merge_many(short), strict=True))
        for s in new:
            if len(s) > SHORT:
                fresh[s] = self.vocabulary.packed(self.vocabulary.merge(s))
        if self.library is not None:
            self._compare(fresh)
        known.update(fresh)
        ids = [b"".join([self.open, *map(known.__getitem__, found), self.close]) for found in cut]
        right = [not self.odd or self.odd.isdisjoint(found) for found in cut]
        for s in new:
            if len(s) > SHORT:  # rarely met again
                del known[s]
        return ids, right

    def _compare(self, fresh: dict[str, bytes]) -> None:
        """Note stretches whose ids differ from the library's, many to a call.

        A character that no piece holds goes before each one, so that they stay apart.
        """
        v = self.vocabulary
        gap = next(c for c in map(chr, range(0xE000, 0xF900)) if not any(c in p for p in v.ids))
        mark = v.packed([gap])
        lead = b"".join(v.packed(v.merge(s)) for s in v.stretches.findall(v.prefix))
        groups = [list(g) for g in batched(fresh, TOGETHER)]
        theirs = self.library.encode([gap + gap.join(g) for g in groups], num_threads=1)
        for group, found in zip(groups, theirs, strict=True):
            ours = lead + b"".join(mark + fresh[s] for s in group)
            if np.array(found, dtype="<u4").tobytes() != ours:
                if len(group) == 1:
                    self.odd.update(group)
                else:
                    for s in group:
                        self._compare({s: fresh[s]})

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; the space put before the first word goes."""
        v = self.vocabulary
        ids = np.frombuffer(packed, dtype="<u4")
        parts, kind = self.surface[ids], v.kind[ids]
        spoken = np.flatnonzero(kind != 2)
        if not len(spoken):
            return ""
        first, last = spoken[0], spoken[-1] + 1
        if v.prefix and kind[first] == 0 and ids[first] != v.unknown and (
                parts[first][:1] == b" "):
            parts[first] = parts[first][1:]
        if len(spoken) == last - first:
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        out: list[str] = []
        for run in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(kind)) + 1):
            raw = b"".join(parts[run])
            if kind[run[0]] != 1:
                out.append(raw.decode())
                continue
            # Each byte that is not part of a character reads as U+FFFD.
            while raw:
                try:
                    out.append(raw.decode())
                    raw = b""
                except UnicodeDecodeError as bad:
                    out.append(raw[: bad.start].decode() + "\ufffd")
                    raw = raw[bad.start + 1 :]
        return "".join(out)


def encode_and_decode(docs: DataFrame, model_path: str, check: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded, verified) per row of docs.

    `ids` are packed as little-endian unsigned 32-bit integers, begin and end ids included;
    `verified` is null without `check`. The model file is read once, on the driver; its size does
    not depend on the documents.
    """
    with open(model_path, "rb") as file:
        model = file.read()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model, check)
        for batch in slices(batches):
            ids, agree = codec.encode(texts(batch))
            decoded = [codec.decode(i) for i in ids]
            if codec.library is not None:
                theirs = codec.library.decode([np.frombuffer(i, "<u4").tolist() for i in ids])
                agree = [a and b == c for a, b, c in zip(agree, decoded, theirs, strict=True)]
            else:
                agree = [None] * len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(decoded, pa.string()),
                 pa.array(agree, pa.bool_())],
                ["doc_id", "n_tokens", "ids", "decoded", "verified"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string, verified boolean")
