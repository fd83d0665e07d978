"""SentencePiece encoding and decoding by streaming Viterbi.

The best segmentation of a text under piece scores is found left to right.  Only the best score
per boundary within reach of the longest piece is retained; when every path that can still
survive runs through one boundary, the ids up to it are committed and forgotten (`Stream`).

A space that follows another character is such a boundary whenever no piece of the vocabulary has
a space after a character.  `Encoder` therefore cuts texts there, encodes each distinct cut of a
batch once, and commits it whole: short cuts side by side in numpy, one character a step, long
ones through a `Stream`.

Spaces become the piece space mark, one is put in front, and characters without a piece become
byte pieces, a literal space mark too, so that decoding gives every text back exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from terrasse.llm.words import plain, runs_of, text_bytes

MARK = "▁"
CACHE = 250_000  # distinct cuts whose ids an encoder remembers from batch to batch; a full memory starts anew
LANE = 64  # longest cut, in characters, that is encoded side by side with others
BYTE_PENALTY = 10.0
SCALE = 1 << 20  # scores are whole multiples of 1 / SCALE, so that sums are exact and ties the same everywhere
NEVER = -(1 << 62)


def zipf(ranks: list[float]) -> list[float]:
    """Log probabilities of pieces whose frequency falls as one over their rank."""
    share = 1 / (np.array(ranks) + 2.0)
    return np.log(share / share.sum()).tolist()


@dataclass
class Pieces:
    """A vocabulary as arrays: a trie over character classes and the bytes and score of every piece."""

    texts: list[str]
    scores: list[float]
    byte_ids: list[int]  # ids of the pieces of single bytes 0 … 255
    bos: int = 1
    eos: int = 2
    spoken: list[bytes] = field(default_factory=list)

    @classmethod
    def load(cls, model_file: str) -> Pieces:
        """Read a model file.  Ranks of a merge vocabulary (whole, falling scores) become Zipf log probabilities."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.GetPieceSize()
        texts, scores, byte_ids = [], [], [-1] * 256
        for i in range(n):
            if model.IsByte(i):
                byte_ids[int(model.IdToPiece(i)[3:5], 16)] = i
            real = not (model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i))
            texts.append(model.IdToPiece(i) if real else "")
            scores.append(model.GetScore(i))
        if all(s == int(s) for s in scores):
            real = [i for i, t in enumerate(texts) if t]
            for i, score in zip(real, zipf([-scores[i] for i in real]), strict=True):
                scores[i] = score
        return cls(texts, scores, byte_ids, model.bos_id(), model.eos_id())

    def __post_init__(self) -> None:
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary needs a piece for every byte")
        self.spoken = [t.replace(MARK, " ").encode() for t in self.texts]
        for b, i in enumerate(self.byte_ids):
            self.spoken[i] = bytes([b])
        self.voice = np.frombuffer(b"".join(self.spoken), np.uint8)
        self.voice_ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, self.spoken), np.int64, len(self.spoken)))))
        self.reach = max(map(len, self.texts))
        self.scores = [round(s * SCALE) for s in self.scores]
        self.lowest = min(s for s, t in zip(self.scores, self.texts, strict=True) if t) - round(BYTE_PENALTY * SCALE)
        self.cuttable = not any(MARK in t.lstrip(MARK) for t in self.texts)
        chars = sorted({c for t in self.texts for c in t})
        self.classes = np.zeros(0x110000, np.int32)  # 0: in no piece
        for k, c in enumerate(chars, 1):
            self.classes[ord(c)] = k
        self.classes[ord(" ")] = self.classes[ord(MARK)]
        self.classes[ord(MARK)] = 0  # a literal mark is not a space
        self.width = len(chars) + 1
        step: dict[int, int] = {}
        piece = [-1]
        for i, t in enumerate(self.texts):
            state = 0
            for c in t.replace(MARK, " "):
                key = state * self.width + int(self.classes[ord(c)])
                if key not in step:
                    step[key] = len(piece)
                    piece.append(-1)
                state = step[key]
            if t:
                piece[state] = i
        self.step, self.piece = step, np.array(piece, np.int32)
        self.score_of = np.array(self.scores, np.int64)
        inner = np.zeros(len(piece), bool)
        inner[[k // self.width for k in step]] = True
        self.inner = inner
        self._hash_table()

    def _hash_table(self) -> None:
        bits = max(10, (4 * len(self.step)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.next = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        for key, state in self.step.items():
            at = self._slot(np.array([key]))[0]
            while self.keys[at] >= 0:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.next[at] = key, state

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def follow(self, key: np.ndarray) -> np.ndarray:
        """Next trie state for ``state * width + class``, -1 for none."""
        at, out = self._slot(key), np.full(len(key), -1, np.int32)
        left = np.arange(len(key))
        while len(left):
            held = self.keys[at[left]]
            hit = held == key[left]
            out[left[hit]] = self.next[at[left[hit]]]
            left = left[~hit & (held >= 0)]
            at[left] = (at[left] + 1) % len(self.keys)
        return out


class Stream:
    """Viterbi over one text that arrives in parts.

    A boundary is open while a piece may still start from it: the last one, and those at most a piece's length back from which
    the text so far is the beginning of a piece.  Only open boundaries keep scores.  The others are nodes of the tree of back
    pointers; one that no path leads through any more goes, and with it those that led to it alone.  The root is the last committed
    boundary: while it is not open and has one child, all surviving paths run through that child, and its id is certain.  Every boundary
    enters and leaves once, so the work is linear in the text, whether paths meet or, as in a long run of one character, do not.
    """

    def __init__(self, pieces: Pieces, start: bool = True):
        self.p = pieces
        self.end = self.base = 0
        self.best = {0: 0}  # open boundaries
        self.back: dict[int, tuple[int, int]] = {}  # boundary -> (boundary before, id or -1 - code point)
        self.children = {0: 0}
        self.child_sum = {0: 0}  # of their positions, so that an only child is known
        self.alive: list[tuple[int, int]] = []  # (start, trie state) of pieces that may still grow
        self.start = start

    def feed(self, text: str) -> Iterator[int]:
        """Ids that became certain."""
        if self.start:
            text, self.start = " " + text, False
        p, step, piece, width, scores = self.p, self.p.step, self.p.piece, self.p.width, self.p.scores
        best, back, children, child_sum = self.best, self.back, self.children, self.child_sum
        for c in text:
            code = ord(c)
            kind = int(p.classes[code])
            end = self.end + 1
            alive, shut, top, link = [], [], NEVER, None
            for start, state in [*self.alive, (self.end, 0)]:
                state = step.get(state * width + kind, -1) if kind else -1
                if state >= 0:
                    found = piece[state]
                    if found >= 0 and best[start] + scores[found] > top:
                        top, link = best[start] + scores[found], (start, int(found))
                    if p.inner[state]:
                        alive.append((start, state))
                        continue
                shut.append(start)
            single = step.get(kind, -1) if kind else -1
            if single < 0 or piece[single] < 0:
                value = best[self.end] + p.lowest * len(c.encode())
                if value > top:
                    top, link = value, (self.end, -1 - code)
            best[end], back[end], self.alive, self.end = top, link, alive, end
            children[end] = child_sum[end] = 0
            children[link[0]] += 1
            child_sum[link[0]] += end
            for at in shut:
                del best[at]
                while not children[at] and at not in best and at != self.base:
                    before = back.pop(at)[0]
                    del children[at], child_sum[at]
                    children[before] -= 1
                    child_sum[before] -= at
                    at = before
            if shut and children[self.base] == 1 and self.base not in best:
                yield from self._commit()

    def finish(self) -> Iterator[int]:
        """The rest, along the best path to the end."""
        ids, at = [], self.end
        while at > self.base:
            at, found = self.back[at]
            ids.append(found)
        for found in reversed(ids):
            yield from self._said(found)
        self.base, self.alive = self.end, []
        self.best, self.back, self.children, self.child_sum = {self.end: self.best[self.end]}, {}, {self.end: 0}, {self.end: 0}

    def _commit(self) -> Iterator[int]:
        """Move the root along while it has one child that every path runs through."""
        while self.children[self.base] == 1 and self.base not in self.best:
            child = self.child_sum.pop(self.base)
            del self.children[self.base]
            self.base = child
            yield from self._said(self.back.pop(child)[1])

    def _said(self, found: int) -> Iterator[int]:
        if found >= 0:
            yield found
        else:
            yield from (self.p.byte_ids[b] for b in chr(-1 - found).encode())


class Encoder:
    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.byte_ids = np.array(pieces.byte_ids, np.int32)
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.at, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each row's ids start, and all ids.  A null or empty text has no ids."""
        texts = plain(texts)
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        data, ends = text_bytes(pc.if_else(pa.array(empty), "", pc.binary_join_element_wise("", texts, " ")))
        n = len(texts)
        if self.p.cuttable:
            space = data == 32
            cut = space & ~np.concatenate(([False], space[:-1])) if len(data) else space
            cut[ends[:-1][~empty]] = True
            cut = np.flatnonzero(cut)
        else:
            cut = ends[:-1][~empty]
        first = np.searchsorted(cut, ends)
        if not len(cut):
            return np.zeros(n + 1, np.int64), np.zeros(0, np.int32)
        offsets = np.append(cut, len(data)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        which = self.remembered(parts.dictionary)[parts.indices.to_numpy()]
        count = np.diff(self.at)[which]
        flat = self.ids[np.repeat(self.at[which], count) + runs_of(count)]
        return np.concatenate(([0], np.cumsum(count)))[first], flat

    def remembered(self, parts: pa.Array) -> np.ndarray:
        """Number of each distinct segment in ``at`` and ``ids``, new ones encoded and added."""
        names = parts.to_pylist()
        if len(self.number) + len(names) > CACHE:
            self.forget()
        known = self.number.get
        number = np.fromiter((known(name, -1) for name in names), np.int64, len(names))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            at, ids = self.segments(parts.take(pa.array(fresh)))
            number[fresh] = np.arange(len(self.number), len(self.number) + len(fresh))
            self.number.update((names[i], n) for i, n in zip(fresh.tolist(), number[fresh].tolist(), strict=True))
            self.at, self.ids = np.concatenate((self.at, at[1:] + self.at[-1])), np.concatenate((self.ids, ids))
        return number

    def segments(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each distinct segment (space in front already there)."""
        parts = parts.cast(pa.string())
        chars = np.frombuffer(text_bytes(parts)[0].tobytes().decode().encode("utf-32-le"), np.uint32)
        length = pc.utf8_length(parts).to_numpy().astype(np.int64)
        ends = np.cumsum(length)
        short = length <= LANE
        lane, counts, ids = self.lanes(chars, ends - length, length, short)
        pieces: dict[int, np.ndarray] = {}
        for i in np.flatnonzero(~short):
            stream = Stream(self.p, start=False)
            body = chars[ends[i] - length[i] : ends[i]].tobytes().decode("utf-32-le")
            pieces[int(i)] = np.array([*stream.feed(body), *stream.finish()], np.int32)
        total = np.zeros(len(parts), np.int64)
        total[lane] = counts
        for i, got in pieces.items():
            total[i] = len(got)
        at = np.concatenate(([0], np.cumsum(total)))
        out = np.empty(at[-1], np.int32)
        out[np.repeat(at[lane], counts) + runs_of(counts)] = ids
        for i, got in pieces.items():
            out[at[i] : at[i + 1]] = got
        return at, out

    def lanes(self, chars: np.ndarray, begin: np.ndarray, length: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Short segments in step: numbers of the segments, ids per segment, ids."""
        p, lane = self.p, np.flatnonzero(short)
        size = length[lane]
        pos = np.repeat(begin[lane], size) + runs_of(size)
        code, kind, offset = chars[pos], p.classes[chars[pos]].astype(np.int64), runs_of(size)
        of = np.repeat(np.arange(len(lane)), size)
        left = np.repeat(size, size) - offset  # characters to the end of the segment
        n = len(pos)

        found: list[tuple[np.ndarray, int, np.ndarray]] = []
        alive, state = np.arange(n, dtype=np.int32), np.zeros(n, np.int64)
        for reach in range(1, p.reach + 1):
            state = p.follow(state * p.width + kind[alive + reach - 1]).astype(np.int64)
            ok = state >= 0
            alive, state = alive[ok], state[ok]
            piece = p.piece[state]
            if reach == 1:
                bare = np.ones(n, bool)
                bare[alive[piece >= 0]] = False
            found.append((alive[piece >= 0], reach, piece[piece >= 0]))
            ok = left[alive] > reach
            alive, state = alive[ok], state[ok]
        bare = np.flatnonzero(bare).astype(np.int32)
        point = code[bare].astype(np.int32)
        n_bytes = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)

        # One slot more than characters per lane; slot = boundary.
        slot = np.arange(n, dtype=np.int32) + of.astype(np.int32)
        best, link, back = np.full(n + len(lane), NEVER), np.zeros(n + len(lane), np.int32), np.zeros(n + len(lane), np.int32)
        best[np.cumsum(size + 1) - size - 1] = 0
        start = np.concatenate([f[0] for f in found] + [bare])
        reach = np.concatenate([np.full(len(f[0]), f[1], np.int32) for f in found] + [np.ones(len(bare), np.int32)])
        value = np.concatenate([p.score_of[f[2]] for f in found] + [p.lowest * n_bytes])
        ident = np.concatenate([f[2] for f in found] + [-1 - point])
        group = (offset[start] * (p.reach + 1) + reach).astype(np.uint16 if LANE * (p.reach + 1) < 1 << 16 else np.int64)
        order = np.argsort(group, kind="stable")
        start, reach, value, ident, group = (x[order] for x in (slot[start], reach, value, ident, group))
        edges = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
        for x, y in zip(edges, np.append(edges[1:], len(group)), strict=True):  # by start, then length: earlier starts win ties
            to = start[x:y] + reach[x:y]
            score = best[start[x:y]] + value[x:y]
            better = score > best[to]
            to = to[better]
            best[to], link[to], back[to] = score[better], ident[x:y][better], reach[x:y][better]

        at, active, steps = np.cumsum(size + 1) - 1, np.arange(len(lane)), []
        base = at - size
        while len(active):
            steps.append((active, link[at[active]]))
            at[active] -= back[at[active]]
            active = active[at[active] > base[active]]
        count = np.zeros(len(lane), np.int64)
        for active, _ in steps:
            count[active] += 1
        first = np.cumsum(count) - count
        ids = np.empty(count.sum(), np.int64)
        for k, (active, got) in enumerate(steps):
            ids[first[active] + count[active] - 1 - k] = got
        owner = np.repeat(np.arange(len(lane)), count)
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            wide = np.ones(len(ids), np.int64)
            point = -1 - ids[lost]
            wide[lost] = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
            raw = np.frombuffer(point.astype(np.uint32).tobytes().decode("utf-32-le").encode(), np.uint8)
            ids, owner = np.repeat(ids, wide), np.repeat(owner, wide)
            ids[ids < 0] = self.byte_ids[raw]
            count = np.bincount(owner, minlength=len(lane))
        return lane, count, ids.astype(np.int32)


def spell(pieces: Pieces, starts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of many lists of ids in a row, the space in front of each still there, and their ends."""
    begin = pieces.voice_ends[ids]
    count = pieces.voice_ends[ids + 1] - begin
    ends = np.concatenate(([0], np.cumsum(count)))[starts]
    return pieces.voice[np.repeat(begin, count) + runs_of(count)], ends


def decode_lists(pieces: Pieces, lists: pa.Array) -> pa.Array:
    """The text of each list of ids; control ids say nothing, broken bytes become replacement characters, null stays null."""
    starts, ids = lists.offsets.to_numpy().astype(np.int64), lists.flatten().to_numpy().astype(np.int64)
    data, ends = spell(pieces, starts - starts[0], ids)
    whole = data.tobytes()
    texts = [whole[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    texts = [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts]
    return pa.array([t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist(), strict=True)], pa.string())


def decode(pieces: Pieces, ids: list[int]) -> str:
    return decode_lists(pieces, pa.array([ids], pa.list_(pa.int32())))[0].as_py()
