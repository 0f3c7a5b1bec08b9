"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

A text becomes symbols (characters). All adjacent pairs whose joint text is a
piece wait on an agenda, the best score first and the leftmost of equals; each
step takes the best pair, joins it and puts the two new neighbours on the
agenda. Symbols that are no piece at the end become bytes.

No piece holds a space mark after another character (checked when a model is
loaded), so a text falls apart before every run of space marks, and each
distinct chunk is encoded once: short ones of a batch side by side in numpy,
one agenda step for every chunk at a time, long ones alone on a heap, so that
a text without spaces costs n log n. In each Arrow batch the sentencepiece
library encodes all chunks that are new, which must agree, and decodes all
texts, which must come back whole.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common

SPACE = "▁"
SHORT = 24
#: Chunks a worker remembers in each of two generations; the older one goes when the younger is full.
REMEMBERED = 120_000


class Pieces:
    """A merge-type vocabulary, read from a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(self.library)
        kinds = [not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i)) for i in range(n)]
        self.ids = {self.library.id_to_piece(i): i for i in range(n) if kinds[i]}
        self.scores = [self.library.get_score(i) for i in range(n)]
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bos, self.eos, self.unknown = self.library.bos_id(), self.library.eos_id(), self.library.unk_id()
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece holds a space mark after another character: chunks would not be independent")
        if any(self.library.is_unused(i) for i in range(n)):
            raise ValueError("unused pieces are not supported")
        if any(b == self.unknown for b in self.bytes):
            raise ValueError("the vocabulary has no byte pieces")
        if any("\n" in p for p in self.ids):
            raise ValueError("a piece holds a line break")
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        # symbols beyond the vocabulary (single characters) are numbered from n on, as they are met
        self.extra: dict[str, int] = {}
        self._tables()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _tables(self) -> None:
        """Pairs of pieces that join to a piece, as sorted keys with the joint id and rank."""
        keys, joint = [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 20 | right)
                    joint.append(i)
        # characters that are no piece of their own may still be halves of a piece
        known = {c for p in self.ids for c in p}
        for c in known - set(self.ids):
            self.extra[c] = len(self.scores) + len(self.extra)
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                halves = piece[:cut], piece[cut:]
                if any(h in self.extra for h in halves) and all(h in self.ids or h in self.extra for h in halves):
                    keys.append(self._symbol(halves[0]) << 20 | self._symbol(halves[1]))
                    joint.append(i)
        order = np.argsort(keys, kind="stable")
        self.keys, self.joint = np.array(keys, np.int64)[order], np.array(joint, np.int32)[order]
        score = np.array(self.scores)
        levels = np.unique(score)  # ascending: a higher rank is a better score
        self.rank = np.searchsorted(levels, score).astype(np.int32) + 1
        # the pair table by open addressing: a power of two of slots, at most a quarter of them filled
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full((1 << bits) + 64, -1, np.int64)
        self.slot_joint = np.full((1 << bits) + 64, -1, np.int32)
        left = np.arange(len(self.keys))
        at = self._slot(self.keys)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.slots[at] == -1
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            first = first[free[first]]
            self.slots[at[first]], self.slot_joint[at[first]] = self.keys[left[first]], self.joint[left[first]]
            keep = np.ones(len(left), bool)
            keep[first] = False
            left, at = left[keep], at[keep] + 1
        if self.probes > 60:
            raise ValueError("the pair table is too uneven")
        self.pairs = {int(k): int(j) for k, j in zip(self.keys, self.joint, strict=True)}

    def _symbol(self, c: str) -> int:
        found = self.ids.get(c)
        if found is None:
            found = self.extra.setdefault(c, len(self.scores) + len(self.extra))
        return found

    def _ids(self, symbols: list[int], names: dict[int, str]) -> list[int]:
        out = []
        for s in symbols:
            if s < len(self.scores):
                out.append(s)
            else:
                out += [self.bytes[b] for b in names[s].encode()]
        return out

    def alone(self, chunk: str) -> bytes:
        """One chunk by an agenda on a heap."""
        names = {self._symbol(c): c for c in set(chunk)}
        symbol = [self._symbol(c) for c in chunk]
        after, before = list(range(1, len(symbol))) + [-1], list(range(-1, len(symbol) - 1))
        agenda: list[tuple[float, int, int, int, int]] = []

        def propose(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (joint := self.pairs.get(symbol[a] << 20 | symbol[b])) is not None:
                heapq.heappush(agenda, (-self.scores[joint], a, symbol[a], symbol[b], joint))

        for i in range(len(symbol) - 1):
            propose(i, i + 1)
        while agenda:
            _, a, left, right, joint = heapq.heappop(agenda)
            b = after[a]
            if symbol[a] != left or b < 0 or symbol[b] != right:
                continue
            symbol[a], symbol[b], after[a] = joint, -1, after[b]
            if after[b] >= 0:
                before[after[b]] = a
            propose(before[a], a)
            propose(a, after[a])
        return np.array(self._ids([s for s in symbol if s >= 0], names), "<u4").tobytes()

    def together(self, chunks: list[str]) -> list[bytes]:
        """Short chunks side by side: in each step every chunk takes the best pair on its agenda."""
        text = "".join(chunks)
        size = np.array([len(c) for c in chunks], np.int64)
        wide = int(size.max())
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        some, which = np.unique(code, return_inverse=True)
        names = {self._symbol(chr(c)): chr(c) for c in some.tolist()}
        number = np.array([self._symbol(chr(c)) for c in some.tolist()], np.int32)
        grid = np.full((len(chunks), wide + 1), -1, np.int32)
        row = np.repeat(np.arange(len(chunks)), size)
        grid[row, np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)] = number[which]
        length = size.copy()
        joint = self._joint(grid[:, :-1], grid[:, 1:])
        best = np.where(joint >= 0, self.rank[joint], np.int32(0))
        active = np.arange(len(chunks))
        while len(active):
            at = best[active].argmax(axis=1)  # the leftmost of the best
            good = best[active, at] > 0
            active, at = active[good], at[good]
            if not len(active):
                break
            width = int(length[active].max())
            g = grid[active, : width + 1]
            g[np.arange(len(active)), at] = joint[active, at]
            moved = np.arange(width + 1)[None, :] + (np.arange(width + 1)[None, :] > at[:, None])
            moved = np.minimum(moved, width)
            g = np.take_along_axis(g, moved, axis=1)
            g[:, width] = -1
            grid[active, : width + 1] = g
            length[active] -= 1
            # pairs move along with their left symbol; only those about the new symbol change
            near = np.minimum(moved[:, :width], width - 1)
            joint[active, :width] = np.take_along_axis(joint[active, :width], near, axis=1)
            best[active, :width] = np.take_along_axis(best[active, :width], near, axis=1)
            joint[active, width - 1], best[active, width - 1] = -1, 0
            for shift in (-1, 0):
                place = at + shift
                ok = (place >= 0) & (place < width)
                who, where = active[ok], place[ok]
                new = self._joint(grid[who, where], grid[who, where + 1])
                joint[who, where] = new
                best[who, where] = np.where(new >= 0, self.rank[new], 0)
        ids = grid[np.arange(wide + 1)[None, :] < length[:, None]]
        ends = np.cumsum(length)
        raw = ids.astype("<u4").tobytes()
        out = [raw[4 * x : 4 * y] for x, y in zip((ends - length).tolist(), ends.tolist(), strict=True)]
        for r in np.unique(np.searchsorted(ends, np.flatnonzero(ids >= len(self.scores)), side="right")).tolist():
            out[r] = np.array(self._ids(grid[r, : length[r]].tolist(), names), "<u4").tobytes()
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair joins to, or -1."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) << 20 | right, -2)
        flat = key.ravel()
        out = np.full(len(flat), -1, np.int32)
        at = self._slot(flat)
        look = np.flatnonzero(self.slots[at] != -1)
        for _ in range(self.probes):
            if not len(look):
                break
            slot = at[look]
            hit = self.slots[slot] == flat[look]
            out[look[hit]] = self.slot_joint[slot[hit]]
            look = look[~hit]
            at[look] += 1
            look = look[self.slots[at[look]] != -1]
        return out.reshape(key.shape)

    def _solve(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks: remembered ones, then short and long new ones."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, chunks))
        left = [i for i, ids in enumerate(found) if ids is None]
        missing = [chunks[i] for i in left]
        older = list(map(self.old.get, missing))
        fresh = [j for j, ids in enumerate(older) if ids is None]
        for j, ids in zip(fresh, self._new([missing[j] for j in fresh]), strict=True):
            older[j] = ids
        for i, ids in zip(left, older, strict=True):
            found[i] = ids
        self.young.update(zip(missing, older, strict=True))
        for c in missing:
            if len(c) > SHORT:
                del self.young[c]
        return found

    def _new(self, chunks: list[str]) -> list[bytes]:
        self.checked(chunks, out := self._solved(chunks))
        return out

    def checked(self, chunks: list[str], ids: list[bytes]) -> None:
        """Raises if the library encodes any of the distinct chunks otherwise.

        The library puts a space mark before each text that is not empty;
        before other chunks a line break is set, which is no part of any piece.
        """
        whole = [len(c) > 1 and c[0] == SPACE for c in chunks]
        texts = [c[1:].replace(SPACE, " ") if w else "\n" + c.replace(SPACE, " ") for c, w in zip(chunks, whole, strict=True)]
        theirs = [x if w else x[2:] for x, w in zip(self.library.encode(texts, num_threads=1), whole, strict=True)]
        sizes = [4 * len(x) for x in theirs]
        if sizes == list(map(len, ids)) and np.array_equal(np.frombuffer(b"".join(ids), "<u4"), np.fromiter(chain.from_iterable(theirs), np.uint32, sum(sizes) // 4)):
            return
        wrong = next(c for c, x, y in zip(chunks, ids, theirs, strict=True) if np.frombuffer(x, "<u4").tolist() != y)
        raise AssertionError(f"encoding differs from the library's for {wrong[:80]!r}")

    def _solved(self, chunks: list[str]) -> list[bytes]:
        short = sorted((i for i, c in enumerate(chunks) if len(c) <= SHORT), key=lambda i: len(chunks[i]))
        out = [b"" if len(c) <= SHORT else self.alone(c) for c in chunks]
        for a in range(0, len(short), 4096):
            some = short[a : a + 4096]
            for i, ids in zip(some, self.together([chunks[i] for i in some]), strict=True):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without begin and end."""
        parts = [self.chunks.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        which = np.fromiter(map(number.__getitem__, chain.from_iterable(parts)), np.int64, sum(map(len, parts)))
        if not len(which):
            return [np.zeros(0, "<u4") for _ in texts]
        solved = self._solve(list(number))
        size = np.array([len(x) for x in solved], np.int64) // 4
        pool, start = np.frombuffer(b"".join(solved), "<u4"), np.cumsum(size) - size
        many = size[which]
        ends = np.cumsum(many)
        ids = pool[np.repeat(start[which] - ends + many, many) + np.arange(ends[-1])]
        chunks = np.cumsum([len(p) for p in parts])
        cuts = np.concatenate([[0], ends])[chunks]
        return np.split(ids, cuts[:-1])


_MODELS: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _encode(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        first, last = np.array([model.bos], "<u4"), np.array([model.eos], "<u4")
        for batch in common.slices(batches, "text"):
            texts = [t or "" for t in common.column(batch, "text").to_pylist()]
            own = common.column(batch, "doc_id")
            try:
                ids = [np.concatenate([first, x, last]) for x in model.encode(texts)]
            except AssertionError as e:
                raise AssertionError(f"{e}, in documents {own[0]} to {own[-1]}") from None
            lists = [x.tolist() for x in ids]
            decoded = model.library.decode(lists, num_threads=1) if lists else []
            for doc_id, back, t in zip(own, decoded, texts, strict=True):
                if back != t.replace(SPACE, " "):
                    raise AssertionError(f"decoding does not lead back to document {doc_id}, a text of {len(t)} characters: {t[:80]!r}")
            known = [own, pa.array([len(x) for x in lists], pa.int64())]
            if digests:
                rest = [pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded])]
                yield pa.RecordBatch.from_arrays(known + rest, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([*known, pa.array(lists, pa.list_(pa.int32())), pa.array(decoded)], names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids array<int> with begin and end, decoded) for each row of ``docs``.

    A null text is encoded like an empty one. All rows stay, repeated ones too.
    Only ``doc_id`` and ``text`` are read. ``model`` is the place of the model
    file on every executor. A batch where the library does not agree fails.
    """
    common.lean(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(model, False), "doc_id long, n_tokens long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model: str) -> DataFrame:
    """:func:`encode` with SHA-256 digests for the ids (unsigned 32-bit, little-endian) and the decoded text."""
    common.lean(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(model, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
