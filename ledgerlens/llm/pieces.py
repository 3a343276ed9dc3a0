"""SentencePiece encoding with N-best segmentations, and decoding.

Pieces and scores are read from the model file.  A text becomes the model's form (a leading
blank, blanks as U+2581); characters that no piece covers fall back to byte pieces.  The N
best segmentations by summed piece score come from the piece lattice: a forward Viterbi pass
gives each position the best score from the start, which is an exact heuristic for an A-star
search backward from the end, so paths leave its queue in order of their whole score.

No piece spans a newline, nor holds U+2581 after another character, so the lattice falls
apart at these places.  Distinct segments are solved together, over whole arrays: Viterbi scores
position by position, then the backward search of every segment up to its second path; best paths and
both scores are kept per task (bounded).  As the heuristic is exact, a search takes the best path
straight to the start, and the best of what it leaves in the queue is the second path's score.
In the N best segmentations of a text only the N - 1 segments with the smallest loss from best to
second can differ from their best path, so the N best paths of these are listed, for any N; the
N best of the text combine them.  The listed paths of short segments are kept too (bounded).

Decoding joins the pieces, turns byte pieces into characters, U+2581 into blanks and drops the
leading one: the text itself, whatever it holds.  A text's own U+2581 is encoded by its bytes.

Defined results: null gives null, the empty text no pieces (score 0) and one segmentation.  Texts
with fewer than N segmentations give all of them.  Ties go to the path met first: the shorter
last piece, from the end backward.  Rows are handled one by one.
"""

from __future__ import annotations

import heapq
import itertools
import re
import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa

from pyspark.sql import types as T

from .common import with_text_columns

BLANK = "▁"
#: What a byte piece costs below the lowest score of the model.
BYTE_PENALTY = 10.0
_MEMO = 200_000
_LONGEST_KEPT = 64
#: Segments solved together: their edges are some fifteen arrays of about 200,000 numbers.
_SOLVED_TOGETHER = 8192
#: Characters (and 64 for each segment) whose listed paths are kept.
_OPENED_MEMO = 2_000_000
#: Stands for the text's own U+2581 among segments; no segment has U+2581 after another character.
_OWN_BLANK = BLANK + "\0" * 80 + BLANK
_SEGMENT = re.compile(f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id, read from a model file: 1 normal, 2 unknown, 3 control, 6 byte."""

    def varint(data: bytes, at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value, at

    def fields(data: bytes):
        at = 0
        while at < len(data):
            tag, at = varint(data, at)
            kind = tag & 7
            if kind == 0:
                value, at = varint(data, at)
            elif kind == 1:
                value, at = data[at : at + 8], at + 8
            elif kind == 5:
                value, at = data[at : at + 4], at + 4
            else:
                size, at = varint(data, at)
                value, at = data[at : at + size], at + size
            yield tag >> 3, value

    with open(path, "rb") as f:
        model = f.read()
    pieces = []
    for number, value in fields(model):
        if number == 1:
            own = dict(fields(value))
            pieces.append((own[1].decode("utf-8"), struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0], own.get(3, 1)))
    return pieces


class Pieces:
    """The piece table of a model; made on the driver and broadcast."""

    def __init__(self, model: list[tuple[str, float, int]]):
        self.ids = {p: i for i, (p, _, kind) in enumerate(model) if kind == 1}
        self.scores = [s for _, s, _ in model]
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model) if kind == 6}
        #: What each id stands for; control pieces for nothing.
        self.spelled = [
            bytes([int(p[3:5], 16)]) if kind == 6 else p.replace(BLANK, " ").encode() if kind == 1 else b"" for p, _, kind in model
        ]
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces to fall back to")
        self.byte_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - BYTE_PENALTY
        for bad in self.ids:
            if "\n" in bad or re.search(f"[^{BLANK}]{BLANK}", bad):
                raise ValueError("a piece crosses a place where segments end")
        self.longest = max(map(len, self.ids), default=1)
        #: Beginnings of pieces: a search ends where none goes on.
        self.begins = {p[:n]: 0 for p in self.ids for n in range(1, len(p) + 1)}
        self._index()

    def _index(self) -> None:
        """The beginnings as numbered states: transitions by state and character, pieces by state."""
        for k, begin in enumerate(self.begins, 1):
            self.begins[begin] = k
        moves: dict[int, list[tuple[int, int]]] = {}
        for b, k in self.begins.items():
            moves.setdefault(self.begins[b[:-1]] if len(b) > 1 else 0, []).append((ord(b[-1]), k))
        # one table with four places a move or more, and one for each character; the moves of a state are shifted
        # by an amount of its own to where all of them find free places, so a look at one place tells
        reach = max([4 * len(self.begins), *(ord(b[-1]) for b in self.begins)])
        self.mask = (1 << reach.bit_length()) - 1
        self.move_keys, self.move_to = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int64)
        self.move_shift = np.zeros(len(self.begins) + 1, np.int64)
        shifts = np.random.default_rng(0)
        for state, own in sorted(moves.items(), key=lambda m: -len(m[1])):
            chars, to = np.array(own, np.int64).T
            place = chars
            while (self.move_keys[place] >= 0).any():
                self.move_shift[state] = shifts.integers(self.mask + 1)
                place = chars + self.move_shift[state] & self.mask
            self.move_keys[place], self.move_to[place] = state << 21 | chars, to
        self.state_id = np.full(len(self.begins) + 1, -1, np.int32)
        self.state_score = np.zeros(len(self.begins) + 1)
        for p, i in self.ids.items():
            self.state_id[self.begins[p]] = i
            self.state_score[self.begins[p]] = self.scores[i]

    def _lattices(self, codes: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, ids, scores) of all edges; ``limit``: the end of the segment of each character."""
        starts, ends, ids, scores = [], [], [], []
        at, state, depth = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
        covered = np.zeros(len(codes), bool)
        while len(at):
            chars = codes[at + depth]
            place = self.move_shift[state] + chars & self.mask
            there = self.move_keys[place] == (state << 21 | chars)
            at, state = at[there], self.move_to[place[there]]
            depth += 1
            whole = self.state_id[state] >= 0
            starts.append(at[whole])
            ends.append(at[whole] + depth)
            ids.append(self.state_id[state[whole]])
            scores.append(self.state_score[state[whole]])
            if depth == 1:
                covered[at[whole]] = True
            go = at + depth < limit[at]
            at, state = at[go], state[go]
        bare = np.flatnonzero(~covered)  # by bytes
        c = codes[bare]
        starts.append(bare)
        ends.append(bare + 1)
        ids.append(np.full(len(bare), -1, np.int32))
        scores.append(self.byte_score * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)))
        return tuple(np.concatenate(x) for x in (starts, ends, ids, scores))

    def solve(self, segments: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(best ids as packed int32, best scores, losses of the second-best) of many segments at once: the first two
        paths of ``nbest``."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        own = np.repeat(np.arange(len(segments)), sizes)
        after = np.cumsum(sizes)
        starts, ends, ids, scores = self._lattices(codes, after[own])
        # nodes: a segment of n characters has n + 1, so its nodes are shifted by its number
        shift = own[starts]
        tails, heads = starts + shift, ends + shift
        step = ends - (after - sizes)[shift]  # edges into the n-th character of any segment go together
        # by step, end and length, in one number: no two edges have all three
        order = np.argsort((step * (len(codes) + len(segments) + 1) + heads) * (self.longest + 1) + heads - tails)
        tails, heads, ids, scores, step, shift = (x[order] for x in (tails, heads, ids, scores, step, shift))
        best = np.full(len(codes) + len(segments), -np.inf)
        back = np.zeros(len(best), np.int64)
        best[after - sizes + np.arange(len(segments))] = 0.0
        bounds = np.searchsorted(step, np.arange(1, int(step[-1]) + 2))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            one = best[tails[a:b]] + scores[a:b]
            new = np.flatnonzero(np.concatenate(([True], heads[a + 1 : b] != heads[a : b - 1])))
            most = np.maximum.reduceat(one, new)
            group = np.repeat(np.arange(len(new)), np.diff(np.append(new, b - a)))
            hit = np.flatnonzero(one == most[group])
            taken = hit[np.concatenate(([True], group[hit[1:]] != group[hit[:-1]]))]
            node = heads[a:b][new]
            best[node], back[node] = most, a + taken
        last = after + np.arange(len(segments))
        # A-star from the ends backward, a step of every search at a time
        who, node, found = np.arange(len(segments)), last, []
        first = after - sizes + np.arange(len(segments))
        behind = np.full(len(best), -np.inf)
        behind[last] = 0.0
        while len(who):
            edge = back[node]
            found.append((who, edge))
            behind[tails[edge]] = behind[node] + scores[edge]
            node = tails[edge]
            more = node != first[who]
            who, node = who[more], node[more]
        # the queues hold the other edges into the nodes that were taken, each with the score of its best path
        left = np.flatnonzero(behind[heads] > -np.inf)
        left = left[back[heads[left]] != left]
        second = np.full(len(segments), -np.inf)
        np.maximum.at(second, shift[left], best[tails[left]] + scores[left] + behind[heads[left]])
        who = np.concatenate([w for w, _ in found][::-1])
        edge = np.concatenate([e for _, e in found][::-1])
        order = np.argsort(who, kind="stable")
        who, edge = who[order], edge[order]
        flat, counts = ids[edge], np.ones(len(edge), np.int64)
        bare = np.flatnonzero(flat < 0)
        if len(bare):
            spelled = [chr(codes[tails[edge[i]] - who[i]]).encode("utf-8", "surrogatepass") for i in bare]
            counts[bare] = [len(x) for x in spelled]
            place = np.cumsum(counts) - counts
            flat = np.repeat(flat, counts)
            for i, x in zip(place[bare], spelled, strict=True):
                flat[i : i + len(x)] = [self.byte_ids[y] for y in x]
        ends_of = np.cumsum(np.bincount(np.repeat(who, counts), minlength=len(segments))) * 4
        packed, at, data = [], 0, flat.astype(np.int32).tobytes()
        for end in ends_of.tolist():
            packed.append(data[at:end])
            at = end
        return packed, best[last], best[last] - second

    def edges(self, segment: str, at: int, plain: bool) -> list[tuple[int, float, tuple[int, ...]]]:
        """(end, score, ids) of the lattice's edges that start at ``at``; ``plain``: U+2581 is a character of the text."""
        found = []
        ids, begins, scores = self.ids, self.begins, self.scores
        for end in range(at + 1, min(len(segment), at + self.longest) + 1):
            piece = segment[at:end]
            if piece not in begins:
                break
            i = ids.get(piece)
            if i is not None:
                found.append((end, scores[i], (i,)))
        if plain or not found or found[0][0] != at + 1:  # no piece for the one character
            own = tuple(self.byte_ids[b] for b in segment[at].encode("utf-8", "surrogatepass"))
            edge = (at + 1, self.byte_score * len(own), own)
            found = [edge] if plain else [edge, *found]
        return found

    def nbest(self, segment: str, n: int, plain: bool = False) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best (score, ids) of a segment, best first."""
        size = len(segment)
        into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        best = [float("-inf")] * (size + 1)
        best[0] = 0.0
        for at in range(size):  # forward: Viterbi scores
            for end, score, ids in self.edges(segment, at, plain):
                into[end].append((at, score, ids))
                if best[at] + score > best[end]:
                    best[end] = best[at] + score
        order = itertools.count()
        queue = [(-best[size], 0, size, 0.0, None)]
        found = []
        while queue and len(found) < n:  # backward: A-star, the score behind plus the best ahead
            _, _, at, behind, path = heapq.heappop(queue)
            if at == 0:
                ids = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                found.append((behind, tuple(ids)))
                continue
            for start, score, ids in into[at]:  # of equal ones the last pushed goes on
                heapq.heappush(queue, (-(best[start] + score + behind), -next(order), start, behind + score, (ids, path)))
        return found

    def decode(self, ids) -> str:
        """The text of ``ids``: the bytes that pieces stand for, without the leading blank."""
        return spell(self.spelled, ids)


def spell(spelled: list[bytes], ids) -> str:
    return b"".join(map(spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]


class Encoder:
    """Encodes lists of texts; keeps the results of distinct segments."""

    def __init__(self, pieces: Pieces, n: int):
        self.pieces, self.n = pieces, n
        self.opened: dict[str, list[tuple[float, bytes]]] = {}
        self.opened_size = 0
        self._clear()

    def _clear(self) -> None:
        #: Numbers by segment; one that is new takes the next.
        self.known: dict[str, int] = defaultdict(itertools.count().__next__)
        self.packed: list[bytes] = []
        self.best, self.loss = np.empty(0), np.empty(0)

    def _learn(self, segments: list[str]) -> np.ndarray:
        """The numbers of segments; adds the results of those that aren't known."""
        if len(self.packed) > _MEMO:
            self._clear()
        at = np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))
        new = list(itertools.islice(self.known, len(self.packed), None))
        packed, best, loss = [b""] * len(new), np.empty(len(new)), np.empty(len(new))
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        short = np.flatnonzero(lengths <= _LONGEST_KEPT)
        for first in range(0, len(short), _SOLVED_TOGETHER):
            some = short[first : first + _SOLVED_TOGETHER]
            solved, best[some], loss[some] = self.pieces.solve([new[k] for k in some])
            for k, ids in zip(some.tolist(), solved, strict=True):
                packed[k] = ids
        for k in np.flatnonzero(lengths > _LONGEST_KEPT).tolist():  # one by one: their length would keep short ones waiting
            paths = self._paths(new[k])
            packed[k], best[k] = paths[0][1], paths[0][0]
            loss[k] = paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf
        self.packed += packed
        self.best, self.loss = np.concatenate([self.best, best]), np.concatenate([self.loss, loss])
        return at

    def _segments(self, text: str) -> list[str]:
        if not text:
            return []
        if BLANK not in text:
            return _SEGMENT.findall(BLANK + text.replace(" ", BLANK))
        out = []  # the text's own U+2581 stand between stretches without it
        for k, part in enumerate(text.split(BLANK)):
            out += [_OWN_BLANK] * bool(k) + _SEGMENT.findall(("" if k else BLANK) + part.replace(" ", BLANK))
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, float, list[float]]]:
        """(ids as packed int32, score, scores of the N best) of each text."""
        return [(ids[0], score, scores) for score, scores, ids in self.encode_all(texts)]

    def encode_all(self, texts: list[str]) -> list[tuple[float, list[float], list[bytes]]]:
        """(score, scores of the N best, their ids as packed int32) of each text."""
        parts = [self._segments(t) for t in texts]
        numbers = self._learn([x for own in parts for x in own])
        ends = list(itertools.accumulate(map(len, parts)))
        out = []
        for own, end in zip(parts, ends, strict=True):
            at = numbers[end - len(own) : end]
            score = float(self.best[at].sum())
            packed = list(map(self.packed.__getitem__, at.tolist()))
            scores, ids = [], []
            for lost, choice, paths in self._ranked(own, at):
                for k, j in zip(paths, choice, strict=True):
                    packed[k] = paths[k][j][1]
                scores.append(score - lost)
                ids.append(b"".join(packed))
            out.append((score, scores, ids))
        return out

    def _paths(self, segment: str) -> list[tuple[float, bytes]]:
        """The N best, two at least, (score, ids as packed int32) of a segment by A-star."""
        found = self.opened.get(segment)
        if found is None:
            n = max(2, self.n)
            listed = self.pieces.nbest(BLANK, n, plain=True) if segment == _OWN_BLANK else self.pieces.nbest(segment, n)
            found = [(score, np.array(ids, np.int32).tobytes()) for score, ids in listed]
            if self.opened_size > _OPENED_MEMO:
                self.opened, self.opened_size = {}, 0
            self.opened[segment] = found
            self.opened_size += 64 + len(segment)
        return found

    def _ranked(self, own: list[str], at: np.ndarray):
        """The N smallest (loss, choice of a path for each open segment, open segments with paths) of a text."""
        loss = self.loss[at]
        few = min(self.n - 1, len(loss))
        least = [np.argmin(loss)] if few == 1 else np.argsort(loss, kind="stable")[:few]
        opened = [int(k) for k in least if loss[k] < np.inf]
        paths = {k: self._paths(own[k]) for k in opened}
        ranked = [(0.0, ())]
        for k in opened:
            top = paths[k][0][0]
            ranked = heapq.nsmallest(self.n, ((lost + top - s, (*c, j)) for lost, c in ranked for j, (s, _) in enumerate(paths[k])))
        return [(lost, choice, paths) for lost, choice in ranked]

    def nbest(self, text: str) -> list[tuple[float, list[int]]]:
        """The N best (score, ids) of a text."""
        _, scores, ids = self.encode_all([text])[0]
        return [(score, np.frombuffer(own, np.int32).tolist()) for score, own in zip(scores, ids, strict=True)]


def encode_texts(docs, pieces: Pieces, n: int = 2, text: str = "text", keep_text: bool = True, packed: bool = False):
    """``docs`` with ``__ids`` (array<int>, or packed little-endian int32 as binary), ``__score``, ``__scores`` (of the N best)
    and ``__next_ids`` (the ids of the second to the N-th best, like ``__ids``)."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def make():
        encoder = Encoder(shared.value, n)
        form = (lambda ids: ids) if packed else (lambda ids: np.frombuffer(ids, "<i4"))

        def compute(raws):
            done = iter(encoder.encode_all([raw.decode("utf-8", "replace") for raw in raws if raw is not None]))
            rows = [None if raw is None else next(done) for raw in raws]
            of = lambda get: [None if r is None else get(r) for r in rows]
            return [of(lambda r: form(r[2][0])), of(lambda r: r[0]), of(lambda r: r[1]), of(lambda r: [form(x) for x in r[2][1:]])]

        return compute

    kind = ("binary", pa.binary()) if packed else ("array<int>", pa.list_(pa.int32()))
    fields = [
        ("__ids", *kind),
        ("__score", "double", pa.float64()),
        ("__scores", "array<double>", pa.list_(pa.float64())),
        ("__next_ids", f"array<{kind[0]}>", pa.list_(kind[1])),
    ]
    return with_text_columns(docs, text, make, fields, drop_text=not keep_text)


def decode_ids(frame, pieces: Pieces, ids: str = "__ids"):
    """``frame`` with ``__decoded``: the text of packed ids in the binary column ``ids``, or of each entry of an array of such."""
    shared = frame.sparkSession.sparkContext.broadcast(pieces.spelled)  # these workers need no more of the model
    many = isinstance(frame.schema[ids].dataType, T.ArrayType)

    def make():
        spelled = shared.value

        def one(raw):
            return None if raw is None else spell(spelled, np.frombuffer(raw, "<i4").tolist())

        if many:
            return lambda lists: [[None if raws is None else list(map(one, raws)) for raws in lists]]
        return lambda raws: [list(map(one, raws))]

    kind = ("array<string>", pa.list_(pa.string())) if many else ("string", pa.string())
    return with_text_columns(frame, ids, make, [("__decoded", *kind)])
