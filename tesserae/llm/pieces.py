"""SentencePiece encoding and decoding by N-best search over the piece lattice.

A text is cut where no piece of the model can reach over (before a word, between
a word and the sign after it), so its lattice is that of its segments in a row.
In a segment's lattice forward Viterbi gives, for every position, the best
score from the start.  Those scores are exact heuristics for A* from the end:
hypotheses leave the queue in order of their full scores, so the first N that
reach the start are the N best.  A text's N best follow from its segments' by
one more best-first search over how much each alternative loses.

Pieces and scores are the model's own: sums of scores rank segmentations.  A character that no piece
covers has a score below every piece's (``UNKNOWN`` under the least) and, if
the model has byte pieces, comes out as its bytes.  Decoding gives the text
back exactly, U+2581 excepted, which reads as a blank.

``pieces`` is the encoding that models of this vocabulary were fed: the
library's.  For a model of the unigram kind that is the best of the N; one of
the BPE kind merges by rank, so its encoding is one path of the lattice, and
the N best are the alternatives by the sum of scores.  ``agrees`` says whether
both are the same.

Defined results: a null or empty text has no pieces, score 0 and decodes to
the empty text; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain, count

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import Kept, without_cycles

MARK, UNKNOWN = "▁", 10.0
#: A field that, after a model's own, turns off the mark in front of a text.
NO_PREFIX = b"\x1a\x02\x18\x00"


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protocol-buffer message: (number, integer or bytes)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + n]
            at += n


class Model:
    """Pieces and scores of a model file, and N-best search over them."""

    def __init__(self, data: bytes, n: int = 4, cache_bytes: int = 120 << 20):
        from sentencepiece import SentencePieceProcessor

        self.n, self.room, self.used, self.known, self.before, self.single, self.others = n, cache_bytes, 0, {}, {}, {}, {}
        self.library = SentencePieceProcessor(model_proto=data + NO_PREFIX)
        self.pieces: list[str] = []
        self.score: dict[str, tuple[float, int]] = {}
        self.bytes: dict[int, int] = {}
        self.unk, low = 0, 0.0
        for number, piece in fields(data):
            if number != 1:
                continue
            got = dict(fields(piece))
            text, kind, score = got[1].decode(), got.get(3, 1), float(np.frombuffer(got.get(2, bytes(4)), "<f4")[0])
            i = len(self.pieces)
            self.pieces.append(text)
            if kind == 1 or kind == 4:
                self.score[text] = (score, i)
                low = min(low, score)
            elif kind == 6:
                self.bytes[int(text[3:5], 16)] = i
            elif kind == 2:
                self.unk = i
        self.low = low - UNKNOWN
        value = {i: bytes([b]) for b, i in self.bytes.items()}
        self.raw = [value[i] if i in value else t.encode() for i, t in enumerate(self.pieces)]
        self.held = ahocorasick.Automaton()
        for text, (score, i) in self.score.items():
            self.held.add_word(text, (len(text), score, i))
        self.held.make_automaton()
        self.singles = frozenset(t for t in self.score if len(t) == 1)
        self.cut = self.cuts()

    def cuts(self) -> re.Pattern:
        """Where a text falls into segments: no piece reaches over these places.

        They lie before marks, if in pieces marks follow nothing but marks;
        between a letter and a sign that follows no letter in any piece; and
        around line ends that are in no piece.
        """
        before: dict[str, set[str]] = {}
        for t in self.score:
            for x, y in zip(t, t[1:], strict=False):
                before.setdefault(y, set()).add(x)
        known = {c for t in self.score for c in t}
        letters = "".join(sorted(c for c in known if c.isalpha()))
        signs = "".join(re.escape(c) for c in sorted(known) if not c.isalnum() and c != MARK and not any(x.isalpha() for x in before.get(c, ())))
        strange = "".join(c for c in "\n\r\t\x0b\x0c" if c not in known)
        places = [f"(?<=[{letters}])(?=[{signs}])"] if letters and signs else []
        places += [f"(?=[{strange}])", f"(?<=[{strange}])"] if strange else []
        self.by_word = not before.get(MARK, set()) - {MARK}
        if self.by_word:
            places.append(f"(?<=[^{MARK}])(?={MARK})")
        return re.compile("|".join(places) or "(?!)")

    def lattice(self, s: str) -> tuple[list[float], list[list[tuple[float, int, int, float]]]]:
        """Forward Viterbi scores of all positions, and the edges into each: (-(score up to its end), piece id, start, own score).

        Id -1 is a character that no piece covers.
        """
        n = len(s)
        forward, into = [0.0] + [-np.inf] * n, [[] for _ in range(n + 1)]
        strange = [] if self.singles.issuperset(s) else [b for b, c in enumerate(s, 1) if c not in self.singles]
        low = self.low
        for b, (size, score, i) in self.held.iter(s):  # by ascending ends, so what lies before is final
            b += 1
            while strange and strange[0] <= b:
                at = strange.pop(0)
                into[at].append((-forward[at - 1] - low, -1, at - 1, low))
                forward[at] = max(forward[at], forward[at - 1] + low)
            a = b - size
            total = forward[a] + score
            into[b].append((-total, i, a, score))
            if total > forward[b]:
                forward[b] = total
        for at in strange:
            into[at].append((-forward[at - 1] - low, -1, at - 1, low))
            forward[at] = max(forward[at], forward[at - 1] + low)
        return forward, into

    def search(self, s: str, n: int) -> tuple[list[tuple[float, tuple[int, ...]]], float]:
        """The ``n`` best segmentations of a segment, (score, piece ids), best first; and the score of the next.

        A hypothesis is a path from the end and the edge that it takes next;
        its priority is its own score and the forward score of what is left,
        which is exact, so each that leaves the queue is the next best and its
        way on is along the best edges.  Edges second to them start the
        hypotheses that join the queue.  Of ties the smaller piece id goes
        first, from the end.
        """
        _, into = self.lattice(s)
        tick, out = 0, []
        into[-1].sort()
        queue = [(into[-1][0][0], 0, len(s), 0, None, 0.0)]
        while queue and len(out) < n:
            _, _, at, k, behind, gone = heapq.heappop(queue)
            while True:
                edges = into[at]
                if k + 1 < len(edges):
                    tick += 1
                    heapq.heappush(queue, (edges[k + 1][0] - gone, tick, at, k + 1, behind, gone))
                _, i, a, score = edges[k]
                behind, gone, at, k = (i, a, at, behind), gone + score, a, 0
                if not at:
                    break
                into[at].sort()
            path = []
            while behind is not None:
                path.append(behind[:3])
                behind = behind[3]
            out.append((gone, self.ids(s, path)))
        return out, -queue[0][0] if queue else -np.inf

    def top(self, s: str) -> tuple[float, float, bytes]:
        """What ``search`` knows of a segment after its first hypothesis: loss of the next, the best's score and ids.

        That one takes the best edge into each place, and the next parts from
        it at one place for the second edge there, so two edges of each place do.
        """
        n = len(s)
        forward, other, piece, length = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        if not self.singles.issuperset(s):
            [(score, ids)], second = self.search(s, 1)
            return score - second, score, array("i", ids).tobytes()
        for b, (size, score, i) in self.held.iter(s):
            b += 1
            total, so_far = forward[b - size] + score, forward[b]
            if total > so_far or total == so_far and i < piece[b]:
                other[b], forward[b], piece[b], length[b] = so_far, total, i, size
            elif total > other[b]:
                other[b] = total
        at, ids, best, second = n, [], forward[n], -np.inf
        while at:
            # what the path from here to the end adds is the best's score less that up to here
            if (x := other[at] + best - forward[at]) > second:
                second = x
            ids.append(piece[at])
            at -= length[at]
        ids.reverse()
        return best - second, best, array("i", ids).tobytes()

    def best(self, s: str) -> tuple:
        """``top`` of a segment, or of a few in a row."""
        known, single, found = self.known, self.single, []
        for p in self.cut.split(s):
            if p:
                if (got := known.get(p) or single.get(p)) is None:
                    got = single[p] = self.top(p)
                    self.used += 200 + 8 * len(p)
                found.append(got)
        return found[0] if len(found) == 1 else (min([f[0] for f in found]), sum([f[1] for f in found]), b"".join([f[2] for f in found]))

    def learn(self, segments: list[str]) -> None:
        """Meet new segments: (loss of the second best, score, ids of the best, ids of the library's encoding) of each.

        What has been met since the last time that the room was used up stays a while.
        """
        known, top, best = self.known, self.top, self.best
        for at in range(0, len(segments), 20_000):
            some = segments[at : at + 20_000]
            for s, ids in zip(some, self.library.encode(some, num_threads=1), strict=True):
                got, own = top(s) if s[1:].isalpha() else best(s), array("i", ids).tobytes()
                known[s] = (got[0], got[1], got[2], got[2] if own == got[2] else own)
            self.used += 200 * len(some) + 8 * sum(map(len, some))

    def met(self, texts: list[list[str]]) -> dict[str, tuple]:
        """What is known of all segments of some texts."""
        if self.used > self.room:
            self.known, self.before, self.single, self.used = {}, self.known, {}, 0
            self.others = {}
        known, before, new = self.known, self.before, []
        for s in set(chain.from_iterable(texts)).difference(known):
            if (got := before.get(s)) is not None:
                known[s] = got
                self.used += 200 + 8 * len(s)
            else:
                new.append(s)
        self.learn(new)
        return self.known

    def ids(self, s: str, path: list[tuple[int, int, int]]) -> tuple[int, ...]:
        out: list[int] = []
        for i, a, b in path:
            if i >= 0:
                out.append(i)
            else:
                out += [self.bytes[x] for x in s[a:b].encode("utf-8", "surrogatepass")] if self.bytes else [self.unk]
        return tuple(out)

    def segments(self, text: str) -> list[str]:
        """The text with marks for blanks and one in front, in segments."""
        if self.by_word and "  " not in text and text[0] != " ":
            return (MARK + text.replace(" ", f" {MARK}")).split(" ")
        return [p for p in self.cut.split(MARK + text.replace(" ", MARK)) if p]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, list[tuple[float, bytes]]]]:
        """Of each text the library's encoding and the N best segmentations, best first: (score, piece ids, four bytes each)."""
        split = [self.segments(t) if t else [] for t in texts]
        known = self.met(split)
        for segments in split:
            found = [known[s] for s in segments]
            yield b"".join([f[3] for f in found]), self.bests(segments, found)

    def bests(self, segments: list[str], found: list[tuple]) -> list[tuple[float, bytes]]:
        if not segments:
            return [(0.0, b"")]
        best = [f[2] for f in found]
        top = sum([f[1] for f in found])
        # no more than N - 1 segments depart from their best in any of the N best
        losses = np.array([f[0] for f in found])
        few = min(self.n - 1, len(found))
        some = np.flatnonzero(losses <= np.partition(losses, few - 1)[few - 1]) if few else []
        some = [k for k in sorted(some, key=lambda k: (losses[k], k))[:few] if losses[k] < np.inf]
        others = {k: self.alternatives(segments[k]) for k in some}
        options = [[found[k][1] - score for score, _ in others[k]] for k in some]
        ends = [0, *accumulate(map(len, best))] if some else []
        first, out, tick = b"".join(best), [], count()
        queue = [(0.0, next(tick), (), 0)]
        # a state: loss, choices so far as (option, alternative), next option that may still change
        while queue and len(out) < self.n:
            loss, _, chosen, start = heapq.heappop(queue)
            out.append((top - loss, self.patched(first, ends, others, [(some[k], alt) for k, alt in chosen])))
            if chosen:  # the next alternative of the last one chosen
                k, alt = chosen[-1]
                if alt + 1 < len(options[k]):
                    heapq.heappush(queue, (loss - options[k][alt] + options[k][alt + 1], next(tick), (*chosen[:-1], (k, alt + 1)), start))
            for k in range(start, len(options)):
                if len(options[k]) > 1:
                    heapq.heappush(queue, (loss + options[k][1], next(tick), (*chosen, (k, 1)), k + 1))
        return out

    def alternatives(self, s: str) -> list[tuple[float, bytes]]:
        if (got := self.others.get(s)) is None:
            got = self.others[s] = [(score, array("i", ids).tobytes()) for score, ids in self.search(s, self.n)[0]]
            self.used += 100 + 150 * self.n
        return got

    @staticmethod
    def patched(first: bytes, ends: list[int], others: dict, chosen: list[tuple[int, int]]) -> bytes:
        parts, at = [], 0
        for k, alt in sorted(chosen):
            parts += [first[at : ends[k]], others[k][alt][1]]
            at = ends[k + 1]
        return b"".join([*parts, first[at:]]) if parts else first

    def decode(self, ids) -> str:
        """The text of piece ids; byte pieces join into characters."""
        raw = b"".join(map(self.raw.__getitem__, array("i", ids)))
        text = raw.decode("utf-8", "surrogatepass" if b"\xed" in raw else "replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


KEPT = Kept(Model)


def kept_model() -> Kept:
    """One model for all tasks of a worker, as the segments that it has met serve them all."""
    return KEPT


def model_bytes(path: str | None = None) -> bytes:
    """Of the model file; the default is the public one of this machine."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def arrays(ids: list[bytes]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def parts(text: pa.Array, rows: int = 500, chars: int = 4 << 20) -> Iterator[list[str | None]]:
    """The texts in lists of no more than ``rows``, and ``chars`` unless one alone is longer."""
    out, held = [], 0
    for x in text:
        value = x.as_py()
        if out and (len(out) == rows or held + len(value or "") > chars):
            yield out
            out, held = [], 0
        out.append(value)
        held += len(value or "")
    if out:
        yield out


def encoded(docs: DataFrame, n: int = 4, path: str | None = None, wanted: Sequence[str] = ("pieces", "scores", "nbest", "agrees", "decoded"), cache_bytes: int = 24 << 20) -> DataFrame:
    """``docs`` with what is ``wanted`` of ``pieces`` (ids), ``scores`` of the N best, ``nbest`` (their ids), ``agrees`` and ``decoded``.

    Columns of those names are replaced.  Rows leave Python in small batches,
    as ids take several times the room of their text; a worker holds what it
    has met of segments twice in ``cache_bytes`` at most, about.
    """
    kinds = {"pieces": "array<int>", "scores": "array<double>", "nbest": "array<array<int>>", "agrees": "boolean", "decoded": "string"}
    docs = docs.drop(*kinds)
    data = docs.sparkSession.sparkContext.broadcast(model_bytes(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with kept_model().use(data.value, n, cache_bytes) as model:
            yield from ready(model, without_cycles(batches))

    def ready(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in parts(batch.column("text"), 200, 1 << 20):
                own, best = zip(*model.encode(some), strict=True)
                sizes = pa.array(np.cumsum([0, *map(len, best)]), pa.int32())
                made = {
                    "pieces": lambda: arrays(own), "scores": lambda: pa.array([[x for x, _ in b] for b in best], pa.list_(pa.float64())),  # noqa: B023
                    "nbest": lambda: pa.ListArray.from_arrays(sizes, arrays([ids for b in best for _, ids in b])),  # noqa: B023
                    "agrees": lambda: pa.array([x == b[0][1] for x, b in zip(own, best, strict=True)]), "decoded": lambda: pa.array([model.decode(x) for x in own], pa.string()),  # noqa: B023
                }
                part = batch.slice(at, len(some))
                at += len(some)
                yield pa.RecordBatch.from_arrays([*part.columns, *[made[c]() for c in wanted]], [*part.schema.names, *wanted])

    given = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*given, *[f"{c} {kinds[c]}" for c in wanted]]))


def digest(docs: DataFrame, n: int = 4, path: str | None = None, cache_bytes: int = 120 << 20) -> DataFrame:
    """doc_id, n_pieces, pieces_sha256 (of the ids, four bytes each, low first), nbest_sha256 (of all bests' in a row), scores, agrees and round_trip."""
    data = docs.sparkSession.sparkContext.broadcast(model_bytes(path))

    @F.arrow_udf("struct<n_pieces:long,pieces_sha256:string,nbest_sha256:string,scores:array<double>,agrees:boolean,round_trip:boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with kept_model().use(data.value, n, cache_bytes) as model:
            yield from digests(model, without_cycles(batches))

    def digests(model: Model, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = {"n_pieces": pa.int64(), "pieces_sha256": pa.string(), "nbest_sha256": pa.string(), "scores": pa.list_(pa.float64()), "agrees": pa.bool_(), "round_trip": pa.bool_()}
        for text in batches:
            rows = []
            for some in parts(text):
                for value, (ids, best) in zip(some, model.encode(some), strict=True):
                    whole = hashlib.sha256(b"".join([x for _, x in best])).hexdigest()
                    same = model.decode(ids) == (value or "").replace(MARK, " ")
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), whole, [s for s, _ in best], ids == best[0][1], same))
            cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.values(), strict=True)], list(kinds))

    rows = docs.select(F.col("doc_id").cast("long"), run("text").alias("_e"))
    return rows.select("doc_id", "_e.*")
