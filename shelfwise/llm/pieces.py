"""SentencePiece encoding and decoding with N-best segmentations.

The scores of the vocabulary file span a lattice of pieces over a text.
Forward Viterbi gives the best score of every prefix. Backward A-star search
uses those as exact heuristics, so it takes paths out in order of their score.

* No piece holds a word start after other characters, and none holds a line
  end, so a text's lattice falls apart into words. The distinct words of a
  batch are solved together as columns of one forward pass, in which a place
  is looked up only while a piece begins so; the best segmentations of a text
  are merged from the few words with the closest second choice.
* Further segmentations are stored as edits of the best one, so N of them cost
  little more than one.
* One pass over the scan, no shuffle. Output batches are bounded by pieces.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
NBEST = 4
#: Words kept in a worker's table, and the longest word that is kept or solved among others.
KEEP_WORDS, KEEP_CHARS = 200_000, 48
#: Characters of text that are encoded together and leave as one batch, about.
BATCH_CHARS = 2_000_000
_NEVER = 2**60
_CHUNKS = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")


class Vocabulary(NamedTuple):
    """Piece texts, whole-number scores and the ids of the 256 byte pieces."""

    texts: list[str]
    scores: list[int]
    plain: list[bool]
    bytes_: list[int]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a SentencePiece file on the driver; executors get its pieces, so they need no file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    odd = [model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i) for i in ids]
    return Vocabulary([model.id_to_piece(i) for i in ids], [round(model.get_score(i)) for i in ids],
                      [not x for x in odd], [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


class Remembered:
    """A bounded table: when the younger half is full, the older half is forgotten."""

    def __init__(self, size: int):
        self.half, self.young, self.old = size // 2, {}, {}

    def get(self, word: str):
        return self.young.get(word) or self._promoted(word)

    def _promoted(self, word: str):
        found = self.old.get(word)
        return found and self.put(word, found)

    def put(self, word: str, value):
        if len(word) <= KEEP_CHARS:
            if len(self.young) >= self.half:
                self.young, self.old = {}, self.young
            self.young[word] = value
        return value


class Solved(NamedTuple):
    """Best segmentations of words: ids of all, and where they start, how many they are, score and gap of each."""

    ids: np.ndarray
    start: np.ndarray
    count: np.ndarray
    score: np.ndarray
    gap: np.ndarray


class PieceTable:
    """Pieces and their beginnings by a hash of their characters, for words of one length at a time."""

    BASE, BITS = np.uint64(0x9E3779B97F4A7C15), 20

    def __init__(self, ids: dict[str, int], scores: list[int]):
        self.codes = np.zeros(1 << self.BITS, np.uint64)
        self.used = np.zeros(1 << self.BITS, bool)
        self.ids = np.full(1 << self.BITS, -1, np.int32)  # a beginning that is no piece keeps -1
        self.scores = np.zeros(1 << self.BITS, np.int64)
        by_length: dict[int, list[str]] = {}
        for text in {text[:end] for text in ids for end in range(1, len(text) + 1)}:
            by_length.setdefault(len(text), []).append(text)
        if sum(map(len, by_length.values())) > 1 << (self.BITS - 1):
            raise ValueError("the vocabulary is too large for the table")
        self.probes = 1
        for texts in by_length.values():
            codes = self._codes(self._points(texts))
            for text, code, slot in zip(texts, codes.tolist(), self._slot(codes).tolist()):
                probes = 1
                while self.used[slot]:
                    slot, probes = (slot + 1) % (1 << self.BITS), probes + 1
                self.used[slot], self.codes[slot] = True, code
                if text in ids:
                    self.ids[slot], self.scores[slot] = ids[text], scores[ids[text]]
                self.probes = max(self.probes, probes)

    @staticmethod
    def _points(words: list[str]) -> np.ndarray:
        return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)

    def _codes(self, points: np.ndarray) -> np.ndarray:
        code = np.zeros(len(points), np.uint64)
        for column in points.T:
            code = (code + column + np.uint64(1)) * self.BASE
            code ^= code >> np.uint64(31)
        return code

    def _slot(self, codes):
        return ((codes * self.BASE) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def _find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each code, and whether it holds the code."""
        slot = self._slot(codes)
        hit = self.codes[slot] == codes
        away = np.flatnonzero(~hit & self.used[slot])
        for _ in range(self.probes - 1):
            if not len(away):
                break
            slot[away] = (slot[away] + 1) % (1 << self.BITS)
            hit[away] = self.codes[slot[away]] == codes[away]
            away = away[~hit[away] & self.used[slot[away]]]
        return slot, hit & self.used[slot]

    def _occurrences(self, words: list[str], length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For sizes 1, 2, ...: word, id and score of every piece in the words by its start, and where each start begins.

        A place goes on to the next size only while a piece begins so.
        """
        n, out = len(words), []
        points = np.ascontiguousarray(self._points(words).T).ravel()  # all first characters, all second ones, ...
        place, code, size = np.arange(n * length), np.zeros(n * length, np.uint64), 0
        while len(place):
            code = (code + points[place + size * n] + np.uint64(1)) * self.BASE
            code ^= code >> np.uint64(31)
            size += 1
            slot, hit = self._find(code)
            place, code, slot = place[hit], code[hit], slot[hit]
            whole = self.ids[slot] >= 0
            at = place[whole]
            out.append((at % n, self.ids[slot[whole]], self.scores[slot[whole]], np.searchsorted(at, np.arange(length + 1) * n)))
            more = place < (length - size) * n
            place, code = place[more], code[more]
        return out

    def search(self, words: list[str], length: int) -> tuple[np.ndarray, ...]:
        """Forward Viterbi over all words at once: ids at the end of each row, their count, score, gap, and
        whether all characters are pieces; the other words have no ids."""
        n = len(words)
        found = self._occurrences(words, length)
        known = np.bincount(found[0][0], minlength=n) == length
        first = np.full((length + 1, n), -_NEVER, np.int64)
        second, came, piece = first.copy(), np.zeros((length + 1, n), np.int64), np.zeros((length + 1, n), np.int32)
        first[0] = 0
        for end in range(1, length + 1):
            best, next_, size_, piece_ = first[end], second[end], came[end], piece[end]
            for size in range(min(end, len(found)), 0, -1):
                start = end - size
                word, ids, scores, begins = found[size - 1]
                own = slice(begins[start], begins[start + 1])
                word, score = word[own], scores[own]
                if not len(word):
                    continue
                total, other, old = first[start][word] + score, second[start][word] + score, best[word]
                better = total > old
                next_[word] = np.maximum(np.where(better, old, np.maximum(total, next_[word])), other)
                word = word[better]
                best[word], size_[word], piece_[word] = total[better], size, ids[own][better]
        path, at, count = np.zeros((n, length), np.int32), np.full(n, length), np.zeros(n, np.int64)
        rows = np.flatnonzero(known)
        while len(rows):
            count[rows] += 1
            path[rows, length - count[rows]] = piece[at[rows], rows]
            at[rows] -= came[at[rows], rows]
            rows = rows[at[rows] > 0]
        gap = np.where(second[length] > -_NEVER // 2, first[length] - second[length], _NEVER)
        return path, count, first[length], gap, known


class Segmenter:
    """Lattice search over one vocabulary."""

    def __init__(self, vocabulary: Vocabulary, nbest: int = NBEST):
        self.nbest = nbest
        self.ids, self.prefixes = {}, {}
        for i, (text, score) in enumerate(zip(vocabulary.texts, vocabulary.scores)):
            if vocabulary.plain[i] and text:
                self.ids[text] = i
                for end in range(1, len(text)):
                    self.prefixes.setdefault(text[:end], None)
                self.prefixes[text] = score
        if any("\n" in text or SPACE in text.lstrip(SPACE) for text in self.ids):
            raise ValueError("a piece crosses a word or a line")
        self.byte_ids = vocabulary.bytes_
        byte_of = {i: bytes([b]) for b, i in enumerate(vocabulary.bytes_)}
        self.raw = [byte_of.get(i, text.encode() if vocabulary.plain[i] else b"") for i, text in enumerate(vocabulary.texts)]
        self.unknown = min(s for s, plain in zip(vocabulary.scores, vocabulary.plain) if plain) - 10
        self.table = PieceTable(self.ids, vocabulary.scores)
        self.words, self.choices = Remembered(KEEP_WORDS), Remembered(KEEP_WORDS // 10)

    def _fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    def edges(self, chunk: str) -> Iterator[tuple[int, int, int, tuple[int, ...]]]:
        """(start, end, score, ids) of every piece in the chunk, by start and then end."""
        find, ids, n = self.prefixes.get, self.ids, len(chunk)
        for start in range(n):
            single = False
            for end in range(start + 1, n + 1):
                score = find(chunk[start:end], 1)
                if score == 1:  # no piece begins so; scores are never above 0
                    break
                if score is not None:
                    single = single or end == start + 1
                    yield start, end, score, (ids[chunk[start:end]],)
            if not single:
                yield start, start + 1, self.unknown, self._fallback(chunk[start])

    def search(self, chunk: str) -> tuple[bytes, int, int]:
        """Forward Viterbi with the best two scores of every prefix."""
        n, find, ids = len(chunk), self.prefixes.get, self.ids
        first, second, came = [0] + [-_NEVER] * n, [-_NEVER] * (n + 1), [0] * (n + 1)
        for start in range(n):
            one, two, single = first[start], second[start], False
            for end in range(start + 1, n + 1):
                score = find(chunk[start:end], 1)
                if score == 1:
                    break
                if score is not None:
                    if end == start + 1:
                        single = True
                    total = one + score
                    if total > first[end]:
                        second[end] = max(first[end], two + score)
                        first[end], came[end] = total, start
                    elif total > second[end]:
                        second[end] = total
            if not single:
                end, total = start + 1, one + self.unknown
                if total > first[end]:
                    second[end], first[end], came[end] = max(first[end], two + self.unknown), total, start
                elif total > second[end]:
                    second[end] = total
        cuts, end = [], n
        while end:
            cuts.append((came[end], end))
            end = came[end]
        path: list[int] = []
        for start, end in reversed(cuts):
            piece = ids.get(chunk[start:end])
            path.extend((piece,) if piece is not None else self._fallback(chunk[start:end]))
        gap = first[n] - second[n] if second[n] > -_NEVER // 2 else _NEVER
        return array("i", path).tobytes(), first[n], gap

    def n_best(self, chunk: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """(score, ids) of the n best segmentations: backward A-star under the forward scores."""
        forward, into = [0] + [-_NEVER] * len(chunk), [[] for _ in range(len(chunk) + 1)]
        for start, end, score, ids in self.edges(chunk):
            into[end].append((start, score, ids))
            forward[end] = max(forward[end], forward[start] + score)
        heap, pushed, out = [(-forward[-1], 0, len(chunk), 0, None)], 0, []
        while heap and len(out) < n:
            _, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path:
                    ids.extend(path[0])
                    path = path[1]
                out.append((behind, tuple(ids)))
                continue
            for start, score, ids in into[at]:
                pushed += 1
                heapq.heappush(heap, (-(behind + score + forward[start]), pushed, start, behind + score, (ids, path)))
        return out

    def chunks(self, text: str) -> list[str]:
        """Words with the spaces before them, and line ends; joined they are the text with a space in front."""
        if "  " in text or SPACE in text or text.startswith(" "):
            return _CHUNKS.findall(SPACE + text.replace(" ", SPACE))
        words = (SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n ")).split(" ")
        return [w for w in words if w] if "\n" in text else words

    def solve(self, words: list[str]) -> Solved:
        """Words of one length are solved together; long ones and those with unknown characters one by one."""
        n = len(words)
        lengths, parts, held = np.fromiter(map(len, words), np.int64, n), [], 0
        start, count, score, gap = (np.zeros(n, np.int64) for _ in range(4))
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for low, high in zip(cuts.tolist(), cuts[1:].tolist()):
            own, length = order[low:high], int(lengths[order[low]])
            single = own
            if length <= KEEP_CHARS:
                path, count[own], score[own], gap[own], known = self.table.search([words[i] for i in own.tolist()], length)
                ids = path[np.arange(length) >= length - count[own][:, None]]
                start[own] = held + np.cumsum(count[own]) - count[own]
                parts.append(ids)
                held, single = held + len(ids), own[~known]
            for i in single.tolist():
                packed, score[i], gap[i] = self.words.get(words[i]) or self.words.put(words[i], self.search(words[i]))
                ids = np.frombuffer(packed, np.int32)
                start[i], count[i], held = held, len(ids), held + len(ids)
                parts.append(ids)
        return Solved(np.concatenate(parts) if parts else np.empty(0, np.int32), start, count, score, gap)

    def _choices(self, word: str) -> list[tuple[int, tuple[int, ...]]]:
        return self.choices.get(word) or self.choices.put(word, self.n_best(word, self.nbest))

    def encode_all(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, int, list[dict]]]:
        """For each text: ids, score, and the n best segmentations as edits (at, drop, ids) of the first."""
        chunked = [self.chunks(t) if t else [] for t in texts]
        every = [w for words in chunked for w in words]
        coded = pa.array(every, pa.large_string()).dictionary_encode()
        word, place = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
        place[word] = np.arange(len(every))
        solved = self.solve([every[i] for i in place.tolist()])
        count, scores, gaps = solved.count[word], solved.score[word], solved.gap[word]
        begins = np.concatenate(([0], np.cumsum(count)))
        ids = solved.ids[np.repeat(solved.start[word] - begins[:-1], count) + np.arange(begins[-1])]
        done = 0
        for words in chunked:
            last = done + len(words)
            own = ids[begins[done]:begins[last]]
            yield own, *self._merged(words, own, scores[done:last], gaps[done:last], begins[done:last + 1] - begins[done])
            done = last

    def encode(self, text: str | None) -> tuple[np.ndarray, int, list[dict]]:
        return next(self.encode_all([text]))

    def _merged(self, words: list[str], ids: np.ndarray, scores: np.ndarray, gaps: np.ndarray, begins: np.ndarray):
        """Score and the n best segmentations; each differs from the best in some of the N - 1 closest words.

        Equal scores are ordered by the changed places, from left to right.
        """
        wanted = self.nbest - 1
        if wanted and len(gaps) > wanted:
            near = np.flatnonzero(gaps <= np.partition(gaps, wanted - 1)[wanted - 1])
            near = near[np.argsort(gaps[near], kind="stable")][:wanted]
        else:
            near = np.arange(len(gaps) if wanted else 0)
        near = np.sort(near[gaps[near] < _NEVER])
        merged: list[tuple[int, tuple]] = [(0, ())]
        for place in near.tolist():
            best = tuple(ids[begins[place]:begins[place + 1]].tolist())
            choices = [(0, None)] + [(int(scores[place]) - s, i) for s, i in self._choices(words[place]) if i != best]
            merged = sorted(((gap + more, edits if new is None else (*edits, (place, new)))
                             for gap, edits in merged for more, new in choices), key=lambda x: (x[0], x[1]))[:self.nbest]
        span = {p: (int(begins[p]), int(begins[p + 1] - begins[p])) for p in near.tolist()}
        score = int(scores.sum())
        return score, [
            {"score": score - gap, "edits": [{"at": span[p][0], "drop": span[p][1], "ids": list(new)} for p, new in edits]}
            for gap, edits in merged]

    def decode(self, ids) -> str:
        """Text of piece ids; bytes that form no character become U+FFFD."""
        text = b"".join(list(map(self.raw.__getitem__, ids))).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def apply_edits(ids: list[int], edits: list[dict]) -> list[int]:
    """The ids of a further segmentation from those of the best one."""
    out, done = [], 0
    for edit in edits:
        out += [*ids[done:edit["at"]], *edit["ids"]]
        done = edit["at"] + edit["drop"]
    return out + list(ids[done:])


_EDITS = pa.list_(pa.struct([("score", pa.int64()), ("edits", pa.list_(pa.struct([
    ("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))
_ADDED = ("ids array<int>, n_pieces bigint, score bigint, "
          "nbest array<struct<score:bigint,edits:array<struct<at:int,drop:int,ids:array<int>>>>>, round_trip boolean")


def _packed(doc_id: pa.Array, texts: list[str | None], segmenter: Segmenter) -> pa.RecordBatch:
    ids, scores, best = zip(*segmenter.encode_all(texts))
    same = [segmenter.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts)]
    offsets = np.concatenate(([0], np.cumsum(list(map(len, ids))))).astype(np.int32)
    pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))
    return pa.RecordBatch.from_arrays(
        [doc_id, pieces, pa.array(np.diff(offsets), pa.int64()), pa.array(scores, pa.int64()), pa.array(best, _EDITS),
         pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_pieces", "score", "nbest", "round_trip"])


def _encoder(vocabulary: Vocabulary, nbest: int):
    own: list[Segmenter] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not own:
            own.append(Segmenter(vocabulary, nbest))
        segmenter = own[0]

        for batch in batches:
            texts, begin = batch.column(1).to_pylist(), 0
            while begin < len(texts):
                end, held = begin, 0
                while end < len(texts) and held < BATCH_CHARS:
                    held, end = held + len(texts[end] or "") + 1, end + 1
                yield _packed(batch.column(0).slice(begin, end - begin), texts[begin:end], segmenter)
                begin = end

    return run


def encode(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", nbest: int = NBEST) -> DataFrame:
    """(doc_id, ids, n_pieces, score, nbest, round_trip), one row for each row of ``docs``.

    ``nbest`` holds up to ``nbest`` segmentations in order of their score, each
    as edits of ``ids``. A space begins every text and every space becomes the
    piece sign; a character without a piece becomes its bytes. ``round_trip``
    tells whether decoding gives the text back, which fails only for texts that
    hold the piece sign themselves. Null and empty texts have no pieces.
    Other columns are not read.
    """
    vocabulary = load_vocabulary(model_path)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encoder(vocabulary, nbest), f"doc_id {kind}, {_ADDED}")


def decode(pieces: DataFrame, model_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``pieces`` with the text of its ids in a further column; null ids give null."""
    vocabulary = load_vocabulary(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(vocabulary)
        for batch in batches:
            texts = [None if i is None else segmenter.decode(i) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return pieces.mapInArrow(run, T.StructType([*pieces.schema.fields, T.StructField(into, T.StringType())]))
