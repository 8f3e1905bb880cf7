"""Terms of texts counted in Arrow batches.

The code points of a batch stand in one array, which is walked in windows.  A window's
n-grams and short words become numbers (document, then the places of up to three code
points in the window's alphabet); one sort of them gives the counts.  Longer words are
numbered by a dictionary.  No row per occurrence is made, and only distinct terms of a
document leave the task, or, in blocks, distinct terms of many documents with lists of them.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle

from chatprep.functions.terms import GRAM_LENGTHS, WORD
from chatprep.functions.text import WHITESPACE

# What runs in Python workers travels by value: executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHORT = max(GRAM_LENGTHS)  # words up to it are numbers like n-grams
POINT_BITS = 21
POINTS = 1 << POINT_BITS
TEXT_BYTES = 1 << 20  # of texts that are laid out together
BLOCK_POSTINGS = 1 << 21  # terms of documents after which a block ends


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _strings(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings of code points, which end at these places."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    if not len(flat) or flat.max() < 0x80:
        offsets[1:] = ends
        data = flat.astype(np.uint8).tobytes()
    else:
        size = 1 + (flat >= 0x80).astype(np.int32) + (flat >= 0x800) + (flat >= 0x10000)
        offsets[1:] = np.append(0, np.cumsum(size))[ends]
        data = flat.astype(np.uint32).tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data))


def _texts(codes: np.ndarray) -> pa.Array:
    """Codes (up to three code points plus one, the first on top) as strings."""
    parts = np.empty((len(codes), SHORT), np.int64)
    for i in range(SHORT):
        parts[:, i] = (codes >> POINT_BITS * (SHORT - 1 - i)) & (POINTS - 1)
    flat, filled = parts.ravel(), parts > 0
    return _strings(flat[filled.ravel()] - 1, np.cumsum(filled.sum(axis=1)))


class Asked:
    """The terms to count, and a number for each: short ones as sorted codes, longer words by name."""

    def __init__(self, numbers: dict[str, int]):
        short = {_code(t): n for t, n in numbers.items() if len(t) <= SHORT}
        self.codes = np.array(sorted(short), np.int64)
        self.numbers = np.array([short[c] for c in self.codes.tolist()], np.int64)
        self.words = {t: n for t, n in numbers.items() if len(t) > SHORT}

    def has(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes), bool)
        return self.codes[np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)] == codes


def _code(term: str) -> int:
    return sum((ord(c) + 1) << (SHORT - 1 - i) * POINT_BITS for i, c in enumerate(term))


def _tallied(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order with their counts."""
    if counts is None:
        return _runs(np.sort(codes))
    order = np.argsort(codes, kind="stable")
    return _runs(codes[order], counts[order])


def _runs(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    sums = np.diff(np.append(first, len(codes))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts
    return codes[first], sums.astype(np.int64)


def _joined(codes: np.ndarray, counts: np.ndarray, more: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two tallies as one: few ``more`` are looked up in the codes."""
    place = np.searchsorted(codes, more)
    known = np.zeros(len(more), bool)
    known[place < len(codes)] = codes[place[place < len(codes)]] == more[place < len(codes)]
    counts[place[known]] += sums[known]
    return np.insert(codes, place[~known], more[~known]), np.insert(counts, place[~known], sums[~known])


def _with_prefixes(codes: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Tallied n-grams of full length (a point less where the text ends) and those a point shorter."""
    if not len(codes):
        return codes, counts
    last = codes.dtype.type((1 << bits) - 1)
    prefix = codes & ~last
    first = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
    lacks = codes[first] != prefix[first]  # else the prefix stands there, where a text ends
    head = first + np.cumsum(lacks) - lacks
    old = np.ones(len(codes) + int(lacks.sum()), bool)
    old[head[lacks]] = False
    both, sums = np.empty(len(old), codes.dtype), np.empty(len(old), np.int64)
    both[old], sums[old] = codes, counts
    both[head], sums[head] = prefix[first], np.add.reduceat(counts, first)
    return both, sums


def _looked_up(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``table[places]``; bytes are translated."""
    if places.dtype != np.uint8:
        return table[places]
    whole = np.zeros(256, table.dtype)
    whole[: len(table)] = table
    return np.frombuffer(places.tobytes().translate(whole.tobytes()), table.dtype)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch by about ``TEXT_BYTES``, so that long texts are not laid out together."""
    sizes = pa.compute.binary_length(batch.column("_text")).to_numpy()
    number = np.cumsum(sizes, dtype=np.int64) // TEXT_BYTES
    cuts = np.flatnonzero(number[1:] != number[:-1]) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(start, end - start)


class _Counting:
    """``keys, term, tf`` of batches of ``keys, _text``.

    With ``merge`` neighbouring rows of equal key are one document, also across batches.
    With ``asked`` only those terms are given, as lists of their numbers: ``keys, tid, tf``.
    """

    def __init__(self, keys: list[str], piece: int, merge: bool, asked: Asked | None):
        self.keys, self.piece, self.merge, self.asked = keys, piece, merge, asked
        plane = "".join(chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000)
        self.kind = np.zeros(POINTS, np.uint8)
        for i, p in enumerate(WORD.split("|"), 1):
            self.kind[_points("".join(re.findall(p, plane)))] = i
        self.blank = np.zeros(POINTS, bool)
        self.blank[_points(WHITESPACE)] = True
        self.seen, self.rank = np.zeros(POINTS, bool), np.zeros(POINTS, np.int32)
        self.open = None  # the last document, which may go on: its keys, codes, counts, words

    def _lay_out(self, texts: list[str]) -> None:
        """The texts as places of code points in their alphabet, those not blank, and where words begin."""
        sizes = np.array([len(t) for t in texts], np.int64)
        self.points, self.ends = _points("".join(texts)), np.cumsum(sizes)
        places = self.points.astype(np.intp)
        self.seen[places] = True
        self.alphabet = np.flatnonzero(self.seen)
        self.seen[self.alphabet] = False
        self.rank[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        self.letters = np.append(0, self.alphabet + 1)
        ranks = self.rank.take(places)
        del places
        if len(self.alphabet) < 256:
            ranks = ranks.astype(np.uint8)
        self.filled = _looked_up(np.append(True, ~self.blank[self.alphabet]), ranks)
        filled_rows, starts = sizes > 0, self.ends - sizes
        own_sizes = np.zeros(len(sizes), np.int64)
        if len(ranks):
            own_sizes[filled_rows] = np.add.reduceat(self.filled, starts[filled_rows], dtype=np.int64)
        self.own_document = np.repeat(self.document.astype(np.int32), own_sizes)
        self.own_lasts = (np.cumsum(own_sizes) - 1)[own_sizes > 0]
        beyond = np.zeros(SHORT, ranks.dtype)
        self.own, self.ranks = np.append(ranks.take(np.flatnonzero(self.filled)), beyond), np.append(ranks, beyond)
        kind = _looked_up(np.append(0, self.kind[self.alphabet]).astype(np.uint8), ranks)
        turns = np.ones(len(kind), bool)
        np.not_equal(kind[1:], kind[:-1], out=turns[1:])
        turns[starts[filled_rows]] = True
        begins = np.flatnonzero(turns)
        length, word = np.diff(np.append(begins, len(kind))), kind[begins] > 0
        documents = np.repeat(self.document.astype(np.int32), sizes)[begins]
        # Places of what holds are found before it is taken: a mask costs a jump a value.
        short, long = np.flatnonzero(word & (length <= SHORT)), word & (length > SHORT)
        self.short = begins.take(short), length.take(short), documents.take(short)
        points, long = np.flatnonzero(np.repeat(long, length)), np.flatnonzero(long)
        self.long = self.points.take(points), length.take(long), documents.take(long)

    def _window(self, start: int, end: int, first: int, last: int):
        """(document, code, count) of what starts at these points, of them non-blank ``first`` to ``last``."""
        bits = len(self.alphabet).bit_length()
        low, high = self.document[np.searchsorted(self.ends, (start, end - 1), "right")]
        used = SHORT * bits + int(high - low).bit_length()
        if used > 63:
            middle = (start + end) // 2
            cut = first + int(np.count_nonzero(self.filled[start:middle]))
            yield from self._window(start, middle, first, cut)
            yield from self._window(middle, end, cut, last)
            return
        number = np.int32 if used < 32 else np.int64
        mask = number((1 << bits) - 1)
        code = (self.own_document[first:last] - number(low)).astype(number, copy=False)
        for i in range(SHORT):
            code <<= number(bits)
            code |= self.own[first + i : last + i]
        # A row's last point starts no n-gram, the one before it one of two points.
        lasts = self.own_lasts[slice(*np.searchsorted(self.own_lasts, (first, last + 1)))]
        code[lasts[lasts > first] - 1 - first] &= ~mask
        ended = lasts[lasts < last] - first
        code[ended] = np.iinfo(number).max
        code.sort()  # those that start none come last
        codes, counts = _with_prefixes(*_runs(code[: len(code) - len(ended)]), bits)
        begins, length, document = (w[slice(*np.searchsorted(self.short[0], (start, end)))] for w in self.short)
        code = (document - number(low)).astype(number, copy=False)
        for i in range(SHORT):
            code <<= number(bits)
            code |= np.where(length > i, self.ranks[begins + i], 0).astype(number)
        codes, counts = _joined(codes, counts, *_tallied(code))
        whole = np.zeros(len(codes), np.int64)
        for i in range(SHORT):
            whole <<= POINT_BITS
            whole |= self.letters[(codes >> number((SHORT - 1 - i) * bits)) & mask]
        document = low + (codes.astype(np.int64) >> SHORT * bits)
        if self.asked is not None:
            held = self.asked.has(whole)
            document, whole, counts = document[held], whole[held], counts[held]
        yield document, whole, counts

    def _long_words(self):
        """Different words, and (document, number of the word, count) in order."""
        points, length, documents = self.long
        coded = _strings(points, np.cumsum(length)).dictionary_encode()
        codes, counts = _tallied((documents.astype(np.int64) << 32) | coded.indices.to_numpy())
        document, word = codes >> 32, codes & ((1 << 32) - 1)
        if self.asked is not None:
            held = np.array([w in self.asked.words for w in coded.dictionary.to_pylist()], bool)[word]
            document, word, counts = document[held], word[held], counts[held]
        return coded.dictionary, document, word, counts

    def _out(self, keys: pa.RecordBatch, place: np.ndarray, terms: np.ndarray | pa.Array, counts) -> Iterator[pa.RecordBatch]:
        """``terms`` are codes or, of longer words, strings; ``place`` has their rows of ``keys``, in order."""
        if not len(terms):
            return
        coded = isinstance(terms, np.ndarray)
        if self.asked is None:
            columns = [_texts(terms) if coded else terms, pa.array(counts, pa.int64())]
            names = [*self.keys, "term", "tf"]
        else:
            starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            offsets = pa.array(np.append(starts, len(place)), pa.int32())
            if coded:
                numbers = self.asked.numbers[np.searchsorted(self.asked.codes, terms)]
            else:
                numbers = [self.asked.words[t] for t in terms.to_pylist()]
            lists = pa.array(numbers, pa.int64()), pa.array(counts, pa.int64()).cast(pa.float64())
            columns = [pa.ListArray.from_arrays(offsets, c) for c in lists]
            place, names = place[starts], [*self.keys, "tid", "tf"]
        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(place)) for c in keys.columns), *columns], names=names)

    def _close(self) -> Iterator[pa.RecordBatch]:
        if self.open is not None:
            keys, codes, counts, words = self.open
            self.open = None
            yield from self._out(keys, np.zeros(len(codes), np.int64), codes, counts)
            yield from self._out(keys, np.zeros(len(words), np.int64), pa.array(words.keys(), pa.string()), list(words.values()))

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, texts = batch.select(self.keys), batch.column("_text").to_pylist()
        if not texts:
            return
        if self.merge:
            ended = pa.compute.run_end_encode(batch.column(self.keys[0]))
            ends = ended.run_ends.to_numpy()
            self.document = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            heads = np.concatenate(([0], ends[:-1]))
        else:
            self.document = heads = np.arange(len(texts))
        codes, counts, words = np.zeros(0, np.int64), np.zeros(0, np.int64), Counter()
        if self.open is not None:
            if self.open[0].column(0)[0].as_py() == keys.column(0)[0].as_py():
                _, codes, counts, words = self.open
                self.open = None
            yield from self._close()
        self._lay_out(texts)
        now, last = 0, 0  # the document whose codes are held back
        for start in range(0, len(self.points), self.piece):
            end = min(start + self.piece, len(self.points))
            first, last = last, last + int(np.count_nonzero(self.filled[start:end]))
            for document, code, count in self._window(start, end, first, last):
                if not len(code):
                    continue
                upto = np.searchsorted(document, now, "right")
                codes, counts = _tallied(np.append(codes, code[:upto]), np.append(counts, count[:upto]))
                if document[-1] == now:
                    continue
                yield from self._out(keys, np.full(len(codes), heads[now]), codes, counts)
                now = document[-1]
                hold = np.searchsorted(document, now)
                yield from self._out(keys, heads[document[upto:hold]], code[upto:hold], count[upto:hold])
                codes, counts = code[hold:], count[hold:]
        final = len(heads) - 1
        if now != final or not self.merge:
            yield from self._out(keys, np.full(len(codes), heads[now]), codes, counts)
            codes, counts = codes[:0], counts[:0]
        spelled, word_document, word, sums = self._long_words()
        old = np.searchsorted(word_document, 0, "right")  # words of the first document, which may have begun before
        begun = len(words) > 0
        old = old if begun else 0
        for w, n in zip(spelled.take(pa.array(word[:old])).to_pylist(), sums[:old].tolist()):
            words[w] += n
        upto = max(old, np.searchsorted(word_document, final) if self.merge else len(word))
        if begun and final:
            yield from self._out(keys, np.zeros(len(words), np.int64), pa.array(words.keys(), pa.string()), list(words.values()))
            words = Counter()
        yield from self._out(keys, heads[word_document[old:upto]], spelled.take(pa.array(word[old:upto])), sums[old:upto])
        for w, n in zip(spelled.take(pa.array(word[upto:])).to_pylist(), sums[upto:].tolist()):
            words[w] += n
        # Copied: a slice would keep the whole batch in memory.
        self.open = keys.take(pa.array([heads[final]])), codes, counts, words
        if not self.merge:
            yield from self._close()


class _Blocks(_Counting):
    """``term, part, block, df, docs, tfs``: terms of a run of documents with those they are in.

    A document is in one block, and its neighbours in order follow it there; ``part`` comes
    with the texts and is the same for all of a task, which numbers its blocks.
    """

    def __init__(self, keys: list[str], piece: int):
        super().__init__(keys, piece, True, None)
        self.part, self.number = None, 0
        self._begin()

    def _begin(self) -> None:
        self.known, self.base, self.documents = None, 0, []  # rows of which a document's number is the place
        self.coded, self.spelled, self.size, self.rows = [], [], 0, 0

    def _out(self, keys: pa.RecordBatch, place: np.ndarray, terms: np.ndarray | pa.Array, counts) -> Iterator[pa.RecordBatch]:
        if len(terms):
            if keys is not self.known:
                # Copied: a slice would keep the whole batch in memory.
                self.documents.append(keys.column(0).take(pa.array(np.arange(keys.num_rows))))
                self.known, self.base, self.rows = keys, self.rows, self.rows + keys.num_rows
            held = self.coded if isinstance(terms, np.ndarray) else self.spelled
            held.append(((place + self.base).astype(np.int32), terms, np.asarray(counts, np.int64)))
            self.size += len(terms)
        return iter(())

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            self.part = batch.column("part")[0].as_py()
        yield from super().add(batch)
        if self.size >= BLOCK_POSTINGS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """All documents that have ended, as a block."""
        if not self.size:
            return
        documents = pa.concat_arrays(self.documents)
        if self.coded:
            place, codes, counts = (np.concatenate(c) for c in zip(*self.coded))
            order = np.argsort(codes, kind="stable")  # documents stay in order
            yield self._block(documents, place[order], codes[order], counts[order], _texts)
        if self.spelled:
            place, counts = (np.concatenate([c[i] for c in self.spelled]) for i in (0, 2))
            words = pa.concat_arrays([c[1] for c in self.spelled]).dictionary_encode()
            numbers = words.indices.to_numpy()
            order = np.argsort(numbers, kind="stable")
            yield self._block(documents, place[order], numbers[order], counts[order], lambda n: words.dictionary.take(pa.array(n)))
        self.number += 1
        self._begin()

    def _block(self, documents, place, terms, counts, spell) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
        ends = np.append(first, len(terms))
        same = np.ones(len(first), np.int64)
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), c) for c in (documents.take(pa.array(place)), pa.array(counts))]
        columns = [spell(terms[first]), pa.array(same * self.part), pa.array(same * self.number), pa.array(np.diff(ends)), *lists]
        return pa.RecordBatch.from_arrays(columns, names=["term", "part", "block", "df", "docs", "tfs"])


class _Frequencies(_Counting):
    """``term, df``: terms of all documents of a task with how many they are in.

    A term comes once, or once for each ``BLOCK_POSTINGS`` different ones.
    """

    def __init__(self, keys: list[str], piece: int):
        super().__init__(keys, piece, True, None)
        self.coded, self.worded, self.size = [], [], 0
        self._begin()

    def _begin(self) -> None:
        self.sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words = pa.array([], pa.string()), np.zeros(0, np.int64)

    def _out(self, keys: pa.RecordBatch, place: np.ndarray, terms: np.ndarray | pa.Array, counts) -> Iterator[pa.RecordBatch]:
        (self.coded if isinstance(terms, np.ndarray) else self.worded).append(terms)
        self.size += len(terms)
        return iter(())

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield from super().add(batch)
        if self.size >= BLOCK_POSTINGS:
            self._sum()
            if len(self.sums[0]) + len(self.words[0]) >= BLOCK_POSTINGS:
                yield from self.flush()

    def _sum(self) -> None:
        if self.coded:
            held = _tallied(np.concatenate(self.coded))
            self.sums = _tallied(*(np.concatenate(c) for c in zip(self.sums, held)))
        if self.worded:
            known, sums = self.words
            words = pa.concat_arrays([known, *self.worded]).dictionary_encode()
            total = np.bincount(words.indices.to_numpy())
            total[: len(known)] += sums - 1  # different ones, which stand first
            self.words = words.dictionary, total
        self.coded, self.worded, self.size = [], [], 0

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._sum()
        for terms, sums in ((_texts(self.sums[0]), self.sums[1]), self.words):
            if len(terms):
                yield pa.RecordBatch.from_arrays([terms, pa.array(sums)], names=["term", "df"])
        self._begin()


def term_blocks(key: str, piece: int):
    return _flushed(_Blocks, key, piece)


def term_frequencies(key: str, piece: int):
    return _flushed(_Frequencies, key, piece)


def _flushed(kind: type[_Blocks | _Frequencies], key: str, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = kind([key], piece)
        for batch in batches:
            for part in _parts(batch):
                yield from counting.add(part)
        yield from counting._close()
        yield from counting.flush()

    return run


def counted_terms(keys: list[str], piece: int, merge: bool, asked: Asked | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = _Counting(keys, piece, merge, asked)
        for batch in batches:
            for part in _parts(batch):
                yield from counting.add(part)
        yield from counting._close()

    return run
