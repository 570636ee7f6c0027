"""SentencePiece encoding of merge type with seeded merge-dropout, and its decoding.

Spaces become the meta symbol, one is put in front, characters outside the
vocabulary become byte pieces, and nothing else is normalised, so every text
decodes to itself. Merges are taken from an agenda, best score first, leftmost
first among equals. A candidate that comes up is skipped for good if a hash falls
below the dropout; it is keyed by the seed, the document, the place of the word in
it, and the place and both symbols of the candidate in the word. So every
candidate of every word of every document is drawn on its own.

What a word becomes depends only on which of its steps are skipped. A class is a
word with the steps skipped so far, and knows the candidates that come up if no
more are; classes are made once and remembered, while the skips are drawn for each
occurrence by walking from class to class. Occurrences with many skips and long
words are merged one by one.

Many words advance side by side in arrays; words of over 48 characters go through
a heap. Both follow the same agenda and give the same pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ludometry.llm.base import batches, slices, texts
from ludometry.llm.rolling import ranges
from ludometry.llm.words import Numbering

META = "▁"
SEGMENTS = re.compile(r" *[^ ]+| +")
LONGEST = 48
SLICE = 1 << 20
# Characters of a word that has classes, so that its steps (at most three for each
# character but the first) fit into the bits of a mask; skips that a class may have.
CLASSED, SKIPS = 20, 2
# Occurrences whose skips are drawn at a time.
BLOCK = 1 << 14
_MASK = (1 << 64) - 1
# Odd constants that spread a key over 64 bits.
_C = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _spread(x: int) -> int:
    x ^= x >> 32
    x = x * _C[0] & _MASK
    x ^= x >> 29
    x = x * _C[1] & _MASK
    return x ^ (x >> 32)


def _hash(seed: int, place: int, left: int, right: int) -> int:
    """64 bits of the key."""
    return _spread((seed * _C[0] ^ (place + 1) * _C[1] ^ (left + 1) * _C[2] ^ (right + 1) * _C[3]) & _MASK)


def _skipped(seed: int, key: int, place: int, left: int, right: int) -> int:
    """What decides whether the word of a key skips the candidate at a place in it."""
    return _spread(_hash(seed, place, left, right) ^ key & _MASK)


def _spread_arrays(x: np.ndarray) -> np.ndarray:
    """The same of arrays, in place."""
    u = np.uint64
    x ^= x >> u(32)
    x *= u(_C[0])
    x ^= x >> u(29)
    x *= u(_C[1])
    x ^= x >> u(32)
    return x


def _hash_arrays(seed: int, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The same of arrays."""
    u = np.uint64
    c = [u(x) for x in _C]
    place, left, right = (x.astype(u) for x in (place, left, right))
    return _spread_arrays((place + u(1)) * c[1] ^ (left + u(1)) * c[2] ^ (right + u(1)) * c[3] ^ u(seed * _C[0] & _MASK))


@dataclass(frozen=True)
class Dropout:
    """Which merges are skipped: a share and a seed."""

    share: float = 0.1
    seed: int = 1

    @property
    def limit(self) -> int:
        return min(_MASK, int(self.share * 2.0**64))


class Vocabulary:
    """Pieces and scores, and what is looked up in them."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int]) -> None:
        # Kinds: 0 a piece of text, 1 a byte, 2 a control or unknown piece.
        self.pieces = pieces
        ids = {piece: k for k, piece in enumerate(pieces) if kinds[k] == 0}
        self.first_byte = next(k for k, piece in enumerate(pieces) if kinds[k] == 1 and piece == "<0x00>")
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for piece, k in ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = k
        self.of_char[ord(" ")] = self.of_char[ord(META)]
        self.of_char[ord(META)] = -1  # a meta symbol in a text is not a space
        merges = [
            (ids[piece[:cut]], ids[piece[cut:]], k, scores[k])
            for piece, k in ids.items()
            for cut in range(1, len(piece))
            if piece[:cut] in ids and piece[cut:] in ids
        ]
        merges.sort()
        self.keys = np.array([left << 32 | right for left, right, _, _ in merges] + [1 << 62], dtype=np.int64)
        self.merged = np.array([k for _, _, k, _ in merges] + [-1], dtype=np.int32)
        self.scores = np.array([score for *_, score in merges] + [-np.inf], dtype=np.float32)
        self.table = {key: n for n, key in enumerate(self.keys[:-1].tolist())}
        self._place_merges()
        raw = [
            bytes([int(piece[3:5], 16)]) if kinds[k] == 1 else b"" if kinds[k] == 2 else piece.replace(META, " ").encode()
            for k, piece in enumerate(pieces)
        ]
        self.sizes = np.array([len(x) for x in raw], dtype=np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.digest = hashlib.sha256(repr((pieces, scores, kinds)).encode()).hexdigest()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file on the driver; tasks get the vocabulary, not the path."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.vocab_size())
        kinds = [1 if model.is_byte(k) else 2 if model.is_control(k) or model.is_unknown(k) else 0 for k in numbers]
        return cls([model.id_to_piece(k) for k in numbers], [model.get_score(k) for k in numbers], kinds)

    def _place_merges(self) -> None:
        """A slot for every merge: the one its key hashes to, or the next that is free."""
        none = len(self.keys) - 1
        bits = max(4, none.bit_length() + 2)
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, none, dtype=np.int32)
        left = np.arange(none)
        slot = self._slot(self.keys[:-1])
        while len(left):
            free = self.slots[slot] == none
            self.slots[slot[free]] = left[free]  # of several, the last stays
            left, slot = left[self.slots[slot] != left], slot[self.slots[slot] != left]
            slot = (slot + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(_C[0]) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the merge of each pair, or the last number where there is none."""
        none = len(self.keys) - 1
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -1
        slot = self._slot(key)
        found = self.slots[slot]
        open_ = np.flatnonzero((found != none) & (self.keys[found] != key))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
            found[open_] = self.slots[slot[open_]]
            open_ = open_[(found[open_] != none) & (self.keys[found[open_]] != key[open_])]
        return found

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Piece of each code point, or minus the code point less 2 where there is none."""
        found = self.of_char[codes]
        return np.where(found >= 0, found, -2 - codes.astype(np.int32))

    def as_bytes(self, symbol: int) -> list[int]:
        return [self.first_byte + b for b in chr(-2 - symbol).encode("utf-8", "surrogatepass")]


def merge_by_heap(vocabulary: Vocabulary, codes: np.ndarray, key: int, dropout: Dropout) -> list[int]:
    """The symbols of one word after all merges; ``key`` is that of its document and place."""
    symbols = vocabulary.symbols(codes).tolist()
    after = [*range(1, len(symbols)), -1]
    before = list(range(-1, len(symbols) - 1))
    agenda: list[tuple[float, int, int, int, int]] = []

    def propose(at: int) -> None:
        right = after[at]
        if right >= 0 and symbols[at] >= 0 and symbols[right] >= 0:
            number = vocabulary.table.get(symbols[at] << 32 | symbols[right])
            if number is not None:
                heapq.heappush(agenda, (-float(vocabulary.scores[number]), at, symbols[at], symbols[right], number))

    for at in range(len(symbols)):
        propose(at)
    while agenda:
        _, at, left, right, number = heapq.heappop(agenda)
        follower = after[at]
        if symbols[at] != left or follower < 0 or symbols[follower] != right:
            continue  # one side has been merged away meanwhile
        if dropout.limit and _skipped(dropout.seed, key, at, left, right) < dropout.limit:
            continue
        symbols[at] = int(vocabulary.merged[number])
        symbols[follower] = None
        after[at] = after[follower]
        if after[at] >= 0:
            before[after[at]] = at
        if before[at] >= 0:
            propose(before[at])
        propose(at)
    return [symbol for symbol in symbols if symbol is not None]


def merge_side_by_side(
    vocabulary: Vocabulary,
    symbols: np.ndarray,
    sizes: np.ndarray,
    keys: np.ndarray,
    dropout: Dropout,
    masks: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The same for many words: rows of ``symbols``, of which ``sizes`` count. In place.

    With ``masks`` their bits, not keys, say which steps are skipped; then the third
    result has, for each step, the rows that come to it and the hashes of their candidates.
    """
    rows, width = symbols.shape
    none = len(vocabulary.keys) - 1
    columns = np.arange(width)
    number = np.full((rows, width), none, dtype=np.int32)
    if width > 1:
        number[:, :-1] = vocabulary.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(rows, -1)
    number[columns >= sizes[:, None] - 1] = none
    grids = [symbols, number]
    if dropout.limit:
        place = np.tile(columns.astype(np.int32), (rows, 1))  # where each symbol begins
        grids.append(place)
    trace: list[tuple[np.ndarray, np.ndarray]] = []
    live = np.arange(rows)
    while len(live):
        value = vocabulary.scores[number[live]]
        at = value.argmax(axis=1)
        going = value[np.arange(len(live)), at] > -np.inf
        live, at = live[going], at[going]
        if not len(live):
            break
        chosen = number[live, at]
        if dropout.limit:
            drawn = _hash_arrays(dropout.seed, place[live, at], symbols[live, at], symbols[live, at + 1])
            if masks is None:
                skip = _spread_arrays(drawn ^ keys[live]) < np.uint64(dropout.limit)
            else:
                skip = (masks[live] >> np.uint64(len(trace)) & np.uint64(1)).astype(bool)
                trace.append((live, drawn))
            number[live[skip], at[skip]] = none
        else:
            skip = np.zeros(len(live), dtype=bool)
        own, at, chosen = live[~skip], at[~skip], chosen[~skip]
        if len(own):
            # The merged symbol stands at ``at``; what follows moves one to the left.
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            for grid in grids:
                grid[own] = np.take_along_axis(grid[own], source, axis=1)
            symbols[own, at] = vocabulary.merged[chosen]
            sizes[own] -= 1
            number[own, sizes[own] - 1] = none
            for left in (at - 1, at):
                fits = (left >= 0) & (left + 1 < sizes[own])
                r, c = own[fits], left[fits]
                number[r, c] = vocabulary.find(symbols[r, c], symbols[r, c + 1])
    return symbols, sizes, trace


def _expanded(flat: np.ndarray, sizes: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols outside the vocabulary replaced by their bytes."""
    if not len(flat) or flat.min() >= 0:
        return flat, sizes
    word = np.repeat(np.arange(len(sizes)), sizes)
    unknown, inverse = np.unique(np.where(flat < 0, flat, 0), return_inverse=True)
    spelled = [vocabulary.as_bytes(int(x)) if x < 0 else [0] for x in unknown]
    times = np.array([len(x) for x in spelled])[inverse]
    starts = np.cumsum([0, *map(len, spelled)])[:-1]
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    bytes_ = np.concatenate([np.array(x) for x in spelled])[np.repeat(starts[inverse], times) + nth]
    known = np.repeat(flat, times)
    return np.where(known < 0, bytes_, known), np.bincount(np.repeat(word, times), minlength=len(sizes))


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start : start + size]`` one after another."""
    ends = np.cumsum(sizes)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


def encode_words(vocabulary: Vocabulary, words: list[str], keys: np.ndarray, dropout: Dropout) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all words one after another, and how many each has; ``keys`` name their documents and places."""
    return _merged(vocabulary, words, keys.astype(np.uint64), dropout)[:2]


def _merged(
    vocabulary: Vocabulary, words: list[str], keys: np.ndarray, dropout: Dropout, masks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same, by ``masks`` of short words if given, and the hashes of all steps and how many each word has."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    symbols = vocabulary.symbols(codes)
    sizes = np.zeros(len(words), dtype=np.int64)
    parts: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    order = np.argsort(lengths, kind="stable")
    bounds = np.searchsorted(lengths[order], [0, 3, 5, 7, 9, 12, 16, 24, 32, LONGEST + 1])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        for at in range(a, b, 8_000):
            own = order[at : min(at + 8_000, b)]
            width = max(int(lengths[own].max()), 1)
            columns = np.arange(width)
            inside = columns < lengths[own][:, None]
            grid = np.where(inside, symbols[np.where(inside, starts[own][:, None] + columns, 0)], -1) if len(symbols) else np.full((len(own), width), -1)
            grid, sizes[own], trace = merge_side_by_side(
                vocabulary, grid, lengths[own].copy(), keys[own], dropout, None if masks is None else masks[own]
            )
            steps.extend((own[live], drawn) for live, drawn in trace)
            parts.append(grid[columns < sizes[own][:, None]])
            owners.append(own)
    for word in order[bounds[-1] :].tolist():
        own_codes = codes[starts[word] : starts[word] + lengths[word]]
        made = merge_by_heap(vocabulary, own_codes, int(keys[word]), dropout)
        sizes[word] = len(made)
        parts.append(np.array(made, dtype=np.int32))
        owners.append(np.array([word]))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    done = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    begun = np.zeros(len(words), dtype=np.int64)
    begun[done] = np.cumsum(sizes[done]) - sizes[done]
    # Steps of a word come in order; a stable sort puts those of a word together.
    stepped = np.concatenate([own for own, _ in steps]) if steps else np.zeros(0, np.int64)
    hashes = np.concatenate([drawn for _, drawn in steps]) if steps else np.zeros(0, np.uint64)
    counts = np.bincount(stepped, minlength=len(words))
    flat, sizes = _expanded(_gathered(flat, begun, sizes).astype(np.int64), sizes, vocabulary)
    return flat, sizes, hashes[np.argsort(stepped, kind="stable")], counts


def _segments(text: str) -> list[str]:
    """Words with the spaces before them, less the one space that each begins with.

    No merge reaches over the end of a word, so each is encoded on its own.
    """
    words = text.split(" ")
    if "" in words:
        return [word[1:] for word in SEGMENTS.findall(f" {text}")]
    return words


class _Growing:
    """An array with room to grow."""

    def __init__(self, kind: type) -> None:
        self.held, self.size = np.empty(1 << 10, kind), 0

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            held = np.empty(max(size, len(self.held) * 3 // 2), self.held.dtype)
            held[: self.size] = self.all
            self.held = held
        self.held[self.size : size] = values
        self.size = size

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.size]


class Encoder:
    """Encodes texts and remembers the classes of words that come again, up to a bounded number.

    A word met once is merged as it comes. When there are too many, all are let go but
    the names of the most frequent, which have classes again when they are met next.
    """

    def __init__(self, vocabulary: Vocabulary, dropout: Dropout, most: int = 60_000) -> None:
        self.vocabulary, self.dropout, self.most = vocabulary, dropout, most
        self.seen: set[str] = set()  # words met once
        self.uses = _Growing(np.int64)
        self.forget()

    def forget(self) -> None:
        if self.uses.size:
            order = np.argsort(-self.uses.all)[: self.most // 3].tolist()
            self.seen = {self.words[k] for k in order}
        self.index: dict[str, int] = {}
        self.words: list[str] = []
        self.uses = _Growing(np.int64)  # occurrences of every word
        self.roots = _Growing(np.int64)  # of every word: its class without skips
        self.flat = _Growing(np.int32)  # the pieces of all classes
        # Of every class: its word, its mask, and its ranges of pieces and of steps.
        self.word, self.mask = _Growing(np.int64), _Growing(np.uint64)
        self.starts, self.sizes = _Growing(np.int64), _Growing(np.int64)
        self.begins, self.counts = _Growing(np.int64), _Growing(np.int64)
        # Of every step of a class: the hash of its candidate, and the class that also skips it, or -1: not met.
        self.drawn, self.next = _Growing(np.uint64), _Growing(np.int64)

    def _numbers(self, words: list[str], uses: np.ndarray) -> np.ndarray:
        """The numbers of words that have classes, -1 for the others; new ones are made."""
        get, seen = self.index.get, self.seen
        own = np.fromiter([get(word, -1) for word in words], np.int64, len(words))
        fresh = own < 0
        if self.dropout.limit:
            fresh &= np.fromiter(map(len, words), np.int64, len(words)) < CLASSED
        once = np.flatnonzero(fresh & (uses == 1)).tolist()
        made = [*np.flatnonzero(fresh & (uses > 1)).tolist(), *(k for k in once if words[k] in seen)]
        if len(seen) > 8 * self.most:
            seen.clear()
        seen.update([words[k] for k in once])
        if made:
            numbers = len(self.words) + np.arange(len(made))
            own[made] = numbers
            chosen = [words[k] for k in made]
            self.index.update(zip(chosen, numbers.tolist(), strict=True))
            self.words.extend(chosen)
            self.uses.add(np.zeros(len(made), np.int64))
            self.roots.add(self._make(self.words, numbers, np.zeros(len(made), np.uint64)))
        known = np.flatnonzero(own >= 0)
        self.uses.all[own[known]] += uses[known]
        return own

    def _make(self, words: list[str], word: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """New classes of words (by number) and masks."""
        chosen = [f" {words[k]}" for k in word.tolist()]
        none = np.zeros(len(word), np.uint64)
        flat, sizes, drawn, counts = _merged(self.vocabulary, chosen, none, self.dropout, mask)
        made = self.word.size + np.arange(len(word))
        self.starts.add(self.flat.size + np.cumsum(sizes) - sizes)
        self.begins.add(self.drawn.size + np.cumsum(counts) - counts)
        for held, values in (
            (self.word, word), (self.mask, mask), (self.sizes, sizes), (self.counts, counts),
            (self.flat, flat), (self.drawn, drawn), (self.next, np.full(len(drawn), -1)),
        ):
            held.add(values)
        return made

    def _skips(self, keys: np.ndarray, classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences that skip a step of their class, from the ``first`` on, and the first that they skip."""
        who, where = [], []
        for at in range(0, len(keys), BLOCK):
            own = classes[at : at + BLOCK]
            counts = self.begins.all[own] + self.counts.all[own] - first[at : at + BLOCK]
            step = ranges(first[at : at + BLOCK], counts)
            values = self.drawn.all[step] ^ np.repeat(keys[at : at + BLOCK], counts)
            hit = np.flatnonzero(_spread_arrays(values) < np.uint64(self.dropout.limit))
            owner = np.searchsorted(np.cumsum(counts), hit, side="right")
            fresh = np.flatnonzero(np.diff(owner, prepend=-1))
            who.append(at + owner[fresh])
            where.append(step[hit[fresh]])
        return (np.concatenate(who), np.concatenate(where)) if who else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _walk(self, words: list[str], keys: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The classes that occurrences come to from those without skips, or -1 if they skip too often."""
        classes = classes.copy()
        live = np.flatnonzero(classes >= 0)
        first = self.begins.all[classes[live]]
        for skips in range(SKIPS + 1):
            who, step = self._skips(keys[live], classes[live], first)
            live = live[who]
            if skips == SKIPS:
                classes[live] = -1
                break
            fresh = np.unique(step[self.next.all[step] < 0])
            if len(fresh):
                before = np.searchsorted(self.begins.all, fresh, side="right") - 1
                bit = np.uint64(1) << (fresh - self.begins.all[before]).astype(np.uint64)
                self.next.all[fresh] = self._make(words, self.word.all[before], self.mask.all[before] | bit)
            following = self.next.all[step]
            before = classes[live]
            first = self.begins.all[following] + (step - self.begins.all[before]) + 1
            classes[live] = following
        return classes

    def encode(self, keys: list[int | None], values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts one after another, and how many each has.

        ``keys`` name the texts for the choice of skips; null texts have no pieces.
        """
        if max(len(self.words), self.word.size // 2) > self.most:
            self.forget()
        met = Numbering()
        ids, counts, places = [np.zeros(0, np.int64)], [], [np.zeros(0, np.uint64)]
        for key, value in zip(keys, values, strict=True):
            found = _segments(value) if value else []
            ids.append(met.of(found))
            counts.append(len(found))
            place = np.arange(len(found))
            base = np.full(1, 0 if key is None else key)
            places.append(_hash_arrays(self.dropout.seed, base, place, place))
        ids, places = np.concatenate(ids).astype(np.int64), np.concatenate(places)
        words = list(met)
        own = self._numbers(words, np.bincount(ids, minlength=len(words)))
        classes = own[ids]
        known = np.flatnonzero(classes >= 0)
        classes[known] = self.roots.all[classes[known]]
        if self.dropout.limit:
            classes = self._walk(self.words, places, classes)
        alone, known = np.flatnonzero(classes < 0), np.flatnonzero(classes >= 0)
        flat, own = encode_words(self.vocabulary, [f" {words[k]}" for k in ids[alone].tolist()], places[alone], self.dropout)
        starts, sizes = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        starts[known], sizes[known] = self.starts.all[classes[known]], self.sizes.all[classes[known]]
        starts[alone], sizes[alone] = self.flat.size + np.cumsum(own) - own, own
        text = np.repeat(np.arange(len(values)), np.array(counts, dtype=np.int64))
        pieces = _gathered(np.concatenate((self.flat.all, flat.astype(np.int32))), starts, sizes)
        return pieces, np.bincount(text, sizes, len(values)).astype(np.int64)


def encode_texts(vocabulary: Vocabulary, keys: list[int | None], values: list[str | None], dropout: Dropout) -> tuple[np.ndarray, np.ndarray]:
    return Encoder(vocabulary, dropout).encode(keys, values)


def decode_pieces(vocabulary: Vocabulary, pieces: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of pieces that stand one after another, ``counts`` for each."""
    raw = _gathered(vocabulary.bytes, vocabulary.offsets[pieces], vocabulary.sizes[pieces]).tobytes()
    ends = np.concatenate(([0], np.cumsum(vocabulary.sizes[pieces])))
    bounds = ends[np.concatenate(([0], np.cumsum(counts)))].tolist()
    out = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return [text[1:] if text.startswith(" ") else text for text in out]


def _per_part(rows: DataFrame, schema: str, vocabulary: Vocabulary, dropout: Dropout, columns) -> DataFrame:
    """The result of ``columns``, which takes a part and an encoder; the encoder lives as long as its task."""
    arrow = batches(schema)
    share = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(share.value, dropout)
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                made = columns(part, encoder)
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(made, list(arrow)[1:], strict=True))], schema=arrow)

    return rows.mapInArrow(run, schema)


def _as_lists(pieces: np.ndarray, counts: np.ndarray, values: list[str | None]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(pieces, pa.int32()))
    missing = pa.array([value is None for value in values], pa.bool_())
    return pc.if_else(missing, pa.scalar(None, lists.type), lists)


def encode(docs: DataFrame, vocabulary: Vocabulary, dropout: Dropout = Dropout()) -> DataFrame:
    """doc_id and pieces (array<int>) of every row of (doc_id, text).

    Empty texts have no pieces, null texts a null; texts of any length are
    encoded whole. Rows that share a doc_id and a text get the same pieces.
    """
    def column(part, encoder):
        values = part["text"].to_pylist()
        return (_as_lists(*encoder.encode(part["doc_id"].to_pylist(), values), values),)

    return _per_part(texts(docs), "doc_id long, pieces array<int>", vocabulary, dropout, column)


def encoded(docs: DataFrame, vocabulary: Vocabulary, dropout: Dropout = Dropout()) -> DataFrame:
    """The documents with ``pieces`` (array<int>) in place of ``text``, other columns as they are.

    A column named pieces, if there is one, gives way.
    """
    share = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rest = [f for f in docs.schema.fields if f.name not in ("text", "pieces")]
    schema = T.StructType([*rest, T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    arrow = batches(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(share.value, dropout)
        for batch in stream:
            for part in slices(batch, "text", SLICE):
                values = part["text"].to_pylist()
                made = _as_lists(*encoder.encode(part["doc_id"].to_pylist(), values), values)
                yield pa.RecordBatch.from_arrays([*(part[f.name] for f in rest), made.cast(arrow.field("pieces").type)], schema=arrow)

    return docs.select(*(f.name for f in rest), "text").mapInArrow(run, schema)


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of every row of (doc_id, pieces).

    Null pieces give a null text, no pieces an empty one. Rows that share a doc_id, or
    have none, each give a row; other columns are ignored, and an empty table gives
    an empty result.
    """
    share = rows.sparkSession.sparkContext.broadcast(vocabulary)
    schema = batches("doc_id long, text string")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts = pc.fill_null(pc.list_value_length(part["pieces"]), 0).to_numpy()
                flat = part["pieces"].flatten().to_numpy()
                found = decode_pieces(share.value, flat, counts)
                missing = part["pieces"].is_null().to_pylist()
                column = pa.array([None if m else t for m, t in zip(missing, found, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([part["doc_id"], column], schema=schema)

    return rows.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, vocabulary: Vocabulary, dropout: Dropout = Dropout()) -> DataFrame:
    """Digests of every document's pieces and of what they decode to.

    doc_id, n_chars, n_pieces, pieces_sha256 (of little-endian 32-bit ids),
    decoded_sha256 (of the UTF-8 bytes) and lossless. A null text counts as empty.
    Rows that share a doc_id, or have none, each give a row; other columns are
    ignored, and an empty table gives an empty result.
    """
    def columns(part, encoder):
        values = [value or "" for value in part["text"].to_pylist()]
        pieces, counts = encoder.encode(part["doc_id"].to_pylist(), values)
        decoded = decode_pieces(encoder.vocabulary, pieces, counts)
        ends = np.concatenate(([0], np.cumsum(counts))).tolist()
        return (
            list(map(len, values)),
            counts,
            [hashlib.sha256(pieces[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)],
            [hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() for text in decoded],
            [a == b for a, b in zip(values, decoded, strict=True)],
        )

    schema = (
        "doc_id long, n_chars long, n_pieces long, pieces_sha256 string, "
        "decoded_sha256 string, lossless boolean"
    )
    return _per_part(texts(docs), schema, vocabulary, dropout, columns)
