"""Token ids of whole texts through the ``tokenizers`` library, with a cache of text chunks.

Both tokenizers cut a text before they merge bytes, and always

- before a space with a character other than white space behind it,
- between a letter or an ASCII mark other than the apostrophe and a line break,
- between a letter and the only line break before it, if a letter or such a mark is
  before that,
- between a letter and such a mark.

So what stands between such places has the same ids wherever it stands.  A batch of texts
is cut there as one array of bytes, and all its chunks are looked up at once; unknown ones
are cut at their marks too, and what is still unknown is encoded together and kept.  The
cache is emptied at ``CACHE_SIZE`` entries, which changes time, never ids.  Texts with
characters outside the Latin blocks are encoded directly.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from silverlode.llm.words import mix

#: Chunks in the cache, under three quarters of its places.
CACHE_SIZE = 1_500_000
_PLACES = 1 << 21
#: Longer chunks are encoded in every batch anew.
LONGEST_CACHED = 24
PIECE_BYTES = 2_000_000
_MOST_IDS = 8_000_000

_SPACES = np.zeros(256, bool)
# Next to bytes of C2, which can be white space beyond ASCII, nothing is cut.
_SPACES[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0xC2]] = True
_LETTERS = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True
# Control characters 1C to 1F are white space to some libraries only; C9 and above lead characters beyond U+023F.
_ODD = np.zeros(256, bool)
_ODD[[*range(0x1C, 0x20), *range(0xC9, 0x100)]] = True

# The bytes behind a chunk's first 0 to 8 in a word, all of them FF.
_FILL = np.array([(0xFFFFFFFFFFFFFFFF << 8 * n) & 0xFFFFFFFFFFFFFFFF for n in range(9)], np.uint64)

_ENCODERS: dict[str, Encoder] = {}


def _odd_places(data: np.ndarray) -> np.ndarray:
    """Places of characters other than U+0000 to U+024F, U+2010 to U+2027 and the euro sign, and of 1C to 1F."""
    at = np.flatnonzero(_ODD[data])
    if not len(at):
        return at
    lead = data[at]
    one, two = (data[np.minimum(at + i, len(data) - 1)] for i in (1, 2))
    known = (lead == 0xC9) & (one < 0x90)
    known |= (lead == 0xE2) & (((one == 0x80) & (two >= 0x90) & (two <= 0xA7)) | ((one == 0x82) & (two == 0xAC)))
    return at[~known]


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where letters begin and where they end; of those beyond ASCII only U+00C0 to U+00FF."""
    begins = _LETTERS[data]
    ends = begins.copy()
    accented = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    begins[:-1] |= accented
    ends[1:] |= accented
    return begins, ends


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where chunks begin, as one truth value per byte."""
    cut = np.zeros(len(data), bool)
    if len(data) < 2:
        return cut
    line = data == 0x0A
    begins, ends = _letters(data)
    ends |= _MARKS[data]
    cut[:-1] = (data[:-1] == 0x20) & ~_SPACES[data[1:]]
    cut[1:] |= ends[:-1] & line[1:]
    cut[2:] |= ends[:-2] & line[1:-1] & begins[2:]
    return cut


def _mark_cuts(data: np.ndarray) -> np.ndarray:
    """Where marks begin that follow a letter, as one truth value per byte."""
    cut = np.zeros(len(data), bool)
    if len(data) > 1:
        cut[1:] = _letters(data)[1][:-1] & _MARKS[data[1:]]
    return cut


def _byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level tokens; line breaks keep theirs."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(others)}, 0x0A: "\n"}


_CHARACTERS = _byte_characters()


class _Cache:
    """Slots of chunks by their bytes, looked up in arrays for all chunks of a batch at once."""

    def __init__(self) -> None:
        self.keys = np.zeros((_PLACES, LONGEST_CACHED // 8), np.uint64)
        self.slots = np.full(_PLACES, -1, np.int32)
        self.held = 0

    @staticmethod
    def keys_of(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The bytes of each chunk of at most ``LONGEST_CACHED`` bytes, filled up with FF, which no text holds."""
        padded = np.frombuffer(data + bytes(LONGEST_CACHED), np.uint8)
        words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        keys = np.empty((len(starts), LONGEST_CACHED // 8), np.uint64)
        for i in range(keys.shape[1]):
            filled = np.clip(sizes - 8 * i, 0, 8)
            keys[:, i] = words[np.minimum(starts + 8 * i, len(words) - 1)] | _FILL[filled]
        return keys

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        total = keys[:, 0].copy()
        for i in range(1, keys.shape[1]):
            total = total * np.uint64(0x9E3779B97F4A7C15) + keys[:, i]
        return (mix(total) & np.uint64(_PLACES - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if it has none."""
        found = np.full(len(keys), -1, np.int64)
        left, place = np.arange(len(keys)), self._place(keys)
        while len(left):
            slot = self.slots[place]
            same = (self.keys[place] == keys[left]).all(1) & (slot >= 0)
            found[left[same]] = slot[same]
            on = ~same & (slot >= 0)
            left, place = left[on], (place[on] + 1) & (_PLACES - 1)
        return found

    def add(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Distinct keys without a slot get one, as long as there is room."""
        keys = keys[: max(0, CACHE_SIZE - self.held)]
        self.held += len(keys)
        left, place = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.slots[place] < 0
            self.slots[place[free]] = slots[left[free]]
            mine = self.slots[place] == slots[left]
            self.keys[place[mine]] = keys[left[mine]]
            left, place = left[~mine], (place[~mine] + 1) & (_PLACES - 1)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_space = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        # The same merges for words whose bytes are already written as characters.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes[number] = len(token.removesuffix("</w>"))
        self._empty()

    def _empty(self) -> None:
        self.cache = _Cache()
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)  # those of slot i are ids[ends[i] : ends[i + 1]]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of all words, each of them letters with a space before them at most, and how many each has."""
        text = "\n".join(words).encode()
        ids = np.array(self.words.encode_batch_fast([text.decode("latin-1").translate(_CHARACTERS)], add_special_tokens=False)[0].ids, np.uint32)
        breaks = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A), len(text))
        wanted = breaks - np.arange(len(breaks))
        ends = np.cumsum(self.bytes[ids])
        last = np.searchsorted(ends, wanted)
        # Tokens that do not spell the words can't be told apart.
        if len(ends) != last[-1] + 1 or (ends[last] != wanted).any():
            return None
        return ids, np.diff(last, prepend=-1)

    def _add(self, chunks: list[str]) -> np.ndarray:
        """New slots for ``chunks``."""
        forms = chunks if self.keeps_space else [c.strip().lower() for c in chunks]
        plain = np.array([c.removeprefix(" ").isalpha() for c in forms], bool)
        found = self._encode_words([c for c, p in zip(forms, plain) if p]) if plain.any() else None
        if found is None:
            plain[:] = False
            found = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        others = self._encode([c for c, p in zip(forms, plain) if not p])
        first = len(self.ends) - 1
        sizes = np.concatenate([found[1], np.array([len(i) for i in others], np.int64)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, found[0], *others])
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        slots = np.empty(len(chunks), np.int64)
        slots[order] = np.arange(first, first + len(chunks))
        return slots

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slots in a row, and where those of each begin and end."""
        sizes = np.diff(self.ends)[slots]
        ends = np.append(0, np.cumsum(sizes))
        return self.ids[np.arange(ends[-1]) + np.repeat(self.ends[slots] - ends[:-1], sizes)], ends

    def _put_together(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of unknown chunks by what stands between their marks, and which of them have several parts."""
        data = b"".join(names)
        begin = np.cumsum([0] + [len(n) for n in names])
        cut = _mark_cuts(np.frombuffer(data, np.uint8))
        cut[begin[:-1]] = True
        starts = np.flatnonzero(cut)
        parts = self._slots(data, starts, np.append(starts[1:], len(data)), whole=True)
        first = np.searchsorted(starts, begin)
        several = np.diff(first) > 1
        slots = parts[first[:-1]]
        if several.any():
            ids, ends = self._gather(parts)
            bounds = ends[first]
            sizes = np.diff(bounds)
            slots[several] = np.arange(several.sum()) + len(self.ends) - 1
            self.ids = np.concatenate([self.ids, ids[np.repeat(several, sizes)]])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes[several])])
        return slots, several

    def _slots(self, data: bytes, starts: np.ndarray, ends: np.ndarray, whole: bool = False) -> np.ndarray:
        """The slot of each chunk; ``whole`` ones are not cut at marks."""
        sizes = ends - starts
        short = sizes <= LONGEST_CACHED
        keys = self.cache.keys_of(data, starts[short], sizes[short])
        slots = np.full(len(starts), -1, np.int64)
        slots[short] = self.cache.find(keys)
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            texts = pa.array([data[a:b] for a, b in zip(starts[unknown].tolist(), ends[unknown].tolist())], pa.binary())
            named = texts.dictionary_encode()
            names = named.dictionary.to_pylist()
            which = named.indices.to_numpy()
            if whole:
                new, kept = self._add([c.decode() for c in names]), np.ones(len(names), bool)
            else:
                new, kept = self._put_together(names)
            slots[unknown] = new[which]
            one = np.empty(len(names), np.int64)
            one[which] = unknown
            one = one[kept & short[one]]
            self.cache.add(keys[(np.cumsum(short) - 1)[one]], slots[one])
        return slots

    def _chunks(self, text: str) -> list[str]:
        """The chunks of a text that are looked up first."""
        data = text.encode()
        cut = _cuts(np.frombuffer(data, np.uint8))
        cut[:1] = True
        starts = np.flatnonzero(cut).tolist()
        return [data[a:b].decode() for a, b in zip(starts, [*starts[1:], len(data)])]

    def _piece(self, texts: list[str]) -> Iterator[bytes]:
        coded = [t.encode() for t in texts]
        raw = b"".join(coded)
        data = np.frombuffer(raw, np.uint8)
        offsets = np.append(0, np.cumsum([len(c) for c in coded])).astype(np.int64)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(offsets, _odd_places(data), "right") - 1] = True
        cut = _cuts(data)
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, offsets)
        if odd.any():
            # Texts that are encoded directly give no chunks.
            kept = ~np.repeat(odd, np.diff(first))
            starts, ends = starts[kept], ends[kept]
            first = np.append(0, np.cumsum(np.where(odd, 0, np.diff(first))))
        if self.cache.held >= CACHE_SIZE or len(self.ids) > _MOST_IDS:
            self._empty()
        ids, after = self._gather(self._slots(raw, starts, ends))
        direct = iter(self._encode([t for t, o in zip(texts, odd) if o]))
        bounds = after[first].tolist()
        for o, a, b in zip(odd.tolist(), bounds, bounds[1:]):
            yield next(direct).tobytes() if o else ids[a:b].tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids per text (null: empty) as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= PIECE_BYTES:
                out += self._piece(held)
                held, size = [], 0
        return out + list(self._piece(held))


def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
