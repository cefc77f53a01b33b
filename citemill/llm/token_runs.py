"""Token ids of many texts at once, without a Python object per word.

A tokenizer file whose pre-tokeniser drops white space, parts letters from
punctuation and lower-cases gives a text the ids of its parts one after the
other, parts being what stands between spaces and line feeds. A part of letters
with punctuation behind it is two units, its word in lower case and its marks;
any other part is one unit as it is. The units of a batch are put into a
dictionary (Arrow, in native code), only units that are new are encoded, and the
ids of all units are gathered with array arithmetic.

Units that were seen are remembered up to ``REMEMBERED_BYTES``; when they are
more, they are forgotten and those of the current batch stay. Whether the file
splits texts in this way is tried out with a probe text when it is loaded; where
it doesn't, whole texts are encoded.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED_BYTES = 8 << 20
# Longer units, in bytes, are not remembered.
LONG_UNIT = 64
WORDS_AT_ONCE = 500
END_OF_WORD = "</w>"
# Punctuation that joins no word (no apostrophe).
PUNCTUATION = b'.,;:!?#*$%&|()"/+=<>@~^_[]{}-'
# How byte-level vocabularies spell bytes that are no printable Latin-1 character;
# of these, the ones that a lower-case Latin letter ends with.
UNPRINTABLE = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
SPELLING = [(chr(b), chr(256 + i)) for i, b in enumerate(UNPRINTABLE) if b in (0x9F, 0xA0, 0xAD)]

SPACE, LETTER, MARK, OTHER = range(4)
CLASSES = np.full(256, OTHER, dtype=np.uint8)
CLASSES[[0x20, 0x0A]] = SPACE
CLASSES[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
CLASSES[list(PUNCTUATION)] = MARK

# Words and marks in all the ways they may meet, other scripts, spaces and numbers.
PROBE = (
    'Plain words, UPPER Case; (brackets) "quoted" a-b c_d e/f x. y? ...! | || é ÉCOLE ß ÿ naïve, don\'t I\'LL we\'re 3.14 7up'
    " a1b2 <b> &amp; Σίσυφος ΣΑΣ 日本語 е́ é\tTab\r\nLine\x0b\x0c end　wide supercalifragilistic zzzzqx qxzzz ÀÖØÞ ×÷ a× .b. -- -x- x- (y)z"
)


class Units:
    """The units of some texts, one after the other in ``data``."""

    def __init__(self, texts: list[bytes]):
        # A space behind each text, so the last byte is one.
        data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
        kind = CLASSES[data]
        lead = np.flatnonzero(data == 0xC3)
        second = data[lead + 1]
        lead = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        solid = kind != SPACE
        edges = np.flatnonzero(np.diff(solid, prepend=False))
        starts, sizes = edges[0::2], edges[1::2] - edges[0::2]
        odd = kind == OTHER
        odd[1:] |= (kind[:-1] == MARK) & (kind[1:] == LETTER)
        simple = ~np.logical_or.reduceat(odd, starts) if len(starts) else np.empty(0, dtype=bool)
        # Spaces go; the parts then lie side by side.
        self.data, kind = data[solid], kind[solid]
        word = np.repeat(simple, sizes) & (kind == LETTER)
        begins = np.zeros(len(kind), dtype=bool)
        begins[np.cumsum(sizes) - sizes] = True
        begins[1:] |= word[:-1] & (kind[1:] == MARK)
        self.starts = np.flatnonzero(begins)
        self.is_word = word[self.starts]
        upper = word & (((self.data >= 0x41) & (self.data <= 0x5A)) | ((self.data >= 0x80) & (self.data <= 0x9E)))
        self.data[upper] += 0x20
        # Where each text begins, and the last ends, among the units.
        text_starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        place = np.concatenate(([0], np.cumsum(solid)))[text_starts]
        self.bounds = np.searchsorted(self.starts, place)

    def encoded(self) -> pa.DictionaryArray:
        offsets = np.append(self.starts, len(self.data)).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.data)]
        return pa.BinaryArray.from_buffers(pa.binary(), len(self.starts), buffers).dictionary_encode()


def bounds_of(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


class RunEncoder:
    """Texts (UTF-8 bytes) to the ids of all of them and where each text's ids begin and end."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words need no more than the merges: they are in lower case and spelled in bytes already.
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        parts |= {"normalizer": None, "post_processor": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.merges = Tokenizer.from_str(json.dumps(parts))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END_OF_WORD)]] = True
        self.forget()
        probe = PROBE.encode()
        self.splits = self._by_units([probe, probe[:200]])[0].tolist() == self._whole([probe, probe[:200]])[0].tolist()
        self.forget()

    def forget(self) -> None:
        self.known, self.known_ids = pa.array([], type=pa.binary()), np.empty(0, dtype=np.uint32)
        self.known_bounds = np.zeros(1, dtype=np.int64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self._by_units(texts) if self.splits else self._whole(texts)

    def _plain(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, and how many each has."""
        texts = [u.decode("utf-8", "replace") for u in units]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.array([i for ids in found for i in ids], dtype=np.uint32), sizes

    def _words(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words, many in one text: the last token of a word carries the end-of-word mark."""
        cuts = np.append(np.arange(0, len(words), WORDS_AT_ONCE), len(words)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), b" ").to_pylist()
        ids, sizes = [], []
        for i, text in enumerate(joined):
            spelled = text.decode("latin-1")
            for byte, letter in SPELLING:
                spelled = spelled.replace(byte, letter)
            own = np.array(self.merges.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, dtype=np.uint32)
            n = np.diff(np.flatnonzero(self.ends[own]), prepend=-1)
            if len(n) != cuts[i + 1] - cuts[i] or n.sum() != len(own):
                own, n = self._plain(text.split(b" "))
            ids.append(own)
            sizes.append(n)
        return np.concatenate(ids), np.concatenate(sizes)

    def _whole(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = self._plain(texts)
        return ids, bounds_of(sizes)

    def _new(self, units: pa.BinaryArray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number, in the order of ``units``."""
        sizes, out = np.zeros(len(units), dtype=np.int64), []
        for chosen, encode in ((is_word, self._words), (~is_word, lambda u: self._plain(u.to_pylist()))):
            if chosen.any():
                ids, sizes[chosen] = encode(units.filter(pa.array(chosen)))
                out.append((chosen, ids))
        ids = np.empty(int(sizes.sum()), dtype=np.uint32)
        for chosen, own in out:
            ids[np.repeat(chosen, sizes)] = own
        return ids, sizes

    def _by_units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        units = Units(texts)
        if not len(units.starts):
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        encoded = units.encoded()
        vocabulary = encoded.dictionary
        found = pc.index_in(vocabulary, value_set=self.known)
        fresh = found.is_null().to_numpy(zero_copy_only=False)
        new = vocabulary.filter(pa.array(fresh))
        is_word = np.zeros(len(vocabulary), dtype=bool)
        is_word[encoded.indices.to_numpy()] = units.is_word
        ids, sizes = self._new(new, is_word[fresh])
        place = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[fresh] = len(self.known) + np.arange(len(new))
        bounds = np.concatenate((self.known_bounds, self.known_bounds[-1] + np.cumsum(sizes)))
        every = np.concatenate((self.known_ids, ids))
        unit = place[encoded.indices.to_numpy()]
        n = (bounds[1:] - bounds[:-1])[unit]
        out = every[places(bounds[unit], n)]
        self._remember(new, ids, sizes)
        return out, bounds_of(n)[units.bounds]

    def _remember(self, new: pa.BinaryArray, ids: np.ndarray, sizes: np.ndarray) -> None:
        lengths = pc.binary_length(new).to_numpy(zero_copy_only=False)
        short = lengths <= LONG_UNIT
        if not short.all():
            ids, new = ids[np.repeat(short, sizes)], new.filter(pa.array(short))
            sizes, lengths = sizes[short], lengths[short]
        size = int(lengths.sum()) + 4 * len(ids) + 12 * len(sizes)
        if self.known.nbytes + self.known_ids.nbytes + self.known_bounds.nbytes + size > REMEMBERED_BYTES:
            self.forget()
        if size <= REMEMBERED_BYTES:
            self.known = pa.concat_arrays([self.known, new])
            self.known_ids = np.concatenate((self.known_ids, ids))
            self.known_bounds = np.concatenate((self.known_bounds, self.known_bounds[-1] + np.cumsum(sizes)))


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All indexes of several runs, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


_encoders: dict[str, RunEncoder] = {}


def run_encoder(path: str) -> RunEncoder:
    """One per Python worker, for the file used last."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = RunEncoder(path)
    return _encoders[path]
