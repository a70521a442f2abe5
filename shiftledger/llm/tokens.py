"""Token ids of whole texts by a public tokenizer file, inside Arrow tasks.

Both byte-pair vocabularies used here encode a stretch between spaces on its own, so a batch of texts is
cut into pieces, each distinct piece is encoded once by the tokenizers library, and the ids are put together again by
index arithmetic. Texts in which the cuts aren't certain are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from importlib.util import find_spec

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept per Python worker; beyond it those met only once are dropped, which changes nothing but speed.
CACHE_ENTRIES = 400_000
#: Distinct pieces encoded as one text.
PIECES = 1000
#: A space with white space on both sides, or at the end after white space, is no place to cut.
_WS = r"\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNSAFE_SPACE = rf"(^|[{_WS}]) ([{_WS}]|$)"


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Path of a public tokenizer file: in ``folder``, or beside the installed ``public_tokenizers`` module."""
    return os.path.join(folder or os.path.dirname(find_spec("public_tokenizers").origin), name)


def byte_lengths(vocabulary: dict[str, int], suffix: str) -> np.ndarray:
    """Bytes of text that each id stands for: byte-level vocabularies write one character a byte."""
    lengths = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
    for token, number in vocabulary.items():
        lengths[number] = len(token) - len(suffix) if suffix and token.endswith(suffix) else len(token)
    return lengths


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    """Whether each byte value lies in one of the ranges, ends included."""
    return np.array([any(first <= b <= last for first, last in ranges) for b in range(256)])


_SPACE = _bytes((9, 13), (32, 32))
_ALNUM = _bytes((48, 57), (65, 90), (97, 122))
_PRINT = _bytes((33, 126))
_SIGN = _PRINT & ~_ALNUM
_LOWER = np.array([b | 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


class Encoder:
    """Encodes Arrow string arrays as the library does; keeps the ids of pieces it has met.

    Texts are cut where both vocabularies' rules always cut, whatever stands around: before a sign after a letter or digit (ASCII),
    before a space between words, around a single line end. What the vocabulary ignores (case, white space) is taken away
    before. Texts with a token that the library looks for before all cutting, or with white space that can't be cut, are encoded whole.
    """

    def __init__(self, path: str, most: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        #: Vocabularies with word ends drop white space and case; the others keep a space with the next word.
        self.keeps_space = not model.get("end_of_word_suffix")
        self.lengths = byte_lengths(model["vocab"], model.get("end_of_word_suffix") or "")
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([*added, *([UNSAFE_SPACE] if self.keeps_space else [])])
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.counts = np.zeros(1 << 16, dtype=np.int64)
        #: Whether a piece was met in a later portion of text than the one it was learned in.
        self.again = np.zeros(1 << 16, dtype=bool)

    def _shrink(self) -> None:
        """Keep the pieces that were met again since the last time; start anew if that are too many."""
        again = self.again[: len(self.known)]
        names = [name for name, row in self.known.items() if again[row]]
        rows = np.flatnonzero(again)
        if len(rows) > self.most * 3 // 4:
            self.forget()
            return
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        index = np.repeat(self.starts[rows] - (ends - counts), counts) + np.arange(int(counts.sum()))
        ids = self.ids[index]
        self.forget()
        self._keep(names, ids, counts)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces joined into longer texts, and take the ids apart where the bytes of each end."""
        if self.keeps_space:
            # Between pieces without other white space a line end is a token of its own.
            single = [p for p in pieces if p.lstrip(" ").split() != [p[p.startswith(" ") :]]]
            if single:
                alone = set(single)
                pieces = [p for p in pieces if p not in alone]
                self._learn_singly(single)
        parts = [pieces[i : i + PIECES] for i in range(0, len(pieces), PIECES)]
        while parts:
            joined = [("\n" if self.keeps_space else " ").join(part) for part in parts]
            halves = []
            for part, text, ids in zip(parts, joined, self._plain(joined), strict=True):
                whole = text if self.keeps_space else self.tokenizer.normalizer.normalize_str(text)
                names = whole.split("\n" if self.keeps_space else " ")
                if len(part) > 1 and not (len(names) == len(part) and self._apart(part, names, ids)):
                    halves += [part[: len(part) // 2], part[len(part) // 2 :]]
                elif len(part) == 1:
                    self._keep(part, np.asarray(ids, dtype=np.uint32), np.array([len(ids)]))
            parts = halves

    def _learn_singly(self, pieces: list[str]) -> None:
        each = self._plain(pieces)
        self._keep(pieces, np.asarray([i for x in each for i in x], dtype=np.uint32), np.array([len(x) for x in each]))

    def _apart(self, part: list[str], names: list[str], ids: list[int]) -> bool:
        """Keep the ids of each piece if tokens end where pieces end."""
        array = np.asarray(ids, dtype=np.uint32)
        ends = np.concatenate(([0], np.cumsum(self.lengths[array])))
        sizes = np.array([len(name.encode("utf-8", "surrogatepass")) for name in names], dtype=np.int64)
        glue = 1 if self.keeps_space else 0
        last = np.cumsum(sizes + glue) - glue
        first = last - sizes
        a, b = np.searchsorted(ends, first, side="right") - 1, np.searchsorted(ends, last, side="right") - 1
        if ends[-1] != last[-1] or not (np.array_equal(ends[a], first) and np.array_equal(ends[b], last)):
            return False
        if not np.array_equal(a[1:] - b[:-1], np.full(len(part) - 1, glue)):
            return False
        if glue:
            array = np.delete(array, b[:-1])
        self._keep(part, array, b - a)
        return True

    def _keep(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        row = len(self.known)
        while row + len(pieces) > len(self.starts):
            self.starts, self.counts, self.again = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts, self.again)
            )
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[row : row + len(pieces)] = self.used + np.cumsum(counts) - counts
        self.counts[row : row + len(pieces)] = counts
        self.used += len(ids)
        self.known.update(zip(pieces, range(row, row + len(pieces)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        unsafe = pc.match_substring_regex(texts, self.whole) if self.whole else pa.array([False] * len(texts))
        if not pc.any(unsafe).as_py():
            return self._gather(texts)
        mask = unsafe.to_numpy(zero_copy_only=False)
        ids, counts = self._gather(texts.filter(pc.invert(unsafe)))
        whole = self._plain(texts.filter(unsafe).to_pylist())
        all_counts = np.zeros(len(texts), dtype=np.int64)
        all_counts[~mask], all_counts[mask] = counts, [len(x) for x in whole]
        owner = np.repeat(mask, all_counts)
        result = np.zeros(int(all_counts.sum()), dtype=np.uint32)
        result[~owner] = ids
        result[owner] = np.asarray([i for x in whole for i in x], dtype=np.uint32)
        return result, all_counts

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(pieces of all texts, text that each belongs to)."""
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        # Before the first byte stands what no rule looks at.
        before = np.concatenate((np.zeros(1, np.uint8), data[:-1]))
        begin = _SIGN[data] & _ALNUM[before]
        if self.keeps_space:
            second = np.concatenate((np.zeros(1, np.uint8), before[:-1]))
            begin |= data == 32
            begin |= (data == 10) & _PRINT[before]
            begin |= (before == 10) & _PRINT[second] & _PRINT[data]
            begin[offsets[:-1][np.diff(offsets) > 0]] = True
            starts = np.flatnonzero(begin)
            edges = starts
        else:
            filled = ~_SPACE[data]
            begin |= filled & _SPACE[before]
            begin[offsets[:-1][np.diff(offsets) > 0]] = True
            starts = np.flatnonzero(begin & filled)
            edges = np.cumsum(filled)[starts] - 1
            data = _LOWER[data[filled]]
        owner = np.searchsorted(offsets, starts, side="right") - 1
        ends = pa.py_buffer(np.append(edges, len(data)).astype(np.int64))
        return pa.LargeStringArray.from_buffers(len(edges), ends, pa.py_buffer(np.ascontiguousarray(data))), owner

    def _gather(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Look each piece up and put the ids together."""
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        pieces, owner = self._cut(texts)
        if not len(pieces):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        coded = pc.dictionary_encode(pieces)
        codes = coded.indices.to_numpy()
        names = coded.dictionary.to_pylist()
        if len(self.known) > self.most:
            self._shrink()
        known = self.known
        before = len(known)
        if missing := [name for name in names if name not in known]:
            self._learn(missing)
        rows = np.fromiter(map(known.__getitem__, names), dtype=np.int64, count=len(names))
        self.again[rows[rows < before]] = True
        rows = rows[codes]
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        total = int(ends[-1])
        index = np.repeat(self.starts[rows] - (ends - counts), counts)
        index += np.arange(total)
        per_text = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        return self.ids[index], per_text


@lru_cache(maxsize=1)
def encoder(path: str, most: int = CACHE_ENTRIES) -> Encoder:
    """The last one used is kept for the next task of a Python worker; ``most`` trades its memory for speed."""
    return Encoder(path, most)


def release_encoder() -> None:
    """Give back a kept encoder's memory: for tasks that go on to other work in the same Python workers."""
    encoder.cache_clear()
    pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> list[pa.RecordBatch]:
    """Parts of a batch of about ``most_bytes`` of text each, so that long texts do not add up."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    group = np.cumsum(sizes) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(edges, edges[1:], strict=False) if b > a]
