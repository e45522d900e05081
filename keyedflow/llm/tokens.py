"""Encoding of whole texts with a public tokenizer, through a bounded cache of encoded words."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a worker keeps unless an operator has room for more, and the longest that is kept.
CACHE_WORDS, CACHE_LENGTH = 200_000, 48

#: A space between two white-space characters, or between one and the end.
LOOSE_SPACE = re.compile(r"\s (?:\s|$)")
#: A space after a visible ASCII character.
TIGHT_SPACE = re.compile(r"(?<=[!-~])(?= )")
# Letters of ASCII and Latin-1, digits, ASCII signs (but the apostrophe, which starts contractions) and single
# line ends: the pre-tokenizer makes each such run one word, with a space before it, where plain text goes on.
_RUNS = ("A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9", r"!-&(-/:-@\[-`{-~")
_RUN = "|".join(f"[{run}]++" for run in _RUNS)
PLAIN = re.compile(f" ?(?:{_RUN})|\n")
_ALL = "".join(_RUNS)
#: Such runs, and between them all else up to the next space; together they are the whole text.
PIECES = re.compile(f" ?(?:{_RUN})(?![^ \n{_ALL}])|\n(?![^ {_ALL}])| ?[^ ]++| ")

# Kinds of bytes. Each line end and each space is a run of its own; END stands for the end of a text.
LETTER, DIGIT, SIGN, OTHER, LINE, SPACE, END = range(7)
#: The kind of each byte; letters of Latin-1 are two bytes, 0xC3 and one of those after it but two signs.
KINDS = np.full(256, OTHER, np.uint8)
for _kind, _run in ((LETTER, "[A-Za-z]"), (DIGIT, "[0-9]"), (SIGN, f"[{_RUNS[2]}]"), (LINE, "\n"), (SPACE, " ")):
    KINDS[[b for b in range(128) if re.fullmatch(_run, chr(b))]] = _kind
LATIN, LATIN_SIGNS = 0xC3, (0x97, 0xB7)
#: Stands between words that are encoded together; no plain one holds it.
BETWEEN = "\0"


class Recent(dict):
    """What ``make`` gives for a word. Keeps the words used most recently, in two generations."""

    def __init__(self, make: Callable[[str], bytes], size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def many(self, words: list[str], prepare: Callable[[list[str]], None]) -> list[bytes]:
        """What there is for distinct words; ``prepare`` gets the new ones before ``make`` is asked for each."""
        found = [*map(self.get, words)]
        absent = [word for word, ids in zip(words, found, strict=True) if ids is None]
        older = [*map(self.old.get, absent)]
        new = [word for word, ids in zip(absent, older, strict=True) if ids is None]
        prepare(new)
        made = map(self.make, new)
        older = [next(made) if ids is None else ids for ids in older]
        rest = iter(older)
        found = [next(rest) if ids is None else ids for ids in found]
        if any(len(word) > CACHE_LENGTH for word in absent):
            short = [len(word) <= CACHE_LENGTH for word in absent]
            absent, older = [*compress(absent, short)], [*compress(older, short)]
        half, at = max(self.size // 2, 1), 0
        while at < len(absent):
            if len(self) >= half:
                self.old = self.copy()
                self.clear()
            end = at + half - len(self)
            self.update(zip(absent[at:end], older[at:end], strict=True))
            at = end
        return found


class Encoder:
    """Token ids of texts, equal to encoding each text as one string.

    The byte-level pre-tokenizer takes at most one space into a word and starts a new word before it, unless
    the space stands between white space (or white space and the end). So a text can be cut before all other
    spaces, and around runs of plain characters, and the pieces encoded alone, each distinct one only once. Texts
    with spaces of that kind are cut after visible ASCII characters first, and what still has one is a piece.
    Strings of special tokens count as ordinary text.
    """

    def __init__(self, path: str, words: int | None = None):
        words = words or CACHE_WORDS
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The same model behind a cut at spaces alone, for words that are spelled already.
        self.speller = Tokenizer(self.tokenizer.model)
        self.speller.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # How the byte-level vocabulary spells bytes: itself tells, character by character.
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {b: spell(chr(b))[0][0] for b in range(128)}
        wide = [spell(chr(64 * a + b))[0][0] for a in (2, 3) for b in range(64)]
        self.spelling |= {0xC2: wide[0][0], 0xC3: wide[64][0]} | {0x80 + b: wide[b][1] for b in range(64)}
        self.spelling[ord(BETWEEN)] = " "
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[[*vocabulary.values()]] = [*map(len, vocabulary)]
        self.words = Recent(self._word, words)
        #: Ids of pieces that are about to be looked up for the first time.
        self.ready: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _all(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces; those that are words of the pre-tokenizer go to the model together, without it."""
        ids = {piece: self._whole(piece) for piece in pieces if not plain(piece)}
        words = [piece for piece in pieces if piece not in ids] if ids else pieces
        if words:
            spelled = BETWEEN.join(words).encode().decode("latin-1").translate(self.spelling)
            found = np.array(self.speller.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
            # A token spells as many bytes as it has characters, so sums of these tell where a word's ids end.
            reached, wanted = np.cumsum(self.sizes[found]), np.cumsum([*map(len, spelled.split(" "))])
            ends = np.searchsorted(reached, wanted, side="right") * 4
            if not len(found) or reached[-1] != wanted[-1] or not np.array_equal(reached[ends // 4 - 1], wanted):
                return {piece: self._whole(piece) for piece in pieces}  # a vocabulary that doesn't spell every byte
            data, ends = found.tobytes(), ends.tolist()
            ids.update(zip(words, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        return ids

    def _prepare(self, pieces: list[str]) -> None:
        self.ready = self._all(pieces)

    def _word(self, piece: str) -> bytes:
        return self.ready.pop(piece)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """For every text its ids as little-endian unsigned 32-bit integers."""
        ids, ends = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[start:end].tobytes() for start, end in zip(ends[:-1], ends[1:], strict=True)]

    def encode_column(self, texts: pa.Array, close: bytes = b"") -> tuple[memoryview, np.ndarray]:
        """Ids of all texts, ``close`` after each, as one run of bytes, and where the texts' ids begin and end in it.

        Null texts are empty. Pieces are cut and put together by columns, and each distinct one is looked up once.
        """
        data, offsets = bytes_of(texts)
        cuts = cuts_of(data, offsets)
        ends = np.append(cuts, len(data))
        pieces = pa.Array.from_buffers(pa.large_string(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [*self.words.many(distinct, self._prepare), close]
        order = pieces.indices.to_numpy()
        at = np.searchsorted(cuts, offsets)
        if close:
            order = np.insert(order, at[1:], len(found) - 1)
            at += np.arange(len(at))
        ids = pa.array(found, pa.large_binary()).take(pa.array(order))
        _, ends, values = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        return memoryview(values or b""), ends[at]


def plain(piece: str) -> bool:
    """Whether a piece is one word of the pre-tokenizer; letters of ASCII alone are, and need no pattern."""
    return (piece.isascii() and piece.removeprefix(" ").isalpha()) or PLAIN.fullmatch(piece) is not None


def pieces_of(text: str) -> list[str]:
    """A text cut where the pre-tokenizer cuts it whatever stands on either side."""
    if not LOOSE_SPACE.search(text):
        return PIECES.findall(text)
    pieces: list[str] = []
    for part in TIGHT_SPACE.split(text):
        pieces += [part] if LOOSE_SPACE.search(part) else PIECES.findall(part)
    return pieces


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each begins and ends."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def cuts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of ``pieces_of`` begin, found for all texts at once.

    Pieces are runs of one kind. In a stretch up to the next space, what comes from the first run on that can't be
    encoded alone is one piece; a space belongs to the run after it.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    kinds = KINDS[data]
    wide = np.flatnonzero(data[:-1] == LATIN)
    wide = wide[~np.isin(data[wide + 1], LATIN_SIGNS)]
    kinds[wide] = kinds[wide + 1] = LETTER
    first = np.zeros(len(data), bool)
    first[offsets[offsets < len(data)]] = True
    edges = kinds >= LINE
    edges[1:] |= kinds[1:] != kinds[:-1]
    edges |= first
    runs = np.flatnonzero(edges)
    kind, begins = kinds[runs], first[runs]
    before, after = np.full_like(kind, END), np.full_like(kind, END)
    before[1:] = np.where(begins[1:], END, kind[:-1])
    after[:-1] = np.where(begins[1:], END, kind[1:])
    bound = (kind == OTHER) | ((after == OTHER) & (kind != SPACE))
    bound |= (kind == LINE) & ((after == LINE) | (before == SPACE))
    stretch = begins | (kind == SPACE)
    earlier = np.cumsum(bound) - bound
    free = earlier == earlier[stretch][np.cumsum(stretch) - 1]
    cuts = first  # no longer needed
    cuts[runs] = stretch | (free & (before != SPACE))
    # Spaces that may be loose: the pattern tells, and such texts are cut by it.
    doubtful = (kind == SPACE) & (before >= OTHER) & (before != END) & (after >= OTHER)
    for text in np.unique(np.searchsorted(offsets, runs[doubtful], side="right") - 1):
        start, stop = offsets[text], offsets[text + 1]
        found = data[start:stop].tobytes().decode()
        if LOOSE_SPACE.search(found):
            sizes = [len(piece.encode()) for piece in pieces_of(found)]
            cuts[start:stop] = False
            cuts[start + np.cumsum([0, *sizes[:-1]])] = True
    return np.flatnonzero(cuts)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, words: int | None = None) -> Encoder:
    """The encoder of this worker process, with a cache of so many words, which outlives a task."""
    if (path, words) not in _ENCODERS:
        _ENCODERS[path, words] = Encoder(path, words)
    return _ENCODERS[path, words]


#: Bytes of text that are encoded together, which bounds memory where rows are long.
TEXTS_AT_ONCE = 2 << 20


def groups_of(texts: pa.Array) -> list[tuple[int, int]]:
    """Cut a batch into index ranges of about ``TEXTS_AT_ONCE`` bytes."""
    cuts, size, start = [], 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= TEXTS_AT_ONCE:
            cuts.append((start, i + 1))
            start, size = i + 1, 0
    if start < len(texts):
        cuts.append((start, len(texts)))
    return cuts
