"""Token ids of whole texts, with a cache of the ids of words.

The byte-level tokenizer never merges across the start of a word, so the ids of a
text are those of its words one after another. The texts of a call are split and their
words numbered by Arrow, so a word is looked up once a call, and the texts' ids are one
``take`` by those numbers. Words repeat from call to call as well, so each is encoded once
per worker while it is remembered. Words are encoded by the ``tokenizers`` library, many in
one call. Words of letters only are one piece each for the tokenizer, so they go to its
model without being searched for pieces.
"""
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

TOKENIZER_FILE = "byte_bpe_50k.json"
END_ID = 0

#: Words in each half of the cache.
_CACHED_WORDS = 400_000
_CACHED_WORD_CHARS = 48
_JOINED_CHARS = 1 << 16
#: Characters of the texts that are split at a time; a longer text is split alone.
_SPLIT_CHARS = 1 << 23
# Signs that never join the letters before them.
_SIGNS = ".,!?;:%&#$*"
# White space as Python and Unicode know it, without the blank and the line break.
_OTHER_SPACES = [
    c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"
]

# Letters up to here are letters for every version of Unicode that a library may know.
_LAST_LETTER = "\u024f"


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for signs from 256 on, in order. The
    line break's stands alone, as a piece.
    """
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    signs = {b: chr(256 + k) for k, b in enumerate(others)}
    signs[10] = f"\n{signs[10]}\n"
    return signs


_BYTE_SIGNS = _byte_signs()
# The bytes that another sign stands for, as characters; the line break's sign holds one.
_REPLACED = frozenset(chr(byte) for byte in _BYTE_SIGNS)

_encoders: dict[str, "WordEncoder"] = {}


def encoder_for(path: str) -> "WordEncoder":
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    """``encode`` gives, per text, the little-endian unsigned 32-bit ids as bytes.

    Keys of the cache: ``"word"`` stands for a word after one space, ``"\\nword"`` for
    one after a single line break, without the signs after its last letter. When the newer
    half is full it becomes the older one, whose words are taken over as they are met again.
    """

    def __init__(self, path: str) -> None:
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings are ordinary text here
        self._model = Tokenizer(self._tokenizer.model)
        self._model.pre_tokenizer = WhitespaceSplit()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are parallel
        self._line_break = self._plain("\n")
        if len(self._line_break) != 4:
            raise ValueError("the tokenizer must have one id for a line break")
        self._line_break_id = np.frombuffer(self._line_break, "<u4")[0]
        self._has_blank = np.zeros(self.size, bool)
        for piece, token_id in self._tokenizer.get_vocab().items():
            self._has_blank[token_id] = _BYTE_SIGNS[32] in piece
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._signs_known: dict[str, bytes] = {}

    @property
    def size(self) -> int:
        """Every token id is smaller."""
        return max(self._tokenizer.get_vocab().values()) + 1

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for some in _bounded(texts):
            lines = [_line(text) for text in some]
            by_words = iter(self._by_words([line for line in lines if line is not None]))
            out += [
                self._plain(text) if line is None else next(by_words)
                for text, line in zip(some, lines, strict=True)
            ]
        return out

    def _by_words(self, lines: list[str]) -> list[bytes]:
        if not lines:
            return []
        kind = pa.string() if len(lines[0]) <= _SPLIT_CHARS else pa.large_string()
        split = pc.split_pattern(pa.array(lines, kind), " ")
        numbered = split.values.dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = pa.array(self._ids_of(words), pa.large_binary())
        _, bounds, ids = known.take(numbered.indices).buffers()
        ends = np.frombuffer(bounds, "<i8")[split.offsets.to_numpy()].tolist()
        skipped = len(self._line_break)
        return [
            ids[start + skipped : end].to_pybytes() for start, end in zip(ends[:-1], ends[1:], strict=True)
        ]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of different words."""
        if len(self._known) > _CACHED_WORDS:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        stems = words.copy()
        signed = [k for k, word in enumerate(words) if word[-1] in _SIGNS]
        for k in signed:
            stems[k] = _stem(words[k])
        out = list(map(known.get, stems))
        unknown = [k for k, ids in enumerate(out) if ids is None]
        new = {stems[k]: b"" for k in unknown}
        learn = []
        for stem in new:
            ids = older.get(stem)
            if ids is None:
                learn.append(stem)
            else:
                new[stem] = ids
        self._learn(learn, new)
        for k in unknown:
            out[k] = new[stems[k]]
        signs_known = self._signs_known
        for k in signed:
            signs = words[k][len(stems[k]) :]
            if signs:
                out[k] += signs_known.get(signs) or self._signs(signs)
        for stem in [stem for stem in learn if len(stem) > _CACHED_WORD_CHARS]:
            del new[stem]
        known.update(new)
        return out

    def _plain(self, text: str) -> bytes:
        (encoded,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded.ids, "<u4").tobytes()

    def _learn(self, words: list[str], into: dict[str, bytes]) -> None:
        """Put the ids of different words into a dictionary."""
        letters: list[str] = []
        first_letters: list[str] = []
        others: dict[bool, list[str]] = {False: [], True: []}
        for word in words:
            if _only_letters(word):
                letters.append(word)
            elif word[0] == "\n" and _only_letters(word[1:]):
                first_letters.append(word)
            else:
                others[word[0] == "\n"].append(word)
        if letters:
            self._learn_letters(letters, into)
        if first_letters:
            self._learn_first_letters(first_letters, into)
        for first, prefix, before in ((True, "", self._line_break), (False, " ", b"")):
            chunk: list[str] = []
            size = 0
            for word in others[first]:
                chunk.append(word)
                size += len(word)
                if size > _JOINED_CHARS:
                    self._learn_chunk(chunk, prefix, before, into)
                    chunk, size = [], 0
            if chunk:
                self._learn_chunk(chunk, prefix, before, into)

    def _model_ids(self, text: str, line_break: str) -> np.ndarray:
        """Ids by the model alone, with ``line_break`` in place of each line break."""
        signs = text.encode("utf-8").decode("latin-1")
        for byte in _REPLACED.intersection(signs):
            signs = signs.replace(byte, line_break if byte == "\n" else _BYTE_SIGNS[ord(byte)])
        (encoded,) = self._model.encode_batch_fast([signs], add_special_tokens=False)
        return np.array(encoded.ids, "<u4")

    def _learn_letters(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encode words of letters, each with its blank as one piece.

        Only a word's first id has the blank, so it tells where a word begins.
        """
        ids = self._model_ids("\n" + "\n".join(words), "\n" + _BYTE_SIGNS[32])
        starts = (np.flatnonzero(self._has_blank[ids]) * 4).tolist()
        raw = ids.tobytes()
        for word, start, end in zip(words, starts, [*starts[1:], len(raw)], strict=True):
            into[word] = raw[start:end]

    def _learn_first_letters(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encode words of letters that follow a line break."""
        lines = self._lines(self._model_ids("".join(words)[1:], _BYTE_SIGNS[10]))
        into.update(zip(words, [self._line_break + ids for ids in lines], strict=True))

    def _learn_chunk(
        self, words: list[str], prefix: str, before: bytes, into: dict[str, bytes]
    ) -> None:
        """Encode words as lines of one text."""
        text = "\n".join([prefix + word.removeprefix("\n") for word in words])
        (encoded,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        for word, ids in zip(words, self._lines(np.array(encoded.ids, "<u4")), strict=True):
            into[word] = before + ids

    def _lines(self, ids: np.ndarray) -> list[bytes]:
        """The ids of each line, which those of the line breaks separate."""
        raw = ids.tobytes()
        ends = (np.flatnonzero(ids == self._line_break_id) * 4).tolist()
        starts = [0, *[end + 4 for end in ends]]
        return [raw[start:end] for start, end in zip(starts, [*ends, len(raw)], strict=True)]

    def _signs(self, signs: str) -> bytes:
        ids = self._signs_known.get(signs)
        if ids is None:
            ids = self._plain(signs)
            if len(signs) <= 4:
                self._signs_known[signs] = ids
        return ids


def _only_letters(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) <= _LAST_LETTER)


def _stem(word: str) -> str:
    stem = word.rstrip(_SIGNS)
    return stem if stem and stem[-1].isalpha() else word


def _bounded(texts: list[str]) -> Iterator[list[str]]:
    some: list[str] = []
    size = 0
    for text in texts:
        if some and size + len(text) > _SPLIT_CHARS:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


def _line(text: str) -> str | None:
    """The text after a line break, whose id the caller cuts off, cut into words by its blanks.

    None for white space other than single blanks and line breaks between words.
    """
    if any(space in text for space in _OTHER_SPACES):
        return None
    line = "\n" + text.replace("\n", " \n")
    if "  " in line or "\n " in line or line[-1] in " \n":
        return None  # runs of white space are encoded in their context
    return line
