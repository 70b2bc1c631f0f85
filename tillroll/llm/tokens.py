"""Token ids of whole texts, with a cache of the stretches that tokenizers treat on their own.

A tokenizer splits a text before it merges anything, and no merge crosses a
split. Texts are therefore cut at places where the tokenizer is known to
split, and the ids of each stretch are kept: a word is merged once per worker
instead of once per occurrence. Texts with a special string, and tokenizers
with other splitting rules, go through the library whole.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array
from collections.abc import Callable

from tokenizers import Tokenizer

# White space as the byte-level pattern's \s has it, and letters that keep one form under NFC.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTER = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
# A word of plain letters, another stretch without white space, or white space; of a run of white space the last
# character goes with the word behind it.
BYTE_LEVEL = re.compile(
    f" ?[{LETTER}]+(?![^,.{SPACE}])| ?[^{SPACE}]+|[{SPACE}]+(?=[{SPACE}][^{SPACE}])|[{SPACE}]+"
)
# White space is no token here, so words are independent of it.
WORD_LEVEL = re.compile(rf"[{LETTER}]+(?![^,.\t-\r ])|[^\t-\r ]+")
SPACES = re.compile(f"[{SPACE}]{{2}}")
RUNS = ("  ", "\n\n", " \n", "\n ")  # what SPACES finds in Latin-1 texts without RARE_SPACE
RARE_SPACE = "\t\v\f\r\x85\xa0"
PLAIN_WORD = re.compile(f" ?[{LETTER}]+")
ENTRIES = 200_000
_WORD = "I" if array("I").itemsize == 4 else "L"


class _Cache(dict):
    """Entries that fall out of use are dropped: what a full generation did not ask for again."""

    def __init__(self, make: Callable[[str], bytes], entries: int) -> None:
        super().__init__()
        self.make, self.entries = make, entries
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def turn(self) -> None:
        """Called between texts."""
        if len(self) > self.entries:
            self.older = dict(self)
            self.clear()


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    packed = array(_WORD, ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _one_form_below(text: str) -> bool:
    """Whether all characters are below U+0100, where lower-casing goes character by character."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _has_runs(text: str) -> bool:
    """Whether white space follows on white space."""
    if _one_form_below(text) and not any(c in text for c in RARE_SPACE):
        return any(run in text for run in RUNS)
    return SPACES.search(text) is not None


def _stretches(path: str) -> re.Pattern[str] | None:
    """The cut that is safe for this tokenizer; None where no cut is known to be."""
    with open(path, encoding="utf-8") as file:
        layout = json.load(file)
    first, rest = layout["pre_tokenizer"] or {}, layout["normalizer"]
    if layout["truncation"] or layout["padding"] or layout["model"].get("dropout"):
        return None
    if first.get("type") == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"] and not rest:
        return BYTE_LEVEL
    steps = first.get("pretokenizers") or [{}]
    words = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
    names = {step["type"] for step in (rest or {}).get("normalizers", [])}
    if words and r"[^\s" in steps[0]["pattern"].get("Regex", "") and names <= {"NFC", "Replace", "Lowercase"}:
        return WORD_LEVEL
    return None


class CachedTokenizer:
    """Gives the ids that the library gives for a whole text, without begin or end tokens."""

    def __init__(self, path: str, entries: int = ENTRIES) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.cut = _stretches(path)
        self.front = " " if self.cut is BYTE_LEVEL else ""  # a space belongs to the word behind it
        letters = _byte_letters()
        # What a character's bytes look like to the model, for spaces and the characters of plain words.
        self.shown = {code: "".join(letters[b] for b in chr(code).encode()) for code in range(0x20, 0x100)}
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Cache(self._word, entries)  # with the space in front of them
        self.stretches = _Cache(self._merged, entries)

    def ids(self, text: str | None) -> bytes:
        """Ids of ``text`` (null: empty) as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or any(special in text for special in self.special):
            return id_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self.words.turn()
        self.stretches.turn()
        if not self.front:
            return self._free(text)
        if _has_runs(text):  # a run of white space is split by what is around it
            return self._cut(text)
        first, *rest = text.replace("\n", " \n").split(" ")  # a line's first word is one of its own, with the line break
        return self._cut(first) + b"".join(map(self.words.__getitem__, rest))

    def _free(self, text: str) -> bytes:
        """Ids of a text whose words are independent of the white space around them."""
        if _one_form_below(text):  # all case is lost in the end
            lower = text.lower()
            text = text if any(special in lower for special in self.special) else lower
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.stretches.__getitem__, self.cut.findall(text)))

    def _word(self, word: str) -> bytes:
        """Ids of a word, or of what else stands between two spaces."""
        if word.isascii() and word.isalpha():
            shown = self.shown[0x20] + word if self.front else word.lower()
            return id_bytes([token.id for token in self.model.tokenize(shown)])
        if self.front and word[:1] == "\n":  # no space is in front of what follows
            return self.stretches["\n"] + self._cut(word[1:])
        if PLAIN_WORD.fullmatch(word):
            return self._plain(self.front + word)
        if word[-1:] in (",", ".") and PLAIN_WORD.fullmatch(word[:-1]):
            return self.words[word[:-1]] + self.stretches[word[-1]]
        found = self.cut.findall(self.front + word)
        if len(found) == 1:
            return self._merged(found[0])
        first = found[0][len(self.front) :] if found else ""
        if not first:
            return b"".join(map(self.stretches.__getitem__, found))
        return self.words[first] + b"".join(map(self.stretches.__getitem__, found[1:]))

    def _merged(self, stretch: str) -> bytes:
        if PLAIN_WORD.fullmatch(stretch):
            return self._plain(stretch)
        return id_bytes(self.tokenizer.encode(stretch, add_special_tokens=False).ids)

    def _plain(self, word: str) -> bytes:
        """A plain word is one piece, so it needs the model's merges only."""
        shown = (word if self.front else word.lower()).translate(self.shown)
        return id_bytes([token.id for token in self.model.tokenize(shown)])


@functools.cache
def cached_tokenizer(path: str, entries: int = ENTRIES) -> CachedTokenizer:
    """One per worker process, file and size of the caches."""
    return CachedTokenizer(path, entries)


class TaskTokenizer:
    """A tokenizer for a broadcast, which carries where it is read from.

    A worker makes it once for all tasks that share the broadcast, and drops it,
    with the words it keeps, at the first task that does not.
    """

    def __init__(self, path: str, entries: int = ENTRIES) -> None:
        self.path, self.entries = path, entries

    @functools.cached_property
    def tokenizer(self) -> CachedTokenizer:
        return CachedTokenizer(self.path, self.entries)
