"""Token ids of single words, for tokenizers that drop white space and split words alike.

A tokenizer of this kind gives a text the ids of its words, one after the other, so the
ids of a word can be kept and used again. Whether a file is of this kind is read from
the file; for others the whole text goes to the tokenizers library.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

#: Characters whose lower case, normal form and class no Unicode version has changed, and
#: which of them are letters and numbers.
_PLAIN = re.compile(r"[!-~¡-ÿ]+")
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
_STOPS = b".,"
#: Entries of a generation of a worker's cache, and the length above which a word is not kept.
ROOM, LONG = 200_000, 64

@functools.cache
def _byte_marks() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}

def _split_pattern(spec: dict) -> str | None:
    """The pattern of the pre-tokens if words can be encoded one by one, else None."""
    normal = [(n["type"], n.get("pattern", {}).get("Regex"), n.get("content")) for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    alike = (
        normal == [("NFC", None, None), ("Replace", "\\s+", " "), ("Lowercase", None, None)]
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        and set(re.findall(r"\\[a-zA-Z](?:\{\w+\})?", steps[0]["pattern"].get("Regex", ""))) == {r"\s", r"\p{L}", r"\p{N}"}
        and not re.search(r"(?<!\[)(?<!\\s)(?<!\})\\p", steps[0]["pattern"]["Regex"])  # classes stand in brackets
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
    )
    return steps[0]["pattern"]["Regex"] if alike else None

class _Kept(dict):
    """A dictionary that makes what it lacks. It holds at most two generations of ``room``
    entries: when the young one is full it becomes the old one, whose entries are taken
    over as they are asked for and otherwise forgotten."""

    def __init__(self, make, first=(), room=ROOM):
        super().__init__(first)
        self.make, self.first, self.room, self.old = make, first, room, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONG:
                return value
        if len(self) >= self.room + len(self.first):
            self.old = dict(self)
            self.clear()
            self.update(self.first)
        self[key] = value
        return value

class WordTokenizer:
    """Ids of a word (bytes without ASCII white space), exactly as the library gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.kind = "H" if self.whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.width = array(self.kind).itemsize
        spec = json.loads(self.whole.to_str())
        pattern = _split_pattern({k: spec.get(k) for k in ("normalizer", "pre_tokenizer", "added_tokens")})
        self.by_word = pattern is not None
        if self.by_word:
            # plain words need the classes of plain characters only
            self.pieces = re.compile(pattern.replace(r"\p{L}", _LETTERS).replace(r"\p{N}", _NUMBERS))
            self.special = [t["content"] for t in spec["added_tokens"]]
            self.special_start = os.path.commonprefix(self.special)
            self.marks = _byte_marks()
            self.piece_ids = _Kept(self._piece)
            # letters, then full stops and commas: one piece each, if the pattern says so
            self.plain = self.pieces.findall("word.,") == ["word", ".,"] and not any(
                t.encode().rstrip(_STOPS).isalpha() for t in self.special
            )

    def _piece(self, piece: str) -> bytes:
        marked = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.marks)
        return array(self.kind, [t.id for t in self.whole.model.tokenize(marked)]).tobytes()

    def text_ids(self, text: str) -> bytes:
        """Ids of a text, packed in ``width`` bytes each."""
        return array(self.kind, self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def word_ids(self, word: bytes) -> bytes:
        """Ids of a word, packed likewise."""
        if self.plain:
            letters = word.rstrip(_STOPS)
            if letters.isalpha():  # ASCII letters only
                ids = self.piece_ids[letters.lower().decode()]
                return ids if len(letters) == len(word) else ids + self.piece_ids[word[len(letters):].decode()]
        text = word.decode("utf-8", "replace")
        if not _PLAIN.fullmatch(text) or (self.special_start in text and any(s in text for s in self.special)):
            return self.text_ids(text)  # special strings, rare scripts, odd white space
        found = self.pieces.findall(text.lower())
        if len(found) == 1:
            return self.piece_ids[found[0]]
        return b"".join([self.piece_ids[piece] for piece in found])

@functools.cache
def load(path: str) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    return WordTokenizer(path)
