"""Encoding whole texts with a tokenizer of the tokenizers library, one unit between spaces at a time.

The pre-tokenizers of the two kinds used here split wherever white space follows another character, and between a letter
and what is neither letter nor white space. So a text is cut there into units, and units met before are taken from a
bounded memory.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

# Unicode's White_Space, which both regular-expression libraries mean by \s; Python's \s holds more.
_SPACE = r"\t-\r " + "".join(
    f"\\u{c:04x}"
    for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
_OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c != " " and re.match(f"[{_SPACE}]", c)]
# Characters that are letters for certain, also in lower case (not U+0130), and ASCII that is neither letter nor space.
_LETTER = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_OTHER = r"!-@\[-`{-~"
_MARKS = "".join(c for c in map(chr, range(0x80)) if re.match(f"[{_OTHER}]", c))
# A run up to a space, or up to a letter that something else follows; the rest of the run is a unit of its own.
_RUN = f"[{_OTHER}]*[^{_SPACE}{_OTHER}]*(?:(?<![{_LETTER}])[{_OTHER}]+[^{_SPACE}{_OTHER}]*)*"
#: White space joins the word after it (byte-level tokenizers).
SPACE_KEPT = re.compile(f"[{_SPACE}]*{_RUN}")
#: White space is dropped.
SPACE_DROPPED = re.compile(f"(?=[^{_SPACE}]){_RUN}")

# Units and pieces between white space that one generation of a worker's memory takes, and the longest one that is kept.
# An entry takes some 200 bytes, and there are two generations.
MEMORY_UNITS = 60_000
MEMORY_PIECES = 180_000
MEMORY_UNIT_CHARS = 64
# Slots, by hash, that tell whether a text may have been met before; a byte each.
MET_SLOTS = 1 << 20


class Memory:
    """Ids by text, of texts met twice and lately.

    Most texts are met once, so one is kept when it is met again. A full generation becomes the old one, and what
    that had before is forgotten; what is met again moves from the old generation to the young one.
    """

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.met = bytearray(MET_SLOTS)

    def age(self, entries: int) -> None:
        if len(self.young) > entries:
            self.old, self.young = self.young, {}
            self.met = bytearray(MET_SLOTS)

    def missing(self, wanted: set[str], entries: int) -> list[str]:
        """What is not known; all else is in the young generation then, which is full at ``entries``."""
        self.age(entries)
        old = self.old
        new = wanted.difference(self.young)
        back = {text: old[text] for text in new if text in old}
        self.young.update(back)
        return list(new.difference(back))

    def get(self, text: str) -> bytes | None:
        ids = self.young.get(text)
        if ids is None and (ids := self.old.get(text)) is not None:
            self.young[text] = ids
        return ids

    def again(self, text: str) -> bool:
        """Whether a text may have been met before; it has from now on."""
        at = hash(text) % MET_SLOTS
        if self.met[at]:
            return True
        self.met[at] = 1
        return False

    def settle(self, new: list[str]) -> None:
        """Forget those of the texts just added that are long or were met for the first time."""
        young, again = self.young, self.again
        for text in new:
            if len(text) > MEMORY_UNIT_CHARS or not again(text):
                del young[text]


class UnitEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer_json: str, units: re.Pattern):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # A text that spells a special token is text, not a command.
        self.tokenizer.encode_special_tokens = True
        self.find = units.findall
        self.memory = Memory()

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return {u: array("I", e.ids).tobytes() for u, e in zip(units, found)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """A null text is empty."""
        out: list[bytes] = []
        for at in range(0, len(texts), 64):
            split = [self.find(t) if t else [] for t in texts[at : at + 64]]
            new = self.memory.missing(set().union(*split), MEMORY_UNITS)
            known = self.memory.young
            known.update(self._learn(new))
            out += [b"".join(map(known.__getitem__, units)) for units in split]
            self.memory.settle(new)
        return out


class Pieces(dict):
    """Ids by piece, of pieces met twice and lately: the young generation, so that a known piece costs one look.

    What it lacks comes from the old generation or is learned at once by ``learn``; where that gives None, the piece is put off
    to be learned with others, and stands in ``late`` for each time it was asked for.
    """

    def __init__(self, learn: Callable[[str], bytes | None]):
        super().__init__()
        self.learn = learn
        self.late: list[str] = []
        self.forget()

    @property
    def young(self) -> dict[str, bytes]:
        return self

    def forget(self) -> None:
        """The generation becomes the old one, and what that had is gone."""
        self.old: dict[str, bytes] = dict(self)
        self.met = bytearray(MET_SLOTS)
        self.clear()

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.old.get(piece)
        if ids is not None:
            self.keep(piece, ids)
        elif (ids := self.learn(piece)) is None:
            self.late.append(piece)
        else:
            self.offer(piece, ids)
        return ids

    def offer(self, piece: str, ids: bytes) -> None:
        """Keep a piece that is not long and may have been met before; it has from now on."""
        at = hash(piece) % MET_SLOTS
        if not self.met[at]:
            self.met[at] = 1
        elif len(piece) <= MEMORY_UNIT_CHARS:
            self.keep(piece, ids)

    def keep(self, piece: str, ids: bytes) -> None:
        if len(self) >= MEMORY_PIECES:
            self.forget()
        self[piece] = ids


class PieceEncoder:
    """As ``UnitEncoder``, with what stands between white space (pieces) remembered; a piece is cut into units only when it is new.

    A word of certain letters goes to the tokenizer's model itself, spelled in its byte characters with ``lead`` before it, if a
    probe of all those letters shows that the tokenizer does the same. Marks that end a piece after such a word are a unit of
    their own.
    """

    def __init__(self, tokenizer_json: str, units: re.Pattern, lead: str, lower: bool):
        self.units = UnitEncoder(tokenizer_json, units)
        self.model = self.units.tokenizer.model
        letter = byte_characters()
        sure = re.compile(f"[{_LETTER}]")
        self.lower, self.lead, self.spelled_lead = lower, lead, "".join(letter[b] for b in lead.encode())
        self.spell = {
            c: "".join(letter[b] for b in (chr(c).lower() if lower else chr(c)).encode())
            for c in range(0x250)
            if sure.match(chr(c))
        }
        self.is_word = re.compile(f"[{_LETTER}]+").fullmatch
        self.words = Memory()
        self.marks = Pieces(lambda marks: self.units.encode([marks])[0])
        self.memory = Pieces(self._learn)
        probe = [f"{chr(c)}a{chr(c)}{chr(c)}B" for c in self.spell]
        self.direct = [self._word(self._spelled(p)) for p in probe] == self.units.encode([lead + p for p in probe])

    def _spelled(self, word: str) -> str:
        if word.isascii():
            return self.spelled_lead + (word.lower() if self.lower else word)
        return self.spelled_lead + word.translate(self.spell)

    def _word(self, spelled: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _known_word(self, word: str) -> bytes | None:
        """None for what is no word of certain letters, or a long one."""
        sure = word.isalpha() if word.isascii() else self.is_word(word)
        if not (sure and self.direct and len(word) <= MEMORY_UNIT_CHARS):
            return None
        spelled = self._spelled(word)
        ids = self.words.get(spelled)
        if ids is None:
            self.words.age(MEMORY_UNITS)
            ids = self.words.young[spelled] = self._word(spelled)
        return ids

    def _learn(self, piece: str) -> bytes | None:
        ids = self._known_word(piece)
        if ids is None and (word := piece.rstrip(_MARKS)) != piece and (ids := self._known_word(word)) is not None:
            ids += self.marks[piece[len(word) :]]
        return ids

    def _odd(self, pieces: list[str]) -> dict[str, bytes]:
        """Pieces of several units, of which the words after ``lead`` are known or learned like other words."""
        lead, split = self.lead, [self.units.find(self.lead + p) for p in pieces]
        known = {
            unit: self._known_word(unit.removeprefix(lead)) if unit.startswith(lead) else None
            for unit in set().union(*split)
        }
        rest = [unit for unit, ids in known.items() if ids is None]
        known.update(zip(rest, self.units.encode(rest)))
        return {p: b"".join(map(known.__getitem__, units)) for p, units in zip(pieces, split)}

    def _joined(self, split: list[list[str]]) -> list[bytes]:
        """The ids of some texts, given as their pieces."""
        memory, found, odd = self.memory, [], []
        for at, pieces in enumerate(split):
            before = len(memory.late)
            found.append(list(map(memory.__getitem__, pieces)))
            if len(memory.late) > before:
                odd.append(at)
        if odd:
            late = self._odd(list(set(memory.late)))
            memory.late.clear()
            for at in odd:
                found[at] = [late[p] if ids is None else ids for p, ids in zip(split[at], found[at])]
            for piece, ids in late.items():
                memory.offer(piece, ids)
        return [b"".join(ids) for ids in found]


class WordEncoder(PieceEncoder):
    """For tokenizers that drop white space and lower the case: texts split at white space."""

    def __init__(self, tokenizer_json: str):
        super().__init__(tokenizer_json, SPACE_DROPPED, lead="", lower=True)

    @staticmethod
    def _pieces(text: str | None) -> list[str]:
        # str.split also cuts at 0x1C-0x1F, which are no white space to the tokenizer
        if not text:
            return []
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return re.findall(f"[^{_SPACE}]+", text)
        return text.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """A null text is empty."""
        out: list[bytes] = []
        for at in range(0, len(texts), 64):
            out += self._joined([self._pieces(t) for t in texts[at : at + 64]])
        return out


class SpacedEncoder(PieceEncoder):
    """For tokenizers that keep white space: texts split at single spaces, and what follows each is a piece.

    A text in which a space stands next to other white space is cut into units as a whole.
    """

    def __init__(self, tokenizer_json: str):
        super().__init__(tokenizer_json, SPACE_KEPT, lead=" ", lower=False)

    @staticmethod
    def close(text: str) -> bool:
        """Whether a space stands next to white space; looked up as strings, which takes a quarter of a pattern's time."""
        return "  " in text or any(c in text and (f" {c}" in text or f"{c} " in text) for c in _OTHER_SPACES)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """A null text is empty."""
        out: list[bytes] = []
        for at in range(0, len(texts), 64):
            some = texts[at : at + 64]
            split = [t.split(" ") if t and not self.close(t) else [t or ""] for t in some]
            first = self.units.encode([pieces[0] for pieces in split])
            out += [ids + more for ids, more in zip(first, self._joined([pieces[1:] for pieces in split]))]
        return out


@lru_cache(maxsize=2)
def spaced_encoder(tokenizer_json: str) -> SpacedEncoder:
    """One per Python worker and tokenizer."""
    return SpacedEncoder(tokenizer_json)


@lru_cache(maxsize=2)
def word_encoder(tokenizer_json: str) -> WordEncoder:
    """One per Python worker and tokenizer."""
    return WordEncoder(tokenizer_json)


@lru_cache(maxsize=2)
def encoder(tokenizer_json: str, units: re.Pattern) -> UnitEncoder:
    """One per Python worker and tokenizer."""
    return UnitEncoder(tokenizer_json, units)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    for b in printable:
        out[b] = chr(b)
    for n, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + n)
    return out


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of base64 tokens and ranks."""
    import base64

    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def _halves(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts from which merging by lower ranks makes this token; none if it makes more parts."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best, at = rank, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], rank)
            if r < best:
                best, at = r, i
        if at < 0:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def tokenizer_of_ranks(tokens: list[bytes], pattern: str) -> str:
    """The JSON of a tokenizer that merges as a rank file says, each match of the pattern by itself.

    A pair of tokens that merges to a token when its bytes stand alone is the only pair of tokens that can ever meet
    for it, so one merge per token is enough; a match that is a token as a whole is that token.
    """
    letter = byte_characters()
    spell = ["".join(letter[b] for b in token) for token in tokens]
    ranks = {token: rank for rank, token in enumerate(tokens)}
    merges = []
    for rank, token in enumerate(tokens):
        if len(token) > 1 and (pair := _halves(token, rank, ranks)):
            merges.append([spell[ranks[pair[0]]], spell[ranks[pair[1]]]])
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, byte_level]},
            "post_processor": None,
            "decoder": None,
            "model": {
                "type": "BPE",
                "dropout": None,
                "unk_token": None,
                "continuing_subword_prefix": None,
                "end_of_word_suffix": None,
                "fuse_unk": False,
                "byte_fallback": False,
                "ignore_merges": True,
                "vocab": {s: i for i, s in enumerate(spell)},
                "merges": merges,
            },
        }
    )


def read_json(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
