"""Byte pair encoding from a published tokenizer file: vocabulary, text splitting and pair tests.

The file's own settings decide how text is split. Two kinds are read:

- word vocabularies: NFC, lower case, white space dropped, tokens at word ends marked;
- byte-level vocabularies: nothing is changed, white space belongs to the token after it.

Special tokens written out in a text become their own id, as the library does it by default.
"""

from __future__ import annotations

import json
import unicodedata
from array import array

import ahocorasick
import regex

from pageloom.llm.shared import Memo

#: Fixed values of the byte-level alphabet: bytes that stand for themselves.
PLAIN_BYTES = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Fixed pattern that splits text before byte-level merges.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Control characters that Python splits at, while the Unicode property White_Space leaves them out.
_ODD = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
#: White space and what follows up to the next white space; tokens never reach across two of these.
_SEGMENT = regex.compile(r"\s*\S+|\s+")
_NEVER = 1 << 60
#: In place of a token: the start of a pre-token, and no token.
START, NONE = 0xFFFFFF, -1


def byte_alphabet() -> dict[int, str]:
    """The printable character for each byte: the byte itself, or one from 256 on in order."""
    plain = set(PLAIN_BYTES)
    table, free = {}, 256
    for byte in range(256):
        if byte in plain:
            table[byte] = chr(byte)
        else:
            table[byte] = chr(free)
            free += 1
    return table


class BpeModel:
    """Vocabulary and merges of a tokenizer file, and whether two tokens may stand side by side."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("unknown tokens, prefixes and dropout are not supported")
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = self.ids[a], self.ids[b]
            token = self.ids[a + b]
            if token in self.parts:
                raise ValueError("a token has two merges")
            if any(x in self.parts and self.parts[x][2] >= rank for x in pair):
                raise ValueError("a merge comes before its parts")
            self.rank[pair], self.merged[pair], self.parts[token] = rank, token, (*pair, rank)
        self.word_style = spec["normalizer"] is not None
        self._check_settings(spec)
        self.letters = byte_alphabet()
        self._letter_table = str.maketrans({chr(b): c for b, c in self.letters.items()})
        self._bytes = {c: b for b, c in self.letters.items()}
        pattern = next((x["pattern"]["Regex"] for x in spec["pre_tokenizer"].get("pretokenizers", []) if x["type"] == "Split"), BYTE_PATTERN)
        self.pattern = regex.compile(pattern)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._alone: dict[int, bool] = {}
        self.fits = Memo(self._fits, 150_000)

    def _check_settings(self, spec: dict) -> None:
        before = spec["pre_tokenizer"]
        if self.word_style:
            normal = [x["type"] for x in spec["normalizer"]["normalizers"]]
            split, level = before["pretokenizers"]
            known = normal == ["NFC", "Replace", "Lowercase"] and split["behavior"] == "Removed" and split["invert"] and not level["use_regex"]
        else:
            known = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if not known or any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("this kind of tokenizer file is not supported")

    # Text to pre-tokens

    def spell(self, piece: str) -> str:
        """A pre-token in the alphabet of the vocabulary."""
        if piece.isascii() and self.word_style:
            return piece if piece.isprintable() else piece.translate(self._letter_table)
        return piece.encode().decode("latin-1").translate(self._letter_table)

    def pretokens(self, chunk: str) -> list[str]:
        """Pre-tokens of a stretch of text between two chunk boundaries."""
        if self.word_style:
            if not chunk.isascii():
                chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # no final sigma
            chunk = chunk.lower()
        return self.pattern.findall(chunk)

    def chunks(self, text: str) -> list[str]:
        """Stretches of text that are split and merged without regard to each other."""
        if self.word_style:
            return text.split() if _ODD.search(text) is None else [x for x in _SPACE.split(text) if x]
        return _SEGMENT.findall(text)

    def with_special(self, text: str) -> list[str | int]:
        """The text cut at special tokens; these are given by id."""
        if self.special_pattern is None or "<" not in text:
            return [text] if text else []
        return [self.special.get(x, x) for x in self.special_pattern.split(text) if x]

    # Which tokens may meet

    def _edges(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one side of a token while it grows, each with the rank of the merge that takes it up."""
        chain = [(token, _NEVER)]
        while token in self.parts:
            token, gone = self.parts[token][side], self.parts[token][2]
            chain.append((token, gone))
        return chain[::-1]

    def _meet(self, a: int, b: int, until: int) -> bool:
        """No merge of rank below ``until`` crosses the boundary while a and b grow.

        Merges run by rank, and of equal ones the leftmost first. A crossing merge fires if it comes before
        the merge inside a, and not after the one inside b, that would take up its parts.
        """
        left = self._right.get(a) or self._right.setdefault(a, self._edges(a, 1))
        right = self._left.get(b) or self._left.setdefault(b, self._edges(b, 0))
        i = j = 0
        while True:
            (x, x_gone), (y, y_gone) = left[i], right[j]
            rank = self.rank.get((x, y), _NEVER)
            if rank < until and rank < x_gone and rank <= y_gone:
                return False
            if x_gone == y_gone == _NEVER:
                return True
            if x_gone <= y_gone:
                i += 1
            else:
                j += 1

    def _fits(self, pair: int) -> bool:
        a, b = pair >> 24, pair & 0xFFFFFF
        return self.alone(b) if a == START else self._meet(a, b, _NEVER)

    def alone(self, token: int) -> bool:
        """Whether a token's own string is encoded as that token."""
        known = self._alone.get(token)
        if known is None:
            if token in self.parts:
                a, b, rank = self.parts[token]
                known = self.alone(a) and self.alone(b) and self._meet(a, b, rank)
            else:
                known = True
            self._alone[token] = known
        return known

    # Ids to text

    def decode(self, ids) -> str:
        """Text of ids. Word vocabularies have no decoder: their tokens are joined by spaces."""
        known = self.tokens
        if self.word_style:
            try:
                return " ".join(map(known.__getitem__, ids))
            except KeyError:
                return " ".join([known[i] for i in ids if i in known])
        special = {i for i in self.special.values()}
        out, run = [], []
        for i in ids:
            if i in special:
                out += [self._plain(run), known[i]]
                run = []
            elif i in known:
                run.append(known[i])
        return "".join([*out, self._plain(run)])

    def _plain(self, tokens: list[str]) -> str:
        return bytes(self._bytes[c] for c in "".join(tokens)).decode("utf-8", "replace")


class PrefixEncoder:
    """Encodes pre-tokens by the last token of every prefix.

    For each prefix exactly one token can come last. An automaton over the vocabulary lists the tokens that
    end at a position; the one that fits the last token of the prefix before it is stored. The stored tokens,
    followed back from the end, are the encoding.
    """

    END = "\x00"

    def __init__(self, model: BpeModel) -> None:
        self.model = model
        self.length: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for text, token in model.ids.items():
            if model.suffix and text.endswith(model.suffix):
                text = text.removesuffix(model.suffix) + self.END
            self.length[token] = len(text)
            self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.words = Memo(lambda piece: array("i", self.encode_word(piece)).tobytes(), 80_000)

    def encode_word(self, piece: str) -> list[int]:
        """Token ids of one pre-token."""
        fits, length = self.model.fits, self.length
        text = self.model.spell(piece) + self.END if self.model.suffix else self.model.spell(piece)
        last = [NONE] * len(text)
        last.append(START)  # stands before the first letter, at index -1
        for end, (token, size) in self.automaton.iter(text):
            if last[end] < 0 and (previous := last[end - size]) >= 0 and fits[previous << 24 | token]:
                last[end] = token
        ids, end = [], len(text) - 1
        while end >= 0:
            ids.append(token := last[end])
            end -= length[token]
        ids.reverse()
        return ids

    def encode_chunk(self, chunk: str) -> bytes:
        """Token ids of a stretch of text, as int32 in bytes."""
        return b"".join([self.words[piece] for piece in self.model.pretokens(chunk)])

    def trim(self) -> None:
        self.words.trim()
        self.model.fits.trim()


_MODELS: dict[bytes, BpeModel] = {}


def model_of(content: bytes) -> BpeModel:
    """The model of a file's content, built once in each Python process."""
    if content not in _MODELS:
        _MODELS.clear()
        _MODELS[content] = BpeModel(content)
    return _MODELS[content]
