"""A word-level BPE vocabulary: reading its file, cutting text into words, and exact encoding by prefixes.

The encoder never merges pairs. It stores, for every prefix of a word, the one token that ends
the prefix's encoding: candidates are the tokens that a suffix automaton finds at the prefix's end,
and the one whose boundary to the token before it would survive merging is the right one.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import regex
from tokenizers import Regex, normalizers, pre_tokenizers

#: Fixed values of the vocabulary file's format: the mark of a word's end, the special strings and the word pattern.
WORD_END = "</w>"
SPECIALS = ("<|startoftext|>", "<|endoftext|>")
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: White space as Unicode's property has it (Python's own classes add the separators U+001C to U+001F).
_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORDS = regex.compile(WORD_PATTERN.replace(r"\s", _BLANK))
# the same pattern for text below U+0100, where Python's own engine can list the classes
_LATIN_LETTERS = "a-zªµºß-öø-ÿ"
_LATIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN_LETTERS}]+|[0-9²³¹¼½¾]|[^{_BLANK}{_LATIN_LETTERS}0-9²³¹¼½¾]+")
_SPECIAL = re.compile("|".join(map(re.escape, SPECIALS)))
_SPACES = re.compile(f"[{_BLANK}]+")
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Above every byte symbol: added to the last symbol of a word.
_END = 1 << 10


def chunks(text: str | None) -> list[str]:
    """Parts of a text between white space; no word of the vocabulary's pattern crosses it."""
    if not text:
        return []
    if any(mark in text for mark in _SEPARATORS):  # white space to Python only
        return [part for part in _SPACES.split(text) if part]
    return text.split()


def is_latin(text: str) -> bool:
    """Whether all characters lie below U+0100."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def lowered(text: str) -> str:
    """Composed and in lower case, letter by letter (so that a final sigma is like any other)."""
    if is_latin(text):
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=1)
def _library_parts() -> tuple:
    """The library's own lower-casing and cutting, as the vocabulary file has them."""
    steps = [normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]
    return normalizers.Sequence(steps), pre_tokenizers.Split(Regex(WORD_PATTERN), "removed", invert=True)


def _library_words(text: str) -> list[str]:
    normalizer, splitter = _library_parts()
    return [word for word, _ in splitter.pre_tokenize_str(normalizer.normalize_str(text))]


def _cut(low: str) -> list[str]:
    return (_LATIN_WORDS if is_latin(low) else _WORDS).findall(low)


class Agreement:
    """Characters on which the installed Unicode tables and the library's agree; each is tried when it is first met.

    A try tells the class, the lower case and whether the character moves past a mark before or after it; what two
    characters compose to is looked up as a character too.
    """

    def __init__(self):
        self.same: set[str] = set()
        self.other: set[str] = set()

    def __call__(self, characters: set[str]) -> bool:
        new = characters - self.same
        if not new:
            return True
        if len(self.same) > 200_000:  # a text may list all of Unicode
            self.same.clear()
        for character in new - self.other:
            trial = f"a{character}a {character}{character} 1{character}! a\u0345{character} a{character}\u0334"
            agrees = _library_words(trial) == _cut(lowered(trial))
            (self.same if agrees else self.other).add(character)
        return not new & self.other


_agree = Agreement()


def plain_words(text: str) -> list[str]:
    """Words of a text without special strings; by the library where its tables know the characters otherwise."""
    low = lowered(text)
    if not is_latin(text) and not (_agree(set(text)) and _agree(set(low))):
        return _library_words(text)
    return _cut(low)


def text_words(text: str | None) -> list[str]:
    """Words of a whole text in order; a text without special strings is cut in one go."""
    if not text:
        return []
    if "<|" in text:
        return [word for chunk in chunks(text) for word in words_of(chunk)]
    return plain_words(text)


def words_of(chunk: str) -> list[str]:
    """Words of a chunk in lower case; special strings are words as they stand."""
    found: list[str] = []
    at = 0
    for special in _SPECIAL.finditer(chunk) if "<|" in chunk else ():
        found += plain_words(chunk[at : special.start()])
        found.append(special.group())
        at = special.end()
    return found + plain_words(chunk[at:])


@lru_cache(maxsize=1)
def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: itself where it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(byte) if byte in prints else chr(next(hidden)) for byte in range(256)]


class SuffixAutomaton:
    """Finds, after each symbol of a word, the tokens that end there, longest first.

    States are classes of substrings of the vocabulary. A token is the longest string of its class,
    so a state needs to remember one token at most, and the shorter ones lie on its chain of links.
    """

    def __init__(self, tokens: dict[str, int]):
        self.moves: list[dict[str, int]] = [{}]
        self.link, self.length, self.token = [-1], [0], [-1]
        layer: dict[str, tuple[int, list[str]]] = {"": (0, list(tokens))}
        depth = 0
        while layer:  # the trie of the tokens, layer by layer: each node extends its parent's state
            children: dict[str, tuple[int, list[str]]] = {}
            for prefix, (state, members) in layer.items():
                below: dict[str, list[str]] = {}
                for token in members:
                    if len(token) > depth:
                        below.setdefault(token[depth], []).append(token)
                for symbol, inside in below.items():
                    children[prefix + symbol] = (self._extend(state, symbol), inside)
            layer, depth = children, depth + 1
        for text, token in tokens.items():
            state = 0
            for symbol in text:
                state = self.moves[state][symbol]
            self.token[state] = token
        # what a search needs of each state: moves, length, tokens on its chain of links with their lengths (longest
        # first, the state's own before all), the same from its link on, and the link's node
        self.nodes: list[tuple] = [()] * len(self.link)
        self.nodes[0] = ({}, 0, (), (), None)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            link = self.nodes[self.link[state]]
            own = ((self.token[state], self.length[state]),) if self.token[state] >= 0 else ()
            self.nodes[state] = ({}, self.length[state], own + link[2], link[2], link)
        for (moves, *_), following in zip(self.nodes, self.moves):
            moves.update((symbol, self.nodes[state]) for symbol, state in following.items())

    def _new(self, length: int, moves: dict[str, int], link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.token.append(-1)
        return len(self.link) - 1

    def _split(self, parent: int, symbol: str) -> int:
        """The state of the string ``longest(parent) + symbol``, cut off from a longer class if need be."""
        target = self.moves[parent][symbol]
        if self.length[target] == self.length[parent] + 1:
            return target
        part = self._new(self.length[parent] + 1, dict(self.moves[target]), self.link[target])
        self.link[target] = part
        while parent >= 0 and self.moves[parent].get(symbol) == target:
            self.moves[parent][symbol] = part
            parent = self.link[parent]
        return part

    def _extend(self, last: int, symbol: str) -> int:
        if symbol in self.moves[last]:
            return self._split(last, symbol)
        state = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and symbol not in self.moves[last]:
            self.moves[last][symbol] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, symbol)
        return state


class PairTests(dict):
    """Verdicts on pairs of neighbouring tokens (first token's id shifted, plus the second's), worked out once."""

    def __init__(self, compatible):
        super().__init__()
        self.compatible = compatible

    def __missing__(self, pair: int) -> bool:
        if len(self) >= 1_000_000:
            self.clear()
        fits = self[pair] = self.compatible(pair >> 20, pair & 0xFFFFF)
        return fits


class PrefixEncoder:
    """Exact BPE ids of one word after the other, by dynamic programming over prefixes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, self.special = data["model"], {t["content"]: t["id"] for t in data["added_tokens"]}
        self.text = {number: text for text, number in model["vocab"].items()}
        self.spoken = {**self.text, **{number: text for text, number in self.special.items()}}
        self.symbols = byte_symbols()
        ids = model["vocab"]
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            whole = ids[left + right]
            self.merged[ids[left], ids[right]] = rank
            self.parts[whole], self.rank[whole] = (ids[left], ids[right]), rank
        reachable = {text: number for text, number in ids.items() if number in self.rank or len(text.removesuffix(WORD_END)) == 1}
        self.automaton = SuffixAutomaton({self._spelled(text): number for text, number in reachable.items()})
        self.pairs = PairTests(self.compatible)

    @staticmethod
    def _spelled(token: str) -> str:
        if not token.endswith(WORD_END) or token == WORD_END:
            return token
        token = token.removesuffix(WORD_END)
        return token[:-1] + chr(ord(token[-1]) + _END)

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the boundary between two neighbouring tokens alone.

        Taken back in time, the later of the two comes apart first; a merge across the boundary
        would have won if it ranks before the merge that used up either of its sides (of equal
        merges the one further left goes first).
        """
        never = len(self.merged)
        left_until = right_until = never
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < left_until and across <= right_until:
                return False
            left_made, right_made = self.rank.get(left, -1), self.rank.get(right, -1)
            if left_made < 0 and right_made < 0:
                return True
            if left_made > right_made:
                left, left_until = self.parts[left][1], left_made
            else:
                right, right_until = self.parts[right][0], right_made

    def encode_word(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        if not (word.isascii() and word.isprintable()):  # what prints in ASCII stands for its own byte
            word = "".join([self.symbols[byte] for byte in word.encode("utf-8", "surrogatepass")])
        spelled = word[:-1] + chr(ord(word[-1]) + _END)
        pairs, node = self.pairs, self.automaton.nodes[0]
        last = [0] * (len(spelled) + 1)  # ids shifted, ready to be the first of a pair
        begins = last.copy()
        end = matched = 0
        for symbol in spelled:
            following = node[0].get(symbol)
            while following is None:  # every symbol is a token, so the empty state has a move
                node = node[4]
                matched = node[1]
                following = node[0].get(symbol)
            node = following
            matched += 1
            end += 1
            # a class's longest string may reach back further than the text matched
            for token, size in node[2] if node[1] <= matched else node[3]:
                begin = end - size
                if not begin or pairs[last[begin] | token]:
                    last[end], begins[end] = token << 20, begin
                    break
        ids = []
        while end:
            ids.append(last[end] >> 20)
            end = begins[end]
        return ids[::-1]

    def encode(self, text: str | None) -> list[int]:
        return [number for word in text_words(text) for number in self.encode_word(word)]

    def decode(self, ids: list[int]) -> str:
        """The tokens' own text, one blank between two, as a vocabulary without a decoder gives it."""
        known = map(self.spoken.get, ids)
        return " ".join([text for text in known if text is not None])


@lru_cache(maxsize=2)
def prefix_encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(path)
