"""Byte-level BPE vocabularies in the tokenizers library's JSON format, and their pre-tokens.

A text is cut at the special strings first, then at single spaces between two visible
characters. No pre-token crosses such a space, so the piece after it, together with the space,
is tokenized the same wherever it occurs. That makes the piece a key for remembered results.
"""

from __future__ import annotations

import json
import re

import regex

# Fixed value: the split pattern of the format's byte-level pre-tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRE_TOKEN = regex.compile(PRE_TOKEN)
# Below this code point every Unicode version agrees on letters, numbers and white space.
_LATIN_ONLY = re.compile(r"[\x00-ɏ]*").fullmatch
_BESIDE_SPACE = re.compile(r" \s|\s ").search
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")

DEFAULT_VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The format's printable stand-in for each byte, by rule: visible Latin-1 stays, the rest follows from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, merges as ranks over token ids. Plain data, small enough to broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, letters = content["model"], byte_letters()
        if model["type"] != "BPE" or model.get("ignore_merges") or content["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("A byte-level BPE vocabulary is needed.")
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {}
        by_name: dict[str, int] = {}
        for name, number in model["vocab"].items():
            by_name[name] = number
            if name in self.special:
                self.bytes_of[number] = name.encode()
            else:
                self.bytes_of[number] = bytes(letters[c] for c in name)
        self.bytes_of |= {number: name.encode() for name, number in self.special.items()}
        self.id_of = {b: n for n, b in self.bytes_of.items() if n not in set(self.special.values())}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merge.setdefault((by_name[left], by_name[right]), (rank, by_name[left + right]))

    def merged(self, word: bytes) -> list[int]:
        """The encoding by plain merging, lowest rank first and leftmost among equals."""
        ids, merge = [self.id_of[word[k : k + 1]] for k in range(len(word))], self.merge
        found = [merge.get(pair, _NEVER) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is _NEVER:
                break
            k = found.index(best)
            ids[k : k + 2] = [best[1]]
            del found[k]
            if k:
                found[k - 1] = merge.get((ids[k - 1], ids[k]), _NEVER)
            if k < len(found):
                found[k] = merge.get((ids[k], ids[k + 1]), _NEVER)
        return ids

    def merged_long(self, word: bytes) -> list[int]:
        """The same encoding with a heap, for words of any length in n log n steps."""
        import heapq

        ids = [self.id_of[word[k : k + 1]] for k in range(len(word))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        alive, merge = [True] * len(ids), self.merge
        heap = [(*merge[p], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in merge]
        heap = [(rank, k, made, p) for rank, made, k, p in heap]
        heapq.heapify(heap)
        while heap:
            _, k, made, pair = heapq.heappop(heap)
            right = after[k] if alive[k] else len(ids)
            if right >= len(ids) or (ids[k], ids[right]) != pair:
                continue
            ids[k], alive[right], after[k] = made, False, after[right]
            if after[k] < len(ids):
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < len(ids):
                    p = (ids[left], ids[after[left]])
                    if p in merge:
                        heapq.heappush(heap, (merge[p][0], left, merge[p][1], p))
        return [i for i, a in zip(ids, alive) if a]


_NEVER = (1 << 60, -1)


def pre_tokens(text: str) -> list[str]:
    """Split ``text`` as the library does; letters that Unicode versions class differently go to it."""
    if _LATIN_ONLY(text):
        word = text[1:]
        if word.isalpha() and text[0] == " ":
            return [text]
        if word[:-1].isalpha() and text[0] == " " and word[-1] in ".,;:!?":
            return [text[:-1], word[-1]]
        return _PRE_TOKEN.findall(text)
    from tokenizers.pre_tokenizers import ByteLevel

    found = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)
    return [text[a:b] for _, (a, b) in found]


def pieces(text: str) -> list[str]:
    """Cut at single spaces between visible characters. All but the first piece had a space in front."""
    return _SAFE_SPACE.split(text) if _BESIDE_SPACE(text) else text.split(" ")


def splitter(special: dict[str, int]):
    """Cut a text at special strings: text, special, text, ..., as ``re.split`` with one group does."""
    if not special:
        return lambda text: [text]
    parts = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")
    return lambda text: parts.split(text)
