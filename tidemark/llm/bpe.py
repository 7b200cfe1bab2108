"""Token ids and counts of the dealt vocabularies, equal to the tokenizers library.

Ids of plain texts come from rank tables that are read from the library's own file, since the library takes more than the
CPU time at hand; merging the pair of lowest rank first gives the same ids where ranks follow the order of merges, which is checked. All other
texts, and all counts, go part by part. No pre-token of these vocabularies spans a change from other characters to white space, so a text may be cut
there, and the ids of its parts follow each other. A part that was met before is looked up. A new one goes through
the library: its normalizer and pre-tokenizer cut it into pre-tokens, its BPE model encodes each. Only for
printable ASCII, where both come down to lower case and one fixed expression, is the cut made here.
"""

from __future__ import annotations

import functools
import json
import os
import re
from itertools import chain

import numpy as np

#: White space as the library's expressions have it (fixed: Unicode White_Space).
WHITE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pre-tokens in ASCII, with word ends and byte-level (fixed by the files and the library's pre-tokenizer).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"
BYTES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
ASCII = re.compile(r"[\t\n\r\x20-\x7e]*").fullmatch
#: Byte-level vocabularies spell a byte that is not printable as the next free character from 256 on.
SPELLED = {9: "ĉ", 10: "Ċ", 13: "č", 32: "Ġ"}
#: Parts that one worker keeps, and the longest.
CACHE, LONGEST = 200_000, 48


#: Texts of these characters take rank tables: their white space, case and normal form need no rules of their own.
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ«»„“”‘’…–—]*").fullmatch
#: Pre-tokens of plain texts, with word ends and byte-level (fixed by the files and the library's pre-tokenizer).
PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_BYTES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Marks the end of a word in rank tables; no plain text has it.
END = "\x00"


def rank_table(path: str) -> dict[bytes, int] | None:
    """Bytes of each token, ``</w>`` as ``END``, with its id; None if ids do not follow the order of merges."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    vocab, special = whole["model"]["vocab"], {t["content"] for t in whole["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    if ids != sorted(ids) or len(set(ids)) != len(ids):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes are spelled as themselves, the others from 256 on
    of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def spelled(token: str) -> bytes:
        word = token.removesuffix("</w>")
        return bytes(of[c] for c in word) + (END.encode() if word != token else b"")

    return {spelled(t): i for t, i in vocab.items() if t not in special}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts, equal to ``encode(text, add_special_tokens=False)`` of the library.

    ``known`` has token counts of pre-tokens that need not be encoded to be counted.
    """

    def __init__(self, name: str, known: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(tokenizer_path(name))
        self.model, self.normalizer, self.pre_tokenizer = self.library.model, self.library.normalizer, self.library.pre_tokenizer
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: A vocabulary that drops white space has parts without it.
        self.drops = self.normalizer is not None
        self.parts = re.compile(f"[^{WHITE}]+" if self.drops else f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
        self.split = re.compile(WORDS if self.drops else BYTES).findall
        self._name = name
        self.of_part, self.of_token = _Cache(self.part_ids), _Cache(lambda p: [t.id for t in self.model.tokenize(p)])
        self.counts, self.lengths = _Cache(self.part_count), _Cache(lambda p: len(self.model.tokenize(p)), known)

    def pre_tokens(self, part: str) -> list[str]:
        """Pre-tokens of a part, as the model takes them."""
        if ASCII(part):
            return self.split(part.lower()) if self.drops else [p.translate(SPELLED) if p[0] <= " " else p for p in self.split(part)]
        return [p for p, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(part) if self.drops else part)]

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def part_ids(self, part: str) -> list[int]:
        if "<" in part and any(s in part for s in self.special):
            return self.whole(part)
        return list(chain.from_iterable(map(self.of_token.__getitem__, self.pre_tokens(part))))

    def part_count(self, part: str) -> int:
        if "<" in part and any(s in part for s in self.special):
            return len(self.whole(part))
        return sum(map(self.lengths.__getitem__, self.pre_tokens(part)))

    @functools.cached_property
    def by_rank(self):
        """Ids of a plain text by the rank table, or None where there is none."""
        import regex
        import tiktoken

        ranks = rank_table(tokenizer_path(self._name))
        if not ranks:
            return None
        pattern = rf"(?:{PLAIN_WORDS.replace(r'[^\s', r'[^\x00\s')})\x00" if self.drops else PLAIN_BYTES
        encode = tiktoken.Encoding(self._name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        words = regex.compile(PLAIN_WORDS).findall
        return (lambda text: encode("".join([w + END for w in words(text.lower())]))) if self.drops else encode

    def ids(self, text: str) -> np.ndarray:
        if PLAIN(text) and self.by_rank and not any(s in text for s in self.special):
            return np.array(self.by_rank(text), "<u4")
        return np.fromiter(chain.from_iterable(map(self.of_part.__getitem__, self.parts(text))), "<u4")

    def count(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self.parts(text)))


class _Cache(dict):
    """Values that are known, and those of ``work`` for the first ``CACHE`` short keys; others are worked out each time."""

    def __init__(self, work, known: dict | None = None):
        super().__init__(known or {})
        self.work = work

    def __missing__(self, key: str):
        value = self.work(key)
        if len(self) < CACHE and len(key) <= LONGEST:
            self[key] = value
        return value


@functools.lru_cache(maxsize=4)
def encoder(name: str) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(name)
