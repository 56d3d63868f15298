"""Pre-tokens of the byte-level BPE vocabulary, as its library splits them.

Texts of well-known characters are split by one pattern in C; all others go through the library's own
splitter. Special strings are cut out first, as the library does by default.
"""

from __future__ import annotations

import json
import re
from array import array

from strata.llm.common import per_process, tokenizer_file

# Latin letters, ASCII and line ends: here the pattern below and the library's classes agree (a test goes
# through every character).
_OTHER = re.compile("[^\t\n\r -~À-ÖØ-öø-ɏ]")
_SPLIT = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ɏ0-9]+|\s+(?!\S)|\s+")


def tokenizer(name: str):
    from tokenizers import Tokenizer

    return per_process(("tokenizer", name), lambda: Tokenizer.from_file(tokenizer_file(name)))


def specials(name: str) -> tuple[re.Pattern | None, dict[str, int]]:
    return per_process(("specials", name), lambda: _specials(name))


def _specials(name: str) -> tuple[re.Pattern | None, dict[str, int]]:
    ids = {t.content: i for i, t in tokenizer(name).get_added_tokens_decoder().items() if t.special}
    pattern = re.compile("(" + "|".join(sorted(map(re.escape, ids), key=len, reverse=True)) + ")") if ids else None
    return pattern, ids


def _ordinary(name: str, text: str) -> list[str]:
    if not _OTHER.search(text):
        return _SPLIT.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer(name).pre_tokenizer.pre_tokenize_str(text)]


def split(name: str, text: str) -> list[str]:
    """Pre-tokens and special strings of ``text`` in order; their concatenation is the text."""
    pattern, ids = specials(name)
    if not ids or not any(s in text for s in ids):
        return _ordinary(name, text)
    out: list[str] = []
    for part in pattern.split(text):
        if part in ids:
            out.append(part)
        elif part:
            out.extend(_ordinary(name, part))
    return out


def byte_ranks(name: str) -> dict[bytes, int] | None:
    """The vocabulary by bytes, if it is a byte-level BPE whose ids stand in the order of its merges; else None."""
    model = json.loads(tokenizer(name).to_str())["model"]
    vocabulary, merges = model.get("vocab"), model.get("merges")
    if model.get("type") != "BPE" or model.get("byte_fallback") or model.get("end_of_word_suffix") or not merges:
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    order = [vocabulary[a + b] for a, b in pairs]
    # Byte-level vocabularies write a byte as the character of its number, or, where that is not printable, as the
    # next character from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    added = {t.content for t in tokenizer(name).get_added_tokens_decoder().values()}
    if order != sorted(order) or not all(c in back for t in vocabulary if t not in added for c in t):
        return None
    return {bytes(back[c] for c in t): i for t, i in vocabulary.items() if t not in added}


def piece_encoder(name: str):
    """Pre-token -> ids. Byte-level vocabularies with ids in the order of merges are merged by rank, in a third of the
    library's time and with its ids (a test compares them); others go through the library."""
    ranks = byte_ranks(name)
    if ranks is None:
        return lambda piece: tokenizer(name).encode(piece, add_special_tokens=False).ids
    from tiktoken._tiktoken import CoreBPE

    special = specials(name)[1]
    merge = CoreBPE(ranks, {}, r"(?s).+").encode_single_piece
    return lambda piece: [special[piece]] if piece in special else merge(piece.encode())


class PieceIds(dict):
    """Pre-token -> its ids as little-endian 32-bit bytes, encoded when first asked for.

    Two generations of ``most`` entries: when the young one is full it becomes the old one, from which pre-tokens that
    are still used come back. So memory is bounded and common pre-tokens stay.
    """

    def __init__(self, name: str, most: int = 60_000, longest: int = 64):
        super().__init__()
        self.encode, self.most, self.longest = piece_encoder(name), most, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", self.encode(piece)).tobytes()
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def ids_of(name: str, text: str) -> bytes:
    """All ids of ``text`` as little-endian 32-bit bytes."""
    memo = per_process(("ids", name), lambda: PieceIds(name))
    return b"".join([memo[p] for p in split(name, text)])
