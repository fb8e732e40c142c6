"""Operators 1 and 7 share this: byte-level BPE ids of whole texts.

For these vocabularies white space after any other character always begins a pre-token. A text
can therefore be cut at every single space between two other characters and the pieces encoded by
themselves. ``PieceCache`` remembers the pieces' ids, since words repeat.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import filterfalse

import numpy as np

#: Pieces remembered by one Python worker, the first seen. It bounds memory, not results.
REMEMBERED = 1_000_000
#: Words encoded as one text.
TOGETHER = 256
CUT = re.compile(r"(?<=\S) (?=\S)")


class PieceCache:
    """``ids(texts)``: each text's ids as unsigned 32-bit integers of the machine's (little-endian) order."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], spaced: set[int] | None = None):
        """``spaced``: the ids whose bytes begin with a space. With it, words behind a space are encoded many at once."""
        self.encode = encode
        self.spaced = None if spaced is None else np.isin(np.arange(max(spaced, default=0) + 1), list(spaced))
        self.later: dict[str, bytes] = {"": b""}  # pieces behind a space, without it; "" stands for a text's first piece
        self.odd: dict[str, bytes] = {}  # pieces as they are: first ones, and all of texts with wider white space

    def _learn(self, known: dict[str, bytes], new: list[str], before: str) -> None:
        if before and self.spaced is not None:
            for at in range(0, len(new), TOGETHER):
                self._learn_together(known, new[at : at + TOGETHER])
        else:
            known.update(zip(new, (array("I", x).tobytes() for x in self.encode([before + w for w in new])), strict=True))

    def _learn_together(self, known: dict[str, bytes], new: list[str]) -> None:
        """As a text can be cut at its single spaces, the words' ids are those of the text of all, cut where an id begins with a space."""
        ids = np.array(self.encode([" " + " ".join(new)])[0], dtype="<u4")
        starts = np.flatnonzero((ids < len(self.spaced)) & self.spaced[np.minimum(ids, len(self.spaced) - 1)])
        if len(starts) == len(new) and starts[0] == 0:
            data, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            known.update(zip(new, (data[a:b] for a, b in zip(cuts, cuts[1:])), strict=True))
        else:  # a special token took a space
            known.update(zip(new, (array("I", x).tobytes() for x in self.encode([f" {w}" for w in new])), strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        known, odd = self.later.__contains__, self.odd
        cut: list[tuple[bool, list[str]]] = []
        new: set[str] = set()
        new_odd: set[str] = set()
        for text in texts:
            parts = text.split(" ")
            first, parts[0] = parts[0], ""
            missing = set(filterfalse(known, parts))
            plain = "  " not in text and text[:1].strip() and text[-1:].strip() and not first[-1:].isspace()
            if plain and not any(w[0].isspace() or w[-1].isspace() for w in missing):
                new |= missing
                parts[0] = first
                new_odd.add(first)
            else:
                plain, pieces = False, CUT.split(text)
                parts = [pieces[0], *(f" {w}" for w in pieces[1:])]
                new_odd.update(parts)
            cut.append((plain, parts))
        new_odd.discard("")
        new_odd = new_odd - odd.keys()
        bare = {w[:-1] for w in new if w[-1] in ".," and w[:-1].isalpha()}  # these with a stop or comma are two pre-tokens
        whole = {w for w in new if w[:-1] not in bare or w[-1] not in ".,"} | set(filterfalse(known, bare))
        self._learn(self.later, list(whole), " ")
        self._learn(odd, [*new_odd, *({".", ","} - odd.keys() - new_odd)], "")
        later = self.later
        later.update({w: later[w[:-1]] + odd[w[-1]] for w in new - whole})
        out = []
        for plain, parts in cut:
            if plain:
                first, parts[0] = parts[0], ""
                out.append(odd[first] + b"".join(map(later.__getitem__, parts)))
            else:
                out.append(b"".join(odd[w] for w in parts if w))
        if len(later) > REMEMBERED:
            for w in new | whole:
                later.pop(w, None)
        if len(odd) > REMEMBERED:
            odd.clear()
        return out


_CACHES: dict[tuple[str, str], PieceCache] = {}


def by_tokenizers(path: str) -> PieceCache:
    """Ids as the ``tokenizers`` library gives them for the vocabulary file: none is added, a special token's own text gets its id."""
    if ("tokenizers", path) not in _CACHES:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _CACHES["tokenizers", path] = PieceCache(lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], {i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if t.startswith("Ġ")})
    return _CACHES["tokenizers", path]


_ENCODINGS: dict[str, object] = {}


def by_ranks(path: str):
    """A ``tiktoken`` encoding over a file of ranks, without special tokens."""
    if path not in _ENCODINGS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]
