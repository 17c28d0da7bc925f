"""Token ids of whole texts, with the ids of frequent words remembered."""

from __future__ import annotations

import gc
import os
import string
import struct
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import remembers

ID_BYTES = 4
# Pieces that a worker remembers, unless it is told otherwise: some 200 bytes each.
REMEMBER = 700_000
# Spark runs a process for each core; threads within them only get in each other's way.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
# Pieces that the library gets in one text, and what may stand between them.
JOINED, MARKS = 50, ("\n", " \x01")
LEADS, SAMPLES = ("\u0120", ""), ("a", "The", "house", "Zqxvbw", "internationalisation", "LLM", "\u00fcber", "\u00c9l\u00e8ve", "\u0130")
# The letters before this are of the Latin script, in all versions of Unicode.
LATIN_END = "\u0250"
# What every pre-tokenizer cuts from letters before it (an apostrophe may begin an ending), and
# how many different runs of that, up to which length, a worker remembers.
SIGNS, TAILS, LONGEST_TAIL = string.punctuation.replace("'", ""), 1000, 16


def _byte_characters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: visible Latin-1 characters as they are, the
    others as characters from 256 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + hidden.index(b)) for b in hidden}


BYTE_CHARACTERS = _byte_characters()


@cache
def _packer(n: int) -> Callable[..., bytes]:
    return struct.Struct(f"<{n}I").pack


class TextEncoder:
    """Encodes texts with a tokenizer file of the ``tokenizers`` library.

    The pre-tokenizers of byte-level and of word-end vocabularies never join what stands
    on the two sides of a space or line break, provided that the characters next to it are
    not white space themselves, and they cut punctuation from letters before it. So a text is
    cut there, and the library encodes each different piece once; pieces that recur come from
    memory. A text with other white space is handed to the library whole. Both ways give the
    ids of the whole text, and the names of special tokens are ordinary text.

    ``remember`` bounds the pieces in memory: beyond half of it, those not used since are
    forgotten.
    """

    def __init__(self, path: str, remember: int = REMEMBER, plain_names: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_names
        # Texts with one of these are rare and go to the library whole.
        self.names = () if plain_names else tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.remember = remember
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tokenize = self.tokenizer.model.tokenize
        self.normalizer = self.tokenizer.normalizer
        self.lower = self.normalizer is not None and self.normalizer.normalize_str("Aa") == "aa"
        # What the pre-tokenizer makes of the space in front of a word, if the model can be asked.
        self.lead = next((lead for lead in LEADS if self._leads(" ", b"", lead)), None)
        # A line break has ids of its own, if it has any, and the word behind it no lead.
        self.broken = self._library(["\n"])[0]
        self.breaks = self._leads("\n", self.broken, "")
        # The ids of punctuation behind letters, or None if it has to be encoded with them.
        self.tails: dict[str, bytes | None] = {"": b""}
        # What can stand between pieces so that its own id tells them apart again.
        self.mark, self.mark_id = next(filter(None, map(self._apart, MARKS)), ("", -1))

    def _leads(self, front: str, ids: bytes, lead: str) -> bool:
        own = [self._word(w, lead) for w in SAMPLES]
        whole = self._library([front + w for w in SAMPLES])
        return all(o is None or ids + o == w for o, w in zip(own, whole, strict=True))

    def _apart(self, mark: str) -> tuple[str, int] | None:
        left, whole, right = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in (" a", f" a{mark} b", " b"))
        inner = whole[len(left) : -len(right)]
        return (mark, inner[0]) if len(inner) == 1 and whole == left + inner + right else None

    def _word(self, letters: str, lead: str) -> bytes | None:
        """Latin letters behind a space or line break are one piece to every pre-tokenizer, so
        they go to the model of the library at once, as the characters that stand for their
        bytes."""
        if letters.isascii():
            text = letters.lower() if self.lower else letters
        else:
            text = self.normalizer.normalize_str(letters) if self.normalizer else letters
            if max(letters) >= LATIN_END or not text.isalpha():
                return None
            text = text.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        ids = [t.id for t in self.tokenize(lead + text)]
        return _packer(len(ids))(*ids)

    def _tail(self, signs: str) -> bytes | None:
        if signs not in self.tails:
            if len(self.tails) > TAILS or len(signs) > LONGEST_TAIL:
                return None
            samples = [w for w in SAMPLES if self._word(w, "") is not None]
            alone, *words = self._library([signs, *[" " + w for w in samples]])
            whole = self._library([f" {w}{signs}" for w in samples])
            self.tails[signs] = alone if whole == [w + alone for w in words] else None
        return self.tails[signs]

    def _letters(self, piece: str) -> bytes | None:
        """Ids of a piece of Latin letters and punctuation behind them, or None if it is another."""
        if piece.isalpha():
            return None if self.lead is None else self._word(piece, self.lead)
        front = piece[:1] == "\n"
        letters = piece[front:].rstrip(SIGNS)
        if not letters.isalpha() or (not self.breaks if front else self.lead is None):
            return None
        tail = self._tail(piece[front + len(letters) :])
        if tail is None:
            return None
        if front:
            ids = self._word(letters, "")
            return None if ids is None else self.broken + ids + tail
        ids = self.known.get(letters) or self._word(letters, self.lead)
        return None if ids is None else ids + tail

    def _library(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in encoded]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces behind a space; many go into one text, since a text of its own for
        each costs more than its ids."""
        sign, joint = self.mark.strip(" "), self.mark + " "
        if not pieces:
            return []
        if not sign or any(sign in p for p in pieces):
            return self._library([" " + p for p in pieces])
        texts = [" " + joint.join(pieces[k : k + JOINED]) for k in range(0, len(pieces), JOINED)]
        flat: list[int] = []
        for encoded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            flat += encoded.ids
            flat.append(self.mark_id)
        ids = np.asarray(flat, dtype="<u4")
        data, ends = ids.tobytes(), (ID_BYTES * np.flatnonzero(ids == self.mark_id)).tolist()
        starts = [0, *[end + ID_BYTES for end in ends[:-1]]]
        return [data[start:end] for start, end in zip(starts, ends, strict=True)]

    def _ids(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of different pieces; None where a text with that piece has to be encoded whole."""
        if len(self.known) > self.remember // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        out = list(map(known.get, pieces))
        behind_space, behind_break = [], []
        for i, ids in enumerate(out):
            if ids is None:
                p = pieces[i]
                ids = older.get(p)
                if ids is None:
                    ids = self._letters(p)
                if ids is not None:
                    out[i] = known[p] = ids
                elif p and p.strip() == p:
                    behind_space.append(i)
                elif p[:1] == "\n" and p[1:] and p[1:].strip() == p[1:]:
                    behind_break.append(i)
        for encode, places in ((self._pieces, behind_space), (self._library, behind_break)):
            for i, ids in zip(places, encode([pieces[i] for i in places]), strict=True):
                out[i] = known[pieces[i]] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        # Hundreds of thousands of words live here for a moment and none of them refers to
        # another, so looking for cycles only takes time.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        named = [i for i, text in enumerate(texts) if any(name in text for name in self.names)]
        if named:
            skip = set(named)
            out = self._encode(["" if i in skip else text for i, text in enumerate(texts)])
            for i, ids in zip(named, self._library([texts[i] for i in named]), strict=True):
                out[i] = ids
            return out
        if not texts:
            return []
        # A line break is the lead of the piece behind it, as a space is.
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        places = parts.values.dictionary_encode()
        known = pa.array(self._ids(places.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        at = parts.offsets.to_numpy()
        # No space stands in front of the first word.
        firsts = self._library(parts.values.take(pa.array(at[:-1])).to_pylist())
        placed = known.take(places.indices)
        _, ends, data = placed.buffers()
        ends, data = np.frombuffer(ends, np.int64, len(placed) + 1), memoryview(data or b"")
        starts, stops = ends[at[:-1] + 1].tolist(), ends[at[1:]].tolist()
        out = [first + data[start:stop] for first, start, stop in zip(firsts, starts, stops, strict=True)]
        # A piece that stands for itself only with its neighbours has no bytes to join.
        if known.null_count:
            gaps = np.concatenate([[0], np.cumsum(placed.is_null().to_numpy(zero_copy_only=False))])
            left = np.flatnonzero(gaps[at[1:]] > gaps[at[:-1]]).tolist()
            for i, ids in zip(left, self._library([texts[i] for i in left]), strict=True):
                out[i] = ids
        return out


_encoders: dict[tuple[str, bool], TextEncoder] = {}
remembers(_encoders.clear)


def encoder(path: str, plain_names: bool = False, remember: int = REMEMBER) -> TextEncoder:
    """One encoder for each file and setting in a worker process, which remembers what was asked for last."""
    if (path, plain_names) not in _encoders:
        _encoders[path, plain_names] = TextEncoder(path, plain_names=plain_names)
    _encoders[path, plain_names].remember = remember
    return _encoders[path, plain_names]
