"""Token ids of many texts at once, by a tokenizer file of the ``tokenizers`` library.

The tokenizer never looks across white space (its normalizer and its pre-tokenizer work inside
runs of other characters), so a batch is split at white space by Arrow, each distinct run is
encoded once, and the ids are put together by index. Runs of plain letters, digits and signs go
to the tokenizer's model piece by piece, which saves its regular expressions; every other run, and
every text in which Arrow's white space differs from the tokenizer's, goes through ``encode``.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

# Runs whose pieces are known by rule: visible ASCII without the apostrophe (which starts
# contractions) and the Latin-1 letters, whose lower case is one letter.
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+|\n")
# Arrow splits at these, the tokenizer does not.
_ODD_SPACE = "[\x1c-\x1f]"
_MOST_KNOWN = 250_000  # runs remembered from batch to batch; beyond it they are encoded again


def _packed(ids: Iterable[int]) -> bytes:
    return array("i", ids).tobytes()


class BatchEncoder:
    """Encodes Arrow string arrays; remembers a bounded number of runs."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
        self.bytes = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = _packed(t.id for t in self.model.tokenize(piece.translate(self.bytes)))
            if len(self.pieces) < _MOST_KNOWN:
                self.pieces[piece] = ids
        return ids

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_packed(e.ids) for e in found]

    def _runs(self, runs: list[str]) -> list[bytes]:
        """Ids of each distinct run, as the bytes of 32-bit integers."""
        out: list[bytes | None] = [self.known.get(r) for r in runs]
        new = [i for i, ids in enumerate(out) if ids is None]
        plain = [i for i in new if _PLAIN.fullmatch(runs[i]) and "<|" not in runs[i]]
        simple = set(plain)
        other = [i for i in new if i not in simple]
        if plain:
            at, ids = 0, []
            for piece in _PIECES.findall("\n".join([runs[i] for i in plain]).lower() + "\n"):
                if piece == "\n":
                    out[plain[at]] = b"".join(ids)
                    at, ids = at + 1, []
                else:
                    ids.append(self._piece(piece))
        for i, ids in zip(other, self._encode([runs[i] for i in other])):
            out[i] = ids
        for i in new[: max(0, _MOST_KNOWN - len(self.known))]:
            self.known[runs[i]] = out[i]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where those of each text begin (and the last end)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        split = pc.utf8_split_whitespace(pc.if_else(pa.array(odd), "", texts))
        offsets = split.offsets.to_numpy()
        coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        runs = self._runs(coded.dictionary.to_pylist())
        sizes = np.array([len(r) // 4 for r in runs], np.int64)
        flat = np.frombuffer(b"".join(runs), np.int32)
        begin = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            begin[which] - (ends - lengths), lengths
        )
        ids = flat[places]
        total = np.concatenate([[0], ends])
        first = total[offsets - offsets[0]]
        return self._with_odd(texts, odd, ids, first) if odd.any() else (ids, first)

    def _with_odd(self, texts, odd, ids, first):
        parts = [ids[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        places = np.flatnonzero(odd).tolist()
        for i, e in zip(places, self._encode([texts[i].as_py() for i in places])):
            parts[i] = np.frombuffer(e, np.int32)
        first = np.cumsum([0, *map(len, parts)])
        return np.concatenate(parts), first


@lru_cache(maxsize=2)
def encoder(path: str) -> BatchEncoder:
    """One encoder per Python worker, which serves many tasks."""
    return BatchEncoder(path)
