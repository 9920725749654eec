"""Exact token counts and ids of words, as a tokenizer file gives them.

The library never joins text across ASCII white space and never across the place between a Latin letter or digit and
a run of ``.,;:!?`` after it, so a text's ids are those of its units in order. ASCII letters are lower-cased first,
which the file's own normaliser does as well; words that hold ``<|`` (special strings) are left as they are."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TAIL = r"^(?P<head>(?s:.*)[A-Za-z0-9À-ÖØ-öø-ÿ])(?P<tail>[.,;:!?]+)$"
_PLAIN = re.compile(r"[a-z]+").fullmatch
_encoders: dict[str, "UnitEncoder"] = {}


def units_of(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct units, and for each word the places of its head and of its tail (-1: none) among them."""
    special = pc.match_substring(words, "<|")
    words = pc.if_else(special, words, pc.ascii_lower(words))
    cut = pc.extract_regex(pc.if_else(special, pa.scalar(None, words.type), words), _TAIL)
    has_tail = pc.is_valid(cut)
    heads = pc.if_else(has_tail, pc.struct_field(cut, "head"), words)
    tails = pc.struct_field(cut, "tail").filter(has_tail)
    both = pa.concat_arrays([_one(heads), _one(tails)]).dictionary_encode()
    place = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tail = np.full(len(words), -1, np.int64)
    tail[has_tail.to_numpy(zero_copy_only=False)] = place[len(words) :]
    return both.dictionary, place[: len(words)], tail


def _one(x) -> pa.Array:
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return x.cast(pa.large_string())


class UnitEncoder:
    """Ids of units, with a memory of at most ``most`` of them."""

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.known = Tokenizer.from_file(path), most, {}
        self._check(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def _check(self, path: str) -> None:
        """Units are cut by rules that hold for this kind of file only: any other is an error."""
        probe = "The cat's 3rd, (big) naïve--café! x.y,z 12.5%;\u00c0\u3000b"
        cut = [t + " " for t in probe.split()] + ["Ab.,", "é!?", "9;:", "Ab.,"]
        whole = self.tokenizer.encode("".join(cut).replace(" ", " \n"), add_special_tokens=False).ids
        parts = [i for t in cut[:-4] for i in self.tokenizer.encode(t.strip().lower(), add_special_tokens=False).ids]
        parts += self.tokenizer.encode("".join(cut[-4:]), add_special_tokens=False).ids
        if whole != parts or any(self.tokenizer.encode(a + b, add_special_tokens=False).ids != self.tokenizer.encode(a, add_special_tokens=False).ids + self.tokenizer.encode(b, add_special_tokens=False).ids for a, b in (("ab", ".,"), ("é", "!?"), ("9", ";:"))):
            raise ValueError(f"{path}: its ids depend on letter case, white space or what stands before punctuation")
        if [t.id for t in self.tokenizer.model.tokenize("cat")] != self.tokenizer.encode("cat", add_special_tokens=False).ids:
            raise ValueError(f"{path}: its model alone doesn't give a plain word's ids")

    def encode(self, unit: str) -> list[int]:
        if _PLAIN(unit):  # one pre-token of plain letters: no normaliser or splitting to run
            return [t.id for t in self.tokenizer.model.tokenize(unit)]
        return self.tokenizer.encode(unit, add_special_tokens=False).ids

    def lengths(self, units: pa.Array) -> np.ndarray:
        """Ids of each unit, counted; nothing is remembered."""
        model, encode = self.tokenizer.model.tokenize, self.tokenizer.encode
        return np.fromiter((len(model(u)) if _PLAIN(u) else len(encode(u, add_special_tokens=False)) for u in units.to_pylist()), np.int64, len(units))

    def ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All units' ids in one array, with offsets (len + 1)."""
        if len(self.known) > self.most:
            self.known.clear()
        known, found = self.known, []
        for u in units.to_pylist():
            x = known.get(u)
            if x is None:
                x = known[u] = np.array(self.encode(u), "<u4").tobytes()
            found.append(x)
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)])
        return np.frombuffer(b"".join(found), "<u4"), offsets


def encoder(path: str) -> UnitEncoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]
