"""Token ids of a text, put together from the library's ids of its words.

The vocabulary files handled here (``.json``) are those whose pre-tokeniser drops white space, so
that no token and no normalisation step reaches across ASCII white space. A text is
cut there (and before signs that end a word, if the file's pattern cuts there too), each different word is encoded by the library once, and the ids of the words follow each
other exactly as in the ids of the whole text. Words are found, hashed and looked up as arrays; a remembered word takes some 30 bytes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# Different words of the older and of the newer half that one worker remembers. A full newer half becomes the older one, so that
# frequent words stay and rare ones go (results are the same).
MEMO_WORDS = 600_000
# Longer words (in bytes) are encoded each time they occur.
LONGEST = 64
# Words in one line for the library.
JOINED_WORDS = 200
# Texts are handled in groups of about this many bytes.
GROUP_BYTES = 1 << 20
# Fixed value: a file with this pattern parts letters from signs.
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
UPPER = re.compile(rb"[A-Z]")
LATIN = re.compile("[a-zß-öø-ÿ]+")
SPACE, SIGN, OTHER = 0, 1, 2
KIND = np.full(256, OTHER, dtype=np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = SIGN
LETTER = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def settings_of(path: str) -> dict:
    """The file without its vocabulary and merges."""
    with open(path, encoding="utf-8") as f:
        return {k: v for k, v in json.load(f).items() if k != "model"}


def pattern_of(spec: dict) -> tuple[dict, str]:
    """First step of the pre-tokeniser and its pattern."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    return steps[0], (steps[0].get("pattern") or {}).get("Regex", "")


def safe_at_white_space(spec: dict) -> bool:
    """True if the pre-tokeniser never lets a token hold or depend on white space."""
    first, pattern = pattern_of(spec)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [first]
    drops = first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and "\\s*" not in pattern and " ?" not in pattern
    stripped = any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    prefixed = any(s.get("add_prefix_space") for s in steps)
    return bool(drops) and not stripped and not prefixed


def segments(body: bytes, limit: int = GROUP_BYTES) -> Iterator[bytes]:
    """Cut a long text into pieces of about ``limit`` bytes, at ASCII white space only.

    No token reaches across it, so the pieces' ids follow each other. A run without white space stays whole.
    """
    at = 0
    while len(body) - at > limit:
        end = at + limit
        found = [p for p in (body.find(c, end) for c in (b" ", b"\n", b"\t", b"\r")) if p >= 0]
        if not found:
            break
        yield body[at : min(found)]
        at = min(found)
    yield body[at:] if at else body


def find_words(data: np.ndarray, apart: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; ``data`` begins with two white spaces and ends with one.

    apart: signs at the end of a word are a word of their own after a letter or digit (ASCII, or Latin of two bytes: U+00C0 to U+017F without
    the two signs among them and without the capital I with a dot, whose lower case ends in a combining dot).
    """
    kind = KIND[data]
    edge = np.diff((kind != SPACE).view(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    if not apart:
        return start, end
    edge = np.diff((kind == SIGN).view(np.int8))
    first, after = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    last, lead = data[first - 1], data[first - 2]
    latin = ((lead == 0xC4) & (last != 0xB0)) | (lead == 0xC5) | ((lead == 0xC3) & (last != 0x97) & (last != 0xB7))
    cut = first[(kind[after] == SPACE) & (LETTER[last] | (latin & (last >= 0x80)))]
    return np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))


def hashed(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of 64 and one of 32 bits of every word, byte by byte for all words at once."""
    order = np.argsort(-length, kind="stable")
    at = start[order]
    a, b = np.full(len(at), 0xCBF29CE484222325, dtype=np.uint64), np.full(len(at), 0x9E3779B9, dtype=np.uint32)
    reach = np.searchsorted(-length[order], -np.arange(1, (int(length.max()) if len(length) else 0) + 1), side="right")
    for j, m in enumerate(reach.tolist()):
        c = data[at[:m] + j]
        a[:m] = (a[:m] ^ c) * np.uint64(0x100000001B3)
        b[:m] = (b[:m] + c) * np.uint32(0x85EBCA6B)
        b[:m] ^= b[:m] >> np.uint32(15)
    wide, narrow = np.empty_like(a), np.empty_like(b)
    wide[order], narrow[order] = a, b
    return wide, narrow


class Memo:
    """Known words: sorted hashes, and for each a check, the place and number of its ids."""

    def __init__(self):
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.check, self.at, self.n = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 if it is not known."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        pos = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[pos] == keys, self.slots[pos], -1).astype(np.int64)

    def add(self, keys: np.ndarray, check: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        """``keys`` ascend and are new; ``ids`` are those of all words, one after the other (none if only counted)."""
        pos = np.searchsorted(self.keys, keys)
        self.slots = np.insert(self.slots, pos, np.arange(len(self.check), len(self.check) + len(keys), dtype=np.int32))
        self.keys = np.insert(self.keys, pos, keys)
        self.check = np.concatenate([self.check, check])
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
        self.n = np.concatenate([self.n, n.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``at .. at + n - 1``, one range after the other."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class WordEncoder:
    """Ids of texts, with a memory for words. ``counts=True`` remembers and returns only how many there are."""

    def __init__(self, path: str, counts: bool = False):
        spec = settings_of(path)
        if not safe_at_white_space(spec):
            raise ValueError(f"{path}: its tokens can reach across white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.normalizer = self.tokenizer.normalizer
        lowers = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        # lower-case Latin words pass these normalisers unchanged, so that they are encoded without them
        self.skips = set(lowers) <= {"NFC", "NFD", "NFKC", "Replace", "Lowercase"} and "Lowercase" in lowers
        self.latin = self.skips and not set(lowers) & {"NFD", "NFKC"}
        self.apart = pattern_of(spec)[1] == LETTERS_APART
        special = next((t for t in spec.get("added_tokens", []) if t["special"] and t["content"].startswith("<|")), None)
        self.mark = special["id"] if special else None
        self.separator = f" {special['content']} ".encode() if special else b""
        self.counts = counts
        self.newer, self.older = Memo(), Memo()

    def _batch(self, lines: list[str], plain: bool) -> list:
        self.tokenizer.normalizer = None if plain else self.normalizer
        return self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)

    def _joined(self, words: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word and all ids: many words in a line, told apart by a special token between them."""
        if self.mark is None:
            found = [d.ids for d in self._batch([w.decode("utf-8", "replace") for w in words], plain)]
            return np.array([len(x) for x in found], dtype=np.int64), np.array([i for x in found for i in x], dtype=np.uint32)
        lines = [self.separator.join(words[at : at + JOINED_WORDS]).decode("utf-8", "replace") for at in range(0, len(words), JOINED_WORDS)]
        counts, ids = [], []
        for done in self._batch(lines, plain):
            own = np.array(done.ids, dtype=np.uint32)
            ends = np.append(np.flatnonzero(own == self.mark), len(own))
            counts.append(np.diff(ends, prepend=-1) - 1)
            ids.append(own[own != self.mark])
        return np.concatenate(counts), np.concatenate(ids)

    def _learned(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids in the order of the words. No word holds ``<|``."""

        def unchanged(w: bytes) -> bool:
            return not UPPER.search(w) if w.isascii() else self.latin and bool(LATIN.fullmatch(w.decode("utf-8", "replace")))

        plain = np.array([self.skips and unchanged(w) for w in words], dtype=bool)
        n, at, ids = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64), []
        done = 0
        for chosen, easy in ((np.flatnonzero(plain), True), (np.flatnonzero(~plain), False)):
            if len(chosen):
                n[chosen], own = self._joined([words[i] for i in chosen.tolist()], easy)
                at[chosen] = done + np.cumsum(n[chosen]) - n[chosen]
                ids.append(own)
                done += len(own)
        return n, np.concatenate(ids)[spread(at, n)] if ids else np.empty(0, np.uint32)

    def _known(self, keys: np.ndarray, check: np.ndarray, word: list) -> np.ndarray:
        """Slots in the newer half for ``keys`` (ascending, different); words that are not known are learned. ``word(i)`` gives the bytes of the i-th."""
        if len(self.newer.keys) > MEMO_WORDS:
            self.newer, self.older = Memo(), self.newer
        slot = self.newer.find(keys)
        missing = np.flatnonzero(slot < 0)
        old = self.older.find(keys[missing])
        kept, old = missing[old >= 0], old[old >= 0]
        if len(kept):
            ids = self.older.ids[spread(self.older.at[old], self.older.n[old])] if not self.counts else np.empty(0, np.uint32)
            self.newer.add(keys[kept], self.older.check[old], self.older.n[old], ids)
        new = np.setdiff1d(missing, kept, assume_unique=True)
        if len(new):
            n, ids = self._learned([word(i) for i in new.tolist()])
            self.newer.add(keys[new], check[new], n, ids if not self.counts else np.empty(0, np.uint32))
        return self.newer.find(keys) if len(missing) else slot

    def _group(self, bodies: list[bytes]) -> list:
        """Ids (or their number) of texts without ``<|``."""
        joined = b"  " + b" ".join(bodies) + b" "
        data = np.frombuffer(joined, dtype=np.uint8)
        if self.skips:
            data = LOWERED[data]
            joined = data.tobytes()
        start, end = find_words(data, self.apart)
        length = end - start
        owner = np.searchsorted(1 + np.cumsum([len(b) + 1 for b in bodies]), start, side="left")
        short = length <= LONGEST
        some = np.flatnonzero(short)
        wide, narrow = hashed(data, start[some], length[some])
        keys, first, which = np.unique(wide, return_index=True, return_inverse=True)
        slots = self._known(keys, narrow[first], lambda i: joined[start[some[first[i]]] : end[some[first[i]]]])
        own = slots[which]
        n, at = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        n[some], at[some] = self.newer.n[own], self.newer.at[own]
        # long words, and (in theory) words whose first hash is that of another word
        rest = np.concatenate([np.flatnonzero(~short), some[self.newer.check[own] != narrow]])
        pool = self.newer.ids
        if len(rest):
            n[rest], ids = self._learned([joined[a:b] for a, b in zip(start[rest].tolist(), end[rest].tolist(), strict=True)])
            at[rest] = len(pool) + np.cumsum(n[rest]) - n[rest]
            pool = np.concatenate([pool, ids])
        sizes = np.bincount(owner, weights=n, minlength=len(bodies)).astype(np.int64)
        if self.counts:
            return sizes.tolist()
        raw, stops = pool[spread(at, n)].astype("<u4").tobytes(), np.cumsum(4 * sizes).tolist()
        return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _whole(self, body: bytes) -> bytes | int:
        """A text that may hold special strings, by the library alone."""
        ids = self._batch([body.decode("utf-8", "replace")], False)[0].ids
        return len(ids) if self.counts else np.array(ids, dtype="<u4").tobytes()

    def _long(self, body: bytes) -> bytes | int:
        parts = [self._whole(p) if b"<|" in p else self._group([p])[0] for p in segments(body)]
        return sum(parts) if self.counts else b"".join(parts)

    def encode(self, bodies: list[bytes]) -> list:
        """Per text its packed ids (``<u4``), or their number."""
        plain = [i for i, b in enumerate(bodies) if len(b) <= GROUP_BYTES and b"<|" not in b]
        out: list = [None] * len(bodies)
        if plain:
            for i, found in zip(plain, self._group([bodies[i] for i in plain]), strict=True):
                out[i] = found
        for i, found in enumerate(out):
            if found is None:
                out[i] = self._long(bodies[i])
        return out


@lru_cache(maxsize=1)
def encoder(path: str, counts: bool = False) -> WordEncoder:
    """One per worker process; kept from task to task."""
    return WordEncoder(path, counts)
