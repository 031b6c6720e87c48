"""Token ids of whole texts inside Spark tasks, by a public tokenizer file.

``Encoder`` gives what the file's library gives.  For Hugging Face files whose
pre-tokenizer never lets a token cross certain spaces, a text is cut there and each
distinct chunk is encoded once and kept in a bounded table of two generations, since words
repeat; other files and other texts are encoded whole.  Files whose pre-tokens follow from the
kinds of neighbouring characters have Latin-1 texts cut into these, many texts at a time, and
new words go to the file's model at once, past the normalizer and the pattern.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa

from .common import kept

#: Limits of a generation of the table; beyond them a new one begins, and what is used again moves there.
MAX_CHUNKS = 250_000
MAX_CHUNK_CHARS = 12_000_000
#: Texts that go to the library in one call.
BATCH = 256
#: New words that go to it as one text.
JOINED = 5000

#: A space beside other white space, or at an end: such texts are not cut by single spaces.
_LOOSE = re.compile(r"^\s|\s$| \s|\s ")

#: The pattern whose pre-tokens are runs of letters, digits, runs of other characters, and these short forms.
_BY_KIND = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Each Latin-1 character's lower case, and its kind.  All of them are in NFC.
_LOWER = "".join(map(chr, range(256))).lower().encode("latin-1")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.asarray([_SPACE if c in b"\t\n\x0b\x0c\r \x85\xa0" else {"L": _LETTER, "N": _DIGIT}.get(unicodedata.category(chr(c))[0], _OTHER)
                    for c in range(256)], np.uint8)
#: A word that a normalizer to lower case leaves as it is.
_LATIN_WORD = re.compile("[a-z\xdf-\xf6\xf8-\xff]+").fullmatch


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file: another version has other counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Encoder:
    """Ids of texts, without begin, end or added special tokens, truncation or padding."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.cut, self.leading, self.by_kind = None, False, False
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._whole = lambda texts: model.encode(list(texts), num_threads=1)
        elif path.endswith(".json"):
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self._whole = lambda texts: [e.ids for e in tok.encode_batch_fast(list(texts), add_special_tokens=False)]
            with open(path, "rb") as f:
                self.cut, self.leading, self.by_kind = _cut_of(json.load(f))
            if self.by_kind:
                self._model, self._byte_chars = tok.model, _byte_chars()
            vocab = tok.get_vocab(with_added_tokens=False)
            self.edge = np.zeros(max(tok.get_vocab().values()) + 1, bool)
            self.edge[[i for t, i in vocab.items() if (t[0] == "\u0120" if self.leading else t.endswith("</w>"))]] = True
        else:
            raise ValueError(f"not a tokenizer file: {path}")
        self.clear()

    def clear(self) -> None:
        """Forget all chunks."""
        self._begin()
        self._old: tuple[dict[str, int], np.ndarray, np.ndarray] | None = None

    def _begin(self) -> None:
        #: Chunk to its number; chunk i has the ids ``_flat[_starts[i]:_starts[i + 1]]``.
        self._at: dict[str, int] = {}
        self._starts, self._flat, self._chars = np.zeros(1, np.int64), np.zeros(0, np.uint32), 0

    def _add(self, chunks: list[str], flat: np.ndarray, ends: np.ndarray) -> None:
        n = len(self._starts) - 1
        self._at.update(zip(chunks, range(n, n + len(chunks)), strict=True))
        self._starts = np.concatenate([self._starts, len(self._flat) + ends])
        self._flat = np.concatenate([self._flat, flat])
        self._chars += sum(map(len, chunks))

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered chunks one after another, and where each chunk's ids end."""
        return _gathered(codes, self._starts, self._flat)

    def _learn(self, chunks: list[str]) -> None:
        """Add new chunks.  A word with a comma or full stop behind it has the word's ids, then the mark's."""
        if self.by_kind:
            self._learn_latin([c for c in chunks if _LATIN_WORD(c)])
            chunks = self._learn_composed([c for c in chunks if c not in self._at])
        is_letter = str.isalpha if self.leading else _ends_in_letter
        stem = {c: c[:-1] for c in chunks if c[-1] in ",." and len(c) > 2 and is_letter(c[-2])}
        words = [c for c in dict.fromkeys([*(stem.get(c, c) for c in chunks), *(",." if stem else "")]) if c not in self._at]
        is_plain = (lambda w: w[0] == " " and w[1:].isalpha()) if self.leading else str.isalpha
        plain = [w for w in words if is_plain(w)]
        alone = [w for w in words if not is_plain(w)]
        for k in range(0, len(plain), JOINED):
            alone += self._learn_joined(plain[k:k + JOINED])
        self._learn_alone(alone)
        if stem:
            pairs = np.fromiter((self._at[x] for c, w in stem.items() for x in (w, c[-1])), np.int64, 2 * len(stem))
            flat, ends = self._gather(pairs)
            self._add(list(stem), flat, ends[1::2])

    def _learn_alone(self, chunks: list[str]) -> None:
        """Add chunks, each encoded as a text."""
        for k in range(0, len(chunks), BATCH):
            part = chunks[k:k + BATCH]
            ids = self._whole(part)
            self._add(part, np.asarray([x for i in ids for x in i], np.uint32), np.cumsum([len(i) for i in ids]))

    def _learn_composed(self, chunks: list[str]) -> list[str]:
        """Add chunks of Latin-1 characters, which have the ids of their pre-tokens; gives back the others."""
        latin = {c: b for c in chunks if (b := _latin(c)) is not None}
        pieces, at, ends = _pieces(list(latin.values()))
        if len(at):
            new = [p for p in pieces if p not in self._at]
            self._learn_latin([p for p in new if _LATIN_WORD(p)])
            self._learn_alone([p for p in new if not _LATIN_WORD(p)])
            flat, to = self._gather(np.fromiter(map(self._at.__getitem__, pieces), np.int64, len(pieces))[at])
            self._add(list(latin), flat, np.r_[0, to][ends])
        return [c for c in chunks if c not in self._at]

    def _learn_latin(self, words: list[str]) -> None:
        """Add words that are one pre-token each, which the file's model takes as characters for bytes."""
        flat: list[int] = []
        ends = []
        if words:
            for w in codecs.charmap_decode(" ".join(words).encode(), "strict", self._byte_chars)[0].split(" "):
                flat += [t.id for t in self._model.tokenize(w)]
                ends.append(len(flat))
            self._add(words, np.asarray(flat, np.uint32), np.asarray(ends, np.int64))

    def _learn_joined(self, words: list[str]) -> list[str]:
        """Add words of letters alone, encoded as one text; gives back those not added.

        The form of a token tells where a word begins or ends.  Each word has at least one
        such token, so if there are as many as words, each word has exactly one.
        """
        ids = np.asarray(self._whole([("" if self.leading else " ").join(words)])[0], np.uint32)
        edge = np.flatnonzero(self.edge[ids])
        if len(edge) != len(words):
            return words
        self._add(words, ids, np.r_[edge[1:], len(ids)] if self.leading else edge + 1)
        return []

    def _codes(self, chunks: list[str]) -> np.ndarray:
        if len(self._at) > MAX_CHUNKS or self._chars > MAX_CHUNK_CHARS:
            self._old = (self._at, self._starts, self._flat)
            self._begin()
        codes = np.fromiter(map(self._at.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(codes < 0)
        if len(new):
            missing = [chunks[i] for i in new.tolist()]
            unknown = list(dict.fromkeys(missing))
            if self._old:
                at, starts, flat = self._old
                again = [c for c in unknown if c in at]
                if again:
                    self._add(again, *_gathered(np.fromiter(map(at.__getitem__, again), np.int64, len(again)), starts, flat))
                    unknown = [c for c in unknown if c not in at]
            if unknown:
                self._learn(unknown)
            codes[new] = np.fromiter(map(self._at.__getitem__, missing), np.int64, len(missing))
        return codes

    def _chunks(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the texts' chunks, one text's after another's, and (begin, end) of each text's in them."""
        latin = [_latin(t) if self.by_kind else None for t in texts]
        chunks, at, ends = _pieces([b for b in latin if b is not None])
        first = len(chunks)
        rest = []
        for t, b in zip(texts, latin, strict=True):
            if b is None:
                chunks += self.cut(t)
                rest.append(len(at) + len(chunks) - first)
        codes = self._codes(chunks)
        ends = np.r_[0, ends, np.asarray(rest, np.int64)]
        spans = np.empty((len(texts), 2), np.int64)
        spans[np.argsort([b is None for b in latin], kind="stable")] = np.c_[ends[:-1], ends[1:]]
        return np.r_[codes[at], codes[first:]], spans

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """Number of tokens of each text."""
        if self.cut is None:
            return np.asarray([len(x) for x in self._whole(texts)], np.int64)
        codes, spans = self._chunks(texts)
        sums = np.r_[0, np.cumsum(np.diff(self._starts)[codes])]
        return sums[spans[:, 1]] - sums[spans[:, 0]]

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Token ids of each text, unsigned 32-bit."""
        if self.cut is None:
            return [np.asarray(x, np.uint32) for x in self._whole(texts)]
        codes, spans = self._chunks(texts)
        if not len(codes):
            return [np.zeros(0, np.uint32) for _ in texts]
        flat, to = self._gather(codes)
        return [flat[a:z] for a, z in np.r_[0, to][spans].tolist()]


def _ends_in_letter(c: str) -> bool:
    """Whether the normalizer's form of a letter does: some, as \u0130, become a letter and a mark."""
    return c.isalpha() and (c.isascii() or unicodedata.normalize("NFC", c).lower()[-1].isalpha())


def _byte_chars() -> str:
    """The library's character for each byte; a space, which separates words, stays."""
    from tokenizers.pre_tokenizers import ByteLevel
    level, chars = ByteLevel(add_prefix_space=False, use_regex=False), ["\ufffe"] * 256
    for c in map(chr, range(256)):
        for b, x in zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True):
            chars[b] = x
    return "".join([*chars[:32], " ", *chars[33:]])


def _latin(text: str) -> bytes | None:
    """Lower-case Latin-1 bytes; none if another character or maybe a special string is in the text."""
    if "<|" in text:
        return None
    try:
        return text.encode("latin-1").translate(_LOWER)
    except UnicodeEncodeError:
        return None


def _pieces(texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pre-tokens of Latin-1 texts: the distinct ones, the place of each among them, and where each text's end."""
    if not texts:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    kind = _KIND[chars]
    begins = kind != _SPACE
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    # An apostrophe alone before letters takes those of a short form.  A line end is behind all.
    quote = np.flatnonzero(begins & (chars == ord("'")))
    quote = quote[kind[quote + 1] == _LETTER]
    one, two = chars[quote + 1], chars[quote + 2]
    size = 2 * np.isin(one, list(b"stmd"))
    for a, b in (b"re", b"ve", b"ll"):
        size += 3 * ((one == a) & (two == b))
    quote, size = quote[size > 0], size[size > 0]
    begins[quote + 1] = False
    begins[quote + size] |= kind[quote + size] == _LETTER
    at = np.flatnonzero(begins)
    ends = np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts]))
    if not len(at):
        return [], np.zeros(0, np.int64), ends
    inside = kind != _SPACE
    offsets = np.zeros(len(at) + 1, np.int32)
    np.cumsum(np.add.reduceat(inside, at, dtype=np.int32), out=offsets[1:])
    found = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(chars[inside])]).dictionary_encode()
    _, cuts, data = found.dictionary.buffers()
    cuts, data = np.frombuffer(cuts, np.int32, len(found.dictionary) + 1).tolist(), data.to_pybytes().decode("latin-1")
    return [data[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)], found.indices.to_numpy(), ends


def _gathered(codes: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the numbered chunks of a table one after another, and where each chunk's ids end."""
    size = np.diff(starts)[codes]
    ends = np.cumsum(size)
    return flat[np.repeat(starts[codes] - (ends - size), size) + np.arange(ends[-1])], ends


def _cut_of(spec: dict):
    """How texts may be cut for this file (or None), whether chunks begin with their space, and whether
    Latin-1 texts may be cut by the kinds of their characters.

    Byte-level files whose pattern takes one space into the token after it: before single
    spaces between other characters.  Files that drop white space between tokens: at
    white space, which no normalizer step joins to a neighbour.
    """
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        def before_spaces(t: str) -> list[str]:
            if _LOOSE.search(t):
                return [t] if t else []
            first, *rest = t.split(" ")
            return [first, *[" " + x for x in rest]] if t else []
        return before_spaces, True, False
    steps = pre.get("pretokenizers") or []
    if (len(steps) == 2 and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
            and r"[^\s" in (steps[0].get("pattern") or {}).get("Regex", "") and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex")
            and not steps[1].get("add_prefix_space")
            and {x.get("type") for x in norm.get("normalizers", [])} <= {"NFC", "Replace", "Lowercase"}):
        def at_blanks(t: str) -> list[str]:
            # Case does not matter to them; special strings are looked for before that, so texts that may hold one stay.
            if t.isascii() and "<|" not in t:
                t = t.lower()
            # split() also cuts at U+001C to U+001F, which are no white space to the library.
            return t.split() if not any(c in t for c in "\x1c\x1d\x1e\x1f") else [x for x in t.replace("\n", " ").split(" ") if x]
        names = [x.get("type") for x in norm.get("normalizers", [])]
        return at_blanks, False, steps[0]["pattern"]["Regex"] == _BY_KIND and "Lowercase" in names and (spec.get("model") or {}).get("type") == "BPE"
    return None, False, False


def encoder(path: str) -> Encoder:
    """This worker's encoder for the file, loaded once."""
    held = kept("tokenizer")
    if path not in held:
        held.clear()
        held[path] = Encoder(path)
    return held[path]


def slices(texts: Sequence[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` of about ``chars`` characters each, one text at least."""
    a = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield a, i
            a, held = i, 0
        held += len(t)
    if a < len(texts):
        yield a, len(texts)
