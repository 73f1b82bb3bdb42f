"""Public tokenizers inside Spark tasks, with a bounded cache of encoded chunks.

Encoding a text piece by piece gives the ids of encoding it whole as long as
no pre-token of the tokenizer crosses a cut.  Two ways of cutting are used:

* ``byte`` (byte-level BPE): before a single space and around a single line
  feed that stand between non-blank characters.  A text with any other run of
  blanks, a NUL, or the opening of a special token is encoded whole.
* ``word`` (BPE that drops white space): at every space and line feed, except
  in a text with the opening of a special token, which is encoded whole.

A third class does the same for a sentencepiece model (``piece``).

Words repeat, so most chunks come from the cache and the merges run only once
per distinct word; new words are encoded many at a time.  The cache holds two
generations of ``CACHE_CHUNKS`` / 2 entries: when the younger is full it becomes the older, and
what is met again moves over, so memory stays bounded on any vocabulary.

Whole columns of texts are cut as UTF-8 bytes, in slices of ``SLICE_BYTES``: there a closing mark
after an ASCII letter or digit begins a chunk of its own, Arrow tells the distinct chunks of a slice,
only those are looked up, and numpy puts the ids of all texts together.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_CHUNKS = 1_000_000  # entries (about 200 MB) a Python worker keeps
SLICE_BYTES = 4 << 20  # texts of a column that are cut at a time, or one longer text

_CLOSING = ".,!?;:*#%$&@+=~^_/|()[]{}\"-"  # neither letters nor digits, no apostrophe
_LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")  # one pre-token of either kind, normalised by lower case alone
_MARK = "\x01"
_RUNS = ("  ", " \n", "\n ", "\n\n", "\x00")
_BLANKS = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# What a byte of UTF-8 is: a blank to cut at, a line feed, an ASCII letter or digit, a closing mark; the rest
# is where a text that is encoded whole may be told by (other blanks, the opening of a special token).
_BLANK, _FEED, _ALNUM, _MARKS, _RARE = 1, 2, 4, 8, 16
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(0x20), 0xC2, 0xE1, 0xE2, 0xE3, ord("<")]] = _RARE
_CLASS[[ord(" "), ord("\n")]] = _BLANK, _BLANK | _FEED
_CLASS[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = _ALNUM
_CLASS[[*_CLOSING.encode()]] = _MARKS
_LOADED: dict[tuple, "ChunkTokenizer | PieceTokenizer"] = {}


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file; ``folder`` overrides the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def irregular(text: str) -> bool:
    """Whether ``text`` has blanks other than single spaces and line feeds between non-blank characters, or a NUL."""
    return any(run in text for run in _RUNS) or _BLANKS.search(text) is not None


def chunks_of(text: str) -> list[str]:
    """The chunks of a text that is not irregular: words with the space before them, line feeds."""
    return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00")


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts without nulls, and where each begins in them, with the end of the last."""
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[bounds[0] : bounds[-1]], bounds - bounds[0]


class Chunked:
    """Encoding by chunks and their cache; subclasses cut texts and learn new chunks."""

    def __init__(self, fixed: dict, cached: int):
        self._fixed, self._cache, self._older, self._cached = fixed, dict(fixed), {}, cached

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of every text (None counts as empty), little-endian uint32."""
        out: list[bytes] = []
        for at in range(0, len(texts), 256):
            part = [t or "" for t in texts[at : at + 256]]
            cut = [self._chunks_of(t) for t in part]
            cache = self._met(c for c in cut if c)
            for text, chunks in zip(part, cut, strict=True):
                out.append(self._whole(text) if chunks is None else b"".join(map(cache.__getitem__, chunks)))
        return out

    def encode_chunks(self, chunks: Sequence[str]) -> list[bytes]:
        """Ids of chunks as ``chunks_of`` gives them."""
        return list(map(self._met([chunks]).__getitem__, chunks))

    def _met(self, cut: Iterable[Iterable[str]]) -> dict:
        """The cache, with all chunks of ``cut`` in it."""
        if len(self._cache) > self._cached // 2:
            self._older, self._cache = self._cache, dict(self._fixed)
        cache, older = self._cache, self._older
        missing = set(chain.from_iterable(cut)).difference(cache)
        if older:
            cache.update([(c, older[c]) for c in missing if c in older])
            missing = [c for c in missing if c not in cache]
        self._learn(missing)
        return cache


class _Spelled:
    """Chunks and their ids, one after the other in one array."""

    def __init__(self):
        self.codes: dict[str, int] = {}
        self.first, self.n, self._ids, self._used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 10, np.uint32), 0

    def add(self, chunks: Sequence[str], told: Sequence[bytes]) -> None:
        """Further chunks, none of them known, with their ids as bytes."""
        n = np.fromiter(map(len, told), np.int64, len(told)) // 4
        stop = self._used + int(n.sum())
        if stop > len(self._ids):
            self._ids = np.concatenate([self._ids[: self._used], np.empty(max(stop, 2 * self._used) - self._used, np.uint32)])
        self._ids[self._used : stop] = np.frombuffer(b"".join(told), "<u4")
        self.codes.update(zip(chunks, range(len(self.codes), len(self.codes) + len(chunks)), strict=True))
        self.first = np.concatenate([self.first, self._used + np.cumsum(n) - n])
        self.n, self._used = np.concatenate([self.n, n]), stop

    def told(self, code: int) -> bytes:
        return self._ids[self.first[code] : self.first[code] + self.n[code]].tobytes()

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many chunks, and where each chunk's end among them."""
        n = self.n[codes]
        ends = np.cumsum(n)
        at = np.repeat(self.first[codes] - (ends - n), n)
        at += np.arange(len(at))
        return self._ids[at], ends


class ChunkTokenizer(Chunked):
    """Encodes texts to ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, kind: str, plain: bool = False, cached: int | None = None):
        """``plain``: strings of special tokens inside a text are ordinary text."""
        if kind not in ("byte", "word"):
            raise ValueError(f"unknown kind of tokenizer: {kind}")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = plain
        self._kind, self._plain = kind, plain
        self._chunks_of = self._chunks
        self._model = self._tok.model
        self._shown = {k: token for k, token in enumerate(byte_tokens())}
        if kind == "byte":
            self._line_feed = self._tok.token_to_id("\u010a")
            # Ids whose token begins with a space: inside joined chunks, the first of each.
            self._spaced = {k for token, k in self._tok.get_vocab().items() if token.startswith("\u0120")}
        else:
            self._mark = self._tok.encode(_MARK, add_special_tokens=False).ids
        self._young, self._old = _Spelled(), _Spelled()
        super().__init__({"": b""}, cached or CACHE_CHUNKS)

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        return [ids for at in range(0, len(texts), 256) for ids in self.encode_column(pa.array([t or "" for t in texts[at : at + 256]], pa.large_string()))]

    def encode_column(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of every text of a string column (null counts as empty), little-endian uint32."""
        texts = pc.fill_null(texts, "")
        wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        at = 0
        while at < len(texts):
            offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset + at : texts.offset + len(texts) + 1]
            stop = at + max(1, int(np.searchsorted(offsets, offsets[0] + SLICE_BYTES, "right")) - 1)
            yield from self._slice(texts.slice(at, stop - at))
            at = stop

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        data, bounds = _bytes_of(texts)
        whole = {k: self._whole(t) for k, t in self._unfit(texts, data, bounds)}
        if whole:
            kept = np.ones(len(texts), bool)
            kept[list(whole)] = False
            data, bounds = _bytes_of(pc.if_else(pa.array(kept), texts, ""))
        first = self._cuts(data, bounds)
        chunks = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.append(first, len(data))), pa.py_buffer(data)).dictionary_encode()
        codes = self._codes(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, ends = self._young.ids(codes[chunks.indices.to_numpy()])
        at = np.append(0, ends)[np.searchsorted(first, bounds)].tolist()
        for k in range(len(texts)):
            yield whole[k] if k in whole else ids[at[k] : at[k + 1]].tobytes()

    def _unfit(self, texts: pa.Array, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, str]]:
        """Places and texts of those that have to be encoded whole."""
        kinds = _CLASS[data]
        rare = np.flatnonzero(kinds == _RARE)
        then = data[np.minimum(rare + 1, len(data) - 1)]
        lead = data[rare]
        told = (lead == ord("<")) & (then == ord("|")) & (not self._plain)
        if self._kind == "byte":
            after = data[np.minimum(rare + 2, len(data) - 1)]
            told |= (lead < 0x20) | (lead == 0xC2) & ((then == 0x85) | (then == 0xA0)) | (lead == 0xE1) & (then == 0x9A)
            told |= (lead == 0xE2) & ((then == 0x81) | (then == 0x80) & ((after <= 0x8A) | (after >= 0xA8))) | (lead == 0xE3) & (then == 0x80)
            blank = kinds & _BLANK
            rare = np.concatenate([rare[told], np.flatnonzero(blank[1:] & blank[:-1])])
        else:
            rare = rare[told]
        for k in np.unique(np.searchsorted(bounds, rare, "right") - 1).tolist():
            text = texts[k].as_py()
            if self._chunks(text) is None:
                yield k, text

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the chunks of texts begin: at the texts' own bounds, at blanks, after line feeds (byte)
        and at a closing mark after an ASCII letter or digit, which no pre-token holds together."""
        kinds = _CLASS[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[:-1] = kinds & _BLANK
        cut[1:-1] |= (kinds[:-1] == _ALNUM) & (kinds[1:] == _MARKS)
        if self._kind == "byte":
            cut[1:] |= (kinds & _FEED).astype(bool)
        cut[bounds] = True
        return np.flatnonzero(cut[:-1])

    def _codes(self, chunks: list[str]) -> np.ndarray:
        """Places of chunks in the younger generation, which has them all afterwards."""
        if len(self._young.codes) > self._cached // 2:
            self._old, self._young = self._young, _Spelled()
        codes = np.fromiter(map(self._young.codes.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(codes < 0)
        names = [chunks[k] for k in missing.tolist()]
        codes[missing] = len(self._young.codes) + np.arange(len(names))
        told = list(map(self._old.codes.get, names))
        new = [c for c, k in zip(names, told, strict=True) if k is None]
        # In the word kind a chunk has the blank before it, which gives no id.
        words = new if self._kind == "byte" else [c.lstrip(" \n") for c in new]
        learnt = dict(self._fixed)
        self._spell(new if words is new else set(words).difference(learnt), learnt)
        spelled = map(learnt.__getitem__, words)
        self._young.add(names, [next(spelled) if k is None else self._old.told(k) for k in told])
        return codes

    def _whole(self, text: str) -> bytes:
        return array("I", self._tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunks(self, text: str) -> list[str] | None:
        """The chunks of ``text``, or None when it has to be encoded whole."""
        if self._kind == "byte":
            return None if irregular(text) or self._special(text) else chunks_of(text)
        return None if self._special(text) else text.replace("\n", " ").split(" ")

    def size(self) -> int:
        """Number of entries, special ones included."""
        return self._tok.get_vocab_size(with_added_tokens=True)

    def _special(self, text: str) -> bool:
        return not self._plain and "<|" in text

    def vocabulary(self) -> list[bytes]:
        """The bytes of every token of a byte-level vocabulary, by id."""
        back = {char: b for b, char in enumerate(byte_tokens())}
        entries = self._tok.get_vocab(with_added_tokens=False)
        out = [b""] * self._tok.get_vocab_size(with_added_tokens=True)
        for token, k in entries.items():
            out[k] = bytes(back[c] for c in token)
        return out

    def _learn(self, missing: Iterable[str]) -> None:
        self._spell(missing, self._cache)

    def _spell(self, missing: Iterable[str], known: dict[str, bytes]) -> None:
        """Put chunks into ``known``.  Closing marks are pre-tokens of their own after a letter or
        digit, so a word with marks is put together from the two."""
        missing, letters = list(missing), _LETTERS.fullmatch
        plain = [c for c in missing if letters(c)]
        known.update(zip(plain, self._merged(plain), strict=True))
        composed, need = [], set()
        for chunk in missing:
            if chunk in known:
                continue
            word = chunk.rstrip(_CLOSING)
            if len(word) < len(chunk) and word and word[-1].isalnum():
                composed.append((chunk, word))
                need.update((word, chunk[len(word) :]))
            else:
                need.add(chunk)
        need.difference_update(known)
        plain = [c for c in need if letters(c)]
        known.update(zip(plain, self._merged(plain), strict=True))
        new = list(need.difference(plain))
        for at in range(0, len(new), 4096):
            self._encode_new(new[at : at + 4096], known)
        for chunk, word in composed:
            known[chunk] = known[word] + known[chunk[len(word) :]]

    def _merged(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens as they are: the merges alone, without normalizer and pre-tokenizer."""
        merged, shown, space = self._model.tokenize, self._shown, self._shown[32]
        if self._kind == "word":
            words = [w.lower() for w in words]
        return [array("I", [t.id for t in merged(w.replace(" ", space) if w.isascii() else w.encode().decode("latin-1").translate(shown))]).tobytes() for w in words]

    def _encode_new(self, new: list[str], known: dict[str, bytes]) -> None:
        """Encode chunks, joined to few long texts that the tokenizer takes apart where they meet."""
        if self._kind == "byte":
            spaced = [c for c in new if len(c) > 1 and c[0] == " " and c[1] != " "]
            plain = [c for c in new if c[0] not in " \n"]
            rest = [c for c in new if c in (" ", "\n")]
            found = {}
            for group, glue in ((spaced, ""), (plain, "\n")):
                found.update(zip(group, self._taken_apart(group, glue), strict=True))
            found.update((c, self._tok.encode(c, add_special_tokens=False).ids) for c in rest)
        else:
            free = [c for c in new if _MARK not in c]
            found = dict(zip(free, self._taken_apart(free, f" {_MARK} "), strict=True))
            found.update((c, self._tok.encode(c, add_special_tokens=False).ids) for c in new if _MARK in c)
        for chunk in new:
            known[chunk] = array("I", found[chunk]).tobytes()

    def _taken_apart(self, group: list[str], glue: str) -> list[list[int]]:
        if not group:
            return []
        ids = self._tok.encode_batch_fast([glue.join(group)], add_special_tokens=False)[0].ids
        out: list[list[int]] = []
        if self._kind == "byte" and not glue:
            spaced = self._spaced
            for k in ids:
                if k in spaced:
                    out.append([])
                out[-1].append(k)
        else:
            end = self._line_feed if self._kind == "byte" else self._mark[0]
            out.append([])
            for k in ids:
                if k == end:
                    out.append([])
                else:
                    out[-1].append(k)
        if len(out) != len(group) or self._kind == "word" and len(self._mark) != 1:
            return [e.ids for e in self._tok.encode_batch_fast(group, add_special_tokens=False)]
        return out


def byte_tokens() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 characters
    for themselves, the others in order from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class PieceTokenizer(Chunked):
    """A sentencepiece model that puts a space before each text, over the same chunks.

    No piece holds a space after another character, nor a line feed, so merges stay within chunks.
    """

    def __init__(self, path: str, cached: int | None = None):
        import sentencepiece

        self._sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self._pieces = [self._sp.id_to_piece(k) for k in range(self._sp.get_piece_size())]
        self._joined = any("\u2581" in p.lstrip("\u2581") or "\n" in p for p in self._pieces)
        # Inside a line there is no space to add: the one added goes with a line feed that is cut off.
        self._skip = len(self._sp.encode("\n"))
        super().__init__({"": b"", " ": array("I", [self._sp.piece_to_id("\u2581")]).tobytes()}, cached or CACHE_CHUNKS)

    def vocabulary(self) -> list[bytes]:
        """The bytes of every piece, by id."""
        return [bytes([int(p[3:5], 16)]) if self._sp.is_byte(k) else p.replace("\u2581", " ").encode() for k, p in enumerate(self._pieces)]

    def _whole(self, text: str) -> bytes:
        return array("I", self._sp.encode(text, num_threads=1)).tobytes()

    def chunks(self, text: str) -> list[str] | None:
        """The chunks of a space and ``text``, or None when it has to be encoded whole."""
        if not text or self._joined or "\u2581" in text or irregular(" " + text):
            return None
        return chunks_of(" " + text)

    _chunks_of = chunks

    def _learn(self, missing: Iterable[str]) -> None:
        spaced, inner = [], []
        for c in missing:
            (spaced if c[0] == " " else inner).append(c)
        for chunk, ids in zip(spaced, self._sp.encode([c[1:] for c in spaced], num_threads=1), strict=True):
            self._cache[chunk] = array("I", ids).tobytes()
        for chunk, ids in zip(inner, self._sp.encode(["\n" + c for c in inner], num_threads=1), strict=True):
            self._cache[chunk] = array("I", ids[self._skip :]).tobytes()


def load(path: str, kind: str, plain: bool = False, cached: int | None = None) -> "ChunkTokenizer | PieceTokenizer":
    """The tokenizer of this worker process (loaded once, reused by later tasks); ``kind`` is byte, word or piece."""
    key = (path, kind, plain, cached)
    if key not in _LOADED:
        _LOADED[key] = PieceTokenizer(path, cached) if kind == "piece" else ChunkTokenizer(path, kind, plain, cached)
    return _LOADED[key]
