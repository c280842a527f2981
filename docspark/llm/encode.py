"""Token ids of whole texts, with a cache of the pieces that texts are made of."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from operator import attrgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of a generation of each of a task's two caches, and the longest that is kept.
UNITS, CHUNKS, LONGEST = 500_000, 400_000, 64
#: Code points encoded at a time; a longer text is cut where no token can span.
SLICE = 1 << 20
#: Bytes of texts whose distinct chunks are looked up together; a quarter of it for byte-level files, which give more ids.
TOGETHER = 1 << 24

# White space other than space and newline: a text that has it is encoded whole by byte-level files.
_OTHER = "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_ODD = re.compile(_OTHER)
# A text that has it, white space at its ends or runs of it, in the syntax of Arrow.
_UNEVEN = f"{_OTHER}|\\A[ \n]|[ \n]\\z|[ \n][ \n]"
# Pieces that end where the tokenizer always starts anew: a run of Latin letters, or of ASCII marks that no letter's
# apostrophe opens, before ASCII; a newline before other text. Anything else stands with all up to the next white space.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]++(?![^\x00-\x7f])"
_MARKS = "[!-&(-/:-@\\[-`{-~][!-/:-@\\[-`{-~]*+(?=[A-Za-z0-9 \n]|\\Z)"
_SPACED = re.compile(f" ?{_LETTERS}| ?{_MARKS}|\n(?!\\s|\\Z)|[ \n]*[^ \n]+|[ \n]+")
_PLAIN = re.compile(f"{_LETTERS}|{_MARKS}|[^ \n]+")
# A piece that the tokenizer does not split further.
_UNIT = re.compile(f" ?{_LETTERS}| ?{_MARKS}|\n")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTER_OF = byte_letters()
_SPACE = _LETTER_OF[ord(" ")]
_ID = attrgetter("id")


class Kept(dict):
    """Ids by piece, made when first asked for. A full generation becomes the old one, from which what is asked for
    again is taken over, so that pieces seen once go and those that return stay."""

    most = 0

    def __init__(self):
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
            if len(piece) > LONGEST:
                return ids
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Units(Kept):
    """Ids of pieces."""

    def __init__(self, tokenizer, kind: str):
        super().__init__()
        self.tokenizer, self.model, self.kind = tokenizer, tokenizer.model, kind

    def make(self, piece: str) -> bytes:
        if self.kind == "plain" and piece.isascii() and piece.isalpha():
            ids = map(_ID, self.model.tokenize(piece.lower()))
        elif self.kind and _UNIT.fullmatch(piece):
            unit = (piece if self.kind == "spaced" else piece.lower()).encode().decode("latin-1").translate(_LETTER_OF)
            ids = map(_ID, self.model.tokenize(unit))
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return array("I", ids).tobytes()


class Chunks(Kept):
    """Ids of what stands between two spaces, put together from its pieces."""

    def __init__(self, units: Units, pattern: re.Pattern, lead: str):
        super().__init__()
        self.units, self.pattern, self.lead = units, pattern, lead

    def make(self, part: str) -> bytes:
        if part.isascii() and part.isalpha():
            # one piece, which is remembered here
            return array("I", map(_ID, self.units.model.tokenize(_SPACE + part))).tobytes() if self.lead else self.units.make(part)
        chunk = part if part[:1] == "\n" else self.lead + part
        return b"".join(map(self.units.__getitem__, self.pattern.findall(chunk)))


class Encoder:
    """Ids by the ``tokenizers`` library, ``add_special_tokens=False``; the strings of special tokens are plain text.

    Distinct pieces are encoded by the library and remembered. That gives the ids of the whole text, because both
    known kinds of files split a text before they merge: byte-level ones at the start of each run of white space,
    word-level ones at white space, which they drop. A file of another kind is used on whole texts.
    """

    def __init__(self, path: str, units: int = UNITS, chunks: int = CHUNKS):
        # Spark runs a task per core already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = _kind(json.loads(Path(path).read_text()))
        self.units = Units(self.tokenizer, self.kind)
        spaced = self.kind == "spaced"
        self.chunks = Chunks(self.units, _SPACED if spaced else _PLAIN, " " if spaced else "")
        self.units.most, self.chunks.most = units, chunks
        # fewer entries ask for less memory, so that fewer texts are taken together
        self.together = max(1, (TOGETHER if self.kind == "plain" else TOGETHER // 4) * min(chunks, CHUNKS) // CHUNKS)

    def _slice(self, text: str) -> bytes:
        if self.kind == "plain":
            text = text.lower() if text.isascii() else text
            return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))
        if not self.kind or _ODD.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return b"".join(map(self.units.__getitem__, _SPACED.findall(text)))
        # white space is single here: each starts a chunk of its own
        first, *parts = text.replace("\n", " \n").split(" ")
        head = map(self.units.__getitem__, _SPACED.findall(first))
        return b"".join([*head, *map(self.chunks.__getitem__, parts)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text as unsigned 32-bit integers."""
        out, lo = [], 0
        while lo < len(text):
            hi = self._cut(text, lo)
            out.append(self._slice(text[lo:hi]))
            lo = hi
        return np.frombuffer(b"".join(out), np.uint32)

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; null counts as empty. Equal chunks of neighbouring texts are looked up once."""
        texts = pc.fill_null(texts, "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        lo, ends = 0, np.cumsum(sizes, dtype=np.int64)
        while lo < len(texts):
            if not self.kind or sizes[lo] > SLICE:
                yield self.encode(texts[lo].as_py())
                lo += 1
                continue
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - sizes[lo] + self.together, side="right")))
            large = np.flatnonzero(sizes[lo:hi] > SLICE)
            hi = lo + int(large[0]) if len(large) else hi
            yield from self._together(texts.slice(lo, hi - lo))
            lo = hi

    def _together(self, texts: pa.Array) -> Iterator[np.ndarray]:
        spaced, uneven = self.kind == "spaced", None
        if spaced:
            uneven = pc.match_substring_regex(texts, _UNEVEN)
            parts = pc.split_pattern(pc.replace_substring(pc.if_else(uneven, "", texts), "\n", " \n"), " ")
        else:
            parts = pc.split_pattern(pc.replace_substring(pc.ascii_lower(texts), "\n", " "), " ")
        chunks, counts = parts.flatten(), pc.list_value_length(parts).to_numpy()
        if spaced:
            # the chunk at the start of a text has no space before it
            begins = np.cumsum(counts) - counts
            inner = np.ones(len(chunks), bool)
            inner[begins] = False
            heads = [b"".join(map(self.units.__getitem__, _SPACED.findall(h))) for h in chunks.take(pa.array(begins)).to_pylist()]
            chunks = pc.if_else(pa.array(inner), chunks, None)
        coded = chunks.dictionary_encode()
        ids = list(map(self.chunks.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)))
        code = pc.fill_null(coded.indices, 0).to_numpy()
        if spaced:
            code = code.copy()
            code[begins] = len(ids) + np.arange(len(begins))
            ids += heads
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, first = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(size) - size
        each = size[code]
        end = np.concatenate([[0], np.cumsum(each)])
        spot = np.repeat(first[code] - end[:-1], each)
        spot += np.arange(end[-1])
        out = flat[spot]
        # chunks of each text, then ids
        at = end[np.concatenate([[0], np.cumsum(counts)])]
        alone = set(np.flatnonzero(uneven.to_numpy(zero_copy_only=False)).tolist()) if spaced else ()
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            yield self.encode(texts[k].as_py()) if k in alone else out[a:b]

    def _cut(self, text: str, lo: int) -> int:
        """End of the slice that starts at ``lo``: before a space that follows no white space, or the end."""
        if len(text) - lo <= SLICE or not self.kind:
            return len(text)
        at = text.find(" ", lo + SLICE)
        while at >= 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        return at if at >= 0 else len(text)


def _kind(file: dict) -> str:
    """"spaced" or "plain" if the file's rules are those the pieces are made for, else empty."""
    normal, split, model = file.get("normalizer"), file.get("pre_tokenizer") or {}, file["model"]
    if file.get("post_processor") and file["post_processor"]["type"] != "ByteLevel" or model["type"] != "BPE":
        return ""
    if normal is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space"):
        return "spaced"
    kinds = [n["type"] for n in (normal or {}).get("normalizers", [])]
    steps = split.get("pretokenizers", [])
    if kinds == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"]:
        first, second = steps
        if first["behavior"] == "Removed" and first["invert"] and not second["use_regex"] and "\\s\\p{L}" in first["pattern"].get("Regex", ""):
            return "plain"
    return ""


_encoders: dict[str, Encoder] = {}


def encoder(path: str, units: int = UNITS, chunks: int = CHUNKS) -> Encoder:
    """One encoder per file and task process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, units, chunks)
    return _encoders[path]


def forget() -> None:
    """Drop the encoders of a task process that has no more texts to encode."""
    _encoders.clear()
