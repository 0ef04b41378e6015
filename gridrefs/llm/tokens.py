"""Tokenizing whole texts with a public byte-level BPE file, for use inside tasks.

A text is cut into pieces at places that the tokenizer never looks across. Arrow cuts all texts of
a batch and finds the distinct pieces; each goes to the ``tokenizers`` library once, and the
worker keeps a bounded cache of them. Ids are then gathered by array arithmetic. Texts in which
these places can't be told safely (neighbouring white space, special tokens) go through the
library whole, so ids are always its own.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cached pieces of a worker, in two generations: a full young one becomes the old one.
CACHE_PIECES = 250_000
#: Pieces whose ids are gathered at a time.
GROUP_PIECES = 1 << 17

#: Texts that go whole: white space at an end, next to other white space or other than blank and line end; \x01; special tokens.
_UNSURE = r"^[ \n]|[ \n]$|[ \n][ \n]|[\x01\t\r\x0B\x0C\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|<\|"
#: A full stop or comma between a Latin letter or digit and white space or the end.
_STOP = r"([0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([.,])([ \n]|$)"
#: Pieces that are one run of letters to the pre-tokenizer, with what may stand before them.
_LETTERS = re.compile("([\x01\n]?)([A-Za-zÀ-ÖØ-öø-ɏ]+)").fullmatch


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class PieceEncoder:
    """Encodes texts to little-endian id bytes, 2 bytes an id if the vocabulary allows."""

    def __init__(self, path: str, keep_special_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = keep_special_text
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")  # also array()'s H and I
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: Whether the pre-tokenizer is the byte-level one whose cuts are known.
        self.by_pieces = (
            "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)" in str(self.tokenizer.pre_tokenizer)
            and self.tokenizer.normalizer is None
            and all("<|" in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        )

    def _library(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.dtype.char, x.ids).tobytes() for x in got]

    def _encode_new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are not cached. A piece that starts with \\x01 or a line end stands without a blank before it."""
        kind, tokenize, letters = self.dtype.char, self.model.tokenize, self.letters
        before = {"": (b"", "Ġ"), "\x01": (b"", ""), "\n": (self._library(["\n"])[0], "")}
        out: list[bytes | None] = []
        rest = []
        for p in pieces:
            found = _LETTERS(p)
            if found:  # a single pre-token: the model alone encodes it
                mark, word = found.groups()
                first, blank = before[mark]
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(letters)
                out.append(first + array(kind, [t.id for t in tokenize(blank + word)]).tobytes())
            else:
                rest.append(p)
                out.append(None)
        plain = [p[1:] if p[0:1] == "\x01" else p if p[0:1] == "\n" else " " + p for p in rest]
        others = iter([x for i in range(0, len(plain), 20_000) for x in self._library(plain[i : i + 20_000])])
        return [next(others) if x is None else x for x in out]

    def _of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self.young) > CACHE_PIECES // 2:
            self.young, self.old = {}, self.young
        got = list(map(self.young.get, pieces))
        new = []
        for i in [i for i, x in enumerate(got) if x is None]:
            got[i] = self.old.get(pieces[i])
            if got[i] is None:
                new.append(i)
            else:
                self.young[pieces[i]] = got[i]
        for i, x in zip(new, self._encode_new([pieces[i] for i in new]), strict=True):
            got[i] = self.young[pieces[i]] = x
        return got

    def _encode_cut(self, texts: pa.Array) -> list[bytes]:
        """Id bytes of texts that are safe to cut."""
        marked = pc.replace_substring_regex(pc.utf8_replace_slice(texts, start=0, stop=0, replacement="\x01"), pattern=_STOP, replacement="\\1 \x01\\2\\3")
        pieces = pc.split_pattern(pc.replace_substring(marked, pattern="\n", replacement=" \n"), pattern=" ")
        each = pieces.flatten().dictionary_encode()
        found = self._of_pieces(each.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(found), self.dtype)
        at = each.indices.to_numpy()
        ids = []
        for low in range(0, len(at), GROUP_PIECES):
            part = at[low : low + GROUP_PIECES]
            n = sizes[part]
            ends = np.cumsum(n)
            ids.append(flat[np.repeat(starts[part] - ends + n, n) + np.arange(ends[-1])])
        ids = np.concatenate(ids)
        bounds = np.concatenate(([0], np.cumsum(sizes[at])))[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()]
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Id bytes of each text; a null is an empty text. The texts should be a few megabytes together."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        column = pc.fill_null(column, "")
        if not self.by_pieces:
            return [self._library([t])[0] for t in column.to_pylist()]
        out: list[bytes | None] = [None] * len(column)
        unsure = pc.match_substring_regex(column, pattern=_UNSURE).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(unsure).tolist():
            out[i] = self._library([column[i].as_py()])[0]
        sure = np.flatnonzero(~unsure)
        if len(sure):
            for i, ids in zip(sure.tolist(), self._encode_cut(column.take(pa.array(sure)) if len(sure) < len(column) else column), strict=True):
                out[i] = ids
        return out


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keep_special_text: bool = False) -> PieceEncoder:
    """This worker's encoder for a tokenizer file; loaded once."""
    key = (path, keep_special_text)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, keep_special_text)
    return _encoders[key]
