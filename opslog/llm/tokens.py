"""Token ids by a public tokenizer file, once per distinct word of a batch.

The tokenizer lower-cases, cuts at white space and merges bytes within words,
so a text's ids are its words' ids in order. A batch of texts is cut at ASCII
white space and its words are numbered by Arrow; each distinct word is encoded
once, and the texts' ids are gathered from those by offsets. Words of plain Latin
characters are cut at the file's own word pattern and their pieces go straight to
the library's merge model; a piece's ids are kept from batch to batch in a bounded
table (emptied when full). Any other word (one with white space beyond ASCII in
it, for instance), and any that could hold a special token, goes through the
library's whole pipeline.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
# Entries kept in a worker's table of the pieces that words are made of: about 200 bytes each.
PIECES_KEPT = 500_000
# Bytes of text whose words are numbered together; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20

# Characters whose case folding, normal form and class need no Unicode tables.
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_ONE_PIECE = f"^[{_LETTERS}]+$"
_PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class _Table(dict):
    """A bounded table: a missing entry is made, and a full table emptied first."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """``batches(texts)`` gives the ids of texts as 16-bit numbers; ``ids(text)`` those of one, as little-endian bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        if self.full.get_vocab_size() > 1 << 16:
            raise ValueError("ids above 65535 do not fit this encoder")
        self.merge = self.full.model.tokenize
        self.pieces = _Table(self._piece, PIECES_KEPT)
        # the printable stand-in of each byte, as in the tokenizer's byte alphabet
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        self.byte_text = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def _piece(self, piece: str) -> bytes:
        as_text = piece if piece.isascii() else "".join(map(self.byte_text.__getitem__, piece.encode()))
        return np.array([t.id for t in self.merge(as_text)], "<u2").tobytes()

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(word.lower())))
        return self._whole(word)

    def _whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def batches(self, texts: pa.Array, batch_bytes: int = BATCH_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets) of consecutive slices of ``texts``: text k of a slice has ids[offsets[k]:offsets[k + 1]]."""
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(size) - size
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(before + size, before[first] + batch_bytes, "right")))
            found = self._batch(pc.fill_null(texts.slice(first, last - first), ""))
            # lists and words are done with; Arrow's pool would keep their memory for the worker's lifetime
            pa.default_memory_pool().release_unused()
            yield found
            first = last

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = pc.match_substring(texts, "<|")
        # case folds here as in the tokenizer, so that one entry serves all cases; special tokens keep theirs
        lists = pc.ascii_split_whitespace(pc.if_else(marked, texts, pc.ascii_lower(texts)))
        words = lists.flatten().dictionary_encode()
        whole = pc.match_substring_regex(words.dictionary, _ONE_PIECE).to_pylist()
        coded = [self.pieces[w] if one else self._word(w) for w, one in zip(words.dictionary.to_pylist(), whole)]
        n = np.fromiter(map(len, coded), np.int32, len(coded)) // 2
        start = np.cumsum(n, dtype=np.int32) - n
        which = words.indices.to_numpy()
        own = n[which]
        ends = np.concatenate(([0], np.cumsum(own)))
        at = np.arange(ends[-1], dtype=np.int32) + np.repeat((start[which] - ends[:-1]).astype(np.int32), own)
        return np.frombuffer(b"".join(coded), "<u2")[at], ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]

    def ids(self, text: str | None) -> bytes:
        return self._batch(pa.array([text or ""], pa.string()))[0].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path or default_path())
