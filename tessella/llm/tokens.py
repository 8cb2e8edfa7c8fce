"""Token ids of texts by a public byte-level vocabulary, through the tokenizers library.

Such a vocabulary never merges across the start of a white space character that
stands before another character, so texts are cut there, each distinct piece is
encoded once, and the pieces' ids are put together again. Cutting, looking up
and putting together are array operations over all texts of a batch. New pieces
of Latin, Greek or Cyrillic letters and punctuation after them go through the
library's model in one call, already written in its byte letters; other pieces
go through the whole tokenizer. So do texts that begin with white space, that
hold rare white space or control characters, or an added token such as the end
of a text, which the library takes out of a text before all else.

Pieces are known by 64-bit hashes: two of the pieces that a worker remembers at
a time share one with a probability below 1e-7.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from tessella.llm.common import segment_hashes

#: Distinct pieces that a Python worker remembers; beyond that it keeps the last batch's.
KEPT = 1_000_000
#: Characters that are encoded at a time.
STEP = 1 << 20
#: White space other than blank and line end, and control characters on whose class libraries differ.
_RARE = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
#: Letters beyond ASCII that every library's tables know as such.
_OLD_LETTERS = "\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ʯΑ-ΡΣ-ώЀ-ҁ"
_PUNCTUATION = b".,;:!?%&$#*|\"'()-"


def _byte_letters() -> np.ndarray:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out = np.arange(256, dtype="<u4")
    out[[b for b in range(256) if b not in plain]] = 256 + np.arange(256 - len(plain))
    return out


def _two_byte_letters() -> np.ndarray:
    """Of each code point below 2048: whether it is one of the letters beyond ASCII."""
    letter = re.compile(f"[{_OLD_LETTERS}]")
    return np.array([c >= 128 and bool(letter.match(chr(c))) for c in range(2048)])


_WRITTEN = _byte_letters()
_TWO_BYTES = _two_byte_letters()
#: Classes of bytes: 1 letter, 2 punctuation, 0 anything else; bytes from 128 on are looked at in pairs.
_CLASS = np.zeros(256, np.int8)
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[list(_PUNCTUATION)] = 2


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def _load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (size[0] numbers), first[1], ... as one array."""
    before = np.cumsum(size) - size
    return np.repeat(first - before, size) + np.arange(int(size.sum()))


class Encoder:
    """``encode(texts)`` gives the ids of all texts, one after another, and how many each has."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = _load(path)
        self.model = Tokenizer(self.tokenizer.model)  # takes words in byte letters, one a line
        self.model.pre_tokenizer = CharDelimiterSplit("\n")
        vocabulary = self.tokenizer.get_vocab()
        blank, line = (chr(int(_WRITTEN[c])) for c in b" \n")
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that only a piece's start can have
        self.opens[[i for t, i in vocabulary.items() if t.startswith(blank) or t == line]] = True
        self.lead = vocabulary[line]
        added = [re.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)")
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, "<u4")
        self.size, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # --- what is remembered: sorted hashes, and where in ``ids`` each piece's are

    def _remember(self, keys: np.ndarray, ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        self.keys, self.size, self.first = (np.insert(a, at, b) for a, b in ((self.keys, keys), (self.size, size), (self.first, first + len(self.ids))))
        self.ids = np.append(self.ids, ids)

    def _keep(self, at: np.ndarray) -> None:
        """Forget all pieces but these."""
        size = self.size[at]
        self.ids = self.ids[_ragged(self.first[at], size)]
        self.keys, self.size, self.first = self.keys[at], size, np.cumsum(size) - size

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    # --- new pieces

    def _learn(self, data: np.ndarray, first: np.ndarray, size: np.ndarray, blanks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces of ``data``, where each piece's begin and how many it has; ``blanks``: pieces of white space alone."""
        raw = data[_ragged(first, size)]
        begin = np.cumsum(size) - size
        kind = _CLASS[raw]
        high = np.flatnonzero((raw >= 0xC2) & (raw < 0xE0))
        pair = high[_TWO_BYTES[((raw[high].astype(np.int64) & 31) << 6) | (raw[high + 1] & 63)]] if len(high) else high
        kind[pair] = kind[pair + 1] = 1
        kind[begin] = 3
        # plain: letters, then punctuation, and nothing else
        wrong = (kind == 0).astype(np.int32)
        wrong[1:] += (kind[1:] == 1) & (kind[:-1] == 2)
        wrong[begin] += np.append(kind, 0)[begin + 1] != 1
        plain = (np.add.reduceat(wrong, begin) == 0) & ~blanks

        found, at_id, n_ids = [], np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        chosen, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        if len(chosen):
            at = _ragged(begin[chosen], size[chosen])
            text, kind = raw[at], kind[at]
            start = np.cumsum(size[chosen]) - size[chosen]
            mark = np.flatnonzero((kind[1:] == 2) & (kind[:-1] == 1)) + 1
            after_line = start[text[start] == 10] + 1
            lines = np.insert(_WRITTEN[text], np.concatenate([start[1:], mark, after_line]), 10)
            ids = np.array(self.model.encode_batch_fast([lines.tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids, "<u4")
            at_id[chosen] = edge = np.flatnonzero(self.opens[ids])
            n_ids[chosen] = np.diff(np.append(edge, len(ids)))
            found.append(ids)
        if len(rest):
            texts = [raw[a : a + n] for a, n in zip(begin[rest], size[rest])]
            spaces = [_WRITTEN[t].tobytes().decode("utf-32-le") for t, b in zip(texts, blanks[rest]) if b]
            spaces = iter([x.ids for x in self.model.encode_batch_fast(spaces, add_special_tokens=False)])
            others = iter([x.ids for x in self.tokenizer.encode_batch_fast([t.tobytes().decode() for t, b in zip(texts, blanks[rest]) if not b], add_special_tokens=False)])
            lists = [next(spaces if b else others) for b in blanks[rest]]
            n_ids[rest] = n = np.array([len(x) for x in lists])
            at_id[rest] = sum(map(len, found)) + np.cumsum(n) - n
            found.append(np.array([i for x in lists for i in x], "<u4"))
        return np.concatenate(found), at_id, n_ids

    # --- texts

    def _by_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that neither are empty nor begin with white space."""
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"\n" + b"\n".join(raw), np.uint8)
        text_size = np.array([len(x) + 1 for x in raw])
        text_start = np.zeros(len(data) + 1, bool)
        text_start[np.cumsum(text_size) - text_size] = text_start[-1] = True
        space = np.append((data == 32) | (data == 10), True)
        before_word = space[:-1] & ~space[1:]
        run_start = space[:-1] & (text_start[:-1] | ~np.append(True, space[:-2]))
        start = np.flatnonzero(before_word | run_start)
        size = np.diff(np.append(start, len(data)))
        keys, one, each = np.unique(segment_hashes(data, start, start + size), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(np.append(self.keys, np.uint64(0))[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            self._remember(keys[new], *self._learn(data, start[one[new]], size[one[new]], ~before_word[start[one[new]]]))
            at = np.searchsorted(self.keys, keys)
        first, n = self.first[at][each], self.size[at][each]
        head = text_start[start]  # the line end that stands before each text goes again
        first, n = first + head, n - head
        out = self.ids[_ragged(first, n)]
        if len(self.keys) > KEPT:
            self._keep(at)
        return out, np.add.reduceat(n, np.flatnonzero(head))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        place = np.cumsum([len(t) for t in texts]) // STEP
        edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(texts)]
        found = [self._encode(texts[a:b]) for a, b in zip(edges, edges[1:])]
        return np.concatenate([x for x, _ in found]), np.concatenate([n for _, n in found])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = np.array([t[:1] in " \n" or bool(_RARE.search(t)) or bool(self.added.search(t)) for t in texts], bool)
        if not whole.any():
            return self._by_pieces(texts) if texts else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        out: list[np.ndarray] = [None] * len(texts)
        plain, rest = np.flatnonzero(~whole), np.flatnonzero(whole)
        if len(plain):
            ids, n = self._by_pieces([texts[i] for i in plain])
            for i, x in zip(plain, np.split(ids, np.cumsum(n)[:-1])):
                out[i] = x
        for i, x in zip(rest, self._whole([texts[i] for i in rest])):
            out[i] = x
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def encode_with_end(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after each text's ids."""
        ids, n = self.encode(texts)
        return np.insert(ids, np.cumsum(n), end_id), n + 1


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker and vocabulary, kept over tasks."""
    return Encoder(path)
