"""Encoding with a word-level BPE file of the tokenizers library, one call per *distinct* piece.

The file's pre-tokeniser never crosses white space and its normaliser acts on each word alone, so the
ids of a text are the ids of its words one after another.  A word in plain letters is lower-cased and
cut between its last letter or digit and the signs after it, where the pre-tokeniser always cuts.
Splitting and coding run in Arrow, and only pieces not met before reach the library: the same ids as
encoding whole texts, at a fraction of the time.
"""

from __future__ import annotations

import json
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kestrel.llm.common import Words

#: pieces kept between batches; the cache is emptied beyond that, so memory stays bounded
CACHE_PIECES = 300_000
#: pieces joined in one call of the library
_JOINED = 200
_MARK = "\x01"
#: below U+0180 no character has another composed form, and each lower-cases alone; U+0130 gives two characters
_OTHER = r"[^\x{00}\x{02}-\x{12F}\x{131}-\x{17F}]"
_SIGNS = ".,;:!?*#$%&|"


_DIGITS = pa.array(list("0123456789"), pa.large_string())


def _rest(strings: pa.Array, heads: pa.Array) -> pa.Array:
    """What is left of each string after its head."""
    n = len(strings)
    starts = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset: strings.offset + n + 1]
    left = pc.binary_length(heads).to_numpy(zero_copy_only=False)
    size = np.diff(starts) - left
    ends = np.concatenate([[0], np.cumsum(size)])
    place = np.repeat(starts[:-1] + left - ends[:-1], size) + np.arange(ends[-1])
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[place]
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.vocab_size = self.whole.get_vocab_size()
        #: the same file for pieces in normal form, and for such pieces of letters only
        self.normal = Tokenizer.from_str(json.dumps(spec | {"normalizer": None}))
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.letters = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {
            "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}}))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        mark = self.whole.encode(_MARK, add_special_tokens=False).ids
        suffix = spec["model"].get("end_of_word_suffix")
        kinds = [k.get("type") for k in (spec.get("normalizer") or {}).get("normalizers", [])]
        #: the shortcuts are made for files of this make; any other is asked word by word
        self.shortcut = len(mark) == 1 and bool(suffix) and kinds == ["NFC", "Replace", "Lowercase"]
        self.mark = mark[0] if mark else -1
        self.ends_word = np.zeros(self.vocab_size + 1, bool)
        for token, i in self.whole.get_vocab().items():
            self.ends_word[i] = bool(suffix) and token.endswith(suffix)
        self.forget()

    def forget(self) -> None:
        """Empty the cache of pieces."""
        self.code: dict[str, int] = {"": 0}
        self.size, self.start, self.pool = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _pieces(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(core, tail) of each distinct word; a core after _MARK is a word the library must see whole."""
        hard = pc.match_substring_regex(words, _OTHER)
        for s in self.special:
            hard = pc.or_(hard, pc.match_substring(words, s))
        lower = pc.utf8_lower(words)
        core = pc.utf8_rtrim(lower, _SIGNS)
        last = pc.utf8_slice_codeunits(core, -1)
        whole = pc.or_(hard, pc.invert(pc.or_(pc.utf8_is_alpha(last), pc.is_in(last, _DIGITS))))
        core = pc.if_else(whole, lower, core)
        tail = _rest(lower, core)
        seen = pc.binary_join_element_wise(pa.scalar(_MARK, words.type), words, pa.scalar("", words.type))
        return pc.if_else(hard, seen, core), tail

    def _learn(self, new: list[str]) -> None:
        """Give each new piece a code and its ids."""
        hard = [p for p in new if p[0] == _MARK]
        plain = [p for p in new if p[0] != _MARK]
        alpha = [p for p in plain if p.isalpha()]
        other = [p for p in plain if not p.isalpha()]
        ids, sizes = [], []
        for pieces, tokenizer, sep in ((alpha, self.letters, " "), (other, self.normal, f" {_MARK} ")):
            blocks = [sep.join(pieces[i: i + _JOINED]) for i in range(0, len(pieces), _JOINED)]
            for e in tokenizer.encode_batch_fast(blocks, add_special_tokens=False) if blocks else []:
                got = np.array(e.ids, np.uint32)
                if sep == " ":  # one pre-token a piece: it ends with a word-end token
                    ends = np.flatnonzero(self.ends_word[got]) + 1
                    sizes.append(np.diff(ends, prepend=0))
                else:
                    at = np.flatnonzero(got == self.mark)
                    sizes.append(np.diff(np.concatenate([[-1], at, [len(got)]])) - 1)
                    got = got[got != self.mark]
                ids.append(got)
        for e in self.whole.encode_batch_fast([p[1:] for p in hard], add_special_tokens=False) if hard else []:
            ids.append(np.array(e.ids, np.uint32))
            sizes.append(np.array([len(e.ids)]))
        size = np.concatenate(sizes)
        assert len(size) == len(new), "the tokenizer file cuts pieces in a way not foreseen"
        first = len(self.pool)
        for p, i in zip(alpha + other + hard, range(len(self.size), len(self.size) + len(new))):
            self.code[p] = i
        self.start = np.concatenate([self.start, first + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.pool = np.concatenate([self.pool, *ids])

    def _codes(self, pieces: pa.Array) -> np.ndarray:
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = np.fromiter(map(self.code.get, distinct, repeat(-1)), np.int64, len(distinct))
        if (missing := np.flatnonzero(codes < 0)).size:
            self._learn([distinct[i] for i in missing])
            codes[missing] = [self.code[distinct[i]] for i in missing]
        return codes[coded.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of each text in them: one more than texts)."""
        w = Words(texts)
        if len(self.code) > CACHE_PIECES:
            self.forget()
        if self.shortcut:
            core, tail = self._pieces(w.distinct)
        else:
            core = pc.binary_join_element_wise(pa.scalar(_MARK, w.distinct.type), w.distinct, pa.scalar("", w.distinct.type))
            tail = pa.nulls(len(w.distinct), w.distinct.type).fill_null("")
        codes = np.stack([self._codes(core), self._codes(tail)], axis=1)[w.codes].reshape(-1)
        size = self.size[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.start[codes] - ends[:-1], size) + np.arange(ends[-1])
        return self.pool[place], ends[2 * w.offsets]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
