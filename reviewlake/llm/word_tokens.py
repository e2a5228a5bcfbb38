"""Ids of whole texts by a word-level BPE file, each distinct word encoded once.

Normalisation (composition, white space, lower case), splitting and merging of
``word_bpe_49k`` never reach across white space, and its special tokens hold
none: the ids of a text are the ids of its words, one after the other. So a
word's ids come from the tokenizer when it is first seen and from a table
after. Words are cut at ASCII white space, and where an ASCII letter or digit
meets ASCII punctuation (but for the apostrophe): there the file's own split
always cuts too. All other separators are left to the tokenizer.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PUNCT = r"[!-&(-/:-@\[-`{-~]"
# a mark that could join a letter, or the start of a special token: such texts are cut at white space only
_RAW = "<\\||[\u0300-\u036f]"
# lower-case letters only: one piece of the file's split, unchanged by its normalisation
_ONE = re.compile("[a-zß-öø-ÿ]+")
_JOINT = 4096            # words encoded in one call
MAX_WORDS = 500_000      # words kept: each look-up hashes the whole table


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class WordEncoder:
    """A tokenizer with a bounded table of words; results don't depend on the bound."""

    def __init__(self, path: str | None = None, max_words: int = MAX_WORDS):
        import public_tokenizers as P
        from tokenizers import Tokenizer, pre_tokenizers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        path = path or P.path("word_bpe_49k.json")
        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # words that the file's normalisation and split leave alone need neither
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.max_words = max_words
        self._clear()

    def _clear(self) -> None:
        self.words = pa.array([""], pa.large_string())     # what white space at a text's ends leaves
        self.size, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Adds words that the table has not; returns their slots."""
        words = new.to_pylist()
        one = np.fromiter((bool(_ONE.fullmatch(w)) for w in words), bool, len(words))
        joint, other = new.filter(pa.array(one)), new.filter(pa.array(~one))
        ids, size = [self.ids], [self.size]
        for lo in range(0, len(joint), _JOINT):
            some = joint[lo:lo + _JOINT].to_pylist()
            ids.append(np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32))
            size.append(np.diff(np.flatnonzero(self.closes[ids[-1]]), prepend=-1))
        for lo in range(0, len(other), _JOINT):
            # an encoding takes far more memory than its ids
            some = other[lo:lo + _JOINT].to_pylist()
            made = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(made), np.uint32))
            size.append(np.fromiter(map(len, made), np.int64, len(made)))
        slots = len(self.words) + np.where(one, np.cumsum(one), len(joint) + np.cumsum(~one)) - 1
        self.words = pa.concat_arrays([self.words, joint, other])
        self.ids, self.size = np.concatenate(ids), np.concatenate(size)
        return slots

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids in each text); null is empty, ``end_id`` closes each text."""
        # a copy that starts at 0: the lower-case kernel misreads slices
        text = pc.fill_null(pc.take(texts, pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")
        cut = pc.replace_substring_regex(pc.ascii_lower(text), pattern=f"([a-z0-9])({_PUNCT})", replacement=r"\1 \2")
        cut = pc.replace_substring_regex(cut, pattern=f"({_PUNCT})([a-z0-9])", replacement=r"\1 \2")
        lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(text, _RAW), text, cut))
        found = pc.dictionary_encode(pc.list_flatten(lists))
        slots = pc.index_in(found.dictionary, value_set=self.words)
        if slots.null_count:
            if len(self.words) + slots.null_count > self.max_words:
                self._clear()
                slots = pc.index_in(found.dictionary, value_set=self.words)
        at = slots.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if slots.null_count:
            at[at < 0] = self._learn(found.dictionary.filter(slots.is_null()))
        slots = at[found.indices.to_numpy()]
        size = self.size[slots]
        ids = self.ids[ragged((np.cumsum(self.size) - self.size)[slots], size)]
        count = np.diff(np.append(0, np.cumsum(size))[lists.offsets.to_numpy()])
        if end_id is not None:
            count = count + 1
            closed = np.full(count.sum(), end_id, np.uint32)
            closed[ragged(np.cumsum(count) - count, count - 1)] = ids
            ids = closed
        return ids, count


@lru_cache(maxsize=2)
def word_encoder(path: str | None = None) -> WordEncoder:
    """One encoder per worker process, kept from task to task."""
    return WordEncoder(path)
