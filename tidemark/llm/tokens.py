"""Token ids of whole texts by the tokenizers library, each distinct word encoded once."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tidemark.llm.words import blocks, released

END_ID = 1


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts word by word, each distinct word once.

    Words are parted by ASCII white space, and a word of ASCII letters ends before one of .,;:!?
    too. The vocabulary's normaliser and splitter never join across those places, and they lower
    letters themselves, so the ids of a text are those of its words in turn. What is remembered
    is emptied at `most` words, which changes no result.
    """

    def __init__(self, path: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        self.size = self.tokenizer.get_vocab_size()
        self.closes = np.zeros(self.size, dtype=bool)
        self.closes[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.starts, self.ids, self.total = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 18, dtype=np.uint32), 0

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter((x for f in found for x in f), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters alone are one piece each, which ends at an id that closes a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):
            return self._each(words)
        return ids, np.diff(ends, prepend=0)

    def _learn(self, keys: list[int], words: list[str]) -> None:
        plain = [w.isalpha() for w in words]
        for group, call in ((True, self._letters), (False, self._each)):
            rows = [i for i, x in enumerate(plain) if x is group]
            for low in range(0, len(rows), 1000):
                part = rows[low : low + 1000]
                ids, lengths = call([words[i] for i in part])
                size = len(self.known)
                while size + len(part) + 1 > len(self.starts):
                    self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
                while self.total + len(ids) > len(self.ids):
                    self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
                self.known.update(zip((keys[i] for i in part), range(size, size + len(part)), strict=True))
                self.ids[self.total : self.total + len(ids)] = ids
                self.starts[size + 1 : size + len(part) + 1] = self.total + np.cumsum(lengths)
                self.total += len(ids)

    def encode(self, column: pa.Array):
        """Yields (row, ids of its text as uint32) for every row."""
        for low, block in blocks(column, 1 << 20, marks=True):  # small, as a block's arrays take many times its bytes
            block.lowered_letters()
            distinct, at, which = np.unique(block.hashes(), return_index=True, return_inverse=True)
            if len(self.known) > self.most:
                self.forget()
            keys = distinct.tolist()
            new = [i for i, h in enumerate(keys) if h not in self.known]
            if new:
                raw, b, e = block.data.tobytes(), block.begin[at[new]].tolist(), block.end[at[new]].tolist()
                self._learn([keys[i] for i in new], [raw[i:j].decode() for i, j in zip(b, e, strict=True)])
            place = np.fromiter(map(self.known.__getitem__, keys), dtype=np.int64, count=len(keys))[which]
            start = self.starts[place]
            length = self.starts[place + 1] - start
            ends = np.concatenate([[0], np.cumsum(length)])
            ids = self.ids[np.arange(ends[-1]) + np.repeat(start - ends[:-1], length)]
            cuts = ends[block.first].tolist()
            for i in range(len(block)):
                yield low + i, ids[cuts[i] : cuts[i + 1]]

    def finished(self) -> None:
        """Forget the words at the end of a task, so that a waiting worker holds the vocabulary alone."""
        self.forget()
        released()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for the vocabulary; the vocabulary stays loaded for later tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
