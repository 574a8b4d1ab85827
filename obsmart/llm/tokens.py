"""Token ids of whole texts, encoded word by distinct word.

The given tokenizer drops white space and never lets a token span it, so the
ids of a text are the ids of its words, one after another. Each task encodes
a word once and looks it up afterwards; the cache is bounded and only saves time.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from obsmart.llm.common import texts

#: Ends each document.
END_ID = 2


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class WordEncoder:
    """Encodes columns of texts with a tokenizer that splits at white space,
    separates letters from other signs and lower-cases."""

    #: Words of plain letters that go through the tokenizer in one call.
    CHUNK = 1000
    #: Chunks a call: what the tokenizer returns takes some 1 kB a word until it is read.
    CALL = 16
    #: Letters that neither normalizing nor lower-casing changes; words of
    #: these alone need no more than the tokenizer's byte spelling and merges.
    PLAIN = "^[a-zß-öø-ÿ]+$"

    def __init__(self, path: str, cache_words: int = 250_000):
        # one thread a worker: Spark runs a worker a core, and each thread keeps memory of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: Normalizer and splitting of whole words, and those that words of plain letters need.
        self.whole = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        self.plain = (
            normalizers.Sequence([]),
            pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]),
        )
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.cache_words = cache_words
        self.ends_word = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def _learn(self, words: pa.Array) -> None:
        flats, sizes = [], []
        for at in range(0, len(words), self.CHUNK * self.CALL):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words.slice(at, self.CHUNK * self.CALL).to_pylist(), add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flats.append(np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum())))
            sizes.append(lengths)
        self._keep(words, np.concatenate(flats), np.concatenate(sizes))

    def _learn_plain(self, words: pa.Array) -> None:
        """Joined by spaces, each word ends at its one token with a word end.
        Where the counts don't agree, each is encoded alone."""
        flats, sizes, learnt = [], [], 0
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.plain
        try:
            for at in range(0, len(words), self.CHUNK * self.CALL):
                part = words.slice(at, self.CHUNK * self.CALL)
                chunks = [part.slice(i, self.CHUNK) for i in range(0, len(part), self.CHUNK)]
                joined = self.tokenizer.encode_batch_fast([" ".join(c.to_pylist()) for c in chunks], add_special_tokens=False)
                for chunk, encoding in zip(chunks, joined, strict=True):
                    ids = np.array(encoding.ids, np.uint32)
                    ends = np.flatnonzero(self.ends_word[ids]) + 1
                    if len(ends) == len(chunk) and ends[-1] == len(ids):
                        flats.append(ids)
                        sizes.append(np.diff(ends, prepend=0))
                        learnt += len(chunk)
        finally:
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.whole
        if learnt < len(words):
            return self._learn(words)
        return self._keep(words, np.concatenate(flats), np.concatenate(sizes))

    def _keep(self, words: pa.Array, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, flat])
        self.known = pa.concat_arrays([self.known, words])

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where each distinct piece is in the cache; unknown ones are learnt."""
        at = pc.index_in(pieces, value_set=self.known)
        if not at.null_count:
            return at.to_numpy(zero_copy_only=False)
        missing = pieces.filter(at.is_null())
        if len(self.known) + len(missing) > self.cache_words:
            self._forget()
            missing, at = pieces, pa.nulls(len(pieces), pa.int32())
        plain = pc.match_substring_regex(missing, self.PLAIN)
        order = pa.concat_arrays([missing.filter(plain), missing.filter(pc.invert(plain))])
        first = len(self.known)
        if n := pc.sum(plain).as_py():
            self._learn_plain(order.slice(0, n))
        if n < len(order):
            self._learn(order.slice(n))
        out = at.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        plain = plain.to_numpy(zero_copy_only=False)
        rank = np.where(plain, np.cumsum(plain), n + np.cumsum(~plain)) - 1
        out[out < 0] = first + rank
        return out

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, laid end to end, with each word's start and length."""
        if pc.any(pc.match_substring(words, "<|")).as_py():  # may be a special token: nothing is changed
            place = self._places(words)
            return self.ids, self.starts[place], self.lengths[place]
        parted = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(words), r"(\pL)([.,!?;:]+)", r"\1 \2"))
        bounds = parted.offsets.to_numpy().astype(np.int64)
        coded = parted.flatten().dictionary_encode()
        place = self._places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        flat, ends = self._gather(self.ids, self.starts[place], self.lengths[place])
        starts = ends[bounds[:-1] - bounds[0]]
        return flat, starts, ends[bounds[1:] - bounds[0]] - starts

    @staticmethod
    def _gather(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])], ends

    #: A longer text is cut at white space and encoded piece by piece.
    LONG_BYTES = 16 << 20

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text followed by the end id, and how many each text has."""
        if len(column) == 1 and column.nbytes > self.LONG_BYTES and column[0].is_valid:
            return self._encode_long(column[0].as_py())
        return self._encode(column)

    def _encode_long(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found, begin = [], 0
        while begin < len(text):
            cut = re.compile(r"[\x20\x09-\x0D]").search(text, begin + self.LONG_BYTES // 4)
            end = cut.start() if cut else len(text)
            found.append(self._encode(pa.array([text[begin:end]], pa.large_string()))[0][:-1])
            begin = end
        ids = np.concatenate([*found, np.array([END_ID], np.uint32)])
        return ids, np.array([len(ids)])

    def _encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(texts(column))
        bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        flat, ends = np.empty(0, np.uint32), np.zeros(1, np.int64)
        if len(coded):
            ids, starts, lengths = self._words(coded.dictionary)
            word = coded.indices.to_numpy(zero_copy_only=False)
            flat, ends = self._gather(ids, starts[word], lengths[word])
        counts = ends[bounds[1:]] - ends[bounds[:-1]] + 1
        out = np.full(len(flat) + len(column), END_ID, np.uint32)
        keep = np.ones(len(out), bool)
        keep[np.cumsum(counts) - 1] = False
        out[keep] = flat
        return out, counts


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per Python worker and tokenizer."""
    return WordEncoder(path)


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
