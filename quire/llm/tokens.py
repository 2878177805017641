"""Token ids of whole texts by a public tokenizer file, with a word cache that changes nothing.

The tokenizer's pattern never joins characters over white space and its normaliser
lower-cases, so the ids of a text are those of its white-space chunks in order, and an
ASCII capital may be lowered first.  (A text that holds "<|" is not lowered, because
special tokens are matched as written.)  Chunks that are not cached are encoded by the
tokenizer itself: plain words together, as one text of which every word is one
pre-token, and all others one by one.  Tests compare whole texts with the tokenizer.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

WORD_BPE = "word_bpe_49k.json"
#: What the last token of a word ends with.
WORD_END = "</w>"
#: Words that are encoded as one text.
TEXT_WORDS = 400
#: Chunks kept in a cache; a full cache is emptied, which costs time only.
CACHED = 500_000
#: A run of precomposed Latin letters, then ASCII punctuation (no apostrophe, which may join letters).
PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(1)
def word_tokens(path: str | None = None) -> "WordTokens":
    """The tokenizer of this process; its cache serves all tasks of a call (``serve``)."""
    return WordTokens(path)


class WordTokens:
    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.cache: dict[bytes, bytes] = {}
        self.call = ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def serve(self, call: str) -> None:
        """Empties the cache unless the last task was of the same call."""
        if call != self.call:
            self.cache.clear()
            self.call = call

    def _words(self, words: list[bytes]) -> None:
        """Encodes plain words, many in one text; the last token of each is one that ends a word."""
        for i in range(0, len(words), 20 * TEXT_WORDS):
            some = words[i : i + 20 * TEXT_WORDS]
            texts = [b" ".join(some[k : k + TEXT_WORDS]).decode() for k in range(0, len(some), TEXT_WORDS)]
            ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            edge = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
            assert len(edge) == len(some) + 1 and edge[-1] == 4 * len(ids)
            data = ids.tobytes()
            self.cache.update(zip(some, map(data.__getitem__, map(slice, edge[:-1], edge[1:]))))

    def _learn(self, chunks: set[bytes]) -> None:
        cache, parts, other = self.cache, [], set()
        for c in chunks:
            if m := PLAIN.fullmatch(c):
                parts.append((c, *m.groups()))
            else:
                other.add(c)
        self._words(list({w for _, w, _ in parts}.difference(cache)))
        other |= {p for _, _, p in parts if p and p not in cache}
        if other:
            found = self.tokenizer.encode_batch([c.decode("utf-8", "replace") for c in other], add_special_tokens=False)
            cache.update((c, np.array(e.ids, dtype="<u4").tobytes()) for c, e in zip(other, found))
        cache.update((c, cache[w] + cache[p]) for c, w, p in parts if p)

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers; new chunks of all of them are encoded together."""
        chunks = []
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            chunks.append((data if b"<|" in data else data.lower()).split())
        if len(self.cache) > CACHED:
            self.cache.clear()
        if missing := set().union(*chunks).difference(self.cache):
            self._learn(missing)
        return [b"".join(map(self.cache.__getitem__, c)) for c in chunks]

    def ids(self, text: str | None) -> bytes:
        return self.batch([text])[0]
