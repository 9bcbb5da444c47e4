"""Token ids of whole texts by a vocabulary file of the ``tokenizers`` library, one word at a time.

The vocabularies used here drop white space and never merge across it, so a text's ids are those of its
words in a row. Each distinct word is encoded once and looked up from then on.
"""

from __future__ import annotations

import os
import string

import numpy as np
import tokenizers

#: Words kept for later texts, and the longest one worth keeping.
KEPT_WORDS, KEPT_LENGTH = 1_000_000, 32
#: Words encoded in one call.
CALL_WORDS = 1000
#: Marks that a vocabulary's pattern parts from letters before them; an apostrophe may go on as a contraction.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _letters(word: bytes) -> bool:
    return word.isalpha() or (not word.isascii() and word.decode().isalpha())


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        letters = string.ascii_lowercase
        normal, apart = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        #: Whether the model takes words of small letters as they stand.
        self.direct = (normal is None or normal.normalize_str(letters) == letters) and (
            apart is not None and [w for w, _ in apart.pre_tokenize_str(letters)] == [letters]
        )
        self.words: dict[bytes, bytes] = {}

    @classmethod
    def shared(cls, path: str) -> WordEncoder:
        """The encoder of this Python process: a worker's next task goes on with the same words."""
        kept = tokenizers.__dict__.setdefault("shared_word_encoders", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def encoded(self, texts: list[str | bytes | None]) -> list[bytes]:
        """Ids of each text (bytes: UTF-8) as unsigned 32-bit little-endian numbers; none for null."""
        out, late, missing = [], [], set()
        for k, text in enumerate(texts):
            words = (text.encode() if isinstance(text, str) else text or b"").split()
            found = list(map(self.words.get, words))
            try:
                out.append(b"".join(found))
            except TypeError:  # some words are not known yet
                out.append(b"")
                late.append((k, words))
                missing.update([w for w, ids in zip(words, found, strict=True) if ids is None])
        self._learn(missing)
        for k, words in late:
            out[k] = b"".join(map(self.words.__getitem__, words))
        room = KEPT_WORDS - (len(self.words) - len(missing))
        for k, word in enumerate(missing):
            if k >= room or len(word) > KEPT_LENGTH:
                del self.words[word]
        return out

    def _learn(self, missing: set[bytes]) -> None:
        """Words of letters are looked up with A-Z in lower case, as the vocabulary has them, and apart from marks at their end."""
        core, tail = {}, {}
        for word in missing:
            body = word.rstrip(MARKS)
            if _letters(body):
                core[word], tail[word] = body.lower(), word[len(body) :]
            else:
                core[word], tail[word] = word, b""
        wanted = {w for w in {*core.values(), *tail.values()} if w and w not in self.words}
        fresh = self._encode_small([w for w in wanted if w.isalpha() and w.islower()]) if self.direct else {}
        plain = [w for w in wanted if w not in fresh and _letters(w)]
        for k in range(0, len(plain), CALL_WORDS):
            fresh |= self._encode_plain(plain[k : k + CALL_WORDS])
        rest = [w for w in wanted if w not in fresh]
        for k in range(0, len(rest), CALL_WORDS):
            fresh |= self._encode_each(rest[k : k + CALL_WORDS])
        known = lambda w: fresh[w] if w in fresh else self.words[w]
        self.words.update({w: known(core[w]) + (known(tail[w]) if tail[w] else b"") for w in missing})

    def _encode_small(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of small ASCII letters, which neither normalizing nor parting changes."""
        pieces = self.tokenizer.model.tokenize
        return {w: np.array([t.id for t in pieces(w.decode())], "<u4").tobytes() for w in words}

    def _encode_plain(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters in one call: each gives one run of ids, the last of which ends a word."""
        ids = np.array(self.tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False).ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words) or (len(stops) and stops[-1] != len(ids)):
            return self._encode_each(words)
        data, at = ids.tobytes(), (stops * 4).tolist()
        return {w: data[a:b] for w, a, b in zip(words, [0, *at[:-1]], at, strict=True)}

    def _encode_each(self, words: list[bytes]) -> dict[bytes, bytes]:
        found = self.tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False)
        return {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(words, found, strict=True)}
